"""Reading and writing files: tables are written in the source formats and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.charset import to_latin
from tradeloom.functions.text import null_if_token
from tradeloom.operators import lifecycle as L
from tradeloom.operators.serving import export_csv, table_structure
from tradeloom.operators.store import LayerStore
from tradeloom.rehearsal.registry import Tables, query
from tradeloom.session import scratch_path
from tradeloom.sources.archives import member_date, tab_fields
from tradeloom.sources.delimited import (
    LATIN,
    files_matching,
    ragged_rows,
    read_by_name,
    read_delimited,
    read_without_empty_quotes,
)
from tradeloom.sources.upload import infer_types, profile
from tradeloom.streaming.incremental import ingest_new_files

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def written_csv(t: Tables, rows: DataFrame, name: str, **options) -> str:
    path = scratch_path(t.spark, name)
    rows.write.options(header=True, escape='"', **options).csv(path)
    return path


@query("scan_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv(t: Tables) -> DataFrame:
    """Columns are taken by position: the file's header uses other names."""
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    rows = t.customer.select([F.col(c).alias(f"header {i}") for i, c in enumerate(columns)])
    return read_delimited(t.spark, written_csv(t, rows, "customers", quoteAll=True), CUSTOMER)


@query(
    "scan_csv_empty_as_null",
    """SELECT o_orderkey, nullif(o_orderstatus, 'O') AS status,
              CASE WHEN o_orderpriority = '5-LOW' THEN 'very low' ELSE o_orderpriority END AS priority FROM orders""",
)
def scan_csv_empty_as_null(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", F.lit("")).otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit('very "low"')).otherwise(F.col("o_orderpriority")).alias("priority"),
    )
    path = written_csv(t, rows, "orders", quoteAll=True)
    return read_without_empty_quotes(t.spark, path, "o_orderkey bigint, status string, priority string")


@query(
    "scan_csv_cp1252",
    "SELECT c_custkey, c_name || ' €–™' AS name, CASE WHEN c_nationkey % 2 = 0 THEN 'Œuvre é' ELSE 'ž' END AS remark FROM customer",
)
def scan_csv_cp1252(t: Tables) -> DataFrame:
    rows = t.customer.select(
        "c_custkey",
        to_latin(F.concat("c_name", F.lit(" €–™")), "cp1252").alias("name"),
        to_latin(F.when(F.col("c_nationkey") % 2 == 0, F.lit("Œuvre é")).otherwise(F.lit("ž")), "cp1252").alias("remark"),
    )
    path = written_csv(t, rows, "cp1252", encoding=LATIN)
    return read_delimited(t.spark, path, "c_custkey bigint, name string, remark string", charset="cp1252")


@query(
    "scan_tab_lines",
    """WITH parts AS (SELECT doc_id, string_split(replace(text, '"', ''), ' ') AS p FROM documents)
    SELECT doc_id, p[1] AS f1, p[2] AS f2, p[3] AS f3, p[4] AS f4, p[5] AS f5, p[6] AS f6, p[7] AS f7, p[8] AS f8, p[9] AS f9, array_to_string(list_filter(p[10:], lambda x: x <> ''), ',') AS rest
    FROM parts WHERE len(p) >= 10""",
)
def scan_tab_lines(t: Tables) -> DataFrame:
    names = [f"f{i}" for i in range(1, 10)]
    fields = tab_fields(t.documents.select("doc_id", F.col("text").alias("line")), names, "rest", sep=" ")
    return fields.select("doc_id", *names, "rest")


@query(
    "member_regex_date",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS published
    FROM orders""",
)
def member_regex_date(t: Tables) -> DataFrame:
    stamp = F.upper(F.date_format("o_orderdate", "MMM_yyyy"))
    tail = F.when(F.col("o_orderstatus") == "P", F.lit("_UK.txt")).otherwise(F.lit("_UK.csv"))
    member = F.concat(F.lit("Data/ONSPD_"), stamp, tail)
    return t.orders.select(
        "o_orderkey", member_date(member, r"(?:.*?)/ONSPD_(\w{3}_\d{4})_UK\.csv$", "MMM_yyyy").alias("published")
    )


@query(
    "null_token_scan",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('5-LOW', '1-URGENT', '2-HIGH') THEN NULL ELSE o_orderpriority END AS priority,
              CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS price FROM orders""",
)
def null_token_scan(t: Tables) -> DataFrame:
    priority = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("NULL"))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit("null"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit(""))
        .otherwise(F.col("o_orderpriority"))
    )
    price = F.when(F.col("o_orderstatus") == "F", F.lit("NULL")).otherwise(F.col("o_totalprice").cast("string"))
    rows = t.orders.select(price.alias("Total"), F.col("o_orderkey").alias("Key"), priority.alias("Priority"))
    names = {"Key": "o_orderkey", "Priority": "priority", "Total": "price"}
    path = written_csv(t, rows, "model", quoteAll=True)
    return read_by_name(t.spark, path, "o_orderkey bigint, priority string, price double", names)


@query(
    "ragged_rows",
    """SELECT o_orderkey, 3 + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END - CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS n_cells,
              3 AS n_headers FROM orders WHERE o_orderstatus IN ('P', 'F')""",
)
def ragged_rows_query(t: Tables) -> DataFrame:
    """Open orders have three cells, one with a quoted separator; the others one too many or too few."""
    cells = [F.col("o_orderkey").cast("string"), F.lit('"a, ""b"""')]
    line = (
        F.when(F.col("o_orderstatus") == "P", F.concat_ws(",", *cells, F.lit(""), F.lit("x")))
        .when(F.col("o_orderstatus") == "F", F.concat_ws(",", *cells))
        .otherwise(F.concat_ws(",", *cells, F.lit("x")))
    )
    lines = t.orders.select("o_orderkey", line.alias("line"))
    return ragged_rows(lines, 3).select("o_orderkey", "n_cells", "n_headers")


def upload_columns(t: Tables) -> DataFrame:
    """Text columns of an upload, one of each type and one that is almost numeric."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.orders.select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("key"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise((F.col("o_orderstatus") == "O").cast("string")).alias("open"),
        day.alias("day"),
        F.concat(day, F.lit("T16:30:00Z")).alias("moment"),
        F.when(F.col("o_orderkey") == 7, F.lit("n.a.")).otherwise(F.col("o_custkey").cast("string")).alias("mixed"),
        F.lit("").alias("blank"),
    )


TYPES_SQL = """SELECT * FROM (VALUES (1, 'key', 'integer'), (2, 'price', 'numeric'), (3, 'open', 'boolean'), (4, 'day', 'date'),
    (5, 'moment', 'timestamp'), (6, 'mixed', 'text'), (7, 'blank', 'text')) v(position, "column", type)
    WHERE (SELECT count(*) FROM orders WHERE o_orderkey = 7) = 1"""


@query("infer_types", TYPES_SQL)
def infer_types_query(t: Tables) -> DataFrame:
    return infer_types(upload_columns(t))


@query(
    "csv_profile",
    """WITH first AS (SELECT * FROM orders ORDER BY o_orderkey LIMIT 4),
    s AS (SELECT
      string_agg(lpad(CAST(o_orderkey AS VARCHAR), 12, '0'), '|' ORDER BY o_orderkey) AS key,
      string_agg(CAST(o_totalprice AS VARCHAR), '|' ORDER BY o_orderkey) AS price,
      string_agg(CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_orderstatus = 'O' AS VARCHAR) END, '|' ORDER BY o_orderkey) AS open,
      string_agg(strftime(o_orderdate, '%Y-%m-%d'), '|' ORDER BY o_orderkey) AS day,
      string_agg(strftime(o_orderdate, '%Y-%m-%dT16:30:00Z'), '|' ORDER BY o_orderkey) AS moment,
      string_agg(CASE WHEN o_orderkey = 7 THEN 'n.a.' ELSE CAST(o_custkey AS VARCHAR) END, '|' ORDER BY o_orderkey) AS mixed,
      string_agg('', '|' ORDER BY o_orderkey) AS blank
    FROM first)
    SELECT 'key' AS "column", 'integer' AS type, key AS samples FROM s
    UNION ALL SELECT 'price', 'numeric', price FROM s
    UNION ALL SELECT 'open', 'boolean', open FROM s
    UNION ALL SELECT 'day', 'date', day FROM s
    UNION ALL SELECT 'moment', 'timestamp', moment FROM s
    UNION ALL SELECT 'mixed', CASE WHEN (SELECT count(*) FROM orders WHERE o_orderkey = 7) = 1 THEN 'text' ELSE 'integer' END, mixed FROM s
    UNION ALL SELECT 'blank', 'text', blank FROM s""",
)
def csv_profile(t: Tables) -> DataFrame:
    """All seven columns of the upload: the first rows by key, and types from every row."""
    found = profile(upload_columns(t), order_by="key")
    return found.select("column", "type", F.array_join("samples", "|").alias("samples"))


@query(
    "file_listing",
    r"""SELECT page_id, url FROM pages WHERE regexp_matches(url, '/(en|fr)/\d+')""",
)
def file_listing(t: Tables) -> DataFrame:
    return files_matching(t.pages.select("page_id", "url"), r"/(en|fr)/\d+", column="url")


@query(
    "table_structure",
    """SELECT 1 AS position, 'o_orderkey' AS "column", 'bigint' AS data_type, count(o_orderkey) AS n_values FROM orders
    UNION ALL SELECT 2, 'status', 'string', count(nullif(o_orderstatus, 'F')) FROM orders
    UNION ALL SELECT 3, 'day', 'date', count(o_orderdate) FROM orders""",
)
def table_structure_query(t: Tables) -> DataFrame:
    """Lineage columns are hidden."""
    rows = t.orders.select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("status"), F.to_date("o_orderdate").alias("day"), F.lit("f.csv").alias("datafile_created")
    ).withColumn("data_hash", F.lit("x"))
    return table_structure(rows)


@query(
    "export_csv_null_token",
    """SELECT 'Customer key,segment,balance' AS line WHERE (SELECT count(*) FROM customer) > 0
    UNION ALL SELECT CAST(c_custkey AS VARCHAR) || ',' || CASE WHEN c_mktsegment = 'BUILDING' THEN 'NULL' ELSE c_mktsegment END || ',' ||
      CASE WHEN c_nationkey = 1 THEN 'NULL' ELSE CAST(c_nationkey AS VARCHAR) END FROM customer""",
)
def export_csv_null_token(t: Tables) -> DataFrame:
    """Every part of the export repeats the header, so the lines are made distinct."""
    path = scratch_path(t.spark, "export")
    export_csv(
        t.customer.select(
            F.col("c_custkey").alias("Customer key"),
            F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
            F.nullif("c_nationkey", F.lit(1)).alias("balance"),
        ),
        path,
    )
    return t.spark.read.text(path).select(F.col("value").alias("line")).distinct()


def _store(t: Tables, name: str) -> LayerStore:
    return LayerStore(t.spark, scratch_path(t.spark, name))


@query(
    "append_with_lineage",
    """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'P' THEN 'second.csv' ELSE 'first.csv' END AS datafile_created
    FROM orders""",
)
def append_with_lineage(t: Tables) -> DataFrame:
    store = _store(t, "append")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    first = store.append("orders", L.append_file(None, rows.where("o_orderstatus <> 'P'"), "first.csv"))
    both = store.append("orders", L.append_file(first, rows.where("o_orderstatus = 'P'"), "second.csv"))
    return both.select("o_orderkey", "o_totalprice", "datafile_created")


@query(
    "incremental_append",
    """WITH loads(file) AS (VALUES ('a.csv'), ('a.csv'), ('b.csv'))
    SELECT file AS datafile_created, lower(c_name) AS company_name, c_custkey, count(*) AS copies
    FROM customer JOIN loads ON (file = 'b.csv') = (c_nationkey < 5) GROUP BY ALL""",
)
def incremental_append(t: Tables) -> DataFrame:
    """Loading a file twice doubles its rows; every L1 row points to its own L0 row."""
    store = _store(t, "incremental")
    l0, l1 = None, None
    for file in ("a.csv", "a.csv", "b.csv"):
        rows = t.customer.select("c_custkey", "c_name").where("c_nationkey < 5" if file == "b.csv" else "c_nationkey >= 5")
        top = 0 if l0 is None else l0.agg(F.max("id")).first()[0]
        l0 = store.append("L0", L.append_file(l0, rows, file))
        fresh = l0.where(F.col("id") > top)
        l1 = store.append("L1", L.incremental_l1(fresh, l1, ["company_name", "c_custkey"], {"company_name": F.lower("c_name")}))
    return (
        l1.join(l0.select(F.col("id").alias("data_source_row_id"), "datafile_created"), "data_source_row_id")
        .groupBy("datafile_created", "company_name", "c_custkey")
        .agg(F.count("*").alias("copies"))
    )


@query("full_replace", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def full_replace(t: Tables) -> DataFrame:
    """Each file replaces the table, so only the last one is left."""
    store = _store(t, "replace")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    for status in ("O", "P", "F"):
        result = store.publish("orders", rows.where(F.col("o_orderstatus") == status), status)
    return result


@query(
    "swap_publish",
    "SELECT o_orderkey, o_totalprice * 2 AS price FROM orders WHERE o_orderstatus <> 'P'",
)
def swap_publish(t: Tables) -> DataFrame:
    """The new version is computed from the one it replaces."""
    store = _store(t, "swap")
    current = store.publish("orders", t.orders.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price")))
    return store.publish(
        "orders", current.where("o_orderstatus <> 'P'").select("o_orderkey", (F.col("price") * 2).alias("price"))
    )


@query("restore_version", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'")
def restore_version(t: Tables) -> DataFrame:
    store = _store(t, "restore")
    for status in ("O", "P"):
        store.publish("orders", t.orders.select("o_orderkey", "o_orderstatus").where(F.col("o_orderstatus") == status), status)
    return store.restore("orders", 1)


@query(
    "incremental_files",
    """SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_nationkey < 10 THEN 'batch-0' ELSE 'batch-1' END AS first_seen FROM customer""",
)
def incremental_files(t: Tables) -> DataFrame:
    """Two runs of the stream, the second one after more files arrived, and a third that finds nothing."""
    folder, store = scratch_path(t.spark, "inbox"), _store(t, "stream")
    checkpoint = scratch_path(t.spark, "stream-checkpoint")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    schema = "c_custkey bigint, c_name string, c_acctbal double, c_nationkey int"
    for part in ("c_nationkey < 10", "c_nationkey >= 10"):
        rows.where(part).write.mode("append").parquet(folder)
        ingest_new_files(store, "customers", folder, schema, checkpoint)
    ingest_new_files(store, "customers", folder, schema, checkpoint)
    return store.read("customers").select("c_custkey", "c_name", "c_acctbal", F.col("datafile_created").alias("first_seen"))


@query(
    "null_token_in_cell",
    """SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN NULL ELSE source END AS source FROM documents""",
)
def null_token_in_cell(t: Tables) -> DataFrame:
    cell = F.when(F.col("lang") == "en", F.lit("NULL")).when(F.col("lang") == "fr", F.lit("")).otherwise(F.col("source"))
    return t.documents.select("doc_id", null_if_token(cell).alias("source"))
