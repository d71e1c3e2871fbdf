"""Cleaning functions over text, codes, dates and numbers made from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions import text as X
from tradeloom.rehearsal.registry import Tables, query


@query(
    "parse_yyyymm",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN date_trunc('month', o_orderdate)::TIMESTAMP END AS moment,
              CASE WHEN o_orderstatus <> 'P' THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS day FROM orders""",
)
def parse_yyyymm(t: Tables) -> DataFrame:
    """Text that is no month gives nothing instead of failing."""
    code = F.when(F.col("o_orderstatus") == "P", F.lit("month 13")).otherwise(F.date_format("o_orderdate", "yyyyMM"))
    return t.orders.select("o_orderkey", X.month_start(code).alias("moment"), X.month_date(code).alias("day"))


@query(
    "clean_name",
    "SELECT doc_id, lower(trim('  ' || text || ' LTD ')) AS name FROM documents",
)
def clean_name(t: Tables) -> DataFrame:
    raw = F.concat(F.lit("  "), "text", F.lit(" LTD "))
    return t.documents.select("doc_id", X.clean_name(raw).alias("name"))


ADDRESS_SQL = """concat_ws(' ', CASE WHEN c_nationkey % 3 <> 0 THEN c_name WHEN c_nationkey = 0 THEN ' ' END,
    CASE WHEN c_nationkey % 2 = 0 THEN '' ELSE c_mktsegment END, CASE WHEN c_nationkey % 5 <> 0 THEN 'Road ' || c_nationkey END)"""


def address_parts():
    nation = F.col("c_nationkey")
    return [
        F.when(nation % 3 != 0, F.col("c_name")).when(nation == 0, F.lit(" ")),
        F.when(nation % 2 == 0, F.lit("")).otherwise(F.col("c_mktsegment")),
        F.when(nation % 5 != 0, F.concat(F.lit("Road "), nation)),
    ]


@query("address_concat", f"SELECT c_custkey, nullif(lower(trim({ADDRESS_SQL})), '') AS address FROM customer")
def address_concat(t: Tables) -> DataFrame:
    """Missing lines are skipped, empty ones keep their separator."""
    return t.customer.select("c_custkey", X.joined_address(*address_parts()).alias("address"))


@query(
    "clean_postcode",
    """SELECT c_custkey, upper(replace('ab' || c_nationkey || ' ' || c_custkey || ' x', ' ', '')) AS postcode,
              lower(replace('ab' || c_nationkey || ' ' || c_custkey || ' x', ' ', '')) AS lookup_key FROM customer""",
)
def clean_postcode(t: Tables) -> DataFrame:
    raw = F.concat(F.lit("ab"), "c_nationkey", F.lit(" "), "c_custkey", F.lit(" x"))
    return t.customer.select("c_custkey", X.clean_postcode(raw).alias("postcode"), X.postcode_key(raw).alias("lookup_key"))


@query(
    "split_null_tokens",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'N' THEN 0 ELSE 3 END AS n_codes,
              CASE WHEN l_returnflag = 'N' THEN '' ELSE l_partkey || '|-|' || l_suppkey END AS codes FROM lineitem""",
)
def split_null_tokens(t: Tables) -> DataFrame:
    """An empty text is an empty list, an empty item is a missing one (shown as ``-``)."""
    raw = F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.concat("l_partkey", F.lit(",,"), "l_suppkey"))
    codes = X.split_codes(raw)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.size(codes).alias("n_codes"), F.array_join(codes, "|", "-").alias("codes")
    )


@query(
    "row_hash",
    """SELECT count(*) AS n_rows, count(DISTINCT (l_suppkey, coalesce(status, '<null>'), l_returnflag)) AS n_hashes,
              count(DISTINCT l_suppkey) AS n_suppliers
    FROM (SELECT *, CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber < 4 THEN '' ELSE l_linestatus END AS status FROM lineitem)""",
)
def row_hash(t: Tables) -> DataFrame:
    """Fingerprints separate exactly the rows that differ, a missing value from an empty one included."""
    status = (
        F.when(F.col("l_linenumber") == 1, F.lit(None)).when(F.col("l_linenumber") < 4, F.lit("")).otherwise(F.col("l_linestatus"))
    )
    rows = t.lineitem.select("l_suppkey", status.alias("status"), "l_returnflag")
    hashed = rows.groupBy("l_suppkey", X.row_hash("l_suppkey", "status", "l_returnflag").alias("hash")).agg(F.count("*").alias("n"))
    per_supplier = hashed.groupBy("l_suppkey").agg(F.sum("n").alias("n"), F.count("*").alias("hashes"))
    return per_supplier.agg(
        F.sum("n").alias("n_rows"), F.sum("hashes").alias("n_hashes"), F.count("*").alias("n_suppliers")
    )


@query(
    "null_token_substring",
    """SELECT doc_id, replace(replace(replace(replace(cell, 'NULL', ''), 'None', ''), 'N/A', ''), '''''', '') AS cleaned,
              CASE WHEN cell IN ('NULL', 'None', 'N/A', '''''') THEN '' ELSE cell END AS cleaned_cell
    FROM (SELECT doc_id, unnest([CASE lang WHEN 'en' THEN 'None' || text WHEN 'de' THEN text || 'N/A' WHEN 'fr' THEN '''''' || text ELSE text || ' NULL' END,
            CASE lang WHEN 'en' THEN 'None' WHEN 'de' THEN 'N/A' WHEN 'fr' THEN '''''' ELSE 'NULL' END]) AS cell FROM documents)""",
)
def null_token_substring(t: Tables) -> DataFrame:
    """Every whole text with a token before or behind it, and the token alone."""
    lang = F.col("lang")
    token = F.when(lang == "en", "None").when(lang == "de", "N/A").when(lang == "fr", "''").otherwise("NULL")
    inside = (
        F.when(lang.isin("en", "fr"), F.concat(token, "text")).when(lang == "de", F.concat("text", token))
        .otherwise(F.concat("text", F.lit(" "), token))
    )
    cell = F.col("cell")
    return t.documents.select("doc_id", F.explode(F.array(inside, token)).alias("cell")).select(
        "doc_id", X.remove_null_tokens(cell).alias("cleaned"), X.remove_null_tokens(cell, whole_cell=True).alias("cleaned_cell")
    )


@query(
    "docname_parts",
    """SELECT o_orderkey, CASE WHEN ok THEN 'Prod' || o_custkey || '_' || o_orderkey END AS run_code, CASE WHEN ok THEN 'C' || o_custkey END AS company_id,
              CASE WHEN ok THEN CAST(o_orderdate AS DATE) END AS date, CASE WHEN ok THEN 'xml' END AS file_type
    FROM (SELECT *, o_orderstatus <> 'P' AS ok FROM orders)""",
)
def docname_parts(t: Tables) -> DataFrame:
    name = F.concat(
        F.lit("Prod"), "o_custkey", F.lit("_"), "o_orderkey", F.lit("_C"), "o_custkey", F.lit("_"),
        F.date_format("o_orderdate", "yyyyMMdd"), F.when(F.col("o_orderstatus") == "P", F.lit(".pdf")).otherwise(F.lit(".xml")),
    )
    parts = X.document_name_parts(name)
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@query(
    "scaled_number",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CASE l_returnflag WHEN 'A' THEN -1 ELSE 1 END * l_partkey * CASE WHEN l_linenumber < 4 THEN 1000.0 ELSE 1.0 END AS amount,
              CASE WHEN l_linenumber < 6 THEN CAST(l_suppkey AS DOUBLE) END AS prefixed FROM lineitem""",
)
def scaled_number(t: Tables) -> DataFrame:
    """Separators, a sign, a shift of digits, a leading label and a text that is no number."""
    grouped = F.format_number("l_partkey", 0)
    sign = F.when(F.col("l_returnflag") == "A", F.lit("-"))
    scale = F.when(F.col("l_linenumber") < 4, F.lit("3"))
    labelled = F.when(F.col("l_linenumber") < 6, F.concat(F.lit("Staff: at year end: "), "l_suppkey")).otherwise(F.lit("n/a"))
    none = F.lit(None).cast("string")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        X.scaled_number(grouped, sign, scale).alias("amount"),
        X.scaled_number(labelled, none, none, strip_prefix=True).alias("prefixed"),
    )


@query("multi_format_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 8 <> 7 THEN CAST(o_orderdate AS DATE) END AS day FROM orders")
def multi_format_date(t: Tables) -> DataFrame:
    """Seven spellings and one that is no date."""
    formats = ["yyyy-MM-dd", "yyyyMMdd", "d MMMM yyyy", "d MMM yyyy", "MMMM d, yyyy", "M/d/yyyy", "M.d.yyyy"]
    spelling = F.lit("the last day")
    for i, f in enumerate(formats):
        stamp = F.date_format("o_orderdate", f)
        spelling = F.when(F.col("o_orderkey") % 8 == i, F.upper(stamp) if i == 3 else stamp).otherwise(spelling)
    return t.orders.select("o_orderkey", X.free_date(spelling).alias("day"))


@query(
    "strict_bool",
    """SELECT event_id, CASE event_type WHEN 'click' THEN TRUE WHEN 'view' THEN FALSE END AS flag,
              CASE event_type WHEN 'click' THEN FALSE WHEN 'view' THEN TRUE END AS reversed FROM events""",
)
def strict_bool(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    text = F.when(kind == "click", "true").when(kind == "view", "false").when(kind == "error", "True").otherwise(kind)
    return t.events.select("event_id", X.strict_bool(text).alias("flag"), X.strict_bool(text, reverse=True).alias("reversed"))


@query(
    "clean_text_value",
    r"""SELECT doc_id, replace(replace(regexp_replace(' ' || text || chr(10), '^\s+|\s+$', '', 'g'), chr(10), ' '), '"', '') AS value FROM documents
    UNION ALL SELECT doc_id, NULL FROM documents WHERE lang IN ('de', 'fr')""",
)
def clean_text_value(t: Tables) -> DataFrame:
    """Whole texts on one line without quotes; blank and ``-`` are missing."""
    whole = t.documents.select("doc_id", F.concat(F.lit(" "), "text", F.lit("\n")).alias("cell"))
    blank = F.when(F.col("lang") == "de", " - ").otherwise(" \n").alias("cell")
    cells = whole.unionByName(t.documents.where("lang in ('de', 'fr')").select("doc_id", blank))
    return cells.select("doc_id", X.clean_value(F.col("cell")).alias("value"))


@query(
    "filename_date",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS daily, CAST(date_trunc('month', o_orderdate) AS DATE) AS monthly,
              CAST(date_trunc('month', o_orderdate) AS DATE) AS named, 'ONSPD_' || upper(strftime(o_orderdate, '%b_%Y')) || '_UK.zip' AS stored_as,
              CAST(NULL AS DATE) AS absent FROM orders""",
)
def filename_date(t: Tables) -> DataFrame:
    """Dates in the names of the three downloads, and the name a download is stored under."""
    day = F.col("o_orderdate")
    accounts = F.concat(F.lit("Accounts_Bulk_Data-"), F.date_format(day, "yyyy-MM-dd"), F.lit(".zip"))
    exporters = F.concat(F.lit("/media/exporters"), F.date_format(day, "yyMM"), F.lit(".zip"))
    directory = F.concat(F.lit("/datasets/ons-postcode-directory-"), F.lower(F.date_format(day, "MMMM-yyyy")))
    return t.orders.select(
        "o_orderkey",
        X.name_date(accounts, r"Accounts_Bulk_Data-(\d{4}-\d{2}-\d{2})\.zip$", "yyyy-MM-dd").alias("daily"),
        X.name_date(exporters, r"/exporters(\d{4})\.zip$", "yyMM").alias("monthly"),
        X.name_date(directory, r"/datasets/ons-postcode-directory-([a-zA-Z]+-\d{4})$", "MMMM-yyyy").alias("named"),
        X.dated_name(day, "MMM_yyyy", "ONSPD_", "_UK.zip", upper=True).alias("stored_as"),
        X.name_date(accounts, r"exporters(\d{4})", "yyMM").alias("absent"),
    )
