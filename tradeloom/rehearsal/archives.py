"""Archives, uploads and licensing files made from the tables, taken through the whole way that real files take."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.charset import to_latin
from tradeloom.operators.store import LayerStore
from tradeloom.plans import accounts, countries, datasets, ingest, licensing
from tradeloom.rehearsal.registry import Tables, query
from tradeloom.session import materialize, scratch_path
from tradeloom.sources.archives import BATCH_BYTES, documents_of, lines_of
from tradeloom.sources.delimited import LATIN, read_delimited
from tradeloom.sources.upload import UploadError, profile_upload, read_upload
from tradeloom.spec import INCREMENTAL, DatasetSpec


def zipped(rows: DataFrame, nested: bool) -> DataFrame:
    """``(file, content)``: the ``(file, member, text)`` rows of a file as one archive, nested ones as archives inside it.

    The rows of a file are the orders of one customer. Spark sorts them by file, member and text; a task holds the texts
    of one member and the archive that it is writing.
    """

    def archive(group: Iterator[tuple]) -> bytes:
        outer = io.BytesIO()
        folders: dict[str, tuple[io.BytesIO, zipfile.ZipFile]] = {}

        def add(to: zipfile.ZipFile, name: str, data: str | bytes) -> None:
            to.writestr(zipfile.ZipInfo(name), data)

        with zipfile.ZipFile(outer, "w") as z:
            for member, part in groupby(group, itemgetter(1)):
                if member is None:
                    continue
                text = "\n".join(row[2] for row in part)
                folder, _, name = member.rpartition(".zip/")
                if nested and folder:
                    if folder not in folders:
                        data = io.BytesIO()
                        folders[folder] = data, zipfile.ZipFile(data, "w")
                    add(folders[folder][1], name, text)
                else:
                    add(z, member, text)
            for folder, (data, inner) in folders.items():
                inner.close()
                add(z, f"{folder}.zip", data.getvalue())
        return outer.getvalue()

    def batch_of(files: list, contents: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(contents, pa.binary())], names=["file", "content"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        files, contents, size = [], [], 0
        for file, group in groupby(found, itemgetter(0)):
            files.append(file)
            contents.append(archive(group))
            size += len(contents[-1])
            if size > BATCH_BYTES:
                yield batch_of(files, contents)
                files, contents, size = [], [], 0
        yield batch_of(files, contents)

    sorted_rows = rows.select("file", "member", "text").repartition("file").sortWithinPartitions("file", "member", "text")
    return sorted_rows.mapInArrow(pack, "file string, content binary")


@query(
    "archive_lines",
    """SELECT 'c' || o_custkey || '.zip' AS file, CASE o_orderkey % 3 WHEN 0 THEN 'plain.txt' WHEN 1 THEN 'in.zip/first.txt' ELSE 'in.zip/second.txt' END AS member,
      o_orderkey || chr(9) || o_orderpriority AS line FROM orders""",
)
def archive_lines(t: Tables) -> DataFrame:
    """One archive per customer with a file and an archive of two files in it; every line of all of them comes out."""
    key = F.col("o_orderkey")
    member = F.when(key % 3 == 0, "plain.txt").when(key % 3 == 1, "in.zip/first.txt").otherwise("in.zip/second.txt")
    rows = t.orders.select(
        F.concat(F.lit("c"), "o_custkey", F.lit(".zip")).alias("file"), member.alias("member"),
        F.concat(key, F.lit("\t"), "o_orderpriority").alias("text"),
    )
    return lines_of(zipped(rows, nested=True)).select("file", "member", "line")


@query(
    "accounts_documents",
    """WITH d AS (SELECT o_orderkey AS id, o_orderkey % 10 AS k, o_custkey AS debtors, CAST(o_orderdate AS DATE) AS day FROM orders)
    SELECT 'row' AS kind, id, CASE WHEN k NOT IN (1, 3) THEN day END AS day, CASE WHEN k NOT IN (2, 3) THEN CAST(debtors AS DOUBLE) END AS debtors,
      CAST(NULL AS VARCHAR) AS message FROM d WHERE k <> 0
    UNION ALL SELECT 'error', id, NULL, NULL, CASE k WHEN 0 THEN 'unreadable document' WHEN 1 THEN 'unreadable date 31 March 2020 in context now'
      WHEN 2 THEN 'unreadable number ' || debtors || ' for debtors' ELSE 'undefined context nowhere' END FROM d WHERE k < 4""",
)
def accounts_documents(t: Tables) -> DataFrame:
    """An order is a document: every tenth is no XML, has a bad date, a number out of range or an undefined context."""
    kind = F.col("o_orderkey") % 10
    day = F.when(kind == 1, F.lit("31 March 2020")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    text = F.concat(
        F.lit('<html xmlns:u="http://xbrl.frc.org.uk/fr/2014-09-01/core"><context id="now"><period><instant>'), day,
        F.lit('</instant></period></context><item name="u:Debtors" contextRef="'),
        F.when(kind == 3, "nowhere").otherwise("now"), F.lit('" scale="'), F.when(kind == 2, "40").otherwise("0"),
        F.lit('">'), "o_custkey", F.lit("</item></html>"),
    )
    rows = t.orders.select(
        F.concat(F.lit("c"), "o_custkey", F.lit(".zip")).alias("file"),
        F.concat(F.lit("Prod1_1_"), "o_orderkey", F.lit("_20200331.html")).alias("member"),
        F.when(kind == 0, F.lit("<broken")).otherwise(text).alias("text"),
    )
    elements = materialize(accounts.read_elements(documents_of(zipped(rows, nested=False))), "accounts-elements")
    rules = accounts.rule_table(t.spark)
    none = F.lit(None)
    found = accounts.accounts_rows(elements, rules).select(
        F.lit("row").alias("kind"), F.col("company_id").cast("bigint").alias("id"), F.col("period_end").alias("day"),
        F.col("debtors").cast("double").alias("debtors"), none.cast("string").alias("message"),
    )
    message = F.when(F.col("message").rlike("^(unreadable|undefined)"), F.col("message")).otherwise("unreadable document")
    errors = accounts.document_errors(elements, rules).select(
        F.lit("error").alias("kind"), F.split_part("doc", F.lit("_"), F.lit(3)).cast("bigint").alias("id"),
        none.cast("date").alias("day"), none.cast("double").alias("debtors"), message.alias("message"),
    )
    return found.unionByName(errors)


def _uploaded(t: Tables, bad_key: bool = False) -> str:
    path = scratch_path(t.spark, "upload")
    key = F.col("c_custkey").cast("string")
    last = t.customer.agg(F.max("c_custkey")).scalar()
    rows = t.customer.select(
        (F.when(F.col("c_custkey") == last, "x").otherwise(key) if bad_key else key).alias("key"),
        to_latin(F.concat("c_name", F.lit("\ncafé € "), "c_nationkey"), "cp1252").alias("name"),
        F.when(F.col("c_nationkey") % 2 == 0, "None").otherwise(F.col("c_acctbal").cast("decimal(12,2)").cast("string")).alias("balance"),
    )
    rows.write.options(header=True, quoteAll=True, escape='"', encoding=LATIN).csv(path)
    return path


@query(
    "read_upload",
    """SELECT CAST(c_custkey AS VARCHAR) AS key, c_name || chr(10) || 'café € ' || c_nationkey AS name,
      CASE WHEN c_nationkey % 2 = 0 THEN '' ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) END AS balance FROM customer""",
)
def read_upload_query(t: Tables) -> DataFrame:
    """Windows-1252 with line breaks in quotes; both are found out from the file."""
    return read_upload(t.spark, _uploaded(t))


@query(
    "profile_upload",
    """SELECT 'key' AS "column", CASE WHEN count(*) > 0 THEN 'text' END AS type FROM customer
    UNION ALL SELECT 'name', CASE WHEN count(c_name) > 0 THEN 'text' END FROM customer
    UNION ALL SELECT 'balance', CASE WHEN count(c_acctbal) > 0 THEN 'numeric' END FROM customer""",
)
def profile_upload_query(t: Tables) -> DataFrame:
    """One bad key among all rows makes the column text."""
    return profile_upload(t.spark, _uploaded(t, bad_key=True)).select("column", "type")


@query(
    "licensing_load",
    """SELECT 'loaded' AS kind, CAST(NULL AS VARCHAR) AS rule, CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT 'check', 'status', '{"id":' || o_orderkey || '}' FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'check', 'dates', '{"id":' || o_orderkey || '}' FROM orders WHERE o_orderkey % 7 = 0
    UNION ALL SELECT 'foreign key', 'gi_id -> goods_incidents', '{"gi_id":' || o_orderkey || '}' FROM orders
    UNION ALL SELECT 'processed', 'batches', 'good' UNION ALL SELECT 'failed', 'batches', 'bad' UNION ALL SELECT 'failed', 'control_entries', 'entries'""",
)
def licensing_load(t: Tables) -> DataFrame:
    """A file that fits is loaded whole; one that does not leaves a report of every row, and the group goes on."""
    store, key = LayerStore(t.spark, scratch_path(t.spark, "licensing")), F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    states: list[tuple[str, str, str]] = []

    def batches(name: str, rows: DataFrame, end) -> str:
        path = scratch_path(t.spark, "batches") + f"/{name}"
        rows.select(
            key.alias("id"), F.concat(F.lit("B"), key).alias("batch_ref"),
            F.when(F.col("o_orderstatus") == "F", "RELEASED").when(F.col("o_orderstatus") == "O", "STAGING").otherwise("OPEN").alias("status"),
            day.alias("start_date"), end.alias("end_date"), day.alias("approve_date"),
        ).write.option("header", True).csv(path)
        return path

    def record(table: str, file: str, state: str, message: str | None) -> None:
        if state != "processing":
            states.append((state, table, file))

    entries = scratch_path(t.spark, "entries") + "/entries"
    t.orders.select(key.alias("gi_id"), "o_orderpriority", F.lit("1.5").alias("value")).toDF("gi_id", "rating", "value").write.option("header", True).csv(entries)
    good = batches("good", t.orders.where("o_orderstatus <> 'P'"), day)
    licensing.load_group(t.spark, store, {"batches": good, "control_entries": entries}, record)
    bad = batches("bad", t.orders, F.when(key % 7 == 0, F.lit("1990-01-01 00:00:00")).otherwise(day))
    before = store.read("batches").select(F.lit("loaded").alias("kind"), F.lit(None).cast("string").alias("rule"), F.col("id").cast("string").alias("id"))
    licensing.load_group(t.spark, store, {"batches": bad}, record)
    report = store.read("batches_report").unionByName(store.read("control_entries_report").where("rule like '%goods_incidents'"))
    report = report.where("kind <> 'primary key'").select("kind", "rule", F.col("key").alias("id"))
    told = t.spark.createDataFrame(states, "kind string, rule string, id string")
    return before.unionByName(report).unionByName(told)


@query(
    "process_files",
    """WITH f AS (SELECT *, printf('%02d.csv', c_nationkey) AS file FROM customer)
    SELECT 'row' AS kind, file, CAST(c_custkey AS VARCHAR) AS key FROM f WHERE c_nationkey <> 7
    UNION ALL SELECT DISTINCT 'state', file, CASE WHEN c_nationkey = 7 THEN 'failed' ELSE 'processed' END FROM f""",
)
def process_files(t: Tables) -> DataFrame:
    """A file per nation, one of them with a bad key: the others are loaded, and the registry tells which."""
    folder = scratch_path(t.spark, "many")
    key = F.when(F.col("c_nationkey") == 7, "x").otherwise(F.col("c_custkey").cast("string"))
    rows = t.customer.select(key.alias("key"), "c_name", F.format_string("%02d.csv", "c_nationkey").alias("file"))
    rows.write.partitionBy("file").option("header", True).csv(folder)
    schema = "key bigint, name string"
    spec = DatasetSpec(
        "rehearsal", "customers", INCREMENTAL, schema, lambda spark, path: read_delimited(spark, path, schema), ["key", "name"]
    )
    store = LayerStore(t.spark, scratch_path(t.spark, "many-layers"))
    files = [f"{folder}/file={r.file}" for r in rows.select("file").distinct().collect()]
    ingest.process_files(spec, store, files)
    name = F.replace("file_name", F.lit("file="), F.lit(""))
    states = ingest.registry(store).select(F.lit("state").alias("kind"), name.alias("file"), F.col("state").alias("key"))
    loaded = store.read("rehearsal/customers/L0").withColumnRenamed("datafile_created", "file_name")
    return states.unionByName(loaded.select(F.lit("row").alias("kind"), name.alias("file"), F.col("key").cast("string").alias("key")))


class _Stop(BaseException):
    """Stands for the end of the process: no handler of the loader sees it."""


@query(
    "load_after_stop",
    """WITH f AS (SELECT *, printf('%02d.csv', c_nationkey) AS file FROM customer)
    SELECT 'row' AS kind, file, CAST(c_custkey AS VARCHAR) AS key FROM f WHERE c_nationkey <> 7
    UNION ALL SELECT DISTINCT 'state', file, CASE WHEN c_nationkey = 7 THEN 'failed' ELSE 'processed' END FROM f""",
)
def load_after_stop(t: Tables) -> DataFrame:
    """As ``process_files``, but the first run stops after L0 of the first joint load is written and before L1 is:
    the next run, with a new store, loads every row once and records every file."""
    folder = scratch_path(t.spark, "stopped")
    key = F.when(F.col("c_nationkey") == 7, "x").otherwise(F.col("c_custkey").cast("string"))
    rows = t.customer.select(key.alias("key"), "c_name", F.format_string("%02d.csv", "c_nationkey").alias("file"))
    rows.write.partitionBy("file").option("header", True).csv(folder)
    schema = "key bigint, name string"
    spec = DatasetSpec(
        "rehearsal", "customers", INCREMENTAL, schema, lambda spark, path: read_delimited(spark, path, schema), ["key", "name"]
    )
    root = scratch_path(t.spark, "stopped-layers")
    files = [f"{folder}/file={r.file}" for r in rows.select("file").distinct().collect()]
    first = LayerStore(t.spark, root)
    staged = first.stage

    def stop_at_l1(table, df, *args):
        if table.endswith("/L1"):
            raise _Stop()
        return staged(table, df, *args)

    first.stage = stop_at_l1
    try:
        ingest.process_files(spec, first, files)
    except _Stop:
        pass
    store = LayerStore(t.spark, root)
    ingest.process_files(spec, store, files)
    name = F.replace("file_name", F.lit("file="), F.lit(""))
    states = ingest.registry(store).select(F.lit("state").alias("kind"), name.alias("file"), F.col("state").alias("key"))
    loaded = store.read("rehearsal/customers/L0").withColumnRenamed("datafile_created", "file_name")
    return states.unionByName(loaded.select(F.lit("row").alias("kind"), name.alias("file"), F.col("key").cast("string").alias("key")))


@query(
    "country_codes_load",
    """SELECT n_nationkey AS cty_code, n_name AS cty_name_english, lower(n_name) AS cty_fullname_english,
      substr(n_name, 1, 3) AS cty_abbreviation, n_name || ', region ' || n_regionkey AS cty_comments,
      substr(n_name, 1, 2) AS iso2_digit_alpha,
      upper(substr(n_name, 1, 3)) AS iso3_digit_alpha, CAST(1950 + n_regionkey AS VARCHAR) AS start_valid_year,
      CAST(2000 + n_nationkey AS VARCHAR) AS end_valid_year
    FROM nation""",
)
def country_codes_load(t: Tables) -> DataFrame:
    """The code dictionary as its supplier writes it (single-byte charset, lines ended by a bare CR), through both layers."""
    spec = datasets.COUNTRY_CODES
    rows = t.nation.select(
        F.col("n_nationkey").alias("cty_code"), F.col("n_name").alias("cty_name_english"),
        F.lower("n_name").alias("cty_fullname_english"), F.substring("n_name", 1, 3).alias("cty_abbreviation"),
        F.concat("n_name", F.lit(", region "), "n_regionkey").alias("cty_comments"),
        F.substring("n_name", 1, 2).alias("iso2_digit_alpha"),
        F.upper(F.substring("n_name", 1, 3)).alias("iso3_digit_alpha"),
        (F.col("n_regionkey") + 1950).cast("string").alias("start_valid_year"),
        (F.col("n_nationkey") + 2000).cast("string").alias("end_valid_year"),
    )
    path = scratch_path(t.spark, "country-codes")
    rows.write.options(header=True, escape='"', lineSep="\r", encoding="ISO-8859-1").csv(path)
    store = LayerStore(t.spark, scratch_path(t.spark, "country-layers"))
    ingest.load_file(spec, store, path, "country_codes.csv")
    return store.read(ingest.layer(spec, "L1")).select(spec.l1_columns)


@query(
    "upload_checks",
    """SELECT 'good' AS file, 'rows ' || count(*) AS outcome FROM customer
    UNION ALL SELECT 'header_only', 'no data found below the header'
    UNION ALL SELECT 'bad_header', 'a column name is a lowercase letter followed by lowercase letters, digits or '
      || 'underscores; not valid: "Key Col"'""",
)
def upload_checks(t: Tables) -> DataFrame:
    """Uploads written from a table: a good one, one with a header and no data, one with a column name that is not
    valid. Each is profiled as an upload is before it is confirmed; what fails is told by its message."""
    base = scratch_path(t.spark, "upload-checks")
    rows = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    files = {
        "good": rows,
        "header_only": rows.where(F.lit(False)),
        "bad_header": rows.withColumnRenamed("key", "Key Col"),
    }
    outcomes = []
    for name, df in files.items():
        path = f"{base}/{name}.csv"
        df.coalesce(1).write.option("header", True).csv(path)  # an upload is one file with one header
        try:
            profile_upload(t.spark, path)
            outcomes.append((name, f"rows {read_upload(t.spark, path).count()}"))
        except UploadError as e:
            outcomes.append((name, str(e)))
    return t.spark.createDataFrame(outcomes, "file string, outcome string")


_REQUIRED = ", ".join(
    f"('{iso3}', {int(number)})" for iso3, number in (pair.split() for pair in countries.REQUIRED_COUNTRIES.split(","))
)


@query(
    "required_countries_cover",
    f"""WITH req(iso3, iso_num) AS (VALUES {_REQUIRED}),
    n AS (SELECT upper(substr(n_name, 1, 3)) AS iso3, n_nationkey FROM nation)
    SELECT coalesce(req.iso3, n.iso3) AS iso3, CAST(iso_num AS INTEGER) AS iso_num, req.iso3 IS NOT NULL AS requirement,
      n_nationkey
    FROM req FULL OUTER JOIN n ON req.iso3 = n.iso3""",
)
def required_countries_cover(t: Tables) -> DataFrame:
    """The whole required list against the nations named by their first three letters: which are covered, which not."""
    required = countries.required_countries(t.spark)
    nations = t.nation.select(F.upper(F.substring("n_name", 1, 3)).alias("n_iso3"), "n_nationkey")
    joined = required.join(nations, F.col("iso3") == F.col("n_iso3"), "full_outer")
    return joined.select(
        F.coalesce("iso3", "n_iso3").alias("iso3"), "iso_num",
        F.coalesce("requirement", F.lit(False)).alias("requirement"), "n_nationkey",
    )


@query(
    "reference_postcodes_load",
    """SELECT 'AB' || c_custkey AS postcode, c_name AS local_authority_district_name, c_mktsegment AS region_name, nullif(CAST(c_nationkey % 3 AS VARCHAR), '0') AS region_code,
      CAST(make_date(1980 + c_nationkey, 1, 1) AS DATE) AS date_of_introduction, CASE WHEN c_nationkey % 2 = 0 THEN make_date(2010, 5, 1) END AS date_of_termination FROM customer""",
)
def reference_postcodes_load(t: Tables) -> DataFrame:
    """A written file goes through both layers; blank quoted cells are missing."""
    nation = F.col("c_nationkey")
    known = {
        "postcode": F.concat(F.lit("AB"), "c_custkey"),
        "local_authority_district_name": F.col("c_name"),
        "region_name": F.col("c_mktsegment"),
        "region_code": F.when(nation % 3 == 0, "").otherwise((nation % 3).cast("string")),
        "date_of_introduction": F.concat(nation + 1980, F.lit("-01-01")),
        "date_of_termination": F.when(nation % 2 == 0, "2010-05-01"),
    }
    spec = datasets.REFERENCE_POSTCODES
    path = scratch_path(t.spark, "postcodes")
    rows = t.customer.select([known.get(c, F.lit("")).alias(c) for c in spec.l0_columns])
    rows.write.options(header=True, escape='"').csv(path)
    store = LayerStore(t.spark, scratch_path(t.spark, "postcode-layers"))
    ingest.load_file(spec, store, path, "postcodes.csv")
    return store.read(ingest.layer(spec, "L1")).select(list(known))


@query(
    "raw_tariff_load",
    """SELECT l_suppkey AS reporter, year(l_shipdate) AS year, l_partkey AS product, l_linenumber AS partner,
      CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS duty_type, CAST(l_discount AS DOUBLE) AS simple_average, CAST(l_quantity AS INTEGER) AS number_of_total_lines
    FROM lineitem""",
)
def raw_tariff_load(t: Tables) -> DataFrame:
    """Two files of raw tariffs, loaded together into the one layer that they have."""
    spec, folder = datasets.RAW_TARIFF, scratch_path(t.spark, "tariffs")
    rows = t.lineitem.select(
        "l_suppkey", F.year("l_shipdate"), "l_partkey", "l_linenumber", F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag")),
        F.col("l_discount").cast("decimal(20,6)"), F.col("l_quantity").cast("int"),
    ).toDF(*spec.l0_columns)
    files = [f"{folder}/{kind}.csv" for kind in ("even", "odd")]
    for path, rest in zip(files, (0, 1)):
        rows.where(F.col("partner") % 2 == rest).write.options(header=True, escape='"').csv(path)
    store = LayerStore(t.spark, scratch_path(t.spark, "tariff-layers"))
    ingest.process_files(spec, store, files)
    loaded = store.read(ingest.layer(spec, "L0")).select(spec.l0_columns)
    return loaded.withColumn("simple_average", F.col("simple_average").cast("double"))


@query(
    "upload_archive",
    """SELECT CAST(c_custkey AS VARCHAR) AS key, CAST(c_nationkey AS VARCHAR) AS nation, 'text' AS kind FROM customer
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), CASE WHEN c_nationkey <> 3 THEN CAST(c_nationkey AS VARCHAR) END, 'typed' FROM customer""",
)
def upload_archive(t: Tables) -> DataFrame:
    """An upload is archived as text under its dataset and file, and loaded with the confirmed types."""
    path = scratch_path(t.spark, "uploads") + "/customers.csv"
    nation = F.when(F.col("c_nationkey") == 3, "N/A").otherwise(F.col("c_nationkey").cast("string"))
    t.customer.select(F.col("c_custkey").alias("key"), nation.alias("nation")).write.option("header", True).csv(path)
    store = LayerStore(t.spark, scratch_path(t.spark, "upload-layers"))
    typed = ingest.load_upload(store, "org", "customers", path, {"key": "integer", "nation": "integer"})
    kept = store.read("org/customers/uploads").where("file = 'customers.csv'")
    kept = kept.select("key", F.when(F.col("nation") == "", "3").otherwise(F.col("nation")).alias("nation"), F.lit("text").alias("kind"))
    return kept.unionByName(typed.select(F.col("key").cast("string"), F.col("nation").cast("string"), F.lit("typed").alias("kind")))
