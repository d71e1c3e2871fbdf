"""Layer lifecycle and file registry over customers, orders and events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.operators import lifecycle as L
from tradeloom.operators import registry as R
from tradeloom.operators.store import LayerStore
from tradeloom.plans.ingest import LAYER0_LINEAGE
from tradeloom.rehearsal.registry import Tables, query
from tradeloom.session import materialize, scratch_path

CUSTOMER = "c_custkey bigint, c_mktsegment string, c_acctbal double"

# Two full files: the first lacks a third of the customers, the second another third; every customer whose
# key ends in 7 has a new balance, and the second file holds each row of nation 5 twice.
SNAPSHOT_SQL = """WITH first AS (SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_custkey % 3 <> 0),
  second AS (SELECT DISTINCT c_custkey, c_mktsegment, CASE WHEN c_custkey % 10 = 7 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal
             FROM customer WHERE c_custkey % 3 <> 1),
  l0 AS (SELECT c_custkey, c_mktsegment, c_acctbal, CASE WHEN f.c_custkey IS NULL THEN 'second.csv' ELSE 'first.csv' END AS datafile_created,
                CASE WHEN s.hit THEN 'second.csv' ELSE 'first.csv' END AS datafile_updated
         FROM (SELECT *, TRUE AS hit FROM first) f FULL JOIN (SELECT *, TRUE AS hit FROM second) s USING (c_custkey, c_mktsegment, c_acctbal)) """


def snapshots(t: Tables) -> tuple[DataFrame, DataFrame]:
    customer = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    first = customer.where("c_custkey % 3 <> 0").drop("c_nationkey")
    changed = F.when(F.col("c_custkey") % 10 == 7, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    copies = F.when(F.col("c_nationkey") == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    second = (
        customer.where("c_custkey % 3 <> 1").withColumn("c_acctbal", changed).withColumn("copy", F.explode(copies))
        .drop("c_nationkey", "copy")
    )
    return first, second


def merged(t: Tables, store: LayerStore) -> DataFrame:
    first, second = snapshots(t)
    empty = t.spark.createDataFrame([], LAYER0_LINEAGE + CUSTOMER)
    l0 = store.publish("L0", L.snapshot_merge(empty, first, "first.csv"))
    return store.publish("L0", L.snapshot_merge(l0, second, "second.csv"))


def _store(t: Tables) -> LayerStore:
    return LayerStore(t.spark, scratch_path(t.spark, "layers"))


@query("snapshot_merge", SNAPSHOT_SQL + "SELECT * FROM l0")
def snapshot_merge(t: Tables) -> DataFrame:
    return merged(t, _store(t)).select("c_custkey", "c_mktsegment", "c_acctbal", "datafile_created", "datafile_updated")


@query(
    "snapshot_subset_hash",
    """WITH first AS (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer WHERE c_nationkey < 15),
    second AS (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer WHERE c_nationkey >= 10)
    SELECT c_mktsegment, c_nationkey, CASE WHEN c_nationkey < 15 THEN 'first.csv' ELSE 'second.csv' END AS datafile_created,
      CASE WHEN c_nationkey >= 10 THEN 'second.csv' ELSE 'first.csv' END AS datafile_updated
    FROM (SELECT * FROM first UNION SELECT * FROM second)""",
)
def snapshot_subset_hash(t: Tables) -> DataFrame:
    """Only two columns make a row new, so the many customers of a pair leave one row."""
    rows = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    empty = t.spark.createDataFrame([], LAYER0_LINEAGE + "c_custkey bigint, c_mktsegment string, c_nationkey int")
    keys = ["c_mktsegment", "c_nationkey"]
    first = materialize(L.snapshot_merge(empty, rows.where("c_nationkey < 15"), "first.csv", keys), "subset")
    both = L.snapshot_merge(first, rows.where("c_nationkey >= 10"), "second.csv", keys)
    return both.select(*keys, "datafile_created", "datafile_updated")


@query(
    "snapshot_l1_increment",
    SNAPSHOT_SQL + "SELECT c_custkey, lower(c_mktsegment) AS segment, c_acctbal FROM l0 WHERE datafile_created = 'second.csv'",
)
def snapshot_l1_increment(t: Tables) -> DataFrame:
    """Rows created by the second file; loading them twice adds nothing the second time."""
    store = _store(t)
    l0 = merged(t, store)
    columns, how = ["c_custkey", "segment", "c_acctbal"], {"segment": F.lower("c_mktsegment")}
    l1 = t.spark.createDataFrame([], "id bigint, data_source_row_id bigint")
    l1 = store.append("L1", L.snapshot_l1_increment(l0, l1, "second.csv", columns, how))
    l1 = store.append("L1", L.snapshot_l1_increment(l0, l1, "second.csv", columns, how))
    return l1.select(columns)


@query("delete_previous_l0", SNAPSHOT_SQL + "SELECT c_custkey, c_acctbal, datafile_created FROM l0 WHERE datafile_updated = 'second.csv'")
def delete_previous_l0(t: Tables) -> DataFrame:
    return L.delete_previous_l0(merged(t, _store(t)), "second.csv").select("c_custkey", "c_acctbal", "datafile_created")


@query("delete_previous_l1", SNAPSHOT_SQL + "SELECT c_custkey, c_acctbal FROM l0 WHERE datafile_updated = 'second.csv'")
def delete_previous_l1(t: Tables) -> DataFrame:
    store = _store(t)
    l0 = merged(t, store)
    l1 = l0.select(F.col("id").alias("data_source_row_id"), "c_custkey", "c_acctbal")
    return L.delete_previous_l1(l0, l1, "second.csv").select("c_custkey", "c_acctbal")


# --- registry --------------------------------------------------------------------------------------

EVENT_FILES_SQL = """WITH files AS (SELECT 'source ' || user_id % 3 AS source, CASE WHEN event_id % 50 <> 0 THEN event_type || '-' || user_id END AS file_name,
    event_id, CASE WHEN value < 2 THEN 'failed' WHEN value < 20 THEN 'processed' WHEN value < 30 THEN 'ignored' ELSE 'processing' END AS state,
    CASE WHEN value < 2 THEN 'error ' || event_id END AS message, ts FROM events),
  newest AS (SELECT *, row_number() OVER (PARTITION BY source, file_name, ts < TIMESTAMP '2024-01-16' ORDER BY event_id DESC) AS rn FROM files),
  old AS (SELECT * FROM newest WHERE ts < TIMESTAMP '2024-01-16' AND (rn = 1 OR file_name IS NULL)),
  new AS (SELECT * FROM newest WHERE ts >= TIMESTAMP '2024-01-16' AND (rn = 1 OR file_name IS NULL)) """


def event_files(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Events of the first half month fill the registry, the later ones update it; the last event of a file counts."""
    value = F.col("value")
    files = t.events.select(
        F.concat(F.lit("source "), F.col("user_id") % 3).alias("source"),
        F.when(F.col("event_id") % 50 != 0, F.concat_ws("-", "event_type", "user_id")).alias("file_name"),
        F.when(value < 2, R.FAILED).when(value < 20, R.PROCESSED).when(value < 30, R.IGNORED).otherwise(R.PROCESSING).alias("state"),
        F.when(value < 2, F.concat(F.lit("error "), "event_id")).alias("error_message"),
        "event_id",
        F.col("ts").alias("created"),
    )

    def newest(rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct("state", "error_message", "created"), "event_id").alias("f")
        named = rows.where("file_name is not null").groupBy("source", "file_name").agg(last).select("source", "file_name", "f.*")
        return named.unionByName(rows.where("file_name is null").drop("event_id"))

    half = F.col("created") < F.lit("2024-01-16").cast("timestamp_ntz")
    old = newest(files.where(half)).select("source", "file_name", "state", "error_message", "created", F.col("created").alias("updated"))
    return old, newest(files.where(~half)).drop("created")


@query(
    "registry_upsert",
    EVENT_FILES_SQL
    + """SELECT source, file_name, coalesce(n.state, o.state) AS state, coalesce(n.message, o.message) AS error_message,
      coalesce(o.ts, TIMESTAMP '2024-02-01') AS created, CASE WHEN n.state IS NOT NULL THEN TIMESTAMP '2024-02-01' ELSE o.ts END AS updated
    FROM (SELECT * FROM old WHERE file_name IS NOT NULL) o FULL JOIN (SELECT * FROM new WHERE file_name IS NOT NULL) n USING (source, file_name)
    UNION ALL SELECT source, NULL, state, message, ts, ts FROM old WHERE file_name IS NULL
    UNION ALL SELECT source, NULL, state, message, TIMESTAMP '2024-02-01', TIMESTAMP '2024-02-01' FROM new WHERE file_name IS NULL""",
)
def registry_upsert(t: Tables) -> DataFrame:
    old, new = event_files(t)
    return R.registry_upsert(old, new, F.lit("2024-02-01").cast("timestamp_ntz"))


@query(
    "unprocessed_files",
    EVENT_FILES_SQL
    + """SELECT DISTINCT source, file_name FROM new WHERE file_name IS NOT NULL AND (source, file_name) NOT IN (
      SELECT (source, file_name) FROM old WHERE file_name IS NOT NULL AND state IN ('processed', 'ignored'))""",
)
def unprocessed_files(t: Tables) -> DataFrame:
    old, new = event_files(t)
    found = new.where("file_name is not null").select("source", "file_name").distinct()
    return R.unprocessed_files(found, old)


@query(
    "files_per_source",
    EVENT_FILES_SQL + "SELECT DISTINCT source, file_name FROM old WHERE state IN ('processed', 'ignored')",
)
def files_per_source(t: Tables) -> DataFrame:
    """Finished files as rows: a source may have any number of them, so they are not packed into a list."""
    old, _ = event_files(t)
    return R.finished_files(old)


@query(
    "expire_stale",
    """SELECT event_id, CASE WHEN stale THEN 'failed' ELSE state END AS state,
      CASE WHEN stale THEN 'The run did not complete within 24 hours and was marked as failed.' ELSE message END AS error_message
    FROM (SELECT *, state IN ('verified', 'processing_store', 'processing_export') AND (started IS NULL OR started <= TIMESTAMP '2024-01-20') AS stale FROM (
      SELECT event_id, CASE event_type WHEN 'click' THEN 'verified' WHEN 'view' THEN 'processing_store' WHEN 'error' THEN 'failed' ELSE 'completed' END AS state,
        CASE WHEN event_type = 'error' THEN 'broken' END AS message, CASE WHEN user_id % 4 <> 0 THEN ts END AS started FROM events))""",
)
def expire_stale(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    runs = t.events.select(
        "event_id",
        F.when(kind == "click", "verified").when(kind == "view", "processing_store").when(kind == "error", "failed").otherwise("completed").alias("state"),
        F.when(kind == "error", "broken").alias("error_message"),
        F.when(F.col("user_id") % 4 != 0, F.col("ts")).alias("started"),
    )
    expired = R.expire_stale(runs, F.lit("2024-01-21").cast("timestamp_ntz"))
    return expired.select("event_id", "state", "error_message")
