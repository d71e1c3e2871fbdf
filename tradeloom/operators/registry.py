"""Which files were handled, with what outcome, and which are still to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.operators.keyed import latest_per_key

PROCESSING, FAILED, PROCESSED, IGNORED = "processing", "failed", "processed", "ignored"

REGISTRY_SCHEMA = (
    "source string, file_name string, state string, error_message string, created timestamp, updated timestamp"
)

# Progress in percent shown for each state of an upload.
UPLOAD_PROGRESS = {
    "uploading": 10,
    "uploaded": 20,
    "verified": 30,
    "processing_store": 40,
    "processing_export": 70,
    "completed": 100,
    "failed": 100,
}
RUNNING_STATES = ["verified", "processing_store", "processing_export"]
STALE_MESSAGE = "The run did not complete within {hours} hours and was marked as failed."


def registry_upsert(registry: DataFrame, updates: DataFrame, at: Column) -> DataFrame:
    """Apply ``(source, file_name, state, error_message)`` updates.

    A known file gets the new state and message and keeps its old ones where the update has none. An update without
    a file name is always a new entry. ``updates`` holds at most one row per file.
    """
    has_name = F.coalesce("file_name", F.lit("")) != ""
    named, unnamed = updates.where(has_name), updates.where(~has_name)
    keys = ["source", "file_name"]
    old, new = registry.alias("old"), named.withColumn("touched", F.lit(True)).alias("new")
    merged = old.where(has_name).join(new, keys, "full").select(
        *keys,
        F.coalesce("new.state", "old.state").alias("state"),
        F.coalesce("new.error_message", "old.error_message").alias("error_message"),
        F.coalesce("old.created", at).alias("created"),
        F.when(F.col("touched"), at).otherwise(F.col("old.updated")).alias("updated"),
    )
    return merged.unionByName(registry.where(~has_name)).unionByName(
        unnamed.select(*keys, "state", "error_message", at.alias("created"), at.alias("updated"))
    )


STATE_SCHEMA = "source string, file_name string, state string, error_message string, at timestamp"


def current_states(states: DataFrame) -> DataFrame:
    """The registry from a log of states: per file the newest state and message that were given, and the first and last
    time. Entries without a file name stand for themselves."""
    has_name = F.coalesce("file_name", F.lit("")) != ""
    newest = states.where(has_name).groupBy("source", "file_name").agg(
        *(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("at"))).alias(c) for c in ("state", "error_message")),
        F.min("at").alias("created"), F.max("at").alias("updated"),
    )
    alone = states.where(~has_name).select(
        "source", "file_name", "state", "error_message", F.col("at").alias("created"), F.col("at").alias("updated")
    )
    return newest.unionByName(alone)


def finished_files(registry: DataFrame) -> DataFrame:
    """Files that need no further work, one row per source and file."""
    return (
        registry.where(F.col("state").isin(PROCESSED, IGNORED)).select("source", "file_name").distinct()
    )


def unprocessed_files(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Discovered files that were never finished; failed and interrupted ones come back."""
    return files.join(finished_files(registry), ["source", "file_name"], "left_anti")


def expire_stale(runs: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Mark runs as failed that never started or started too long ago."""
    stale = F.col("state").isin(RUNNING_STATES) & (
        F.col("started").isNull() | (F.col("started") <= as_of - F.expr(f"interval {hours} hours"))
    )
    return runs.withColumn(
        "error_message", F.when(stale, F.lit(STALE_MESSAGE.format(hours=hours))).otherwise(F.col("error_message"))
    ).withColumn("state", F.when(stale, F.lit(FAILED)).otherwise(F.col("state")))


def progress(state: Column) -> Column:
    lookup = F.create_map(*[F.lit(v) for pair in UPLOAD_PROGRESS.items() for v in pair])
    return F.when(F.coalesce(state, F.lit("")) == "", F.lit(0)).otherwise(F.try_element_at(lookup, state))


def latest_completed(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Newest completed version per pipeline; one without a time counts as newest."""
    return latest_per_key(
        versions.where(F.col("state") == "completed"), keys, [F.col("processed_at").desc_nulls_first(), F.col("id").desc()]
    )
