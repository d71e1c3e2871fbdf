"""How files change the two layers: snapshot merge, incremental append, deletion of superseded rows.

Every operator takes the current layer and returns the next one. Nothing is written here: a caller
publishes the result as a new version (see ``store``), so a layer is never read and overwritten at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.text import row_hash

LINEAGE = ["id", "datafile_created", "datafile_updated", "data_hash"]


def next_id(layer: DataFrame) -> Column:
    """One more than the largest id in ``layer``, as a value usable in another frame."""
    return layer.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("next")).scalar()


def with_row_ids(rows: DataFrame, layer: DataFrame | None = None) -> DataFrame:
    """Unique ids above those of ``layer``. They are not dense, and no global ordering is needed."""
    start = F.lit(1).cast("bigint") if layer is None else next_id(layer)
    return rows.withColumn("id", start + F.monotonically_increasing_id())


def standardise(rows: DataFrame, columns: list[str], transforms: dict | None = None) -> DataFrame:
    """Select ``columns``, each by its transform or unchanged."""
    transforms = transforms or {}

    def column(name: str) -> Column:
        how = transforms.get(name, F.col(name))
        return (F.expr(how) if isinstance(how, str) else how).alias(name)

    return rows.select([column(c) for c in columns])


def snapshot_merge(
    layer: DataFrame, snapshot: DataFrame, file_name: str, hash_columns: list[str] | None = None
) -> DataFrame:
    """Merge a full file into L0: new rows are added, known rows get ``datafile_updated``, the rest stays.

    Rows are matched by a fingerprint, which is unique on both sides and spreads evenly, so one hot value
    in the data cannot skew the join. Copies inside the file collapse before the shuffle. When only some
    columns are hashed, the row with the smallest full fingerprint stands for its copies.
    """
    data = snapshot.columns
    hashed = snapshot.withColumn("data_hash", row_hash(*(hash_columns or data)))
    if hash_columns and set(hash_columns) != set(data):
        picked = F.min_by(F.struct(*data), row_hash(*data)).alias("row")
        fresh = hashed.groupBy("data_hash").agg(picked).select("data_hash", "row.*")
    else:
        fresh = hashed.dropDuplicates(["data_hash"])
    fresh = fresh.select("data_hash", F.struct(*data).alias("new"))
    known = layer.select("data_hash", F.struct("id", "datafile_created", "datafile_updated", *data).alias("old"))
    is_new, seen = F.col("old").isNull(), F.col("new").isNotNull()
    return known.join(fresh, "data_hash", "full").select(
        F.when(is_new, next_id(layer) + F.monotonically_increasing_id()).otherwise(F.col("old.id")).alias("id"),
        F.when(is_new, F.lit(file_name)).otherwise(F.col("old.datafile_created")).alias("datafile_created"),
        F.when(seen, F.lit(file_name)).otherwise(F.col("old.datafile_updated")).alias("datafile_updated"),
        "data_hash",
        *[F.when(is_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in data],
    )


def snapshot_l1_increment(
    l0: DataFrame, l1: DataFrame, file_name: str, columns: list[str], transforms: dict | None = None
) -> DataFrame:
    """Rows to add to L1: what this file created in L0 and L1 does not hold yet."""
    created = l0.where(F.col("datafile_created") == file_name).join(
        l1.select(F.col("data_source_row_id").alias("id")), "id", "left_anti"
    )
    with_source = {"data_source_row_id": F.col("id"), **(transforms or {})}
    return with_row_ids(standardise(created, ["data_source_row_id", *columns], with_source), l1)


def append_file(layer: DataFrame | None, rows: DataFrame, file_name: str) -> DataFrame:
    """Rows of one incremental file with ids and the file name. Loading a file twice doubles its rows."""
    return with_row_ids(rows, layer).withColumn("datafile_created", F.lit(file_name))


def incremental_l1(
    l0_rows: DataFrame, l1: DataFrame | None, columns: list[str], transforms: dict | None = None
) -> DataFrame:
    """L1 rows of freshly appended L0 rows."""
    with_source = {"data_source_row_id": F.col("id"), **(transforms or {})}
    return with_row_ids(standardise(l0_rows, ["data_source_row_id", *columns], with_source), l1)


def superseded(layer: DataFrame, file_name: str) -> DataFrame:
    """L0 rows the newest file no longer contains. A row without ``datafile_updated`` is never superseded."""
    return layer.where(F.col("datafile_updated") != file_name)


def delete_previous_l0(layer: DataFrame, file_name: str) -> DataFrame:
    return layer.where((F.col("datafile_updated") == file_name) | F.col("datafile_updated").isNull())


def delete_previous_l1(l0: DataFrame, l1: DataFrame, file_name: str) -> DataFrame:
    """L1 without the rows whose source is superseded. Run it before ``delete_previous_l0``."""
    stale = superseded(l0, file_name).select(F.col("id").alias("data_source_row_id"))
    return l1.join(stale, "data_source_row_id", "left_anti")


def unpivot_years(wide: DataFrame, ids: list[str], value: str, year: str = "year") -> DataFrame:
    """One row per year column (names starting with 1 or 2); empty cells are kept."""
    years = [c for c in wide.columns if c[:1] in ("1", "2") and c.isdigit()]
    long = wide.unpivot(ids, years, year, value)
    return long.withColumn(year, F.col(year).cast("int"))
