"""Reads of published tables: pages, point lookups, structure, JSON records and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tradeloom.functions.text import camel_case, postcode_key
from tradeloom.session import materialize

PAGE_SIZE = 1000

# Schemas that are never served and lineage columns that are never shown.
INTERNAL_SCHEMAS = [
    "pg_toast", "pg_temp_1", "pg_toast_temp_1", "pg_catalog", "public", "information_schema", "operations", "admin",
]
LINEAGE_COLUMNS = ["data_hash", "datafile_created", "datafile_updated"]


def without_lineage(table: DataFrame) -> DataFrame:
    return table.drop(*LINEAGE_COLUMNS)


def table_structure(table: DataFrame) -> DataFrame:
    """``(position, column, data_type, n_values)``: the columns a reader sees and how many cells are filled."""
    shown = without_lineage(table)
    filled = shown.agg(*[F.count(c).alias(c) for c in shown.columns])
    described = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"`{f.name}`").alias("n_values"),
            )
            for i, f in enumerate(shown.schema.fields, 1)
        ]
    )
    return filled.select(F.inline(described))


def is_servable(schema: Column) -> Column:
    return ~schema.isin(INTERNAL_SCHEMAS)


def servable_table(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """The table of the catalog, or an error for an internal schema, an unknown name or a missing ``id``."""
    if schema in INTERNAL_SCHEMAS or not spark.catalog.tableExists(f"{schema}.{table}"):
        raise LookupError(f"{schema}.{table} does not exist")
    found = spark.table(f"{schema}.{table}")
    if "id" not in found.columns:
        raise ValueError(f"{schema}.{table} has no id column to page by")
    return found


def keyset_page(table: DataFrame, next_id: int = 0, size: int = PAGE_SIZE, id_column: str = "id") -> DataFrame:
    """Rows from ``next_id`` on in id order, each with the id that starts the following page.

    The scan skips lower ids and every task keeps only its first ``size + 1`` rows.
    """
    reach = table.where(F.col(id_column) >= next_id).orderBy(id_column).limit(size + 1)
    # The window sees the page only: at most ``size + 1`` rows.
    page = W.orderBy(id_column).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    more = F.count("*").over(page) > size
    return (
        reach.withColumn("next_id", F.when(more, F.max(id_column).over(page)))
        .where(F.col("next_id").isNull() | (F.col(id_column) < F.col("next_id")))
    )


def assign_pages(table: DataFrame, size: int = PAGE_SIZE, id_column: str = "id", width: int | None = None) -> DataFrame:
    """Number every row's page in id order without sorting the table in one task.

    Rows are range-partitioned by id and sorted inside their partition; each partition counts its rows, and a row's
    position is the count of the partitions before its own (a sum over one row per partition) plus its place in its
    partition. Ids need not be dense. ``width`` is accepted for callers of the earlier interface and not used.
    """
    spark = table.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        table.repartitionByRange(parts, id_column)
        .sortWithinPartitions(id_column)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    )
    placed = materialize(placed, "paged")
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per partition: the window has no more rows than there are partitions.
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start")
    )
    position = F.col("_start") + F.col("_pos")
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn("page", F.floor(position / size).cast("bigint"))
        .drop("_part", "_pos", "_start")
    )


def lookup_postcode(table: DataFrame, postcode: str, column: str = "postcode", id_column: str = "id") -> DataFrame:
    """At most one row whose postcode equals ``postcode`` up to case and spaces; the smallest id wins."""
    wanted = postcode.replace(" ", "").lower()
    return table.where(postcode_key(F.col(column)) == wanted).orderBy(id_column).limit(1)


def records_json(table: DataFrame, camel: bool = True) -> DataFrame:
    """One JSON object per row, in camel case unless switched off; empty cells are ``null``."""
    shown = without_lineage(table)
    names = [F.col(c).alias(camel_case(c) if camel else c) for c in shown.columns]
    return shown.select(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("record"))


def tabular_json(table: DataFrame) -> DataFrame:
    """One JSON array of cell texts per row; the headers are the frame's columns."""
    shown = without_lineage(table)
    return shown.select(F.to_json(F.array(*[F.col(c).cast("string") for c in shown.columns])).alias("record"))


def export_csv(table: DataFrame, path: str, null: str = "NULL") -> None:
    """Write a headed CSV folder with empty cells as ``null``."""
    table.write.option("header", True).option("nullValue", null).option("escape", '"').csv(path)


def export_schema(spark: SparkSession, schema: str, folder: str) -> list[str]:
    """Export every table of a schema to ``folder/TABLE.csv``."""
    names = sorted(t.name for t in spark.catalog.listTables(schema))
    for name in names:
        export_csv(spark.table(f"{schema}.{name}"), f"{folder}/{name}.csv")
    return names
