"""Per-key operators: newest row, carried-forward values, means over a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tradeloom.session import broadcast_checked, materialize


def latest_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of every key in ``order``.

    Spark limits each key to its first row before the shuffle, so a key that holds most of the table sends
    one row per task and not its whole group.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_revision(bound_rates: DataFrame) -> DataFrame:
    """Bound rate with the highest nomenclature revision per reporter and product.

    The revision is the last digit of ``nomen_code``; a row without one sorts first.
    """
    revision = F.right("nomen_code", F.lit(1)).cast("int")
    return latest_per_key(bound_rates, ["reporter", "product"], [revision.desc_nulls_first(), F.col("id").asc()])


def value_per_step(rows: DataFrame, keys: list[str], step: str, values: list[str]) -> DataFrame:
    """One row per key and step with the smallest value and the number of values.

    Rows of one step are peers of a running window: they all see the same count, and only one of their
    values can be carried on. Reducing them first (with a partial step before the shuffle) bounds the
    windows below by the number of steps, however many rows a key has.
    """
    return rows.groupBy(*keys, step).agg(
        *[F.min(v).alias(v) for v in values], *[F.count(v).alias(f"{v}_count") for v in values]
    )


def _so_far(keys: list[str], step: str):
    return W.partitionBy(*keys).orderBy(step).rowsBetween(W.unboundedPreceding, 0)


def running_groups(rows: DataFrame, keys: list[str], step: str, value: str) -> DataFrame:
    """Number of non-null values up to and including each step."""
    steps = value_per_step(rows, keys, step, [value])
    return steps.withColumn(f"{value}_group", F.sum(f"{value}_count").over(_so_far(keys, step)))


def forward_fill(rows: DataFrame, keys: list[str], step: str, value: str) -> DataFrame:
    """First value of each running group: the group number splits a key at every new value."""
    groups = running_groups(rows, keys, step, value)
    window = W.partitionBy(*keys, f"{value}_group").orderBy(step).rowsBetween(W.unboundedPreceding, 0)
    return groups.withColumn(f"{value}_filled", F.first(value).over(window))


def forward_fill_fused(rows: DataFrame, keys: list[str], step: str, values: list[str]) -> DataFrame:
    """The same carried values with one window for all of them."""
    steps = value_per_step(rows, keys, step, values)
    return steps.withColumns(
        {f"{v}_filled": F.last(v, ignorenulls=True).over(_so_far(keys, step)) for v in values}
    )


def distinct_with_group_mean(rows: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    """Distinct rows with the mean of ``value`` in their group, duplicates counted in the mean.

    Copies collapse into a count first, which is written once as two branches read it. The means are one
    row per group, so they join by broadcast while there are few groups; no group is ever gathered in one task.
    """
    columns = rows.columns
    counted = materialize(rows.groupBy(*columns).agg(F.count("*").alias("_copies")), "counted-rows")
    means = counted.groupBy(*group).agg(
        (
            F.sum(F.col(value) * F.col("_copies"))
            / F.nullif(F.sum(F.when(F.col(value).isNotNull(), F.col("_copies"))), F.lit(0))
        ).alias(name)
    )
    means = means.withColumnsRenamed({g: f"_{g}" for g in group})
    # Rows without a group value form a group too.
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group]
    return counted.join(broadcast_checked(means), same, "left").select(*columns, name)
