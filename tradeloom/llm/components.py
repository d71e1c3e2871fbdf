"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the least of them. Least neighbours are found by a combinable aggregate and joined back, so a
    node with very many links is neither collected nor handled by one task."""
    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        hung = edges.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        hung = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = hung.unionByName(least.select("u", F.col("m").alias("v")))
    return hung.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``links`` (u, v), where the root is the least node that it is connected to."""
    edges = materialize(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = None
    while True:
        edges = materialize(_star(_star(edges, True), False), "links")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.withColumn("root", F.col("node")))
