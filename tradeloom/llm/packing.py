"""Packing into optimal length buckets.

The histogram of lengths over all documents is small, so the bucket borders that give the least padding can be found
exactly: with ``buckets`` borders, least[k][j] = min over i of least[k-1][i] plus the padding of the lengths after i up
to j, when they are padded to length j. For a fixed k these are lines in the length, queried in rising order, so a
monotone hull answers in time linear in the number of lengths. Inside a bucket, documents fill batches of ``budget``
padded tokens in a fixed order; a document above the budget is a batch of its own.

The histogram is exact at every length: n words in total have fewer than sqrt(2 n) + 1 different lengths. A place within a bucket comes from ranks inside slices of a bucket, dealt by a hash of the id, and sums of
slice sizes, so a bucket may hold any share of the rows.

Cases: null and negative lengths count as 0, and a bucket is at least one token long. Equal ids may swap places only if
their lengths are equal too. An empty table gives no rows. Only the id and the length are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.session import materialize

SLICE_ROWS = 4_096
BUCKETS = 16
BUDGET = 65_536


def word_count(text: Column) -> Column:
    """Words between spaces, tabs and line ends: the tokens of a document where no encoder is asked for."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def borders(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """The lengths that buckets pad to, rising, with the least padding in total; the fewest buckets among equals."""
    rows = sorted((max(1, n), c) for n, c in histogram if c > 0)
    lengths: list[int] = []
    count, mass = [0], [0]
    for n, c in rows:
        if lengths and lengths[-1] == n:
            count[-1] += c
            mass[-1] += n * c
        else:
            lengths.append(n)
            count.append(count[-1] + c)
            mass.append(mass[-1] + n * c)
    d = len(lengths)
    if not d:
        return []
    least: list[int | None] = [0] + [None] * d
    choices: list[list[int]] = []
    finals: list[int] = []
    for _ in range(min(buckets, d)):
        hull: list[tuple[int, int, int]] = []  # (slope, offset, i)
        at, now, chosen = 0, [None] * (d + 1), [0] * (d + 1)
        for j in range(1, d + 1):
            if least[j - 1] is not None:
                line = (-count[j - 1], least[j - 1] + mass[j - 1], j - 1)
                while len(hull) >= 2:
                    (m1, b1, _), (m2, b2, _) = hull[-2], hull[-1]
                    if (line[1] - b1) * (m1 - m2) <= (b2 - b1) * (m1 - line[0]):
                        hull.pop()
                    else:
                        break
                hull.append(line)
                at = min(at, len(hull) - 1)
            if hull:
                x = lengths[j - 1]
                while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                    at += 1
                m, b, i = hull[at]
                now[j] = m * x + b + x * count[j] - mass[j]
                chosen[j] = i
        choices.append(chosen)
        finals.append(now[d])
        least = now
    k = finals.index(min(finals))
    out, j = [], d
    while j:
        out.append(lengths[j - 1])
        j = choices[k][j]
        k -= 1
    return out[::-1]


def pack(
    docs: DataFrame, length: Column, buckets: int = BUCKETS, budget: int = BUDGET, id_col: str = "doc_id"
) -> DataFrame:
    """``doc_id, n_tokens, bucket, bucket_tokens, batch, padding``: the bucket, and the batch inside it, of every row."""
    spark = docs.sparkSession
    sized = docs.select(F.col(id_col).alias("doc_id"), F.greatest(F.coalesce(length, F.lit(0)), F.lit(0)).cast("long").alias("n_tokens"))
    sized = materialize(sized, "packing-lengths")
    counts = sized.groupBy(F.greatest("n_tokens", F.lit(1)).cast("long").alias("n")).agg(F.count("*").alias("c"))
    histogram = [(r.n, r.c) for r in counts.collect()]
    if not histogram:
        empty = "doc_id long, n_tokens long, bucket int, bucket_tokens long, batch long, padding long"
        return spark.createDataFrame([], empty)
    ends = borders(histogram, buckets)
    sizes = [0] * len(ends)
    for n, c in histogram:
        sizes[sum(e < n for e in ends)] += c
    per_bucket = F.array(
        *(
            F.struct(
                F.lit(e).cast("long").alias("tokens"),
                F.lit(max(1, budget // e)).cast("long").alias("room"),
                F.lit(-(-s // SLICE_ROWS)).cast("long").alias("slices"),
            )
            for e, s in zip(ends, sizes)
        )
    )
    bucket = F.size(F.filter(F.array(*(F.lit(e).cast("long") for e in ends)), lambda e: e < F.col("n_tokens")))
    placed = sized.withColumn("bucket", bucket).withColumn("b", F.get(per_bucket, F.col("bucket")))
    placed = placed.select("doc_id", "n_tokens", "bucket", "b.*")
    placed = placed.withColumn("slice", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.col("slices")))
    sums = placed.groupBy("bucket", "slice").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("bucket", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket", "slice").orderBy("doc_id", "n_tokens")
    placed = placed.withColumn("place", F.row_number().over(inside) - 1).join(sums, ["bucket", "slice"])
    return placed.select(
        "doc_id", "n_tokens", "bucket", F.col("tokens").alias("bucket_tokens"),
        F.expr("(before + place) div room").alias("batch"),
        (F.col("tokens") - F.col("n_tokens")).alias("padding"),
    )
