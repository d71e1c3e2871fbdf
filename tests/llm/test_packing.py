import random
from itertools import combinations

from pyspark.sql import functions as F

from tradeloom.llm import packing


def padding(histogram, ends):
    return sum(c * (min(e for e in ends if e >= n) - max(n, 0)) for n, c in histogram)


def test_borders_give_the_least_padding():
    rng = random.Random(4)
    for _ in range(60):
        histogram = [(n, rng.randint(1, 9)) for n in rng.sample(range(1, 60), rng.randint(1, 9))]
        lengths = sorted(n for n, _ in histogram)
        for buckets in (1, 2, 3, 20):
            ends = packing.borders(histogram, buckets)
            assert len(ends) <= buckets and ends[-1] == lengths[-1]
            options = [
                [*c, lengths[-1]] for k in range(min(buckets, len(lengths))) for c in combinations(lengths[:-1], k)
            ]
            assert padding(histogram, ends) == min(padding(histogram, o) for o in options)


def test_batches_keep_to_the_budget(spark):
    rng = random.Random(7)
    rows = [(i, "w " * rng.choice([0, 1, 3, 5, 40, 41, 200])) for i in range(3000)] + [(-1, None), (3, "w w w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit("clash"))
    out = packing.pack(docs, packing.word_count(F.col("text")), buckets=3, budget=100).collect()
    assert len(out) == len(rows)
    tokens = {}
    for r in out:
        assert 0 <= r.padding == r.bucket_tokens - r.n_tokens
        tokens.setdefault((r.bucket, r.batch), []).append(r.bucket_tokens)
    assert all(sum(t) <= 100 or len(t) == 1 for t in tokens.values())
    full = {}
    for (bucket, batch), t in tokens.items():
        full.setdefault(bucket, {})[batch] = len(t)
    for batches in full.values():  # all but the last batch of a bucket are full
        assert sorted(batches) == list(range(len(batches)))
        assert len({n for b, n in batches.items() if b < len(batches) - 1}) <= 1


def test_long_lengths_and_empty_table(spark):
    docs = spark.createDataFrame([(1, 10**7), (2, 3), (3, None), (4, -5)], "doc_id long, n long")
    out = {r.doc_id: r for r in packing.pack(docs, F.col("n"), buckets=2).collect()}
    assert out[1].bucket_tokens >= 10**7 and out[2].n_tokens == 3 and out[3].n_tokens == out[4].n_tokens == 0
    assert packing.pack(docs.where("doc_id > 9"), F.col("n")).count() == 0


def test_one_very_long_document_leaves_the_borders_exact(spark):
    rng = random.Random(3)
    lengths = [1_000_000, *(rng.choice([3, 7, 20, 41, 90, 100, 101, 230]) for _ in range(400))]
    docs = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n long")
    out = packing.pack(docs, F.col("n"), buckets=4).collect()
    some = sorted(set(lengths))
    best = min(
        sum(min(e for e in ends if e >= n) - n for n in lengths)
        for ends in ([*c, 1_000_000] for c in combinations(some[:-1], 3))
    )
    assert len(out) == len(lengths) and sum(r.padding for r in out) == best
