"""Per-key operators against a plain computation, with one key that holds most rows."""

import random
from itertools import groupby

from pyspark.sql import functions as F

from tradeloom.operators import keyed


def sample(n=600):
    rng = random.Random(7)
    return [
        (rng.choice(["hot", "hot", "hot", "a", None]), rng.randint(1, 9), rng.choice([None, None, 1.0, 2.0, 5.0]))
        for _ in range(n)
    ]


def test_forward_fill_in_both_forms(spark):
    rows = sample()
    expected = {}
    for key in {r[0] for r in rows}:
        last, count = None, 0
        for step in range(1, 10):
            values = [v for k, s, v in rows if k == key and s == step]
            if not values:
                continue
            filled = [v for v in values if v is not None]
            last, count = (min(filled) if filled else last), count + len(filled)
            expected[(key, step)] = (count, last)
    df = spark.createDataFrame(rows, "key string, step int, rate double")
    once = keyed.forward_fill(df, ["key"], "step", "rate").collect()
    assert {(r.key, r.step): (r.rate_group, r.rate_filled) for r in once} == expected
    fused = keyed.forward_fill_fused(df, ["key"], "step", ["rate"]).collect()
    assert {(r.key, r.step): r.rate_filled for r in fused} == {k: v[1] for k, v in expected.items()}


def test_group_mean_counts_duplicates(spark):
    rows = sample()
    df = spark.createDataFrame(rows, "key string, step int, rate double")
    got = keyed.distinct_with_group_mean(df, ["key"], "rate", "mean").collect()
    assert {(r.key, r.step, r.rate) for r in got} == set(rows) and len(got) == len(set(rows))
    by_key = sorted(rows, key=lambda r: str(r[0]))
    for key, members in groupby(by_key, key=lambda r: r[0]):
        values = [r[2] for r in members if r[2] is not None]
        assert {round(r["mean"], 9) for r in got if r.key == key} == {round(sum(values) / len(values), 9)}


def test_latest_revision_prefers_a_missing_one_then_the_highest(spark):
    rows = [(1, "H9", 1, 1, 1.0), (2, "H5", 1, 1, 2.0), (3, None, 1, 2, 3.0), (4, "H9", 1, 2, 4.0), (5, "H1", 2, 1, 5.0), (6, "H1", 2, 1, 6.0)]
    df = spark.createDataFrame(rows, "id int, nomen_code string, reporter int, product int, bound_rate double")
    got = {(r.reporter, r["product"]): r.id for r in keyed.latest_revision(df).collect()}
    assert got == {(1, 1): 1, (1, 2): 3, (2, 1): 5}


def test_latest_reduces_before_the_shuffle(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("k"))
    plan = keyed.latest_per_key(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
