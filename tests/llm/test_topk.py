import math
import random

from pyspark.sql import functions as F

from tradeloom.llm import topk


def plain(rows, asked, k):
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in {q: v for q, v in whole if q in asked}.items():
        scores = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def got(spark, rows, asked, k=10):
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(3)
    out = topk.top_k(vectors, vectors.where(F.col("vec_id").isin(asked)), k)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out.collect())


def test_scores_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    rng = random.Random(6)
    rows = [(i, [rng.choice([0.5, -0.25, rng.gauss(0, 1) * rng.choice([1, 1, 4])]) for _ in range(8)]) for i in range(300)]
    rows = [(i, [float(F32(x)) for x in v]) for i, v in rows]
    rows += [(1000 + i, rows[3][1]) for i in range(20)]  # ties
    rows += [(2000, None), (2001, [0.5] * 7 + [None]), (2002, [float("nan")] + [0.5] * 7), (2003, [float("inf")] * 8)]
    asked = list(range(0, 300, 20)) + [1003, 2000, 2002]
    assert got(spark, rows, asked) == plain(rows, asked, 10)


def F32(x):
    import numpy as np

    return np.float32(x)


def test_few_rows_other_dimensions_and_nothing(spark):
    rows = [(1, [1.0, 2.0]), (2, [0.5, 0.5]), (3, [9.0]), (4, [])]
    assert got(spark, rows, [1, 3]) == [(1, 1, 2, 1024 * 512 + 2048 * 512)]
    assert got(spark, rows[2:], [9]) == [] and got(spark, [], [1]) == []


def test_large_components_are_exact(spark):
    rows = [(1, [2.0**20, 1.0]), (2, [2.0**20, 2.0**-9]), (3, [2.0**20, -1.0])]
    assert got(spark, rows, [1]) == plain(rows, [1], 10)


def test_pruning_keeps_ties_and_skips_short_vectors():
    import numpy as np

    rng = np.random.default_rng(1)
    cands = np.floor(rng.normal(size=(2000, 16)) * 100)
    ids = np.arange(2000)
    out = topk.best(np.array([-1]), cands[:1] * 3, np.array([-np.inf]), ids, cands, np.eye(16), 5)
    scores = (cands @ (cands[0] * 3)).astype(int)
    assert [(v, s) for _, v, s in out] == sorted(zip(ids.tolist(), scores.tolist()), key=lambda x: (-x[1], x[0]))[:5]


def test_cells_hold_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 5)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "CELLS", 2)
    rng = random.Random(8)
    rows = [(i, [float(F32(rng.gauss(0, 1) * rng.choice([1, 1, 3]))) for _ in range(6)]) for i in range(200)]
    rows += [(500, rows[7][1])] * 90 + [(501 + i, rows[9][1]) for i in range(40)]  # one id that fills many blocks; ties
    asked = [0, 7, 9, 11, 60, 199, 500, 505]
    assert got(spark, rows, asked) == plain(rows, asked, 10)
    monkeypatch.setattr(topk, "CELL_BYTES", 8 * 6 * 20)  # four blocks of five in a cell
    assert got(spark, rows, asked) == plain(rows, asked, 10)


def test_no_block_passes_through_the_driver(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 8)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng = random.Random(9)
    rows = [(i, [float(F32(rng.gauss(0, 1))) for _ in range(8)]) for i in range(400)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = topk.top_k(vectors, vectors.where("vec_id % 20 = 0"))
    assert sorted(map(tuple, out.collect())) == [tuple(r) for r in plain(rows, range(0, 400, 20), 10)]
    ran = out._jdf.queryExecution().executedPlan().toString().splitlines()
    assert any("isFinalPlan=true" in line for line in ran)
    assert not [line for line in ran if "Broadcast" in line and "Join" in line and "vec_id" not in line]
