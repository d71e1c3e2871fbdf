import math
import random

import numpy as np
from pyspark.sql import functions as F

from tradeloom.llm import negatives


def plain(rows, every=100, scale=256, k_pos=5, k_neg=10, low=30, high=90):
    usable = []
    for vid, vec, lab in rows:
        if vid is None or lab is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        lab = (lab + 1) % 10 if vid % 7 == 0 else lab
        usable.append((vid, lab, [math.floor(scale * float(np.float32(x))) for x in vec]))
    out = []
    for aid, alab, a in usable:
        if aid % every:
            continue
        scored = [(sum(p * q for p, q in zip(a, c)), vid, lab) for vid, lab, c in usable if vid != aid and len(c) == len(a)]
        scored.sort(key=lambda t: (-t[0], t[1]))
        pos = [t for t in scored if t[2] == alab][:k_pos]
        for ps, pid, _ in pos:
            neg = [t for t in scored if t[2] != alab and low * ps <= 100 * t[0] <= high * ps][:k_neg]
            out += [(aid, pid, r + 1, nid, ps, ns) for r, (ns, nid, _) in enumerate(neg)]
    return sorted(out)


def run(spark, rows, every=100):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    relabel = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.mine(df, F.col("vec_id") % every == 0, relabel=relabel).collect()
    return sorted(map(tuple, got))


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 64)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", 4)
    monkeypatch.setattr(negatives, "SEED_ROWS", 100)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1500):
        vec = (rng.normal(size=16) * rng.uniform(0.2, 2)).astype(np.float32).tolist()
        rows.append((i, vec, int(rng.integers(0, 4))))
    rows += [(5000, [1.0] * 16, 1)] * 3  # repeated rows
    rows += [(None, [1.0] * 16, 1), (7000, None, 1), (7001, [None] + [1.0] * 15, 1), (7002, [float("nan")] * 16, 1)]
    rows += [(7003, [1.0] * 16, None), (7100, [0.5] * 8, 2), (7200, [0.0] * 16, 3)]
    assert run(spark, rows, every=20) == plain(rows, every=20)


def test_ties_and_few_rows(spark):
    rows = [(i * 100, [1.0, 0.0], i % 2) for i in range(4)] + [(1, [0.5, 0.0], 0), (2, [0.5, 0.0], 1)]
    assert run(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
