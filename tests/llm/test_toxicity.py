import math
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from tradeloom.llm import toxicity

WORD = regex.compile(r"[\p{L}\p{N}]+")


def toks(text):
    return [toxicity.START] * 2 + WORD.findall((text or "").lower()) + [toxicity.END]


def discounts(counts):
    n = [sum(1 for c in counts if c == i) for i in range(1, 5)]
    if n[0] == 0 or n[1] == 0:
        return 0.5, 0.75, 0.9
    y = n[0] / (n[0] + 2 * n[1])
    d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
    return tuple(min(max(x, 0.05), i + 1.0) for i, x in enumerate(d))


def disc(c, d):
    return max(c - (d[0] if c == 1 else d[1] if c == 2 else d[2]), 0.0)


def mass(c, d):
    return d[0] if c == 1 else d[1] if c == 2 else d[2]


def plain_d(train, texts):
    """The same model by plain counting."""
    tri = {}
    for y, t in train:
        w = toks(t)
        for i in range(len(w) - 2):
            g = tuple(w[i : i + 3])
            tri.setdefault(g, [0, 0])[y] += 1
    cls = []
    for y in (1, 0):
        c = {g: v[y] for g, v in tri.items() if v[y] > 0}
        d = discounts(list(c.values()))
        tot, ms = {}, {}
        for g, n in c.items():
            tot[g[:2]] = tot.get(g[:2], 0) + n
            ms[g[:2]] = ms.get(g[:2], 0) + mass(n, d)
        cls.append((c, d, tot, ms))
    cont2 = {}
    for g, v in tri.items():
        e = cont2.setdefault(g[1:], [0, 0])
        e[0] += v[1] > 0
        e[1] += v[0] > 0
    lower = []
    for k in (0, 1):
        c2 = {g: v[k] for g, v in cont2.items() if v[k] > 0}
        d2 = discounts(list(c2.values()))
        tot2, ms2 = {}, {}
        for g, n in c2.items():
            tot2[g[0]] = tot2.get(g[0], 0) + n
            ms2[g[0]] = ms2.get(g[0], 0) + mass(n, d2)
        lower.append((c2, d2, tot2, ms2))
    cont1 = {}
    for g in cont2:
        cont1[g[1]] = cont1.get(g[1], 0) + 1
    d1 = discounts(list(cont1.values()))
    total = sum(cont1.values())
    m1 = sum(mass(n, d1) for n in cont1.values())
    uni = 1 / (len(cont1) + 1)

    def p1(w):
        return disc(cont1[w], d1) / total + m1 / total * uni if w in cont1 else m1 / total * uni

    def p2(k, v, w):
        c2, d2, tot2, ms2 = lower[k]
        return (disc(c2.get((v, w), 0), d2) + ms2[v] * p1(w)) / tot2[v] if v in tot2 else p1(w)

    def p3(k, g):
        c, d, tot, ms = cls[k]
        if g[:2] not in tot:
            return p2(k, *g[1:])
        return (disc(c.get(g, 0), d) + ms[g[:2]] * p2(k, *g[1:])) / tot[g[:2]]

    out = []
    for t in texts:
        w = toks(t)
        lr = [math.log(p3(0, tuple(w[i : i + 3]))) - math.log(p3(1, tuple(w[i : i + 3]))) for i in range(len(w) - 2)]
        out.append(sum(lr) / len(lr))
    return out


BAD = ["idiot", "stupid", "moron", "trash", "loser", "dumb"]
GOOD = ["garden", "river", "music", "bread", "window", "friend", "table", "morning", "travel", "book"]


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        words = [rng.choice(GOOD) for _ in range(rng.randint(5, 30))]
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words) + 1), "you " + rng.choice(BAD))
        rows.append((i, " ".join(words).title(), toxic))
    return rows


def test_evidence_equals_plain_counting(spark):
    rows = corpus(120)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(999, None), (1000, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    got = {r.doc_id: r.d for r in toxicity.score(docs, labels, held).collect()}
    train = [(y, t) for i, t, y in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    texts = [t for _, t, _ in rows] + [None, ""]
    want = plain_d(train, texts)
    for i, w in zip([r[0] for r in rows] + [999, 1000], want):
        assert abs(got[i] - w) < 1e-9, (i, got[i], w)


def test_held_out_rows_are_told_apart(spark):
    rows = corpus(600, seed=5)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    out = {r.doc_id: r for r in toxicity.score(docs, labels, held).collect()}
    truth = {i: y for i, _, y in rows}
    held_rows = [r for r in out.values() if r.held_out]
    right = sum(1 for r in held_rows if r.predicted == truth[r.doc_id])
    assert len(held_rows) > 150 and right / len(held_rows) >= 0.9
    assert all(0 <= r.score <= 1 for r in out.values())


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(docs, labels, F.col("doc_id") % 3 == 1).collect() == []


def test_rare_words_are_counted_exactly(spark, monkeypatch):
    """Most words outside the numbered ones, most of them unknown to the model, in several shards and rounds."""
    monkeypatch.setattr(toxicity, "HEAD_WORDS", 6)
    rows = [(i, f"{t} only{i} also{i % 40}", y) for i, t, y in corpus(90, seed=3)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(999, None), (1000, "")] + [rows[0][:2]], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    found = toxicity.score(docs, labels, held).collect()
    assert len(found) == 93
    got = {r.doc_id: r.d for r in found}
    train = [(y, t) for i, t, y in [*rows, rows[0]] if zlib.crc32(str(i).encode()) % 3 != 1]
    for i, w in zip([r[0] for r in rows] + [999, 1000], plain_d(train, [t for _, t, _ in rows] + [None, ""])):
        assert abs(got[i] - w) < 1e-9, (i, got[i], w)


def test_blocks_are_small_and_whole():
    rng = np.random.default_rng(7)
    words = np.minimum(rng.zipf(1.3, (3, 60_000)), 100_000) + toxicity.FIRST
    words = np.where(rng.random(words.shape) < 0.01, -words * 10**12, words)
    u, v, w = words[:, toxicity._sorted(*words)[0]]
    new = toxicity._new(u, v, w)
    counts, rows = np.diff(np.append(new, len(u))), rng.integers(0, 1000, len(u))
    block = toxicity.pack(u[new], v[new], w[new], counts, rows)
    for a, b in zip(toxicity.unpack(block), (u[new], v[new], w[new], counts, rows)):
        assert np.array_equal(a, b)
    assert len(block) < 8 * len(u)  # a row of keys takes 48 bytes


def test_shuffle_files_go_and_the_setting_stays(spark):
    before = spark.conf.get(toxicity.CLEANUP, None)
    assert toxicity._written(spark.range(9).repartition(3), "toxicity-test").count() == 9
    assert spark.conf.get(toxicity.CLEANUP, None) == before


def shard_rows(n):
    """Blocks of one shard with about ``n`` trigrams and the bigrams at their ends, some with rare words."""
    rng = np.random.default_rng(11)
    words = np.minimum(rng.zipf(1.3, (3, n)), 100_000) + toxicity.FIRST
    words = np.where(rng.random(words.shape) < 0.05, -words * 10**12, words)
    by, new = toxicity._sorted(*words)
    blocks = []
    for u, v, w in np.array_split(words[:, by[new]], 20, axis=1):
        x, y = np.unique(np.stack([v, w]), axis=1)
        zeros = np.zeros(len(x), np.int64)
        u, v, w = np.concatenate([u, x]), np.concatenate([v, y]), np.concatenate([w, zeros + toxicity.PAD])
        c_t, c_o = (np.concatenate([rng.integers(0, 4, len(u) - len(x)), zeros]) for _ in range(2))
        c_o[: len(u) - len(x)] += c_t[: len(u) - len(x)] == 0
        n_t, n_o = rng.integers(1, 5, (2, len(u)))
        low = toxicity._rare(u, v, w, c_t + c_o)
        more = toxicity._doubles(*rng.uniform(0.001, 0.1, (2, int(low.sum()))))
        blocks.append((toxicity.pack(u, v, w, c_t, np.concatenate([c_o, n_t, n_o]), more), (u, v, w)))
    head = np.ones((len(toxicity.STATS), toxicity.HEAD_WORDS + toxicity.FIRST))
    numbers = {k: (0.5, 0.75, 0.9) for k in ("d_t", "d_o", "d2_t", "d2_o", "d1")} | {"unigrams": (1e6, 1e3, 1e-6)}
    return pa.table({"block": pa.array([b for b, _ in blocks], pa.binary())}), [x for _, x in blocks], head, numbers


def test_terms_of_a_shard_take_little_memory():
    blocks, asked, head, numbers = shard_rows(400_000)
    n = sum(len(x[0]) for x in asked)
    tracemalloc.start()
    toxicity.Terms(blocks, head, numbers)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 * n, peak / n


def test_terms_do_not_depend_on_the_parts(monkeypatch):
    blocks, asked, head, numbers = shard_rows(30_000)
    found = []
    for parts in (1, 8, 64):
        monkeypatch.setattr(toxicity, "PARTS", parts)
        terms = toxicity.Terms(blocks, head, numbers)
        assert np.all(terms.pairs.keys[1:] > terms.pairs.keys[:-1])
        found.append(np.concatenate([terms.of(*x) for x in asked]))
    assert np.any(found[0]) and np.array_equal(found[0], found[1]) and np.array_equal(found[0], found[2])


def test_texts_are_read_in_small_batches(spark, monkeypatch):
    seen, before = [], spark.conf.get(toxicity.READ_ROWS)
    monkeypatch.setattr(toxicity, "materialize", lambda df, name: seen.append(int(df.sparkSession.conf.get(toxicity.READ_ROWS))))
    toxicity._written(spark.range(9), "toxicity-test")
    assert seen[0] <= 1_000 and spark.conf.get(toxicity.READ_ROWS) == before


def test_the_result_reads_no_text_again(spark, tmp_path):
    rows = corpus(40)
    spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    out = toxicity.score(docs, labels, F.crc32(F.col("doc_id").cast("string")) % 3 == 1)
    assert not [x for x in out.inputFiles() if f"{tmp_path}/docs" in x]
    assert out.count() == 41 and out.where("d is null").count() == 0
