import random

import numpy as np
import pyarrow as pa

from tradeloom.llm import dart
from tradeloom.llm.common import WordHashes
from tradeloom.llm.components import components


def test_signatures_agree_as_often_as_documents_are_similar():
    rng = np.random.default_rng(2)
    errors = []
    for size, share in ((40, 0.5), (300, 0.8), (900, 0.3), (5, 0.6)):
        for _ in range(12):
            elements = rng.integers(0, 2**63, 2 * size).astype(np.uint64)
            a, b = rng.integers(1, 6, (2, 2 * size)).astype(float)
            shared = rng.random(2 * size) < share
            a[shared] = b[shared]
            a[~shared & (rng.random(2 * size) < 0.5)] = 0
            want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
            rows = dart.signatures(np.concatenate([elements[a > 0], elements]), np.concatenate([a[a > 0], b]), np.repeat([0, 1], [(a > 0).sum(), len(b)]), 2, 512)
            errors.append((rows[0] == rows[1]).mean() - want)
    assert abs(np.mean(errors)) < 0.01 and np.abs(errors).max() < 0.12


def corpus():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    base = [[rng.choice(words) for _ in range(rng.randint(30, 250))] for _ in range(60)]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    for i in range(200):
        b = list(rng.choice(base[:15]))
        for _ in range(rng.randint(0, max(1, len(b) // 40))):
            b[rng.randrange(len(b))] = rng.choice(words)
        rows.append((100 + i, " ".join(b)))
    hub = [rng.choice(words) for _ in range(400)]
    for i in range(80):  # one large group of near copies, and one of exact ones
        b = list(hub)
        for _ in range(6):
            b[rng.randrange(len(b))] = rng.choice(words)
        rows += [(1000 + i, " ".join(b)), (2000 + i, "  ".join(hub))]
    rows += [(3000, None), (3001, ""), (3002, " \n"), (3003, "two words"), (3004, "two  words"), (3005, "other words"), (5, rows[5][1])]
    return rows


def plain(rows):
    hashes = WordHashes()
    sets = {}
    for doc, text in rows:
        words = (text or "").split()
        if words:
            sets[doc] = dart.weighted_shingles(words, hashes)
    parent = {doc: doc for doc, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if dart.weighted_jaccard(sets[a], sets[b]) >= 0.8:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {doc: find(doc) for doc, _ in rows}


def test_classes_are_those_of_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, class_id int").repartition(4)
    out = dart.near_duplicates(docs).collect()
    assert len(out) == len(rows)
    assert {r.doc_id: r.class_id for r in out} == plain(rows)


def crowd():
    """Texts of one template are alike (0.75), but only two of each are similar enough (0.82)."""
    rng = random.Random(5)
    template = [f"w{i}" for i in range(1200)]
    rows = []
    for i in range(100):
        places = rng.sample(range(2, 1200, 5), 29)
        for who, own in ((i, places[5:17]), (9000 - i, places[17:])):
            one = list(template)
            for k in places[:5]:
                one[k] = f"x{i}-{k}"
            for k in own:
                one[k] = f"y{who}-{k}"
            rows.append((who, " ".join(one)))
    return rows


def test_links_far_from_each_other_in_a_crowded_bucket(spark):
    rows = crowd()
    want = plain(rows)
    got = {r.doc_id: r.class_id for r in dart.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(set(want.values())) > 50
    assert got == want


def test_a_cell_gives_fewer_links_than_texts():
    rng = random.Random(3)
    hub = [f"w{i}" for i in range(600)]
    texts = []
    for i in range(60):  # alike and similar, all in the same buckets
        one = list(hub)
        one[rng.randrange(600)] = f"x{i}"
        texts.append(" ".join(one))
    hashes = WordHashes()
    pairs = [dart.weighted_shingles(t.split(), hashes) for t in texts]
    owner = np.repeat(np.arange(60), [len(e) for e, _ in pairs])
    signed = dart.signatures(np.concatenate([e for e, _ in pairs]), np.concatenate([c for _, c in pairs]).astype(float), owner, 60)
    links = []
    for band in range(dart.DARTS // dart.ROWS):  # one bucket of all texts per band, as a cell of its own
        columns = [
            pa.array([band] * 60), pa.array([dart.BOTH] * 60, pa.int32()), pa.array(range(60)), pa.array(range(60)),
            pa.array([band] * 60, pa.int32()), pa.array([r.astype("<u4").tobytes() for r in signed]), pa.array(texts),
        ]
        batch = pa.RecordBatch.from_arrays(columns, names=["cell", "side", "rep", "root", "band", "signature", "text"])
        found = [row for out in dart._across(0.8)(iter([batch.slice(0, 25), batch.slice(25)])) for row in out.to_pylist()]
        assert len(found) < 60
        links += [(row["u"], row["v"]) for row in found]
    classes = list(range(60))
    for u, v in links:
        classes = [min(classes[u], classes[v]) if c in (classes[u], classes[v]) else c for c in classes]
    assert set(classes) == {0}


def test_least_equal_coordinates():
    assert dart.least_equal(0.8) == 56 and dart.least_equal(1.0) == 96


def test_empty_table(spark):
    assert dart.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_chains_stars_and_circles(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    links += [(7, 7), (300, 301), (301, 300)]
    rng.shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)} | {i: 200 for i in range(200, 209)} | {300: 300, 301: 300}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
