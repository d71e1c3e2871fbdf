import random

import numpy as np

from tradeloom.llm import repeats


def plain(rows):
    """Kept bytes by position in ``rows``."""
    earlier = {}
    for doc, text in rows:
        t = (text or "").encode()
        if doc is not None:
            for p in range(len(t) - 49):
                w = t[p : p + 50]
                earlier[w] = min(doc, earlier.get(w, doc))
    out = []
    for doc, text in rows:
        t = (text or "").encode()
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - 49):
            if doc is not None and earlier[t[p : p + 50]] < doc:
                gone[p : p + 50] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(t) else 0
        out.append((doc, len(t), int(gone.sum()), spans, kept))
    return out


def corpus():
    rng = random.Random(11)
    letters = "ab éßx yz"
    parts = ["".join(rng.choice(letters) for _ in range(rng.randint(30, 140))) for _ in range(25)]
    rows = [(i, "".join(rng.choice(parts)[rng.randint(0, 9) :] for _ in range(rng.randint(0, 6)))) for i in range(-20, 160)]
    rows += [(500, "a" * 700), (501, "a" * 60), (502, "ab" * 300), (503, None), (504, ""), (505, "a" * 49), (7, "a" * 70), (7, "a" * 70)]
    rows += [(None, rows[30][1]), (600, rows[30][1]), (2**62, parts[0] * 3), (-(2**62), parts[0] + parts[1])]
    common = parts[3] + "common line of many documents, longer than fifty bytes in all"
    rows += [(1000 + i, f"{rng.random()} {rng.random()} {common} {rng.random()}") for i in range(150)]
    return rows


def test_removed_bytes_are_those_of_a_plain_search(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, kept string").repartition(5)
    got = sorted(map(tuple, repeats.repeats(docs).collect()), key=str)
    got = [(d, n, m, s, bytes(k)) for d, n, m, s, k in got]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_carried_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "x" * 60, "en", 3), (2, "x" * 60, None, 4)], "doc_id long, text string, lang string, g int")
    rows = {r.doc_id: r for r in repeats.repeats(docs, carry=("lang",)).collect()}
    assert rows[1].lang == "en" and rows[2].lang is None and rows[2].n_removed == 60
    assert repeats.repeats(docs.where("doc_id > 9")).count() == 0


def test_longest_previous_factors_of_pieces():
    rng = random.Random(2)
    pieces = [(rng.randint(0, 9), bytes(rng.choice(b"ab") for _ in range(rng.randint(50, 80)))) for _ in range(40)]
    pieces += [(d, (b"a" * 30 + p)[:80]) for d, p in pieces[:20]]
    blobs = []
    for part in (pieces[:25], pieces[25:]):
        ids, sizes = np.array([d for d, _ in part]), np.array([len(p) for _, p in part])
        blobs.append(repeats.packed(ids) + repeats.packed(sizes) + b"".join(p for _, p in part))
    got = []
    for part, bits in zip((pieces[:25], pieces[25:]), repeats.earlier(blobs)):
        n = sum(len(p) - 49 for _, p in part)
        got += np.unpackbits(np.frombuffer(bits, np.uint8), count=n).tolist()
    want = [int(any(e < d and p[i : i + 50] in q for e, q in pieces)) for d, p in pieces for i in range(len(p) - 49)]
    assert got == want


def test_previous_smaller_places():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 50, 300):
        v = rng.integers(0, 9, n)
        want = [max((j for j in range(i) if v[j] < v[i]), default=-1) for i in range(n)]
        assert repeats.previous_smaller(v).tolist() == want
