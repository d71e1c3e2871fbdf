import hashlib
import zlib

from tradeloom.llm import merkle


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, text):
    d, src, lang, n, _ = row
    return h(field(d) + field(src) + field(lang) + field(n) + field(text))


def tamper(row):
    d, text = row[0], row[4]
    if d is not None and text is not None and zlib.crc32(str(d).encode()) % 3 == 0:
        return text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return text


def tree(hashes):
    """All runs of every level, and the top."""
    levels = []
    while len(hashes) > 1:
        runs = [hashes[i : i + 8] for i in range(0, len(hashes), 8)]
        levels.append(runs)
        hashes = [h("".join(r)) for r in runs]
    return hashes[0], levels


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r, leaf(r, r[4]), leaf(r, tamper(r))))
    keys = sorted(by, key=lambda k: (k is not None, (k or "").encode()))
    subs, trees = [], {}
    for k in keys:
        items = sorted(by[k], key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        by[k] = items
        top, levels = tree([x[1] for x in items])
        subs.append(top)
        trees[k] = levels
    root, upper = tree(subs)

    def climb(i, levels, start):
        sib, cur = "", start
        for runs in levels:
            run = runs[i // 8]
            p = i % 8
            left, right = "".join(run[:p]), "".join(run[p + 1 :])
            sib += left + right
            cur = h(left + cur + right)
            i //= 8
        return sib, cur

    out = []
    for li, k in enumerate(keys):
        for i, (r, lf, tl) in enumerate(by[k]):
            s1, c1 = climb(i, trees[k], tl)
            s2, c2 = climb(li, upper, c1)
            out.append((r[0], lf, subs[li], root, h(s1 + s2), c2, c2 == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(d, t, l, s, n, "x") for d, s, l, n, t in rows], SCHEMA).repartition(parts)
    got = merkle.manifest(df).collect()
    return sorted(map(tuple, got), key=str)


def test_against_a_plain_tree(spark):
    rows = []
    for i in range(300):
        lang = ["en", "de", None, "é", "fr"][i % 5] if i < 290 else "zz"
        text = None if i % 17 == 0 else ("Hello World " * (i % 4)) + ("abc" if i % 2 else "XYZ")
        rows.append((None if i == 7 else i, "src" if i % 3 else None, lang, None if i % 11 == 0 else i * 2, text))
    rows.append(rows[5])  # a repeated row
    rows.append((3, "s", "en", 1, ""))  # a repeated id, empty text
    assert run(spark, rows) == plain(rows)


def test_sizes_at_the_fan_borders(spark):
    for n in (1, 2, 8, 9, 64, 65):
        rows = [(i, "s", "en", i, "Some Text" if i % 2 else "plain") for i in range(n)]
        assert run(spark, rows, parts=4) == plain(rows)


def test_one_document_is_its_own_root(spark):
    got = run(spark, [(1, None, None, None, None)])
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == h("")


def test_empty_table(spark):
    assert run(spark, []) == []


def test_long_text(spark):
    rows = [(i, "s", "en", 1, "A" * 2_000_000 if i == 3 else "b") for i in range(20)]
    assert run(spark, rows) == plain(rows)


def test_salted_path_join(spark, monkeypatch):
    monkeypatch.setattr(merkle, "PATH_BROADCAST_BYTES", 0)
    rows = [(i, "s", ["en", "de", None][i % 3], i, "Ab" * (i % 5)) for i in range(70)]
    assert run(spark, rows) == plain(rows)
