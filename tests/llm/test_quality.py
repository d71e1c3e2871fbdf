import random
import re

from pyspark.sql import functions as F

from tradeloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    again = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again)
    )


def texts():
    rng = random.Random(5)
    out = [None, "", " \n\t\x0b\x0c\r ", "one", "é # ü $$ 🎉", "a " * 5000, "x\n" * 30 + " x", "a b c d e f g h a b c d e f g h"]
    for _ in range(60):
        words = [rng.choice("abcd") for _ in range(rng.randint(1, 60))]
        out.append("".join(w + rng.choice([" ", "  ", "\n", "\t", " "]) for w in words))
    return out


def test_measurements_are_those_of_a_plain_count(spark):
    rows = [(i, t, 7) for i, t in enumerate(texts())] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int").repartition(3)
    found = quality.apply_policy(quality.ledger(docs), "prose-2").collect()
    assert len(found) == len(rows)
    for r in found:
        want = plain(rows[r.doc_id][1])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)
    assert quality.ledger(docs.where("doc_id < 0")).count() == 0


def test_clean_prose_is_kept_and_junk_is_not(spark):
    prose = " ".join(f"word{i} and then" for i in range(30)) + "."
    rows = [(1, prose), (2, prose.replace(" ", "### ")), (3, prose.upper().replace(" ", "!! ")), (4, "go " * 50)]
    kept = {r.doc_id: r.kept for r in quality.apply_policy(quality.ledger(spark.createDataFrame(rows, "doc_id long, text string")), "prose-2").collect()}
    assert kept == {1: True, 2: False, 3: False, 4: False}


def test_ablations_are_those_of_dropping_a_rule(spark):
    entries = spark.range(64).select(F.col("id").alias("doc_id"), F.col("id").alias("fail_bits"))
    out = {r.rule: r for r in quality.ablations(entries, "prose-1").collect()}
    bits = {r.name: 1 << r.bit for r in quality.RULES if r.name in quality.POLICIES["prose-1"]}
    mask = sum(bits.values())
    assert set(out) == set(bits)
    for name, bit in bits.items():
        assert out[name].failed == sum(bool(x & bit) for x in range(64))
        assert out[name].failed_alone == sum(x & mask == bit for x in range(64))
        assert out[name].kept_without == sum(x & mask & ~bit == 0 for x in range(64))
