import random
import re

from tradeloom.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def test_fixed_spans_are_those_of_the_patterns():
    rng = random.Random(1)
    for alphabet in ("ab1.@- ", "0123456789.", "0123456789 -", "+12 ().-3", "a@.b", "45 -"):
        for _ in range(1500):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50)))
            assert pii.base_spans(text) == plain(text), text


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "@" * 300_000, "+1" * 150_000, "0" * 9000 + ".1.1.1"):
        pii.base_spans(text)
    assert pii.base_spans("0" * 9000 + ".1.1.1") == [("ip", 0, 9006)]


DOCS = [
    (1, "mail jo@example.com or call +1 (924) 555-4113 now", "x"),
    (2, "server at 10.2.3.4 and card 4111 1111 1111 1111.", "x"),
    (3, 'password=de7d2564822667d841 and token = "0641917ea4e9feb9cda83477b57ac2654884f485"', "x"),
    (4, None, "x"),
    (5, "", "x"),
    (6, "version 1.2.3 of chapter-10 tttttttttttttttttttttttt", "x"),
    (3, 'password=de7d2564822667d841 and token = "0641917ea4e9feb9cda83477b57ac2654884f485"', "x"),
]


def test_spans_digests_and_redaction(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, spans string")
    found = pii.find(docs)
    model = pii.learn(found)
    rows = pii.decide(found, model).collect()
    assert len(rows) == len(DOCS)
    by = {r.doc_id: r for r in rows}
    assert by[1].spans == "email:5:19,phone:28:45" and (by[1].n_email, by[1].n_phone) == (1, 1)
    assert by[2].spans.startswith("ip:10:18,card:28:47")
    assert by[3].spans.count("secret:") == 2
    assert by[4].spans == by[5].spans == by[6].spans == ""
    assert by[4].base_sha256 == pii.sha256_hex(b"")
    assert by[1].base_sha256 == pii.sha256_hex(b"email:5:19,phone:28:45")
    clean = {r.doc_id: r.text for r in pii.redacted(docs, model).collect()}
    assert clean[1] == "mail <email> or call <phone> now" and clean[4] is None and clean[6] == DOCS[5][1]
    assert "de7d" not in clean[3] and "0641" not in clean[3]


def test_reliable_labelers_are_found_out(spark):
    found = pii.find(spark.createDataFrame(DOCS, "doc_id long, text string, spans string"))
    model = pii.learn(found)
    assert all(abs(t.sum() - 2 * len(pii.VOTERS)) < 1e-9 for t in model.reliability.values())
    assert all(0 < p < 1 for p in model.prior.values())


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    found = pii.find(docs)
    assert pii.decide(found, pii.learn(found)).count() == 0
    assert pii.redacted(docs, pii.learn(found)).count() == 0


def test_overlapping_spans_are_redacted_as_one_stretch():
    assert pii.redact("abcdefghij", [(0, 2, 6), (1, 4, 8), (2, 2, 3)]) == "ab<email>ij"


def test_secrets_of_any_length_are_candidates():
    long = "k" * 60 + "7" + "Q" * 300
    text = f"token {long} and key 12345678901234567890x and words"
    found = [m.group() for m in pii.FURTHER["secret"].finditer(text)]
    assert found == [long, "12345678901234567890x"]
    # Linear on a very long token without a digit, and on many short ones.
    assert not list(pii.FURTHER["secret"].finditer("a" * 300_000))
    assert not list(pii.FURTHER["secret"].finditer("ab1 " * 75_000))
