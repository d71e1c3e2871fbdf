import math
import random
from collections import Counter, defaultdict

import pytest

from tradeloom.llm import kneser

ORDER, START = kneser.ORDER, chr(kneser.START)


def sequence(text):
    return START * (ORDER - 1) + " ".join(text.split())


class Plain:
    def __init__(self, texts):
        self.counts = {ORDER: Counter()}
        for t in texts:
            x = sequence(t)
            self.counts[ORDER].update(x[i : i + ORDER] for i in range(len(x) - ORDER + 1))
        for n in range(ORDER - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.cut = {n: kneser.discounts(Counter(c.values())) for n, c in self.counts.items()}
        self.context = {n: defaultdict(lambda: [0, 0.0]) for n in self.counts}
        for n, c in self.counts.items():
            for g, v in c.items():
                self.context[n][g[:-1]][0] += v
                self.context[n][g[:-1]][1] += self.cut[n][min(v, 3) - 1]

    def p(self, gram):
        n = len(gram)
        if not n:
            return 1 / kneser.ALPHABET
        lower = self.p(gram[1:])
        if gram[:-1] not in self.context[n]:
            return lower
        total, cut = self.context[n][gram[:-1]]
        v = self.counts[n].get(gram, 0)
        return ((v - self.cut[n][min(v, 3) - 1]) if v else 0) / total + cut / total * lower

    def perplexity(self, text):
        x = sequence(text)
        n = len(x) - ORDER + 1
        return math.exp(-sum(math.log(self.p(x[i : i + ORDER])) for i in range(n)) / n)


def corpus():
    rng = random.Random(12)
    words = "the cat sat on a mat and rat ran über straße".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(3, 40))), rng.choice(["en", "de", None])) for i in range(240)]
    rows += [(800, None, "en"), (801, " \n ", "en"), (802, "%%% &&& ###", "en"), (803, "zzzz qqqq 🎉", "fr"), (1, "another text of one id", "en"), (2, rows[2][1], "en")]
    return rows


@pytest.mark.parametrize("most", [kneser.HEAD, 20, 0])
def test_perplexities_are_those_of_a_plain_model(spark, most):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, n_chars int").repartition(3)
    trusted = [r for r in rows if r[0] % 2 == 0 and r[0] < 200]
    model = kneser.train(spark.createDataFrame(trusted, "doc_id long, text string, lang string"))
    plain = Plain([t for _, t, _ in trusted])
    got = sorted((r.doc_id, r.n_chars, r.perplexity) for r in kneser.score(docs, model, most=most).collect() if r.perplexity)
    want = sorted((i, len(" ".join(t.split())), plain.perplexity(t)) for i, t, _ in rows if t and t.split())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(abs(g[2] - w[2]) < 1e-5 * w[2] for g, w in zip(got, want))


def test_probabilities_of_a_context_sum_to_one():
    plain = Plain([t for _, t, _ in corpus() if t])
    seen = {g for g in plain.counts[1]}
    for context in ("the ", "cat ", "qqqq"):
        rest = (kneser.ALPHABET - len(seen)) * plain.p(context + "\x00")
        assert abs(sum(plain.p(context + c) for c in seen) + rest - 1) < 1e-9


def test_odd_texts_go_and_clean_ones_stay(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(200)] + [(None,), (5,)], "doc_id long")
    out = kneser.classify(docs, trusted).collect()
    assert len(out) == len(rows)
    kept = {r.doc_id: r.kept for r in out if r.doc_id not in (1, 2)}
    assert not any(kept[i] for i in (800, 801, 802, 803))
    assert sum(kept[i] for i in range(3, 240)) > 230


def test_no_trusted_text_and_no_rows(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    out = kneser.classify(docs, docs.where("doc_id < 0").select("doc_id")).collect()
    assert all(r.kept == (r.n_chars > 0) for r in out)
    assert kneser.classify(docs.where("doc_id < 0"), docs.select("doc_id")).count() == 0
