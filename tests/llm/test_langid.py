import random

from tradeloom.llm import langid

WORDS = {
    "de": "der die und nicht straße über schön haben werden katze",
    "en": "the and not with street over have would about cat",
    "es": "el los y no con calle sobre tener sería gato mañana",
}


def corpus(n=400):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang].split()) + rng.choice(["", ".", "!"]) for _ in range(rng.randint(1, 30))), lang))
    return rows


def test_held_out_accuracy_and_defined_cases(spark):
    rows = corpus() + [(900, None, "en"), (901, "", "en"), (902, "123 --- ²", "de"), (903, "the and " * 20000, None), (904, "katzen straßen", None)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows + rows[:2]], "doc_id long, text string, lang string, score double")
    model = langid.train(docs.where(~langid.held_out()))
    out = langid.predict(docs, model).collect()
    assert len(out) == len(rows) + 2
    got = {r.doc_id: r for r in out}
    held = [r.doc_id for r in docs.where(langid.held_out()).where("lang is not null and doc_id < 900").collect()]
    right = [got[i].lang_pred == rows[i][2] for i in held]
    assert len(right) > 50 and sum(right) / len(right) > 0.97
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900, 901, 902))
    assert got[903].lang_pred == "en" and got[904].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in out)
    kept = langid.with_language(docs, model, names=("a", "b"))
    assert kept.columns == [*docs.columns, "a", "b"] and kept.count() == len(out)


def test_unseen_words_back_off_to_shorter_pieces():
    import numpy as np

    grams = [{}, {"b": np.array([0.0, 5.0])}, {}, {"abc": np.array([3.0, 0.0])}, {}]
    model = langid.Model(["x", "y"], {"known": np.array([1.0, 2.0])}, grams)
    assert model.of_word("known").tolist() == [1, 2]
    assert model.of_word("zabcz").tolist() == [3, 0]
    assert model.of_word("zbz").tolist() == [0, 5]
    assert model.of_word("zz").tolist() == [0, 0]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "the", None), (2, None, "en")], "doc_id long, text string, lang string")
    out = langid.predict(docs, langid.train(docs)).collect()
    assert {(r.lang_pred, r.score) for r in out} == {("und", 0.0)}
    assert langid.predict(docs.where("doc_id > 2"), langid.train(docs)).count() == 0


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame(corpus(2000), "doc_id long, text string, lang string")
    model = langid.train(docs, sample_docs=200)
    right = [r.lang_pred == r.lang for r in langid.predict(docs, model).join(docs, "doc_id").collect()]
    assert sum(right) / len(right) > 0.95


def test_long_words_are_known_words(spark):
    long = "x" * 30 + "q" * 30
    docs = spark.createDataFrame([(1, f"{long} a {long}", "en"), (2, "b c", "fr")], "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert long in model.words
