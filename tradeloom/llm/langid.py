"""Language identification: words first, then shorter and shorter pieces of a word.

Training counts words per language and keeps, for each known word, its smoothed log frequency in every language. A word
that is not known is scored by its character n-grams of the greatest length that the model knows, trying
``MOST_LETTERS`` letters first and one less each time; a word of which no piece is known says nothing. A document gets
the language with the greatest sum; the score is the posterior of that language, tempered so that a long text does not
make every score 1.

The model is fitted on a bounded sample of the labelled rows (``sample_docs``, chosen by a hash of the id) and holds at
most ``MOST_WORDS`` words and ``MOST_GRAMS`` n-grams, so it may be broadcast. Prediction reads every whole text.

Cases: a null text, or one without a letter, is ``und`` with score 0; so is everything when no row can be learned from.
Equal sums give the first language in alphabetical order. Columns other than id, text and label are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.common import slices

LETTERS = regex.compile(r"\p{L}+")
MOST_LETTERS = 4
MOST_WORDS = 100_000
MOST_GRAMS = 100_000
SAMPLE_DOCS = 20_000
#: Words after which more of them no longer raise the score, in the tempered posterior.
FULL_WORDS = 20
EDGE = "\x02"


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word between two edge marks; the whole of it if it is shorter."""
    marked = EDGE + word + EDGE
    return [marked[i : i + n] for i in range(max(1, len(marked) - n + 1))]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part of the rows: (language, term, size, count); size 0 stands for words."""
    for batch in batches:
        for part in slices(batch, 0, 8_000_000):
            words: dict[str, Counter] = {}
            for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words.setdefault(lang, Counter()).update(LETTERS.findall(text.lower()))
            rows: list[tuple] = []
            for lang, counts in words.items():
                rows += [(lang, w, 0, c) for w, c in counts.items()]
                for n in range(1, MOST_LETTERS + 1):
                    pieces: Counter = Counter()
                    for w, c in counts.items():
                        for g in grams(w, n):
                            pieces[g] += c
                    rows += [(lang, g, n, c) for g, c in pieces.items()]
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 4, kinds)],
                names=["lang", "term", "size", "n"],
            )


@dataclass
class Model:
    """Log frequencies by language (rows in the order of ``languages``) of words and of n-grams by length."""

    languages: list[str]
    words: dict[str, np.ndarray]
    grams: list[dict[str, np.ndarray]]

    def of_word(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is not None:
            return known
        for n in range(MOST_LETTERS, 0, -1):
            table = self.grams[n]
            found = [table[g] for g in grams(word, n) if g in table]
            if found:
                return np.mean(found, axis=0)
        return np.zeros(len(self.languages))


def train(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS
) -> Model:
    """Learn from the rows of ``docs`` whose text and language are not null."""
    usable = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    labelled = docs.select(id_col, lang_col).where(F.col(lang_col).isNotNull()).count()
    if labelled > sample_docs:
        level = int(2**31 * sample_docs / labelled)
        usable = usable.where(F.pmod(F.xxhash64(F.lit(11), F.col(id_col)), F.lit(2**31)) < level)
    counts = (
        usable.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
        .mapInArrow(_count, "lang string, term string, size int, n long")
        .groupBy("size", "term", "lang")
        .agg(F.sum("n").alias("n"))
    )
    terms = counts.groupBy("size", "term").agg(
        F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")
    )
    terms = terms.where((F.col("size") > 0) | (F.col("total") > 1))
    terms = terms.persist()
    try:
        sums = {(r.size, r.lang): r.n for r in counts.groupBy("size", "lang").agg(F.sum("n").alias("n")).collect()}
        languages = sorted({lang for _, lang in sums})
        rows = [
            terms.where(F.col("size") == n).orderBy(F.desc("total"), "term").limit(most).collect()
            for n, most in [(0, MOST_WORDS), *((n, MOST_GRAMS // MOST_LETTERS) for n in range(1, MOST_LETTERS + 1))]
        ]
    finally:
        terms.unpersist()
    tables: list[dict[str, np.ndarray]] = []
    for n, found in enumerate(rows):
        width = 0.1 * (len(found) + 1)
        base = [math.log(sums.get((n, lang), 0) + width) for lang in languages]
        tables.append(
            {r.term: np.array([math.log(r.by.get(lang, 0) + 0.1) - b for lang, b in zip(languages, base)]) for r in found}
        )
    return Model(languages, tables[0], tables)


class _Scores(dict):
    """Word -> row of ``rows``; filled as words come, for a bounded number of them."""

    def __init__(self, model: Model, most: int = 200_000):
        super().__init__()
        self.model, self.most = model, most
        self.rows = np.zeros((most, len(model.languages)))

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        self.rows[at] = self.model.of_word(word)
        return at


class Predictor:
    """Language and score of one text after another."""

    def __init__(self, model: Model):
        self.languages, self.scores = model.languages, _Scores(model)

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = LETTERS.findall(text.lower()) if text else []
        if not words or not self.languages:
            return "und", 0.0
        scores, total = self.scores, np.zeros(len(self.languages))
        for i in range(0, len(words), 100_000):
            known = words[i : i + 100_000]
            if len(scores) + len(known) > scores.most:
                scores.clear()
            total += scores.rows[[scores[w] for w in known]].sum(axis=0)
        best = int(np.argmax(total))
        z = (total - total[best]) / len(words) * min(len(words), FULL_WORDS)
        return self.languages[best], float(1 / np.exp(z).sum())


def with_language(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The rows of ``docs`` with the predicted language and its score behind, under ``names``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict_one = Predictor(shared.value)
        for batch in batches:
            for part in slices(batch, place):
                found = [predict_one(t) for t in part.column(place).to_pylist()]
                more = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*part.schema.names, *names])

    schema = T.StructType([*docs.schema, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return docs.mapInArrow(run, schema)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_language(rows, model).select("doc_id", "lang_pred", "score")


def held_out(id_col: str = "doc_id"):
    """Rows that a model must not learn from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
