"""Perplexity under an interpolated, modified Kneser-Ney model of characters, trained on trusted text.

Texts are sequences of characters in which stretches of white space are one blank, with ``ORDER - 1`` start marks in
front. The tables of the model are sharded by n-gram and built by joins of counts:

* counts of the longest n-grams; for shorter ones the number of different characters in front (continuations);
* per order the three discounts of Chen and Goodman from the numbers of n-grams with count 1 to 4;
* per context the total and how many n-grams follow with count 1, 2, and 3 or more: its back-off weight;
* probabilities from the shortest n-grams up, each joined with its context and with the n-gram without its first
  character. Below single characters lies the uniform distribution over ``ALPHABET`` characters.

Scoring: the ``HEAD`` most frequent n-grams of each order (and contexts) travel to every task, in arrays whose size has
that bound; where the head holds a whole order, an n-gram that is not in it is unseen and backs off at once. All other
n-grams of a document are asked for: they are counted per document, joined with the sharded tables once per different
n-gram, and summed back per document. Both ways give the same probability.

The threshold of a language is a quantile of the perplexity of trusted documents that the model has not learned from (one
in ``HELD``, by a hash of the id), with some slack: texts it knows would look too easy. A language without such documents
uses the threshold of all. Apart from those, counts cover all trusted documents, and scores cover all documents.

Cases: a null or empty text, or one of white space, has no perplexity and is kept out (``kept`` false). A null language
is a language of its own. Without trusted text every character is equally likely, and everything with text is kept.
Repeated rows are scored one by one; repeated ids in the trusted set count once per row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import mix, slices
from tradeloom.session import materialize

ORDER = 5
HEAD = 1 << 20
#: Different n-grams that a counting task holds before it hands them on.
HELD_GRAMS = 400_000
ALPHABET = 1_114_112  # code points
START = 0x10FFFF
HELD = 8
QUANTILE, SLACK = 0.995, 1.5
GOLD = np.uint64(0x9E3779B97F4A7C15)
BLANKS = str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})


def characters(text: str | None) -> np.ndarray:
    """Code points of a text after the start marks; none for a text without a character that isn't white space."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.uint32)
    points = np.frombuffer(" ".join(words).encode("utf-32-le"), "<u4")
    return np.concatenate([np.full(ORDER - 1, START, np.uint32), points])


def keys(points: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash for each n-gram; tables in tasks tell n-grams apart by it."""
    key = np.zeros(max(0, len(points) - n + 1), np.uint64)
    for k in range(n):
        key = mix((key + GOLD) ^ points[k : len(points) - n + 1 + k].astype(np.uint64))
    return key


def keys_of(grams: list[str]) -> np.ndarray:
    """The same for strings of equal length."""
    points = np.frombuffer("".join(grams).encode("utf-32-le"), "<u4").reshape(len(grams), -1)
    key = np.zeros(len(grams), np.uint64)
    for column in points.T:
        key = mix((key + GOLD) ^ column.astype(np.uint64))
    return key


class _Counts:
    """Different n-grams of the highest order with their counts, merged part by part."""

    def __init__(self):
        self.key, self.n, self.grams = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, ORDER), np.uint32)

    def add(self, texts: list[np.ndarray]) -> None:
        points = np.concatenate(texts)
        key = keys(points, ORDER)
        inside = np.ones(len(key), bool)
        for e in np.cumsum([len(t) for t in texts])[:-1].tolist():
            inside[e - ORDER + 1 : e] = False
        where = np.flatnonzero(inside)
        found, first, counts = np.unique(key[where], return_index=True, return_counts=True)
        at = where[first]
        grams = np.stack([points[at + k] for k in range(ORDER)], 1)
        by = np.argsort(np.concatenate([self.key, found]), kind="stable")
        merged = np.concatenate([self.key, found])[by]
        new = np.ones(len(merged), bool)
        new[1:] = merged[1:] != merged[:-1]
        start = np.flatnonzero(new)
        self.key = merged[start]
        self.n = np.add.reduceat(np.concatenate([self.n, counts])[by], start) if len(start) else self.n
        self.grams = np.concatenate([self.grams, grams])[by[start]]

    def rows(self) -> pa.RecordBatch:
        grams = [g.tobytes().decode("utf-32-le") for g in self.grams.astype("<u4")]
        return pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(self.n, pa.int64())], names=["gram", "n"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = _Counts()
    for batch in batches:
        for part in slices(batch, 0):
            texts = [c for c in map(characters, part.column(0).to_pylist()) if len(c)]
            if texts:
                counts.add(texts)
            if len(counts.key) > HELD_GRAMS:
                yield counts.rows()
                counts = _Counts()
    yield counts.rows()


def discounts(numbers: dict[int, int]) -> tuple[float, float, float]:
    """The three discounts from how many n-grams have count 1, 2, 3 and 4; sensible ones where counts are missing."""
    n1, n2, n3, n4 = (numbers.get(i, 0) for i in (1, 2, 3, 4))
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2.0)
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw))


class Model:
    """Tables by order: ``grams[n]`` (gram, p, n) and ``contexts[n]`` (context of n characters, weight, total)."""

    def __init__(self, counts: DataFrame):
        table = counts.select("gram", F.col("n").cast("long").alias("n"))
        tables = {ORDER: table}
        for n in range(ORDER - 1, 0, -1):
            table = table.groupBy(F.substring("gram", 2, n).alias("gram")).agg(F.count("*").alias("n"))
            tables[n] = table = materialize(table, f"kneser-counts-{n}")
        self.grams: dict[int, DataFrame] = {}
        self.contexts: dict[int, DataFrame] = {}
        below = None
        for n in range(1, ORDER + 1):
            table = tables[n].withColumn("context", F.substring("gram", 1, n - 1))
            numbers = {r.n: r.c for r in table.where("n <= 4").groupBy("n").agg(F.count("*").alias("c")).collect()}
            d1, d2, d3 = discounts(numbers)
            cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
            context = table.groupBy("context").agg(F.sum("n").alias("total"), F.sum(cut).alias("cut"))
            context = materialize(context.select("context", "total", (F.col("cut") / F.col("total")).alias("weight")), f"kneser-contexts-{n - 1}")
            joined = table.join(context, "context").withColumn("own", (F.col("n") - cut) / F.col("total"))
            if below is None:
                lower = joined.withColumn("lower", F.lit(1.0 / ALPHABET))
            else:
                shorter = below.select(F.col("gram").alias("rest"), F.col("p").alias("lower"))
                lower = joined.withColumn("rest", F.substring("gram", 2, n - 1)).join(shorter, "rest")
            below = lower.select("gram", (F.col("own") + F.col("weight") * F.col("lower")).alias("p"), "n")
            self.grams[n] = below = materialize(below, f"kneser-grams-{n}")
            self.contexts[n - 1] = context

    def probabilities(self, asked: DataFrame) -> DataFrame:
        """``gram, logp`` for different n-grams of the highest order, backing off through the sharded tables."""
        state = asked.select("gram", F.lit(0.0).alias("weight"), F.lit(None).cast("double").alias("logp"))
        for n in range(ORDER, 0, -1):
            grams = self.grams[n].select(F.col("gram").alias("key"), F.log("p").alias("found"))
            contexts = self.contexts[n - 1].select(F.col("context").alias("front"), F.log("weight").alias("more"))
            state = state.withColumn("key", F.when(F.col("logp").isNull(), F.substring("gram", ORDER - n + 1, n)))
            state = state.withColumn("front", F.substring("key", 1, n - 1))
            state = state.join(grams, "key", "left").join(contexts, "front", "left")
            state = state.select(
                "gram",
                F.when(F.col("logp").isNotNull(), F.col("weight")).otherwise(F.col("weight") + F.when(F.col("found").isNull(), F.coalesce("more", F.lit(0.0))).otherwise(0.0)).alias("weight"),
                F.coalesce("logp", F.col("weight") + F.col("found")).alias("logp"),
            )
        return state.select("gram", F.coalesce("logp", F.col("weight") - math.log(ALPHABET)).alias("logp"))

    def head(self, most: int = HEAD) -> Head:
        return Head(
            {n: _most(t, "gram", "p", "n", most) for n, t in self.grams.items()},
            {n: _most(t, "context", "weight", "total", most) for n, t in self.contexts.items() if n},
            {r.context: r.weight for r in self.contexts[0].select("context", "weight").collect()}.get("", 1.0),
        )


def _most(table: DataFrame, name: str, value: str, frequency: str, most: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Keys and logarithms of the most frequent entries, ``most`` at the utmost, and whether these are all."""
    sizes = sorted(((r[0], r[1]) for r in table.groupBy(frequency).agg(F.count("*")).collect()), reverse=True)
    least, room = 0, most
    for n, c in sizes:
        room -= c
        if room < 0:
            least = n + 1
            break
    rows = table.where(F.col(frequency) >= least).select(name, F.log(value).alias("v")).mapInArrow(_keyed, "key long, v float")
    found = rows.toArrow()
    key, v = np.asarray(found.column(0)).astype(np.int64).view(np.uint64), np.asarray(found.column(1))
    return key, v, room >= 0


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        key = keys_of(batch.column(0).to_pylist()).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(1).cast(pa.float32())], names=["key", "v"])


class Table:
    """Open addressing in two arrays; looking up an array of keys takes a few passes."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, whole: bool):
        bits = max(4, (2 * len(keys) - 1).bit_length())
        self.shift, self.mask, self.whole = np.uint64(64 - bits), np.uint64((1 << bits) - 1), whole
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, np.nan, np.float32)
        left, at = np.arange(len(keys)), (keys >> self.shift).astype(np.int64)
        while len(left):  # all that found a free place take it, of those at one place the last; the rest goes on
            free = np.isnan(self.values[at])
            self.keys[at[free]], self.values[at[free]] = keys[left[free]], values[left[free]]
            stay = self.keys[at] != keys[left]
            left, at = left[stay], at[stay] + 1 & int(self.mask)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, NaN where a key is missing."""
        at = (keys >> self.shift).astype(np.int64)
        out = self.values[at]
        open_ = np.flatnonzero((self.keys[at] != keys) & ~np.isnan(out))
        out[open_] = np.nan
        at = at[open_]
        while len(open_):
            at = at + 1 & int(self.mask)
            v = self.values[at]
            hit = (self.keys[at] == keys[open_]) & ~np.isnan(v)
            out[open_[hit]] = v[hit]
            go = ~hit & ~np.isnan(v)
            open_, at = open_[go], at[go]
        return out


class Head:
    """The frequent part of the model in arrays of bounded size."""

    def __init__(self, grams, contexts, uniform_weight: float):
        self.grams = {n: Table(*t) for n, t in grams.items()}
        self.contexts = {n: Table(*t) for n, t in contexts.items()}
        self.floor = math.log(uniform_weight) - math.log(ALPHABET) if uniform_weight > 0 else -math.log(ALPHABET)

    def score(self, points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities of the characters at ``at``, and which of them have to be asked for."""
        logp = np.full(len(at), np.nan)
        weight = np.zeros(len(at))
        ask = np.zeros(len(at), bool)
        open_ = np.arange(len(at))
        for n in range(ORDER, 0, -1):
            key = np.zeros(len(open_), np.uint64)
            for k in range(n - 1, -1, -1):
                if k == 0:
                    front = key
                key = mix((key + GOLD) ^ points[at[open_] - k].astype(np.uint64))
            v = self.grams[n].get(key)
            hit = ~np.isnan(v)
            logp[open_[hit]] = weight[open_[hit]] + v[hit]
            if not self.grams[n].whole:
                ask[open_[~hit]] = True
                break
            if n > 1:
                more = self.contexts[n - 1].get(front)
                unknown = np.isnan(more)
                if not self.contexts[n - 1].whole:
                    ask[open_[~hit & unknown]] = True
                    hit |= unknown
                weight[open_] += np.where(unknown, 0.0, more)
            open_ = open_[~hit]
        rest = np.isnan(logp) & ~ask
        logp[rest] = weight[rest] + self.floor
        return logp, ask


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: Head = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                texts = [characters(t) for t in part.column(1).to_pylist()]
                sizes = np.array([max(0, len(t) - ORDER + 1) for t in texts])
                points = np.concatenate([*texts, np.zeros(0, np.uint32)])
                begin = np.cumsum([len(t) for t in texts]) - [len(t) for t in texts]
                doc = np.repeat(np.arange(len(texts)), sizes)
                at = np.repeat(begin + ORDER - 1 - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
                logp, ask = head.score(points, at)
                sums = np.bincount(doc[~ask], logp[~ask], len(texts))
                asked: list[list[tuple[str, int]]] = [[] for _ in texts]
                where = np.flatnonzero(ask)
                if len(where):
                    grams = np.stack([points[at[where] - k] for k in range(ORDER - 1, -1, -1)], 1).astype("<u4")
                    for i, row in zip(doc[where].tolist(), grams):
                        asked[i].append(row.tobytes().decode("utf-32-le"))
                arrays = [part.column(0), part.column(2), part.column(3), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())]
                arrays.append(pa.array(asked, pa.list_(pa.string())))
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang", "content", "n_chars", "logp", "asked"])

    return run


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = HEAD
) -> DataFrame:
    """``doc_id, lang, n_chars, perplexity`` (null without a character) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model.head(most))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
        F.xxhash64(text_col).alias("content"),
    )
    kinds = "doc_id long, lang string, content long, n_chars long, logp double, asked array<string>"
    scored = materialize(rows.mapInArrow(_score(shared), kinds), "kneser-scored")
    asking = scored.where(F.size("asked") > 0).withColumn("doc_id", F.coalesce("doc_id", F.lit(-1)))
    if asking.isEmpty():
        whole = scored
    else:
        # Equal rows ask together, and what comes back is divided among them.
        row = ["doc_id", "content"]
        each = asking.select(*row, F.explode("asked").alias("gram")).groupBy(*row, "gram").agg(F.count("*").alias("n"))
        known = model.probabilities(each.select("gram").distinct())
        more = each.join(known, "gram").groupBy(*row).agg(F.sum(F.col("n") * F.col("logp")).alias("more"))
        more = more.join(asking.groupBy(*row).agg(F.count("*").alias("times")), row)
        more = more.select(F.col("doc_id").alias("_id"), "content", (F.col("more") / F.col("times")).alias("more"))
        whole = scored.withColumn("_id", F.coalesce("doc_id", F.lit(-1))).join(more, ["_id", "content"], "left")
        whole = whole.withColumn("logp", F.col("logp") + F.coalesce("more", F.lit(0.0)))
    perplexity = F.when(F.col("n_chars") > 0, F.exp(-F.col("logp") / F.col("n_chars")))
    return whole.select("doc_id", "lang", "n_chars", perplexity.alias("perplexity"))


def train(trusted: DataFrame, text_col: str = "text") -> Model:
    counts = trusted.select(F.col(text_col)).mapInArrow(_count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return Model(materialize(counts, "kneser-counts"))


def classify(
    docs: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, slack: float = SLACK, id_col: str = "doc_id",
    text_col: str = "text", lang_col: str = "lang", most: int = HEAD,
) -> DataFrame:
    """``doc_id, lang, n_chars, perplexity, threshold, kept``; ``trusted`` holds the ids of the documents to learn from."""
    ids = trusted.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    held = F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(HELD)) == 0
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # The ids grow with the corpus, so this is a shuffle at every size.
    known = known.join(ids.where(~held).hint("shuffle_merge"), "doc_id", "left_semi")
    scored = materialize(score(docs, train(known), id_col, text_col, lang_col, most), "kneser-perplexity")
    known = scored.join(ids.where(held), "doc_id", "left_semi")
    limit = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000)) * slack
    default = known.agg(limit).first()[0]
    limits = materialize(known.groupBy("lang").agg(limit.alias("limit")).withColumnRenamed("lang", "of"), "kneser-limits")
    judged = scored.join(limits, scored["lang"].eqNullSafe(limits["of"]), "left")
    threshold = F.coalesce("limit", F.lit(default).cast("double"), F.lit(float("inf")))
    return judged.select(
        "doc_id", "lang", "n_chars", "perplexity", threshold.alias("threshold"),
        F.coalesce(F.col("perplexity") <= threshold, F.lit(False)).alias("kept"),
    )
