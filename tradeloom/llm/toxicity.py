"""Toxicity by class-conditional Kneser-Ney models of words, compared per word.

Texts are lower-cased words (runs of letters or digits) between two start marks and an end mark. Two interpolated,
modified Kneser-Ney trigram models are counted from labelled rows, one per class (toxic, ordinary). Only the top order
and the bigram level (continuation counts) are class-conditional; both classes back off to one shared unigram
distribution of continuation counts over all labelled text, so that a rare expression seen in one class only is smoothed
by what both classes share, and below that lies the uniform distribution over the vocabulary and one unknown word.

A document's evidence is the length-normalised log-likelihood ratio ``d = (log P_toxic - log P_ordinary) / words``;
``score = sigmoid(a * d + b)``, with ``a, b`` fitted by ridge logistic regression (Newton steps as Spark aggregations)
on the labelled rows.

The ratio of a trigram (u, v, w) is a sum in which only what was counted takes part, as the shared unigram probability
of an uncounted bigram cancels out: the back-off ratios of the contexts (u, v) and v, a term of (v, w) if that bigram was
counted, and a term of (u, v, w) if that trigram was. So the terms of an n-gram that was never counted are 0, a bigram's
terms (as a context and as an event) are one number, and the evidence of a text is a sum over its trigrams and bigrams.
The n-grams of the model and those of all texts meet in shards by the hash of the first two words:

* words are numbers: the ``HEAD_WORDS`` most frequent ones of the labelled texts have short ones, all others their 64-bit
  hash (this changes sizes, not results); the terms of those words' own contexts travel to every task;
* a task sends the distinct trigrams of some hundred texts to a shard as one compressed block with the texts they are in,
  and a shard returns a sum for each text, so that neither trigrams nor their probabilities go back to the texts;
* the shards are worked through in ``ROUNDS`` rounds. Each reads the texts anew and leaves only the sums, its shuffle
  files go when it ends; what lies on disk at a time is that part of all trigrams.

Nothing is collected but the numbers of the frequent words and the few sums of the discounts and of the regression.

Cases: a null text is empty; an empty text is the one trigram (start, start, end) and gets a score like any other
text. Very long texts are scored whole. Repeated rows are scored one by one; labelled rows count once per row. Rows
with a null label do not train. Without labelled text of one class its model is the shared one (d = 0). Hash collisions
of 64-bit keys are neglected. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import BATCH_ROWS, mix
from tradeloom.session import materialize

WORD = r"[\p{L}\p{N}]+"
START, END = "\u0002s", "\u0002e"
#: Ridge penalty of the calibration slope, against separable labelled rows.
RIDGE = 1e-3
NEWTON_STEPS = 12
THRESHOLD = 0.7
#: Rows up to which a table of labels is sent to every task (a few tens of bytes a row).
HEAD_ROWS = 1 << 20
#: Words with short numbers; they must fit into 21 bits with the marks.
HEAD_WORDS = 1 << 17
#: Numbers of the marks; PAD stands where a row has no further word, NONE for words that the model has not counted.
START_CODE, END_CODE, PAD, NONE, FIRST = 0, 1, 2, 3, 4
ROUNDS = 3
#: Words of the texts that a task handles at a time, and trigrams of the model in a shard (about).
SLICE_WORDS, SHARD_ROWS = 1 << 19, 1 << 19
LOW = (1 << 28) - 1
#: Bits of the filter of counted rare words, and up to how many of them there is one. It spares rows, not results.
BITS, FILTERED = 1 << 27, 1 << 22
#: Of a shard's contexts, how many parts (a power of 2) become terms one after the other. It bounds memory only.
PARTS = 8
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


def _written(df: DataFrame, name: str) -> DataFrame:
    """``materialize``, after which the shuffle files it needed go at once. Texts are read ``BATCH_ROWS`` at a time: the
    usual 4,096 of them are arrays of tens of MB in each task."""
    conf = df.sparkSession.conf
    own = {CLEANUP: "true", READ_ROWS: str(min(BATCH_ROWS, int(conf.get(READ_ROWS))))}
    before = {k: conf.get(k, None) for k in own}
    try:
        for k, value in own.items():
            conf.set(k, value)
        return materialize(df, name)
    finally:
        for k, value in before.items():
            conf.unset(k) if value is None else conf.set(k, value)


def _forget(written: DataFrame) -> None:
    """Remove what ``_written`` has written; no other plan may still read it."""
    spark, files = written.sparkSession, written.inputFiles()
    if files:
        path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def hashed_words(docs: DataFrame, *keep: str, text_col: str = "text") -> DataFrame:
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(WORD), 0)
    return docs.select(*keep, F.transform(words, lambda w: F.xxhash64(w)).alias("words"))


class Index:
    """Where keys stand among different sorted ones of 64 bits: those with equal leading bits are tried one by one."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(1, len(keys).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.begin = np.searchsorted(keys >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, asked: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where there is none."""
        at = self.begin[asked >> self.shift]
        inside = np.minimum(at, len(self.keys) - 1)
        out = np.where(self.keys[inside] == asked, inside, -1)
        left = np.flatnonzero(out < 0)
        end = self.begin[(asked[left] >> self.shift) + np.uint64(1)]
        at = at[left]
        while len(left):
            at = at + 1
            go = at < end
            left, at, end = left[go], at[go], end[go]
            hit = self.keys[at] == asked[left]
            out[left[hit]] = at[hit]
            left, at, end = left[~hit], at[~hit], end[~hit]
        return out


class Codes:
    """Numbers of words: short ones from ``FIRST`` for frequent words, negative ones from the hash for all others."""

    def __init__(self, frequent: np.ndarray):
        frequent = frequent.view(np.uint64)
        by = np.argsort(frequent)
        self.index, self.code, self.seen = Index(frequent[by]) if len(by) else None, by + FIRST, None

    def only(self, counted: np.ndarray) -> None:
        """From now on rare words are ``NONE`` if their bit is not among those of the counted ones."""
        self.seen = np.zeros(BITS, bool)
        self.seen[counted] = True
        self.seen = np.packbits(self.seen, bitorder="little")

    def of(self, hashes: np.ndarray) -> np.ndarray:
        rare = hashes | np.int64(-(1 << 63))
        if self.seen is not None:
            bit = rare & (BITS - 1)
            rare = np.where(self.seen[bit >> 3] >> (bit & 7) & 1, rare, NONE)
        if self.index is None:
            return rare
        at = self.index.find(hashes.view(np.uint64))
        return np.where(at >= 0, self.code[at], rare)


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h, n = np.unique(np.asarray(batch.column(0).flatten()).astype(np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n, pa.int64())], names=["h", "n"])


def frequent_words(words: DataFrame) -> tuple[Codes, int]:
    """The numbers of the frequent words, and how many words there are in all."""
    counted = words.select("words").mapInArrow(_histogram, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    counted = _written(counted, "toxicity-words")
    rows = counted.orderBy(F.desc("n"), "h").limit(HEAD_WORDS).select("h").toArrow()
    n = int(counted.agg(F.sum("n")).first()[0] or 0)
    _forget(counted)
    return Codes(np.asarray(rows.column(0)).astype(np.int64)), n


def _grams(words: pa.ListArray, codes: Codes, marks: tuple[int, ...]) -> Iterator[tuple]:
    """Trigrams of some rows at a time: first row, end, the three words, and the row of each trigram from the first."""
    offsets, values = np.asarray(words.offsets).astype(np.int64), np.asarray(words.values).astype(np.int64)
    sizes = np.diff(offsets)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_WORDS)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        if a == b:
            continue
        lengths = sizes[a:b] + 2 + len(marks)
        start = np.cumsum(lengths) - lengths
        tok, inner = np.empty(int(lengths.sum()), np.int64), np.ones(int(lengths.sum()), bool)
        for at, mark in [(start, START_CODE), (start + 1, START_CODE)] + [
            (start + 2 + sizes[a:b] + k, m) for k, m in enumerate(marks)
        ]:
            tok[at], inner[at] = mark, False
        tok[inner] = codes.of(values[offsets[a] : offsets[b]])
        begins = np.ones(len(tok), bool)
        begins[start + lengths - 1] = begins[start + lengths - 2] = False
        at = np.flatnonzero(begins)
        yield a, b, tok[at], tok[at + 1], tok[at + 2], np.repeat(np.arange(b - a), lengths - 2)


def _sorted(u: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal trigrams together, and where in it a new one begins."""
    small = (u >= 0) & (v >= 0) & (w >= 0)
    a, b = np.flatnonzero(small), np.flatnonzero(~small)
    a = a[np.argsort(u[a] << 42 | v[a] << 21 | w[a])]
    by = np.concatenate([a, b[np.lexsort((w[b], v[b], u[b]))]])
    new = np.ones(len(by), bool)
    new[1:] = (u[by[1:]] != u[by[:-1]]) | (v[by[1:]] != v[by[:-1]]) | (w[by[1:]] != w[by[:-1]])
    return by, np.flatnonzero(new)


def _planes(x: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T).tobytes()


def _unplaned(data: memoryview, width: int, n: int) -> np.ndarray:
    out = np.zeros((n, 4), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(width, n).T
    return out.view("<u4").reshape(-1).astype(np.int64)


RARE = (1 << 24) - 1


def pack(u: np.ndarray, v: np.ndarray, w: np.ndarray, counts: np.ndarray, rows: np.ndarray, more: bytes = b"") -> bytes:
    """A block: different trigrams, a number for each (in how many rows it occurs), further numbers (these rows one after
    the other), and what else belongs to them."""
    words = np.concatenate([u, v, w])
    rare = words < 0
    data = _planes(np.where(rare, RARE, words), 3) + _planes(counts, 4) + _planes(rows, 4) + words[rare].astype("<i8").tobytes() + more
    sizes = np.array([len(u), len(rows), int(rare.sum()), len(data)], "<i8")
    return sizes.tobytes() + pa.compress(data, codec="zstd", asbytes=True)


def unpack(block: bytes, more: bool = False) -> tuple:
    n, m, r, size = np.frombuffer(block, "<i8", 4).tolist()
    data = memoryview(pa.decompress(block[32:], decompressed_size=size, codec="zstd", asbytes=True))
    words = _unplaned(data, 3, 3 * n)
    counts, rows = _unplaned(data[9 * n :], 4, n), _unplaned(data[13 * n :], 4, m)
    at = 13 * n + 4 * m
    words[words == RARE] = np.frombuffer(data[at:], "<i8", r)
    out = words[:n], words[n : 2 * n], words[2 * n :], counts, rows
    return (*out, data[at + 8 * r :]) if more else out


def _shard(u, v, shards: int):
    """Of a bigram, in arrays; the two primes are above any number of shards."""
    x = (u & LOW) * 1610612741 + (v & LOW) * 805306457
    return (x ^ (x >> 29)) % shards


def _parts(order: np.ndarray, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard with its rows of ``order``, in that order."""
    by = order[np.argsort(shard[order].astype(np.int32), kind="stable")]
    cuts = np.flatnonzero(np.diff(shard[by], prepend=-1)).tolist()
    for x, y in zip(cuts, [*cuts[1:], len(by)]):
        yield int(shard[by[x]]), by[x:y]


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where in sorted columns a new value begins."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _count(shared, shards: int):
    """Blocks ``(v, w, u)`` of the trigrams of some texts with both classes' counts, by the hash of v and w."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = np.asarray(batch.column(0)) == 1
            for a, b, u, v, w, row in _grams(batch.column(1), shared.value, (END_CODE,)):
                by, new = _sorted(v, w, u)
                n_t = np.add.reduceat(y[a:b][row].astype(np.int64)[by], new)
                n_o = np.diff(np.append(new, len(by))) - n_t
                u, v, w = u[by[new]], v[by[new]], w[by[new]]
                out = [(k, pack(v[at], w[at], u[at], n_t[at], n_o[at])) for k, at in _parts(np.arange(len(u)), _shard(v, w, shards))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary()))], names=["shard", "block"])

    return run


#: Of a shard: the counted trigrams, their number, and how many have counts 1 to 4, by class, then the same of bigrams.
COUNTED = "shard long, block binary, n long, " + ", ".join(f"{c}_{i} long" for c in ("c_t", "c_o", "n2_t", "n2_o") for i in range(1, 5))


def _bigrams(v: np.ndarray, w: np.ndarray, c_t: np.ndarray, c_o: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the bigrams of trigrams in the order of (v, w) begin, and their continuation counts by class."""
    new = _new(v, w)
    return new, np.add.reduceat((c_t > 0).astype(np.int64), new), np.add.reduceat((c_o > 0).astype(np.int64), new)


def _merge(blocks: pa.Table) -> pa.Table:
    v, w, u, c_t, c_o = (np.concatenate(x) for x in zip(*(unpack(x.as_py()) for x in blocks.column("block"))))
    # A bigram's trigrams stand together, those with a rare first word too.
    small = (v >= 0) & (w >= 0)
    a, b = np.flatnonzero(small), np.flatnonzero(~small)
    by = np.concatenate([a[np.lexsort((u[a], v[a] << 21 | w[a]))], b[np.lexsort((u[b], w[b], v[b]))]])
    new = _new(v[by], w[by], u[by])
    c_t, c_o = np.add.reduceat(c_t[by], new), np.add.reduceat(c_o[by], new)
    v, w, u = v[by[new]], w[by[new]], u[by[new]]
    _, n2_t, n2_o = _bigrams(v, w, c_t, c_o)
    numbers = [int((n == i).sum()) for n in (c_t, c_o, n2_t, n2_o) for i in range(1, 5)]
    names = [x.split()[0] for x in COUNTED.split(", ")]
    values = [blocks.column("shard")[0].as_py(), pack(v, w, u, c_t, c_o), len(u), *numbers]
    return pa.table([pa.array([x]) for x in values], names=names)


#: What is known of a word: before how many different words it ends a bigram (n1); of its bigrams by class, the sum of the
#: continuation counts and how many have 1, 2, and 3 or more.
STATS = ["n1", "t_sum", "t_1", "t_2", "t_3", "o_sum", "o_1", "o_2", "o_3"]


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``STATS`` of the words in each shard."""
    for batch in batches:
        for shard, block in zip(batch.column(0).to_pylist(), batch.column(1)):
            v, w, _, c_t, c_o = unpack(block.as_py())
            new, n_t, n_o = _bigrams(v, w, c_t, c_o)
            words, at = np.unique(np.concatenate([v[new], w[new]]), return_inverse=True)
            v, w, k = at[: len(new)], at[len(new) :], len(words)
            out = [np.bincount(w, minlength=k)]
            for n in (n_t, n_o):
                out += [np.bincount(v, x, k).astype(np.int64) for x in (n, n == 1, n == 2, n > 2)]
            arrays = [pa.array(words), pa.array(np.full(k, shard)), *map(pa.array, out)]
            yield pa.RecordBatch.from_arrays(arrays, names=["word", "shard", *STATS])


BLOCKS = "shard long, block binary"
MODEL = "block binary, alone binary"


def _doubles(*columns: np.ndarray) -> bytes:
    x = np.ascontiguousarray(np.stack(columns), "<f8")
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes()


def _undoubled(data: memoryview, n: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<f8").reshape(n, -1)


def _back(values: np.ndarray, c: str, numbers: dict) -> tuple[np.ndarray, np.ndarray]:
    """Of words with these ``STATS``: the sum of the continuation counts of their bigrams, and the mass taken from it."""
    k, d = 1 if c == "t" else 5, numbers[f"d2_{c}"]
    return values[k], sum(d[i] * values[k + 1 + i] for i in range(3))


def _events(first: np.ndarray, n1: np.ndarray, n2: dict, numbers: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of counted bigrams: the probabilities of both classes, and the log ratio of what they have above the back-off."""
    total, mass, uniform = numbers["unigrams"]
    p1 = _left(n1, numbers["d1"]) / total + mass / total * uniform
    p2, term = {}, np.zeros(len(n1))
    for sign, c in ((1, "t"), (-1, "o")):
        all_, held = _back(first, c, numbers)
        seen = all_ > 0
        all_ = np.where(seen, all_, 1.0)
        p2[c] = np.where(seen, (_left(n2[c], numbers[f"d2_{c}"]) + held * p1) / all_, p1)
        term += sign * np.log(p2[c] / (np.where(seen, held / all_, 1.0) * p1))
    return p2["t"], p2["o"], term


def _with_rare(shared, numbers: dict):
    """The blocks of a shard with the values of bigrams that have a rare word, and the terms of rare words as contexts."""

    def run(counted: pa.Table, words: pa.Table) -> pa.Table:
        out = []
        rare = np.asarray(words.column("word").combine_chunks()).astype(np.int64)
        by = np.argsort(rare)
        rare, table = rare[by], np.stack([np.asarray(words.column(c).combine_chunks()).astype(np.float64) for c in STATS])[:, by]

        def known(x: np.ndarray) -> np.ndarray:
            values = shared.value[:, np.maximum(x, 0)]
            low = np.flatnonzero(x < 0)
            values[:, low] = table[:, np.searchsorted(rare, x[low])]
            return values

        own = np.asarray(words.column("least").combine_chunks())[by] == np.asarray(words.column("shard").combine_chunks())
        alone = np.full(int(own.sum()), PAD)
        zeros, terms = np.zeros(len(alone), np.int64), own_terms(table[:, own], numbers)
        alone = pack(rare[own], alone, alone, zeros, zeros, _doubles(terms))
        for block in counted.column("block"):
            v, w, u, c_t, c_o = unpack(block.as_py())
            new, n_t, n_o = _bigrams(v, w, c_t, c_o)
            x, y = v[new], w[new]
            low = np.flatnonzero((x < 0) | (y < 0))
            values = _events(known(x[low]), known(y[low])[0], {"t": n_t[low], "o": n_o[low]}, numbers)
            out.append((pack(v, w, u, c_t, c_o, _doubles(*values)), alone))
        return pa.table([pa.array([x[i] for x in out], pa.binary()) for i in range(2)], names=["block", "alone"])

    return run


def _reach(shards: int, turn: int):
    """Counted trigrams with the continuation counts of (v, w), bigrams with theirs, and rare words as contexts, in blocks
    for the shards whose turn it is. Where the bigram has a rare word, its values go along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, alone in zip(batch.column(0), batch.column(1)):
                v, w, u, c_t, c_o, more = unpack(block.as_py(), True)
                new, n_t, n_o = _bigrams(v, w, c_t, c_o)
                of = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(v))))
                x, y = v[new], w[new]
                values = np.zeros((3, len(new)))
                values[:, (x < 0) | (y < 0)] = _undoubled(more, 3)
                words, *_, more = unpack(alone.as_py(), True)
                now = [np.flatnonzero(_shard(a, b, shards) % ROUNDS == turn) for a, b in ((u, v), (x, y), (words, np.full(len(words), PAD)))]
                of, u, v, w, c_t, c_o = (a[now[0]] for a in (of, u, v, w, c_t, c_o))
                x, y, words = x[now[1]], y[now[1]], words[now[2]]
                none = np.zeros(len(words), np.int64)
                pad, zeros = np.full(len(x), PAD), np.zeros(len(x) + len(words), np.int64)
                left = np.concatenate([values[0][of], values[2][now[1]], _undoubled(more, 1)[0][now[2]]])
                right = np.concatenate([values[1][of], zeros])
                u, v, w = np.concatenate([u, x, words]), np.concatenate([v, y, none + PAD]), np.concatenate([w, pad, none + PAD])
                c_t, c_o = np.concatenate([c_t, zeros]), np.concatenate([c_o, zeros])
                n_t, n_o = np.concatenate([n_t[of], n_t[now[1]], none]), np.concatenate([n_o[of], n_o[now[1]], none])
                shard = _shard(u, v, shards)
                out = []
                for k, at in _parts(np.arange(len(u)), shard):
                    low = at[_rare(u[at], v[at], w[at], c_t[at] + c_o[at])]
                    more = _doubles(left[low], right[low])
                    out.append((k, pack(u[at], v[at], w[at], c_t[at], np.concatenate([c_o[at], n_t[at], n_o[at]]), more)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.binary()))], names=["shard", "block"]
                )

    return run


def _rare(u: np.ndarray, v: np.ndarray, w: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which rows have a rare word in their bigram: the last two words of a trigram, the first two of other rows."""
    return (v < 0) | (np.where(n > 0, w, u) < 0)


def own_terms(values: np.ndarray, numbers: dict) -> np.ndarray:
    """The back-off ratio of words as contexts."""
    term = np.zeros(values.shape[1])
    for sign, c in ((1, "t"), (-1, "o")):
        total, mass = _back(values, c, numbers)
        seen = total > 0
        term[seen] += sign * np.log(mass[seen] / total[seen])
    return term


GOLD = np.uint64(0x9E3779B97F4A7C15)


def _pair(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return mix(mix(u.astype(np.uint64) + GOLD) + v.astype(np.uint64))


def _triple(pair: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(pair + mix(w.astype(np.uint64) + GOLD))


def _mass(n: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.where(n <= 0, 0.0, np.where(n == 1, d[0], np.where(n == 2, d[1], d[2])))


def _left(n: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(n - _mass(n, d), 0.0)


ASKED = "shard long, slice long, keys binary, words binary, block binary, sums binary"


def _ask(shared, shards: int, turn: int):
    """Blocks for the shards whose turn it is; with the first ones, each slice's keys, words and terms of frequent words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, own = shared.value
        name = TaskContext.get().partitionId() << 32
        for batch in batches:
            keys = np.asarray(batch.column(0)).astype("<i8")
            for a, b, u, v, w, row in _grams(batch.column(1), codes, (END_CODE, PAD)):
                name += 1
                out = []
                inside = np.ones(len(u), bool)
                inside[np.searchsorted(row, np.arange(b - a))] = False  # the first start mark is no context of one word
                rare = inside & (u < 0)
                if turn == 0:
                    known = np.flatnonzero(inside & ~rare)
                    sums = np.bincount(row[known], own[u[known]], b - a)
                    n = np.bincount(row, minlength=b - a) - 1  # without the row that ends in PAD
                    out.append((name % shards // ROUNDS * ROUNDS, name, keys[a:b].tobytes(), n.astype("<i8").tobytes(), None, sums.tobytes()))
                pad = np.full(int(rare.sum()), PAD, np.int64)
                u, v, w = np.concatenate([u, u[rare]]), np.concatenate([v, pad]), np.concatenate([w, pad])
                row = np.concatenate([row, row[rare]])
                shard = _shard(u, v, shards)
                mine = np.flatnonzero((shard % ROUNDS == turn) & (u != NONE) & (v != NONE))  # no other has terms
                u, v, w, row, shard = u[mine], v[mine], w[mine], row[mine], shard[mine]
                for k, at in _parts(_sorted(u, v, w)[0], shard):
                    p, q, r = u[at], v[at], w[at]
                    new = _new(p, q, r)
                    block = pack(p[new], q[new], r[new], np.diff(np.append(new, len(at))), row[at])
                    out.append((k, name, np.array([b - a], "<i8").tobytes(), None, block, None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 2 + [pa.binary()] * 4)] if out else [pa.array([], t) for t in [pa.int64()] * 2 + [pa.binary()] * 4],
                    names=["shard", "slice", "keys", "words", "block", "sums"],
                )

    return run


class Terms:
    """What the counted bigrams and trigrams of one shard add to the evidence of a text.

    A shard's rows are worked through in ``PARTS`` by the leading bits of their pair of words, so that only its terms and
    the rows as they came are held whole. A context is in one part, and parts in turn are in the order of the pairs."""

    def __init__(self, blocks: pa.Table, head: np.ndarray, numbers: dict):
        parts: list[list[tuple]] = [[] for _ in range(PARTS)]
        for block in blocks.column("block"):
            u, v, w, c_t, rest, more = unpack(block.as_py(), True)
            c_o, n_t, n_o = rest.reshape(3, -1)
            pair, rare = _pair(u, v), _rare(u, v, w, c_t + c_o)
            values = np.zeros((2, len(u)))
            values[:, rare] = _undoubled(more, 2)
            counts = np.stack([c_t, c_o, n_t, n_o]).astype(np.uint32)  # as they were packed
            for k, at in _parts(np.arange(len(u)), pair >> np.uint64(65 - PARTS.bit_length())):
                low = np.flatnonzero(rare[at])
                parts[k].append((u[at], v[at], w[at], counts[:, at], low, values[:, at[low]]))
        done = []
        while parts:
            rows, parts[0] = parts[0], []
            del parts[0]
            if rows:
                done.append(_part_terms(rows, head, numbers))
        self.pairs, self.pair_terms, key, terms = (np.concatenate(x) for x in zip(*done))
        del done
        by = np.argsort(key)
        self.triple_terms = terms[by]
        self.pairs, self.triples = (Index(x) if len(x) else None for x in (self.pairs, key[by]))

    def of(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        new = _new(u, v)  # rows come in the order of their words, but for shards with rare ones also otherwise
        pair = _pair(u[new], v[new])
        found, there = _found(self.pairs, self.pair_terms, pair)
        times = np.diff(np.append(new, len(u)))
        terms, at = np.repeat(found, times), np.flatnonzero(np.repeat(there, times) & (w != PAD) & (w != NONE))
        terms[at] += _found(self.triples, self.triple_terms, _triple(np.repeat(pair, times)[at], w[at]))[0]
        return terms


def _part_terms(rows: list[tuple], head: np.ndarray, numbers: dict) -> tuple[np.ndarray, ...]:
    """The pairs of words in some rows in order, with their terms, and the keys and terms of the trigrams."""
    u, v, w = (np.concatenate(x) for x in list(zip(*rows))[:3])
    c_t, c_o, n_t, n_o = np.concatenate([x[3] for x in rows], 1).astype(np.int64)
    begin = np.cumsum([0, *(len(x[0]) for x in rows)])
    low, values = np.concatenate([x[4] + k for x, k in zip(rows, begin)]), np.zeros((2, len(u)))
    values[:, low] = np.concatenate([x[5] for x in rows], 1)
    pair, three = _pair(u, v), c_t + c_o > 0
    common = np.ones(len(u), bool)
    common[low] = False
    at = np.flatnonzero(common)
    x, y = np.where(three, v, u)[at], np.where(three, w, v)[at]
    p_t, p_o, term = _events(head[:, x], head[0, y], {"t": n_t[at], "o": n_o[at]}, numbers)
    values[0, at], values[1, at] = np.where(three[at], p_t, term), p_o
    two, p2 = values[0], {"t": values[0][three], "o": values[1][three]}
    names, context = np.unique(pair[three], return_inverse=True)
    own, three_terms = np.zeros(len(names)), np.zeros(int(three.sum()))
    for sign, c, n in ((1, "t", c_t[three]), (-1, "o", c_o[three])):
        sums, masses = np.bincount(context, n, len(names)), np.bincount(context, _mass(n, numbers[f"d_{c}"]), len(names))
        there = sums > 0
        own[there] += sign * np.log(masses[there] / sums[there])
        at = np.flatnonzero(n > 0)
        three_terms[at] += sign * np.log1p(_left(n[at], numbers[f"d_{c}"]) / (masses[context[at]] * p2[c][at]))
    pairs, at = np.unique(np.concatenate([pair[~three], names]), return_inverse=True)
    pair_terms = np.bincount(at, np.concatenate([two[~three], own]), len(pairs))
    return pairs, pair_terms, _triple(pair[three], w[three]), three_terms


def _found(index: Index | None, values: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of keys, 0 where there is none, and where there is one."""
    if index is None:
        return np.zeros(len(asked)), np.zeros(len(asked), bool)
    at = index.find(asked)
    return np.where(at >= 0, values[at], 0.0), at >= 0


SUMS = "slice long, keys binary, words binary, sums binary"


def _answer(head, numbers: dict):
    def run(asked: pa.Table, rows: pa.Table) -> pa.Table:
        out, terms = [], Terms(rows, head.value, numbers) if rows.num_rows else None
        for at in range(asked.num_rows):
            name, keys, words, block, sums = (asked.column(c)[at].as_py() for c in ("slice", "keys", "words", "block", "sums"))
            if block is None:
                out.append((name, keys, words, sums))
            elif terms is not None:
                u, v, w, counts, row = unpack(block)
                texts = int(np.frombuffer(keys, "<i8")[0])
                part = np.bincount(row, np.repeat(terms.of(u, v, w), counts), texts)
                if part.any():
                    out.append((name, None, None, part.tobytes()))
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        columns = zip(*out) if out else [[]] * 4
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["slice", "keys", "words", "sums"])

    return run


def _sum(parts: pa.Table) -> pa.Table:
    keys = [x for x in parts.column("keys").to_pylist() if x is not None]
    words = [x for x in parts.column("words").to_pylist() if x is not None]
    sums = sum(np.frombuffer(x, "<f8") for x in parts.column("sums").to_pylist())
    arrays = [parts.column("slice")[:1].combine_chunks(), *(pa.array(x[:1] or [None], pa.binary()) for x in (keys, words, [sums.tobytes()]))]
    return pa.table(arrays, names=["slice", "keys", "words", "sums"])


def _per_text(parts: pa.Table) -> pa.Table:
    whole = _sum(parts)
    keys, n, sums = (np.frombuffer(whole.column(c)[0].as_py(), k) for c, k in (("keys", "<i8"), ("words", "<i8"), ("sums", "<f8")))
    return pa.table([pa.array(keys), pa.array(sums / n), pa.array(n)], names=["key", "d", "words"])


def _discounts(n: list[float]) -> tuple[float, float, float]:
    """The three discounts of Chen and Goodman from the numbers of n-grams seen once to four times."""
    if n[0] == 0 or n[1] == 0:
        return 0.5, 0.75, 0.9
    y = n[0] / (n[0] + 2 * n[1])
    d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1] if n[1] else 1.0, 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
    return tuple(min(max(x, 0.05), i + 1.0) for i, x in enumerate(d))


class Model:
    """Counts of both classes in shards by the hash of the last two words, the numbers of the words, and what is known of
    frequent words (in ``head``, by number); what rare words give is in the blocks."""

    def __init__(self, labelled: DataFrame, label_col: str = "toxic", text_col: str = "text"):
        spark = labelled.sparkSession
        rows = labelled.where(F.col(label_col).isNotNull()).select(F.col(label_col).cast("int").alias("y"), text_col)
        words = hashed_words(rows, "y", text_col=text_col)
        self.codes, n = frequent_words(words)
        self.shards = max(math.ceil(n / SHARD_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions"))) | 1
        blocks = words.mapInArrow(_count(spark.sparkContext.broadcast(self.codes), self.shards), BLOCKS)
        top = _written(blocks.groupBy("shard").applyInArrow(_merge, COUNTED), "toxicity-top")
        s = top.agg(*[F.sum(f"{c}_{i}").alias(f"{c}_{i}") for c in ("c_t", "c_o", "n2_t", "n2_o") for i in range(1, 5)]).first()
        d = {c: _discounts([float(s[f"{c}_{i}"] or 0) for i in range(1, 5)]) for c in ("c_t", "c_o", "n2_t", "n2_o")}
        self.numbers = {"d_t": d["c_t"], "d_o": d["c_o"], "d2_t": d["n2_t"], "d2_o": d["n2_o"]}
        each = top.select("shard", "block").mapInArrow(_stats, "word long, shard long, " + ", ".join(f"{c} long" for c in STATS))
        whole = each.groupBy("word").agg(F.min("shard").alias("least"), *[F.sum(c).alias(c) for c in STATS])
        whole = _written(whole, "toxicity-stats")
        n1 = F.col("n1")
        s = whole.agg(
            *[F.sum(F.when(n1 == i, 1).otherwise(0)).alias(f"n{i}") for i in range(1, 5)], F.sum("n1").alias("total"),
            F.sum(F.when(n1 > 0, 1).otherwise(0)).alias("vocab"), F.sum(F.when(n1 > 2, 1).otherwise(0)).alias("more"),
        ).first()
        d1 = _discounts([float(s[f"n{i}"] or 0) for i in range(1, 5)])
        mass = d1[0] * (s["n1"] or 0) + d1[1] * (s["n2"] or 0) + d1[2] * (s["more"] or 0)
        self.numbers |= {"d1": d1, "unigrams": (float(s["total"] or 0), float(mass), 1.0 / (int(s["vocab"] or 0) + 1))}
        self.head = np.zeros((len(STATS), HEAD_WORDS + FIRST))
        head = whole.where("word >= 0").toArrow()
        word = np.asarray(head.column("word")).astype(np.int64)
        for k, c in enumerate(STATS):
            self.head[k, word] = np.asarray(head.column(c))
        rare = whole.where("word < 0")
        of_shard = each.where("word < 0").select("word", "shard").join(rare, "word").groupBy("shard")
        self.shared = spark.sparkContext.broadcast(self.head)
        known = top.select("shard", "block").groupBy("shard").cogroup(of_shard).applyInArrow(_with_rare(self.shared, self.numbers), MODEL)
        self.rows = _written(known, "toxicity-model")
        if rare.count() <= FILTERED:
            bits = rare.select(F.col("word").bitwiseAND(F.lit(BITS - 1).cast("long")).cast("int").alias("bit")).toArrow()
            self.codes.only(np.asarray(bits.column(0)).astype(np.int64))
        _forget(top)
        _forget(whole)


def _sent(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= HEAD_ROWS else table


def evidence(docs: DataFrame, model: Model, key: str = "_key", text_col: str = "text") -> DataFrame:
    """``(key, d, words)`` per row of ``docs``: the mean log-likelihood ratio per trigram."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((model.codes, own_terms(model.head, model.numbers)))
    words = hashed_words(docs, key, text_col=text_col)
    rounds = []
    for turn in range(ROUNDS):
        asked = words.mapInArrow(_ask(shared, model.shards, turn), ASKED).groupBy("shard")
        rows = model.rows.mapInArrow(_reach(model.shards, turn), BLOCKS).groupBy("shard")
        answers = asked.cogroup(rows).applyInArrow(_answer(model.shared, model.numbers), SUMS)
        rounds.append(_written(answers.groupBy("slice").applyInArrow(_sum, SUMS), "toxicity-sums"))
    parts = rounds[0]
    for more in rounds[1:]:
        parts = parts.unionByName(more)
    return parts.groupBy("slice").applyInArrow(_per_text, "key long, d double, words long").withColumnRenamed("key", key)


def calibrate(evidence_rows: DataFrame, label_col: str = "y") -> tuple[float, float]:
    """``a, b`` of a ridge logistic regression of the label on ``d``; Newton steps, each one aggregation."""
    a, b = 1.0, 0.0
    rows = evidence_rows.select("d", F.col(label_col).cast("double").alias("y"))
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + F.exp(-(F.lit(a) * F.col("d") + F.lit(b))))
        w = p * (1 - p)
        s = rows.agg(
            F.sum((F.col("y") - p) * F.col("d")).alias("ga"), F.sum(F.col("y") - p).alias("gb"),
            F.sum(w * F.col("d") * F.col("d")).alias("haa"), F.sum(w * F.col("d")).alias("hab"), F.sum(w).alias("hbb"),
        ).first()
        if s["hbb"] is None:
            return a, b
        ga, gb = s["ga"] - RIDGE * a, s["gb"]
        haa, hab, hbb = s["haa"] + RIDGE, s["hab"], s["hbb"] + 1e-9
        det = haa * hbb - hab * hab
        if det <= 0:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a + da, b + db
        if abs(da) + abs(db) < 1e-9:
            break
    return a, b


def score(docs: DataFrame, labels: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted, d`` for every row of ``docs``. ``labels`` ``(doc_id, toxic)``; rows
    where ``held`` (an expression over ``doc_id``) is false teach the models and the calibration; where it is null
    (a null id) the row neither teaches nor counts as held out."""
    trains = ~held
    # Rows are known by a hash of id and text: equal rows are equal texts with equal scores, and no copy of the
    # texts is written. Collisions of 64-bit hashes are neglected.
    rows = docs.select(id_col, text_col).withColumn("_key", F.xxhash64(id_col, text_col))
    known_labels = _sent(labels.select(id_col, F.col("toxic").alias("y")))
    model = Model(rows.where(trains).join(known_labels, id_col).select("y", text_col), "y", text_col)
    ev = evidence(rows.select("_key", text_col), model)
    ev = _written(ev.groupBy("_key").agg(F.min("d").alias("d"), F.min("words").alias("words")), "toxicity-evidence")
    rows = _written(rows.select(id_col, "_key"), "toxicity-rows")  # from here on no text is read
    taught = rows.where(trains).join(known_labels, id_col)
    known = ev.join(taught.select("_key", "y"), "_key").where(F.col("y").isNotNull()).select("d", "y")
    a, b = calibrate(_written(known, "toxicity-known"))
    s = 1 / (1 + F.exp(-(F.lit(a) * F.col("d") + F.lit(b))))
    out = rows.select(id_col, "_key").join(ev, "_key", "left")
    return out.select(
        id_col, F.coalesce(held, F.lit(False)).alias("held_out"), s.alias("score"),
        F.when(s >= THRESHOLD, 1).otherwise(0).alias("predicted"), "d",
    )
