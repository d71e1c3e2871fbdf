"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text that a task handles at a time, in characters. It bounds memory only, never what is read.
SLICE_CHARS = 1_000_000

WORD = regex.compile(r"[^\x20\x09-\x0D]+")


#: Rows of an Arrow batch. Texts are long: the usual 10,000 of them are tens of MB, several times over in a worker.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of ``BATCH_ROWS`` at most; results do not depend on it."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once a row however often (and inside which lambda) ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def slices(batch: pa.RecordBatch, text: int, chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``chars`` bytes of the text in column ``text`` each, one row at least."""
    lengths = np.asarray(batch.column(text).fill_null("").cast(pa.large_binary()).to_numpy(zero_copy_only=False))
    sizes = np.fromiter(map(len, lengths), np.int64, len(lengths)) if len(lengths) else np.zeros(0, np.int64)
    group = np.cumsum(sizes) // max(chars, 1)
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def hash64(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


class WordHashes(dict):
    """Word -> 64-bit hash, remembered for a bounded number of words."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = hash64(word.encode("utf-8", "surrogatepass"))
        return value

    def of(self, words: Iterable[str], count: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, count)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words, from the hashes of the words."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    n = len(hashes) - width + 1
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n] + np.uint64(k + 1))
    return out


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
