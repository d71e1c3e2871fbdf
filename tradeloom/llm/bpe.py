"""Byte-level BPE with a lexicon of frequent words in a minimal acyclic transducer.

Words (pre-tokens) are counted over the whole corpus. The most frequent ones are merged once and compiled, in byte
order, into the smallest automaton that shares their suffixes; each arc carries the number of words that it skips, so
the sum along a path is the number of the word and leads to its ids. The automaton is one flat file of at most
``LEXICON_WORDS`` words of ``LEXICON_BYTES`` bytes, which bounds its size; every Python worker maps it into memory. A
word that it lacks is merged exactly, by rank and then from left to right.

Cases: a null text is empty and has no ids. The string of a special token stands for that token. A corpus without words
compiles an empty lexicon. Rows are encoded one by one, repeated or not; only the id and the text are read.
"""

from __future__ import annotations

import heapq
import json
import mmap
import os
import re
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import sha256_hex, slices
from tradeloom.session import materialize

LEXICON_WORDS = 100_000
LEXICON_BYTES = 48
#: Words whose ids a worker remembers between slices.
REMEMBERED = 400_000
#: Longest word that is merged together with others.
TOGETHER = 64

# Letters and numbers that came after version 16 of Unicode, which the vocabulary's library follows.
LATE = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 "
    "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 "
    "16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 "
    "1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 "
    "1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
_late = "".join("-".join(f"\\U{int(end, 16):08X}" for end in span.split("-")) for span in LATE.split())
_letter, _number = (rf"[\p{{{kind}}}--[{_late}]]" for kind in "LN")

# How the byte-level vocabulary cuts a text into words; PLAIN for texts without late characters, and the
# same for ASCII alone.
ANY = regex.compile(
    rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?{_letter}+| ?{_number}+| ?[[^\s\p{{L}}\p{{N}}]||[{_late}]]+|\s+(?!\S)|\s+"
)
PLAIN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
HAS_LATE = regex.compile(f"[{_late}]")
ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")


def words(text: str) -> list[str]:
    if text.isascii():
        return ASCII.findall(text)
    try:
        text.encode("latin-1")  # far quicker than a search, and true of most texts that are not ASCII
    except UnicodeEncodeError:
        return (ANY if HAS_LATE.search(text) else PLAIN).findall(text)
    return PLAIN.findall(text)


class Vocabulary:
    """Ids of single bytes, merges (pair of ids -> rank, id), bytes of each id and the special tokens of a file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            saved = json.load(file)
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
        byte = {c: b for b, c in letter.items()}
        ids = saved["model"]["vocab"]
        self.bytes_of: dict[int, bytes] = {i: bytes(byte[c] for c in token) for token, i in ids.items()}
        self.single = [ids[letter[b]] for b in range(256)]
        self.merges = {}
        for rank, pair in enumerate(saved["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        pairs = sorted((a << 32 | b, rank, new) for (a, b), (rank, new) in self.merges.items())
        self.pair_keys, self.pair_ranks, self.pair_ids = (np.array(x, np.int64) for x in (zip(*pairs) if pairs else [[]] * 3))
        self.special = {t["content"]: t["id"] for t in saved.get("added_tokens", [])}
        self.bytes_of |= {i: token.encode() for token, i in self.special.items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def parts(self, text: str) -> list[str]:
        """The text cut at special tokens, which stand at the odd places."""
        return self.split_special.split(text) if self.split_special else [text]

    def merge(self, word: bytes) -> list[int]:
        """The ids of a word; time grows as n log n with its length."""
        ids = [self.single[b] for b in word]
        if len(ids) < 2:
            return ids
        merges, n = self.merges, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # Entries are (rank, place, new id, left id, right id); one that no longer fits its place is stale.
        pairs = [(i, a, b, merges.get((a, b))) for i, (a, b) in enumerate(zip(ids, ids[1:]))]
        queue = [(found[0], i, found[1], a, b) for i, a, b, found in pairs if found]
        heapq.heapify(queue)
        while queue:
            _, i, new, a, b = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := merges.get((new, ids[k])):
                    heapq.heappush(queue, (found[0], i, found[1], new, ids[k]))
            h = before[i]
            if h >= 0 and (found := merges.get((ids[h], new))):
                heapq.heappush(queue, (found[0], h, found[1], ids[h], new))
        return [x for x in ids if x >= 0]


    def _ranked(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of each pair; a pair that never merges has a rank above all others."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        ok = self.pair_keys[at] == key
        return np.where(ok, self.pair_ranks[at], len(self.pair_keys)), self.pair_ids[at]

    def merge_many(self, found: list[bytes]) -> list[bytes]:
        """The ids of many words as little-endian 32-bit numbers: words of a length take a merge each at a time."""
        out: list[bytes] = [b""] * len(found)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        single = np.array(self.single, np.int64)
        for n in np.unique(lengths).tolist():
            who = np.flatnonzero(lengths == n)
            if n < 2 or n > TOGETHER or not len(self.pair_keys):
                for i in who:
                    out[i] = np.array(self.merge(found[i]), "<u4").tobytes()
                continue
            ids = single[np.frombuffer(b"".join(found[i] for i in who), np.uint8)].reshape(len(who), n)
            rank, new = self._ranked(ids[:, :-1], ids[:, 1:])
            never = len(self.pair_keys)
            while len(who):
                j = rank.argmin(1) if rank.shape[1] else np.zeros(len(who), np.int64)
                each = np.arange(len(who))
                done = rank[each, j] == never if rank.shape[1] else np.ones(len(who), bool)
                if done.any():
                    for i, row in zip(who[done], ids[done].astype("<u4")):
                        out[i] = row.tobytes()
                    who, ids, rank, new, j = who[~done], ids[~done], rank[~done], new[~done], j[~done]
                    each = np.arange(len(who))
                    if not len(who):
                        break
                width = ids.shape[1]
                ids[each, j] = new[each, j]
                keep = np.ones(ids.shape, bool)
                keep[each, j + 1] = False
                ids = ids[keep].reshape(len(who), width - 1)
                keep = np.ones(rank.shape, bool)
                keep[each, j] = False
                rank, new = rank[keep].reshape(len(who), width - 2), new[keep].reshape(len(who), width - 2)
                for at, ok in ((j - 1, j > 0), (j, j < width - 2)):
                    rows, cols = each[ok], at[ok]
                    rank[rows, cols], new[rows, cols] = self._ranked(ids[rows, cols], ids[rows, cols + 1])
        return out


def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The file of the minimal transducer for words in strictly rising byte order, with their ids."""
    # A state is [final, {label: state}]; finished states are replaced by an equal one that is registered.
    registry: dict[tuple, int] = {}
    final: list[bool] = []
    arcs: list[tuple[tuple[int, int], ...]] = []
    path: list[tuple[bool, list[tuple[int, int]]]] = [(False, [])]
    labels: list[int] = []

    def freeze(depth: int) -> None:
        while len(path) > depth + 1:
            ends, out = path.pop()
            key = (ends, tuple(out))
            if (state := registry.get(key)) is None:
                state = registry[key] = len(final)
                final.append(ends)
                arcs.append(key[1])
            path[-1][1].append((labels.pop(), state))

    last, offsets, flat = None, [0], []
    for word, ids in entries:
        if last is not None and word <= last:
            raise ValueError("words must rise")
        common = len(os.path.commonprefix([word, last])) if last else 0
        freeze(common)
        for b in word[common:]:
            path.append((False, []))
            labels.append(b)
        path[-1] = (True, path[-1][1])
        last = word
        flat += ids
        offsets.append(len(flat))
    freeze(0)
    final.append(path[0][0])
    arcs.append(tuple(path[0][1]))
    below = np.zeros(len(final), np.int64)  # words that end at or after a state; targets have smaller numbers
    keys, targets, skips = [], [], []
    for state, out in enumerate(arcs):
        total = int(final[state])
        for label, target in out:
            keys.append(state << 8 | label)
            targets.append(target)
            skips.append(total)
            total += int(below[target])
        below[state] = total
    arrays = [np.array(keys, "<i8"), np.array(targets, "<i8"), np.array(skips, "<i8"), np.array(final, "<i8"), np.array(offsets, "<i8"), np.array(flat, "<u4")]
    return np.array([len(a) for a in arrays], "<i8").tobytes() + b"".join(a.tobytes() for a in arrays)


class Lexicon:
    """A mapped file of ``compile_lexicon``."""

    def __init__(self, file: bytes):
        # The mapping outlives the name of the file, so nothing is left behind when the worker goes.
        with tempfile.TemporaryFile(prefix="lexicon-") as f:
            f.write(file)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = np.frombuffer(self.map, "<i8", 6)
        at, arrays = 48, []
        for n in sizes.tolist()[:5]:
            arrays.append(np.frombuffer(self.map, "<i8", n, at))
            at += 8 * n
        self.keys, self.targets, self.skips, self.final, self.offsets = arrays
        self.ids = memoryview(self.map)[at : at + 4 * int(sizes[5])]

    def find(self, found: list[bytes]) -> np.ndarray:
        """The number of each word, -1 if it isn't in the lexicon: all words take a step at a time."""
        n = len(found)
        out = np.full(n, -1, np.int64)
        if not n or not len(self.keys):
            return out
        lengths = np.fromiter(map(len, found), np.int64, n)
        starts = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(found), np.uint8)
        live = np.flatnonzero((lengths > 0) & (lengths <= LEXICON_BYTES))
        state = np.full(len(live), len(self.final) - 1, np.int64)
        number = np.zeros(len(live), np.int64)
        step = 0
        while len(live):
            key = state << 8 | data[starts[live] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[arc] == key
            live, arc, number = live[ok], arc[ok], number[ok]
            state, number = self.targets[arc], number + self.skips[arc]
            step += 1
            ends = lengths[live] == step
            hit = ends & (self.final[state] == 1)
            out[live[hit]] = number[hit]
            live, state, number = live[~ends], state[~ends], number[~ends]
        return out


def _count(vocabulary: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab: Vocabulary = vocabulary.value

        def rows(counts: Counter) -> pa.RecordBatch:
            arrays = [pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["word", "n"])

        counts: Counter = Counter()
        for batch in batches:
            for part in slices(batch, 0):
                for text in part.column(0).to_pylist():
                    for piece in vocab.parts(text or "")[::2]:
                        counts.update(words(piece))
                if len(counts) > REMEMBERED:
                    yield rows(counts)
                    counts = Counter()
        yield rows(counts)

    return run


def train_lexicon(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", most: int = LEXICON_WORDS) -> bytes:
    """Count the words of every text, merge the most frequent ones and compile them."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    counts = docs.select(F.col(text_col)).mapInArrow(_count(shared), "word string, n long")
    counts = counts.groupBy("word").agg(F.sum("n").alias("n")).where((F.col("n") > 1) & (F.octet_length("word") <= LEXICON_BYTES))
    counts = materialize(counts, "bpe-words")
    # The least frequency above which there are no more than ``most`` words: few words have any one high frequency.
    enough, room = 2, most
    for n, words_of_n in sorted(((r.n, r.c) for r in counts.groupBy("n").agg(F.count("*").alias("c")).collect()), reverse=True):
        room -= words_of_n
        if room < 0:
            enough = n + 1
            break
    frequent = counts.where(F.col("n") >= enough).select("word").collect()
    found = sorted(r.word.encode() for r in frequent)
    return compile_lexicon(zip(found, (np.frombuffer(x, "<u4").tolist() for x in vocabulary.merge_many(found))))


class Encoder:
    """Encodes texts with a lexicon and a vocabulary; ids are little-endian 32-bit numbers."""

    def __init__(self, vocabulary: Vocabulary, lexicon: bytes):
        self.vocabulary, self.lexicon = vocabulary, Lexicon(lexicon)
        self.known: dict[str, bytes] = {}
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in vocabulary.special.items()}
        size = max(vocabulary.bytes_of, default=-1) + 1
        self.bytes_of = [vocabulary.bytes_of.get(i, b"") for i in range(size)]

    def learn(self, found: set[str]) -> None:
        new = [w for w in found if w not in self.known]
        raw = [w.encode() for w in new]
        ids, numbers = self.lexicon.ids, self.lexicon.find(raw)
        has = numbers >= 0
        starts, ends = (4 * self.lexicon.offsets[numbers[has] + k] for k in (0, 1))
        self.known.update(zip((w for w, ok in zip(new, has) if ok), (bytes(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist()))))
        lacking = np.flatnonzero(~has).tolist()
        merged = self.vocabulary.merge_many([raw[i] for i in lacking])
        self.known.update(zip((new[i] for i in lacking), merged))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [[(words(p) if k % 2 == 0 else p) for k, p in enumerate(self.vocabulary.parts(t))] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        self.learn({w for pieces in cut for p in pieces[::2] for w in p})
        known, special = self.known.__getitem__, self.special
        return [b"".join(special[p] if isinstance(p, str) else b"".join(map(known, p)) for p in pieces) for pieces in cut]

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace")


def _encoder(vocabulary: Broadcast, lexicon: Broadcast, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value, lexicon.value)
        for batch in batches:
            for part in slices(batch, 1):
                ids = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                decoded = [encoder.decode(x) for x in ids]
                arrays = [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64())]
                if digests:
                    arrays += [pa.array(map(sha256_hex, ids)), pa.array([sha256_hex(t.encode()) for t in decoded])]
                else:
                    arrays += [pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names = ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def encode(
    docs: DataFrame, vocabulary: Vocabulary, lexicon: bytes, digests: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every text; with ``digests`` the SHA-256 of ids and text instead of them."""
    context = docs.sparkSession.sparkContext
    run = _encoder(context.broadcast(vocabulary), context.broadcast(lexicon), digests)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return rows.mapInArrow(run, f"doc_id long, n_tokens long, {kinds}")
