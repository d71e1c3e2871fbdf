"""Removing repeated passages with longest-previous-factor arrays.

Every byte that is covered by a string of ``LENGTH`` bytes which also starts in a document with a smaller id is removed.

A suffix array over everything would not fit anywhere, so equal strings are first brought together. The key of a window
of ``LENGTH`` bytes is the least hash among its ``GRAM``-byte substrings: equal windows have equal keys, and neighbours
mostly share theirs, so a document is a sequence of runs, pieces of at most 80 bytes under one key. Documents are dealt
into groups by a hash of the id. Each group tells, per key range, which (key, hash of the piece) it has and the least id
that has it. The answer is one of four for each piece:

* nothing else has this key, or no other piece has: keep;
* a smaller document has the same piece: all its windows are removed;
* the key has different pieces: the piece itself has to be looked at;
* the key is busy (some group has more than ``BUSY`` different pieces of it): its windows have to be looked at one by
  one, under the hash of the window, so a passage common to any share of the documents does not meet in one place.

For the last two the bytes are sent. There, suffixes are ranked by prefix doubling up to ``LENGTH`` bytes; in that order
the previous and the next suffix of a smaller document are found, and the longest previous factor of a suffix reaches
``LENGTH`` if either lies in the same class of equal prefixes. One bit per window goes back to the group, which removes.

Pieces and windows are told apart by hashes of 88 and 64 bits before bytes are compared.

Cases: a null text is empty; texts shorter than ``LENGTH`` stay whole; equal ids are not smaller than each other; rows
with a null id stay whole and are nobody's earlier document. Only the id and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import mix, sha256_hex

LENGTH = 50
GRAM = 20
SPAN = LENGTH - GRAM + 1  # grams of a window, and the most windows of a piece
BUSY = 12
#: The keys of pieces are distributed about like the least of so many hashes.
CROWDED = 22
#: Bytes of text that a group holds on average and that are hashed at a time, and pieces of a key range.
GROUP_BYTES = 1 << 20
CHUNK = 1 << 17
RANGE_PIECES = 200_000
KEY_BITS = np.uint64(48)
GOLD = np.uint64(0x9E3779B97F4A7C15)

KEEP, REMOVE, PIECE, WINDOWS = range(4)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as the least one, the bytes that the rest needs, and these."""
    values = np.ascontiguousarray(values, np.uint64)
    base = values.min() if len(values) else np.uint64(0)
    rest = values - base
    width = max(1, (int(rest.max()).bit_length() + 7) // 8) if len(values) else 1
    return np.array([len(values), base, width], "<u8").tobytes() + rest.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    count, base, width = np.frombuffer(data, "<u8", 3, at)
    at, n, w = at + 24, int(count), int(width)
    out = np.zeros((n, 8), np.uint8)
    out[:, :w] = np.frombuffer(data, np.uint8, n * w, at).reshape(n, w)
    return out.reshape(-1).view("<u8") + base, at + n * w


class Group:
    """The texts of a group as one array of bytes, its runs, and its different pieces in the order of their keys."""

    def __init__(self, rows: pa.Table):
        self.ids = rows.column("doc_id").combine_chunks()
        text = rows.column("text").combine_chunks()
        text = pa.concat_arrays([c for c in text.chunks]) if isinstance(text, pa.ChunkedArray) else text
        text = text.fill_null("").cast(pa.large_binary())
        offsets = np.frombuffer(text.buffers()[1], "<i8", len(text) + 1, 8 * text.offset)
        raw = text.buffers()[2]
        self.data = np.frombuffer(raw, np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0])) if raw else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        ids = self.ids.combine_chunks() if isinstance(self.ids, pa.ChunkedArray) else self.ids
        self.known = np.asarray(ids.is_valid())
        # Signed ids in an order-preserving unsigned form.
        self.order = np.asarray(ids.fill_null(0)).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        self._runs()

    def _runs(self) -> None:
        n = len(self.data)
        self.h16 = np.zeros(max(0, n - 15), np.uint64)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        a, docs = 0, len(self.offsets) - 1
        while a < docs:  # documents are read some at a time, so that the arrays fit the cache
            b = max(a + 1, int(np.searchsorted(self.offsets, self.offsets[a] + CHUNK, "right")) - 1)
            parts.append(self._runs_of(a, b))
            a = b
        start, count, key = (np.concatenate([x[i] for x in parts]) if parts else np.zeros(0, np.int64) for i in range(3))
        # Runs of text that repeats itself are cut; equal windows meet under their key in any case.
        pieces = -(-count // SPAN)
        which = np.repeat(np.arange(len(start)), pieces)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.start = start[which] + nth * SPAN
        self.count = np.minimum(SPAN, count[which] - nth * SPAN)
        self.doc = np.searchsorted(self.offsets, self.start, "right") - 1
        self.key = key[which].astype(np.uint64)
        first, last = self.window_hash(self.start), self.window_hash(self.start + self.count - 1)
        self.tag = mix(first * GOLD + last + self.count.astype(np.uint64)) >> np.uint64(24)
        self._distinct()

    def _runs_of(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, windows and keys of the runs of the documents from ``a`` to before ``b``."""
        low, high = int(self.offsets[a]), int(self.offsets[b])
        n, none = high - low, np.zeros(0, np.int64)
        if n < LENGTH:
            return none, none, none.astype(np.uint64)
        raw = self.data[low:high].tobytes()
        h8 = np.empty(n - 7, np.uint64)
        for k in range(8):  # the eight bytes from each place as one number
            h8[k::8] = np.frombuffer(raw, "<u8", (n - k) // 8, k)
        h16 = h8[:-8] * GOLD
        h16 ^= h16 >> np.uint64(32)
        h16 += h8[8:]
        h16 *= np.uint64(0xBF58476D1CE4E5B9)
        h16 ^= h16 >> np.uint64(29)
        h16 *= np.uint64(0x94D049BB133111EB)
        self.h16[low : low + len(h16)] = h16
        least = h8[16:] & np.uint64(0xFFFFFFFF)  # of the last four bytes of each gram, but for the end
        least = np.concatenate([least, [int.from_bytes(raw[n - 4 - j : n - j], "little") for j in (3, 2, 1, 0)]]).astype(np.uint64)
        least = (least[: n - GRAM + 1] + np.uint64(1)) * GOLD
        least += h16[: n - GRAM + 1]
        least ^= least >> np.uint64(32)
        least *= np.uint64(0xBF58476D1CE4E5B9)
        least >>= np.uint64(64) - KEY_BITS
        reach = 1
        while 2 * reach <= SPAN:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        windows = n - LENGTH + 1
        least = np.minimum(least[:windows], least[SPAN - reach :][:windows])
        begins, ends = self.offsets[a:b] - low, self.offsets[a + 1 : b + 1] - low
        good = np.zeros(windows + 1, np.int8)
        usable = (ends - begins >= LENGTH) & self.known[a:b]
        np.add.at(good, begins[usable], 1)
        np.add.at(good, ends[usable] - LENGTH + 1, -1)
        good = np.cumsum(good[:-1], dtype=np.int8)
        new = np.ones(windows, bool)
        np.not_equal(least[1:], least[:-1], out=new[1:])
        new[1:] |= good[1:] != good[:-1]
        new[begins[begins < windows]] = True
        start = np.flatnonzero(new)
        count = np.diff(np.append(start, windows))
        ok = good[start] == 1
        return start[ok] + low, count[ok], least[start[ok]]

    def window_hash(self, s: np.ndarray) -> np.ndarray:
        h = self.h16
        return mix(mix(h[s] * GOLD + h[s + 16]) + mix(h[s + 18] * GOLD + h[s + 34] + np.uint64(1)))

    def _distinct(self) -> None:
        """Different (key, tag), each with the run of the smallest id; where a key has many, it is one busy entry."""
        ids = self.order[self.doc]
        by = np.argsort(self.key)
        key = self.key[by]
        twin = np.zeros(len(by), bool)  # only keys that occur again need the other columns
        if len(by):
            twin[1:] = key[1:] == key[:-1]
            twin[:-1] |= twin[1:]
        again = by[twin]
        by[twin] = again[np.lexsort((ids[again], self.tag[again], self.key[again]))]
        tag = self.tag[by]
        new = np.ones(len(by), bool)
        new[1:] = (key[1:] != key[:-1]) | (tag[1:] != tag[:-1])
        first = by[new]
        of_run = np.empty(len(by), np.int64)
        of_run[by] = np.cumsum(new) - 1
        key = self.key[first]
        edge = np.ones(len(key), bool)
        edge[1:] = key[1:] != key[:-1]
        run_key = np.cumsum(edge) - 1
        many = np.bincount(run_key, minlength=1)[run_key] > BUSY if len(key) else np.zeros(0, bool)
        self.first = first  # run of each different piece
        self.piece = of_run  # different piece of each run
        self.first_id = ids[first]
        self.later = ids > self.first_id[of_run] if len(by) else np.zeros(0, bool)
        # Entries: pieces of keys that are not busy, and one for each busy key.
        lead = ~many | edge
        self.entry_of = np.cumsum(lead) - 1
        self.entry_key, self.entry_busy = key[lead], many[lead]
        self.entry_tag = np.where(self.entry_busy, np.uint64(0), self.tag[first][lead])
        self.entry_id = self.first_id[lead]

    def requests(self, ranges: int) -> list[tuple[int, bytes]]:
        part = range_of(self.entry_key, ranges)
        out = []
        for a, b in spans(part):
            gaps = np.diff(self.entry_key[a:b], prepend=np.uint64(0))
            columns = [gaps[:1], gaps[1:], self.entry_tag[a:b], self.entry_id[a:b], self.entry_busy[a:b]]
            out.append((int(part[a]), b"".join(packed(c) for c in columns)))
        return out

    def answers(self, replies: dict[int, bytes], ranges: int) -> np.ndarray:
        """What was said of each different piece, from the codes of the entries."""
        part = range_of(self.entry_key, ranges)
        code = np.zeros(len(part), np.uint8)
        for a, b in spans(part):
            bits = np.unpackbits(np.frombuffer(replies[int(part[a])], np.uint8), count=2 * (b - a))
            code[a:b] = bits[::2] * 2 + bits[1::2]
        return code[self.entry_of]

    def sent(self, code: np.ndarray, ranges: int) -> tuple[list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
        """What has to be compared, by key range: starts, sizes in bytes and least ids, of pieces and of windows.

        Also the hashes of the windows in rising order and the least id of each, to find them again."""
        runs = self.first[code == PIECE]
        key, start, size = self.key[runs], self.start[runs], self.count[runs] + LENGTH - 1
        least = self.order[self.doc[runs]]
        busy = self.first[code == WINDOWS]
        at = np.repeat(self.start[busy], self.count[busy])
        at = at + np.arange(len(at)) - np.repeat(np.cumsum(self.count[busy]) - self.count[busy], self.count[busy])
        ids = np.repeat(self.order[self.doc[busy]], self.count[busy])
        hashes = self.window_hash(at) if len(at) else np.zeros(0, np.uint64)
        by = np.lexsort((ids, hashes))
        new = np.ones(len(by), bool)
        new[1:] = hashes[by][1:] != hashes[by][:-1]
        by = by[new]
        part = np.concatenate([range_of(key, ranges), even_range(hashes[by], ranges)])
        starts = np.concatenate([start, at[by]])
        sizes = np.concatenate([size, np.full(len(by), LENGTH)])
        least = np.concatenate([least, ids[by]])
        order = np.argsort(part, kind="stable")
        out = [(int(part[order[a]]), order[a:b], starts[order[a:b]], sizes[order[a:b]], least[order[a:b]]) for a, b in spans(part[order])]
        return out, hashes[by], ids[by]

    def pieces(self, code: np.ndarray, ranges: int) -> list[tuple[int, bytes]]:
        out = []
        for part, _, starts, sizes, ids in self.sent(code, ranges)[0]:
            raw = self.data[ragged(starts, sizes)].tobytes()
            out.append((part, packed(ids) + packed(sizes) + raw))
        return out

    def removed(self, code: np.ndarray, replies: dict[int, bytes], ranges: int) -> np.ndarray:
        """Whether each byte goes."""
        n = len(self.data)
        if not len(self.start):
            return np.zeros(n, bool)
        parts, hashes, hash_ids = self.sent(code, ranges)
        n_pieces = int((code == PIECE).sum())
        bits: dict[int, np.ndarray] = {}
        flags = np.zeros(len(hashes), bool)
        for part, which, _, sizes, _ in parts:
            windows = sizes - LENGTH + 1
            said = np.unpackbits(np.frombuffer(replies[part], np.uint8), count=int(windows.sum())).astype(bool)
            ends = np.cumsum(windows)
            single = which >= n_pieces
            flags[which[single] - n_pieces] = said[ends[single] - 1]
            for i, e, w in zip(which[~single].tolist(), ends[~single].tolist(), windows[~single].tolist()):
                bits[i] = said[e - w : e]
        starts = np.zeros(n, bool)
        whole = self.later | (code[self.piece] == REMOVE)
        starts[ragged(self.start[whole], self.count[whole])] = True
        number = np.cumsum(code == PIECE) - 1
        for run in np.flatnonzero(~whole & (code[self.piece] == PIECE)).tolist():
            s, said = self.start[run], bits[number[self.piece[run]]]
            starts[s : s + len(said)] |= said
        busy = np.flatnonzero(~whole & (code[self.piece] == WINDOWS))
        if len(busy):
            at = ragged(self.start[busy], self.count[busy])
            mine = np.repeat(self.order[self.doc[busy]], self.count[busy])
            place = np.searchsorted(hashes, self.window_hash(at))
            starts[at] |= (mine > hash_ids[place]) | flags[place]
        # A byte goes if one of the last LENGTH places starts a removed window.
        total = np.cumsum(starts, dtype=np.int32 if n < 2**31 else np.int64)
        total[LENGTH:] -= total[:-LENGTH].copy()
        return total > 0


def range_of(key: np.ndarray, ranges: int) -> np.ndarray:
    """The range of a key. Keys are least values of many hashes and crowd at the low end, so ranges follow the
    distribution of such a minimum; they keep the order of the keys."""
    share = 1 - (1 - key.astype(np.float64) / 2.0**48) ** CROWDED
    return (share * ranges).astype(np.int64).clip(0, ranges - 1)


def even_range(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """The range of a 64-bit hash that is spread evenly."""
    return ((hashes >> np.uint64(32)).astype(np.float64) * (ranges / 2.0**32)).astype(np.int64).clip(0, ranges - 1)


def spans(part: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each stretch of equal values."""
    if not len(part):
        return []
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    return list(zip(cuts, cuts[1:]))


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers from each start, as many as its size."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def decide(blobs: list[bytes]) -> list[bytes]:
    """The codes for the entries of all groups in a key range, two bits each, blob by blob."""
    keys, tags, ids, busy, sizes = [], [], [], [], []
    for blob in blobs:
        first, at = unpacked(blob)
        gaps, at = unpacked(blob, at)
        tag, at = unpacked(blob, at)
        least, at = unpacked(blob, at)
        many, at = unpacked(blob, at)
        keys.append(np.cumsum(np.concatenate([first, gaps]), dtype=np.uint64))
        tags.append(tag)
        ids.append(least)
        busy.append(many == 1)
        sizes.append(len(tag))
    key, tag, least, many = (np.concatenate(x) for x in (keys, tags, ids, busy))
    by = np.lexsort((least, tag, many, key))
    k, t, d, m = key[by], tag[by], least[by], many[by]
    new_key = np.ones(len(by), bool)
    new_key[1:] = k[1:] != k[:-1]
    new = new_key.copy()
    new[1:] |= (t[1:] != t[:-1]) | (m[1:] != m[:-1])
    of_key, of_piece = np.cumsum(new_key) - 1, np.cumsum(new) - 1
    n_pieces = np.bincount(of_key[new])[of_key]
    key_busy = np.bincount(of_key, m)[of_key] > 0
    least_id = d[new][of_piece]
    code = np.where(n_pieces > 1, PIECE, KEEP)
    code[key_busy] = WINDOWS
    code[(d > least_id) & ~m] = REMOVE
    # A busy key of one group alone still has different pieces there.
    back = np.empty(len(by), np.uint8)
    back[by] = code
    out, at = [], 0
    for n in sizes:
        c = back[at : at + n]
        out.append(np.packbits(np.stack([c >> 1, c & 1], 1).ravel()).tobytes())
        at += n
    return out


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """The nearest place before each one that has a smaller value, -1 if none: places skip along earlier answers."""
    at = np.arange(len(values)) - 1
    todo = np.flatnonzero(at >= 0)
    while len(todo):
        todo = todo[values[at[todo]] >= values[todo]]
        at[todo] = at[at[todo]]
        todo = todo[at[todo] >= 0]
    return at


def dense(values: np.ndarray) -> np.ndarray:
    """Ranks of numbers from 0 on, equal ones alike."""
    by = np.argsort(values)
    ordered = values[by]
    out = np.empty(len(values), np.uint64)
    step = np.zeros(len(values), np.uint64)
    step[1:] = ordered[1:] != ordered[:-1]
    out[by] = np.cumsum(step)
    return out


def ranks(data: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The rank of the ``LENGTH`` bytes from each place that has them (``left``: bytes up to the end of the piece), by
    prefix doubling: each step ranks pairs of ranks, at the places that a later step still asks for."""
    n = len(data)
    raw = data.tobytes() + bytes(8)
    eight = np.empty(n, np.uint64)
    for k in range(8):
        eight[k::8] = np.frombuffer(raw, ">u8", (n - k + 7) // 8, k)
    rank = np.zeros(n + LENGTH, np.uint64)
    place = np.flatnonzero(left >= 8)
    rank[place] = dense(eight[place])
    for reach, step in ((16, 8), (32, 16), (LENGTH, LENGTH - 32)):
        place = place[left[place] >= reach]
        rank[place] = dense(rank[place] << np.uint64(32) | rank[place + step])
    return rank[place]


def earlier(blobs: list[bytes]) -> list[bytes]:
    """For each window of the pieces of all groups, one bit: the longest previous factor reaches ``LENGTH``."""
    ids, sizes, raw, numbers = [], [], [], []
    for blob in blobs:
        least, at = unpacked(blob)
        size, at = unpacked(blob, at)
        ids.append(least)
        sizes.append(size.astype(np.int64))
        raw.append(np.frombuffer(blob, np.uint8, len(blob) - at, at))
        numbers.append(len(least))
    least, size, data = np.concatenate(ids), np.concatenate(sizes), np.concatenate(raw)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(data))
    rank, owner = ranks(data, left), np.repeat(least, size - LENGTH + 1)
    order = np.argsort(rank)  # the suffix order
    doc, klass = owner[order], rank[order]
    before = previous_smaller(doc)
    after = len(doc) - 1 - previous_smaller(doc[::-1])[::-1]
    found = (before >= 0) & (klass[before] == klass)
    found |= (after < len(doc)) & (klass[np.minimum(after, len(doc) - 1)] == klass)
    bits = np.zeros(len(rank), bool)
    bits[order] = found
    windows = size - LENGTH + 1
    out, at, i = [], 0, 0
    for n in numbers:
        w = int(windows[i : i + n].sum())
        out.append(np.packbits(bits[at : at + w]).tobytes())
        at, i = at + w, i + n
    return out


BLOBS = "g int, kind int, part int, data binary"


def _table(g: int, kind: int, rows: list[tuple[int, bytes]]) -> pa.Table:
    n = len(rows)
    columns = [pa.array([g] * n, pa.int32()), pa.array([kind] * n, pa.int32()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())]
    return pa.table(columns, names=["g", "kind", "part", "data"])


def _answering(answer, kind: int):
    """Blobs of one key range in, an answer for each out."""

    def run(rows: pa.Table) -> pa.Table:
        col = rows.to_pydict()
        out = answer(col["data"])
        n = len(out)
        return pa.table(
            [pa.array(col["g"], pa.int32()), pa.array([kind] * n, pa.int32()), pa.array(col["part"], pa.int32()), pa.array(out, pa.binary())],
            names=["g", "kind", "part", "data"],
        )

    return run


def _replies(rows: pa.Table, kind: int) -> dict[int, bytes]:
    return {p: d for k, p, d in zip(*(rows.column(c).to_pylist() for c in ("kind", "part", "data"))) if k == kind}


def repeats(
    docs: DataFrame, digests: bool = False, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans`` and the kept bytes (``kept``), or with ``digests`` their SHA-256.

    Columns named in ``carry`` travel with the text, so that they need not be joined to the result."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *carry)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Groups and key ranges follow the bytes alone: their product is the number of messages.
    groups = max(2 * spark.sparkContext.defaultParallelism, -(-total // GROUP_BYTES))
    shuffled = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-groups // 4))
    ranges = max(8, total // 16 // RANGE_PIECES)
    # The one shuffle of texts; its three readers share it.
    dealt = rows.select(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(groups)).cast("int").alias("g"), "doc_id", "text", *carry)
    dealt = dealt.repartition(shuffled, "g")

    def request(texts: pa.Table) -> pa.Table:
        return _table(texts.column("g")[0].as_py(), 0, Group(texts).requests(ranges))

    def send(texts: pa.Table, replies: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _table(0, 0, [])
        group = Group(texts)
        code = group.answers(_replies(replies, 0), ranges)
        return _table(texts.column("g")[0].as_py(), 1, group.pieces(code, ranges))

    def remove(texts: pa.Table, replies: pa.Table) -> pa.Table:
        group = Group(texts)
        code = group.answers(_replies(replies, 0), ranges)
        gone = group.removed(code, _replies(replies, 1), ranges)
        out = []
        for a, b in zip(group.offsets[:-1].tolist(), group.offsets[1:].tolist()):
            mine = gone[a:b]
            kept = group.data[a:b][~mine].tobytes()
            edges = int(mine[0]) + int((mine[1:] & ~mine[:-1]).sum()) if b > a else 0
            out.append((b - a, int(mine.sum()), edges, sha256_hex(kept) if digests else kept))
        columns = list(zip(*out)) if out else [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string() if digests else pa.binary()]
        arrays = [texts.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds)), *(texts.column(c) for c in carry)]
        return pa.table(arrays, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", *carry])

    said = dealt.groupBy("g").applyInArrow(request, BLOBS).groupBy("part").applyInArrow(_answering(decide, 0), BLOBS)
    sent = dealt.groupBy("g").cogroup(said.groupBy("g")).applyInArrow(send, BLOBS)
    told = sent.groupBy("part").applyInArrow(_answering(earlier, 1), BLOBS)
    both = said.unionByName(told)
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept " + ("string" if digests else "binary")
    result += "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in carry)
    return dealt.groupBy("g").cogroup(both.groupBy("g")).applyInArrow(remove, result)
