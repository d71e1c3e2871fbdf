"""Near-duplicates by DartMinHash.

A document is the multiset of its five-word shingles, each with its count as weight. For every shingle and weight band
[0, 1), [1, 2), [2, 4), ... a Poisson process, seeded by the shingle, throws darts: each has a time, a place in the band
and one of ``DARTS`` coordinates. A dart counts if its place is below the weight. Only darts up to a time are thrown at
all, chosen from the total weight so that all coordinates are probably hit; a document with a coordinate left empty is
thrown again for twice the time. The earliest dart of a coordinate is its signature there, and two documents agree on it
with the probability of their weighted Jaccard similarity. Bands of four coordinates are joined.

Documents with equal words are one text; only its first document goes on. In a bucket all texts are compared with the
least one; and, so that no group is compared all with all, the bucket is sorted by the coordinates that follow those of
its key, and of the ``NEAR`` texts on either side each text is compared with the ``PARTNERS`` whose signatures agree most.
A group of any size is dealt out by ranges of that order. These links only save work: in every bucket that still holds
several components afterwards, each text is compared with all texts of the other components, in cells of two blocks of
about ``BLOCK`` texts, whatever the size of the bucket. Signatures are compared first, and pairs that agree in fewer
coordinates than ``least_equal`` are passed over, as a pair of the least similarity does less than once in a million
times; every other pair is verified exactly on whole texts inside the cell, unless links of the cell connect it already,
so that pairs are never rows. Links of similarity 0.8 share a bucket but for 3 in a million.

Cases: documents with one to four words have one shingle, their words; those without a word (null, empty) are alone.
Ids that repeat belong to one document per text. Ties take the least id. Only id and text are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import WordHashes, mix, shingles, slices
from tradeloom.llm.components import components
from tradeloom.session import materialize

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
WIDTH = 5
DARTS = 96
ROWS = 4
SIMILAR = 0.8
#: For the first links: neighbours on either side that signatures are compared with, how many of them are verified, and
#: the share of equal coordinates from which on they are likely.
NEAR, PARTNERS, LIKELY = 64, 3, 0.66
#: Texts of a bucket that meet another block at a time, and the probability that a similar pair is passed over.
BLOCK, MISSED = 256, 1e-6
#: The side of texts whose cell is a block with itself.
BOTH = 2
GOLD = np.uint64(0x9E3779B97F4A7C15)


def weighted_shingles(words: list[str], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Shingles as sorted 64-bit hashes, and how often each occurs."""
    h = hashes.of(words, len(words))
    found = shingles(h, min(WIDTH, max(1, len(words))))
    return np.unique(found, return_counts=True)


def _salt(k: int) -> np.uint64:
    return np.uint64(int(GOLD) * k % 2**64)


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(elements: np.ndarray, weights: np.ndarray, docs: np.ndarray, count: int, darts: int = DARTS) -> np.ndarray:
    """One row of ``darts`` 32-bit values for each of ``count`` documents; ``docs`` says whose each element is."""
    total = np.bincount(docs, weights, count)
    best = np.full(count * darts, np.uint64(2**64 - 1))
    until = np.where(total > 0, darts * (math.log(darts) + 3) / np.maximum(total, 1e-300), 0.0)
    todo = total > 0
    while todo.any():
        mine = todo[docs]
        e, w, d = elements[mine], weights[mine], docs[mine]
        best.reshape(count, darts)[todo] = np.uint64(2**64 - 1)
        band, low = 0, 0.0
        while len(e):
            width = 1.0 if band == 0 else float(2 ** (band - 1))
            seed = mix(e + _salt(band + 1))
            at, when, k = np.arange(len(e)), np.zeros(len(e)), 0
            while len(at):
                k += 1
                h = mix(seed[at] + _salt(k))
                when = when - np.log(_uniform(h)) / width
                ok = when < until[d[at]]
                at, when, h = at[ok], when[ok], h[ok]
                g = mix(h + GOLD)
                hit = low + _uniform(g) * width < w[at]
                g = mix(g[hit] + GOLD)
                who = d[at[hit]]
                rank = (when[hit] / until[who] * 2.0**32).astype(np.uint64)
                cell = who * darts + (g % np.uint64(darts)).astype(np.int64)
                np.minimum.at(best, cell, rank << np.uint64(32) | g >> np.uint64(32))
            low, band = low + width, band + 1
            more = w > low
            e, w, d = e[more], w[more], d[more]
        todo &= (best.reshape(count, darts) == np.uint64(2**64 - 1)).any(1)
        until = np.where(todo, 2 * until, until)
    return (best & np.uint64(0xFFFFFFFF)).astype(np.uint32).reshape(count, darts)


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each document and band."""
    count, darts = signature.shape
    parts = signature.reshape(count, darts // rows, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(darts // rows, dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(rows):
        key = mix(key * GOLD + parts[:, :, j] + np.uint64(1))
    return key


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for part in slices(batch, 1):
            ids, content, found, counts, owner = [], [], [], [], []
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = WORDS.findall(text) if text else []
                if words:
                    s, c = weighted_shingles(words, hashes)
                    owner.append(np.full(len(s), len(ids)))
                    found.append(s)
                    counts.append(c.astype(np.float64))
                    ids.append(doc)
                    content.append(hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest())
            if ids:
                signed = signatures(np.concatenate(found), np.concatenate(counts), np.concatenate(owner), len(ids))
                rows = [r.astype("<u4").tobytes() for r in signed]
                arrays = [pa.array(ids, pa.int64()), pa.array(content, pa.binary()), pa.array(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "content", "signature"])


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each band of each text: its key, and the two coordinates that follow, which order a bucket."""
    for batch in batches:
        if batch.num_rows:
            signed = np.stack([np.frombuffer(s, "<u4") for s in batch.column(1).to_pylist()])
            keys = band_keys(signed)
            bands = keys.shape[1]
            after = np.roll(signed, -ROWS, 1).reshape(len(signed), bands, ROWS)[:, :, :2].astype(np.uint64)
            order = after[:, :, 0] << np.uint64(31) | after[:, :, 1] >> np.uint64(1)
            arrays = [pa.array(x.ravel().view(np.int64)) for x in (keys, order)]
            band = pa.array(np.tile(np.arange(bands, dtype=np.int32), len(signed)))
            ids = pa.array(np.repeat(np.asarray(batch.column(0)), bands))
            yield pa.RecordBatch.from_arrays([*arrays, band, ids], names=["key", "place", "band", "rep"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Likely pairs among the rows of a sorted part of the buckets."""
    held: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
    for batch in batches:
        for a in range(0, batch.num_rows, 4096):
            part = batch.slice(a, 4096)
            key, rep = np.asarray(part.column(0)), np.asarray(part.column(1))
            signed = np.stack([np.frombuffer(s, "<u4") for s in part.column(2).to_pylist()])
            if held is not None:
                key, rep, signed = (np.concatenate(x) for x in zip(held, (key, rep, signed)))
            found = []
            for d in range(1, min(NEAR, len(key) - 1) + 1):
                same = np.flatnonzero(key[d:] == key[:-d])
                if len(same):
                    share = (signed[same + d] == signed[same]).mean(1)
                    ok = share >= LIKELY
                    found.append((share[ok], same[ok], same[ok] + d))
            if found:
                share, i, j = (np.concatenate(x) for x in zip(*found))
                whose, other, share = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([share, share])
                by = np.lexsort((-share, whose))
                whose, other = whose[by], other[by]
                first = np.searchsorted(whose, whose)
                best = np.arange(len(whose)) - first < PARTNERS
                u, v = rep[whose[best]], rep[other[best]]
                pairs = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])
            held = key[-NEAR:], rep[-NEAR:], signed[-NEAR:]


def least_equal(least: float, darts: int = DARTS) -> int:
    """Equal coordinates that a pair of similarity ``least`` falls below with a probability of at most ``MISSED``."""
    below = 0.0
    for k in range(darts):
        below += math.comb(darts, k) * least**k * (1 - least) ** (darts - k)
        if below > MISSED:
            return k
    return darts


def _across(least: float):
    """Of cells that lie together, links (u, v) that join the components which a similar pair connects.

    A pair is compared in the first band that both texts share and in no other, and only while nothing that was found
    before connects it, likely pairs first. So a cell gives fewer links than it has texts, however many pairs are alike.
    """
    equal = least_equal(least)

    def candidates(cell, side, rep, root, band, signed) -> tuple[np.ndarray, np.ndarray]:
        first, second, share = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for d in range(1, len(cell)):
            together = np.flatnonzero(cell[d:] == cell[:-d])
            if not len(together):
                break
            i, j = together, together + d
            ok = (root[i] != root[j]) & ((side[i] != side[j]) | (side[i] == BOTH))
            i, j = i[ok], j[ok]
            same = signed[i] == signed[j]
            agree = same.sum(1)
            ok = (agree >= equal) & (same.reshape(len(same), DARTS // ROWS, ROWS).all(2).argmax(1) == band[i])
            first.append(i[ok])
            second.append(j[ok])
            share.append(agree[ok])
        by = np.argsort(-np.concatenate(share), kind="stable")
        return np.concatenate(first)[by], np.concatenate(second)[by]

    def links(cell, side, rep, root, band, signed, text, hashes) -> pa.RecordBatch:
        parent: dict[int, int] = {}
        known: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}

        def find(x: int) -> int:
            while x in parent:
                parent[x] = x = parent.get(parent[x], parent[x])
            return x

        def shingled(i: int) -> tuple[np.ndarray, np.ndarray, int]:
            if i not in known:
                found, counts = weighted_shingles(WORDS.findall(text[i]), hashes)
                known[i] = found, counts, int(counts.sum())
            return known[i]

        us, vs = [], []
        for i, j in zip(*(x.tolist() for x in candidates(cell, side, rep, root, band, signed))):
            x, y = find(int(root[i])), find(int(root[j]))
            if x == y:
                continue
            a, b = shingled(i), shingled(j)
            if min(a[2], b[2]) >= least * max(a[2], b[2]) and weighted_jaccard(a[:2], b[:2]) >= least:
                parent[max(x, y)] = min(x, y)
                us.append(min(rep[i], rep[j]))
                vs.append(max(rep[i], rep[j]))
        return pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [np.asarray(batch.column(k)) for k in range(5)]
            rows.append(np.stack([np.frombuffer(s, "<u4") for s in batch.column(5).to_pylist()]))
            rows.append(np.array(batch.column(6).to_pylist(), object))
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            # The last cell may go on in the next batch.
            end = int(np.searchsorted(rows[0], rows[0][-1]))
            if end:
                yield links(*(x[:end] for x in rows), hashes)
            held = [x[end:] for x in rows]
        if held is not None:
            yield links(*held, hashes)

    return run


def _open_links(members: DataFrame, found: DataFrame, distinct: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links (u, v) between texts of a bucket that are not connected yet, enough to connect what is similar."""
    rooted = members.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    rooted = materialize(rooted.select("key", "band", "rep", F.coalesce("root", "rep").alias("root")), "near-rooted")
    several = rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("key")
    opened = materialize(rooted.join(several, "key"), "near-open")
    # A large component has blocks of its own, the small ones of a bucket share some.
    parts = opened.groupBy("key", "root").agg(F.count("*").alias("n"))
    large = F.col("n") >= BLOCK
    shared = parts.where(~large).groupBy("key").agg(F.sum("n").alias("rest"))
    parts = parts.join(shared, "key", "left").select(
        "key", "root", F.when(large, F.col("root")).alias("own"),
        F.ceil(F.when(large, F.col("n")).otherwise(F.col("rest")) / BLOCK).alias("blocks"),
    )
    placed = opened.join(parts, ["key", "root"])
    dealt = F.xxhash64(F.lit(7), F.when(F.col("own").isNull(), F.col("root")).otherwise(F.col("rep")))
    placed = placed.select("key", "band", "rep", "root", "own", F.xxhash64("own", F.pmod(dealt, F.col("blocks"))).alias("block"))
    placed = materialize(placed, "near-blocks")
    blocks = placed.groupBy("key", "block").agg(F.any_value("own").alias("own"))
    blocks = materialize(blocks, "near-block-names")
    other = blocks.select("key", F.col("block").alias("with"), F.col("own").alias("its"))
    cells = blocks.join(other, "key")
    cells = cells.where(F.coalesce(F.col("own") != F.col("its"), F.lit(True)))
    cell = F.xxhash64("key", F.least("block", "with"), F.greatest("block", "with"))
    side = F.when(F.col("block") == F.col("with"), BOTH).otherwise((F.col("block") < F.col("with")).cast("int"))
    cells = cells.select("key", "block", cell.alias("cell"), side.cast("int").alias("side"))
    rows = placed.join(cells, ["key", "block"]).join(distinct, "rep").join(texts, "rep")
    rows = rows.repartition("cell").sortWithinPartitions("cell")
    rows = rows.select("cell", "side", "rep", "root", "band", "signature", "text")
    return materialize(rows.mapInArrow(_across(least), "u long, v long").distinct(), "near-across")


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common / max(1, int(a[1].sum() + b[1].sum()) - common)


def _verify(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        last, left = None, None
        for batch in batches:
            us, vs = [], []
            for u, v, a, b in zip(*(batch.column(i) for i in range(4))):
                if last != (u.as_py(), len(a.as_py())):
                    last = (u.as_py(), len(a.as_py()))
                    left = weighted_shingles(WORDS.findall(a.as_py()), hashes)
                right = weighted_shingles(WORDS.findall(b.as_py()), hashes)
                big, small = max(left[1].sum(), right[1].sum()), min(left[1].sum(), right[1].sum())
                if small >= least * big and weighted_jaccard(left, right) >= least:
                    us.append(u.as_py())
                    vs.append(v.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return run


def _links(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose texts are similar; texts of one ``u`` come one after another."""
    left = texts.select(F.col("rep").alias("u"), F.col("text").alias("a"))
    right = texts.select(F.col("rep").alias("v"), F.col("text").alias("b"))
    joined = pairs.join(right, "v").join(left, "u").select("u", "v", "a", "b")
    return materialize(joined.mapInArrow(_verify(least), "u long, v long"), "near-links")


def near_duplicates(docs: DataFrame, least: float = SIMILAR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, class_id`` of every document; a class is named by its least id."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = materialize(rows.mapInArrow(_sign, "doc_id long, content binary, signature binary"), "near-signatures")
    # Equal words have equal signatures, so any of them stands for all.
    distinct = signed.groupBy("content").agg(F.min("doc_id").alias("rep"), F.any_value("signature").alias("signature"))
    distinct = materialize(distinct.select("rep", "signature"), "near-texts")
    keys = materialize(distinct.mapInArrow(_spread, "key long, place long, band int, rep long"), "near-bands")
    buckets = keys.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    members = materialize(keys.join(buckets.select("key", "least"), "key"), "near-members")
    stars = members.where("rep <> least").select(F.col("least").alias("u"), F.col("rep").alias("v"))
    shuffled = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    close = (
        members.select("key", "place", "rep").join(distinct, "rep").select("key", "rep", "signature", "place")
        .repartitionByRange(shuffled, "key", "place", "rep").sortWithinPartitions("key", "place", "rep")
        .select("key", "rep", "signature").mapInArrow(_neighbours, "u long, v long")
    )
    pairs = stars.unionByName(close).distinct()
    wanted = members.select("rep").distinct()
    # An id may stand for several texts; only one of them is the text of its content.
    texts = materialize(rows.join(wanted, F.col("doc_id") == F.col("rep"), "left_semi").select(F.col("doc_id").alias("rep"), "text").distinct(), "near-compared")
    links = _links(pairs, texts, least)
    found = materialize(components(links), "near-components")
    more = _open_links(members.select("key", "band", "rep"), found, distinct, texts, least)
    if not more.isEmpty():
        # What was found stands for the links within its components.
        known = found.select(F.col("root").alias("u"), F.col("node").alias("v"))
        found = materialize(components(known.unionByName(more)), "near-components")
    groups = signed.groupBy("content").agg(F.min("doc_id").alias("rep"))
    named = groups.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("content", F.coalesce("root", "rep").alias("class_id"))
    classes = signed.select("doc_id", "content").join(named, "content").groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    return rows.select("doc_id").join(classes, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
