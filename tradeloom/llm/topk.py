"""Exact top-k inner products over vectors in descending order of length.

Components become whole numbers, so scores are exact. All vectors are rotated into the basis of the right singular
vectors of the whole table (from its Gram matrix, summed by Spark), where the first coordinates hold most of a product.
Vectors are dealt into blocks by descending length. A first round against the block of the longest vectors gives each
query a score that its k-th best reaches at least. Then each block meets each block of queries: candidates in descending
length are skipped once the length of query and candidate cannot reach the k-th best score (Cauchy-Schwarz), then those
whose rotated partial sum plus the product of the residual lengths cannot; what is left is scored exactly. The bounds
are widened by the rounding error of double precision, and equal scores are kept for the tie rule.

Queries are a stated set that meets all rows, block by block. Blocks of neighbouring length share a cell, which one task
holds while all queries pass; so queries are copied once a cell, not once a block, and the number of cells grows only
with ``CELL_BYTES`` of vectors each. Queries and blocks meet in one exchange: no plan can send either through the driver.
Memory is bounded by a cell and a block of queries. The best k of a query in a cell are all that is shuffled.

Cases: vectors that are null, empty, of another number of dimensions than most (ties: the smaller number), or that hold null or non-finite components take no part. Scores beyond 64 bits are an error of the input and
saturate. Equal ids are different rows, but a query that repeats an id is the least of its vectors, and rows of its own id
never answer it. Only id and vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.session import materialize

BLOCK = 4096  # candidates of a block
QUERY_BLOCK = 512
CELLS = 64  # tasks that share the blocks, or one for each core if there are more
CELL_BYTES = 128 << 20  # vectors of a cell
LEADING = 4  # one in so many rotated coordinates is in the partial sum
STEP = 256  # candidates that are looked at together
EXACT = 2.0**52


def usable(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``vec_id, v`` with the whole numbers of every vector without missing or infinite components."""
    v = F.col(vec_col).cast("array<double>")
    good = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(good & F.col(id_col).isNotNull())
    return rows.select("vec_id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("double")).alias("v"))


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column(0), batch.num_rows)
            total = x.T @ x if total is None else total + x.T @ x
    if total is not None:
        d = len(total)
        at = np.arange(d * d, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(at // d), pa.array(at % d), pa.array(total.ravel())], names=["i", "j", "s"])


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(rows, -1)


def rotation(vectors: DataFrame) -> np.ndarray:
    """The right singular vectors, greatest singular value first, as columns."""
    parts = vectors.select("v").mapInArrow(_gram, "i long, j long, s double")
    i, j, sums = (c.to_numpy() for c in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).toArrow().columns)
    d = int(i.max(initial=-1)) + 1
    gram = np.zeros((d, d))
    gram[i, j] = sums
    peak = np.abs(gram).max() if d else 0
    if not np.isfinite(peak) or not peak:
        return np.eye(d)
    return np.linalg.eigh(gram / peak)[1][:, ::-1].copy()


def _pack(kind: str, size: int):
    """Rows (id, vector, score to reach) of a partition, in its order, become one numbered row for each ``size`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        numbers = count()

        def row() -> pa.RecordBatch:
            data = [np.concatenate([h[i] for h in held]).astype(t).tobytes() for i, t in ((0, "<i8"), (1, "<f8"))]
            held.clear()
            columns = [pa.array([next(numbers)], pa.int32()), *(pa.array([x], pa.binary()) for x in data)]
            return pa.RecordBatch.from_arrays(columns, names=["nth", f"{kind}_ids", f"{kind}_data"])

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, data = np.asarray(batch.column(0)), _matrix(batch.column(1), batch.num_rows)
            if batch.num_columns > 2:
                data = np.hstack([data, np.asarray(batch.column(2), dtype=np.float64)[:, None]])
            at = 0
            while at < len(ids):
                n = size - sum(len(h[0]) for h in held)
                held.append((ids[at : at + n].copy(), data[at : at + n].copy()))
                at += n
                if sum(len(h[0]) for h in held) == size:
                    yield row()
        if held:
            yield row()

    return run


def _saturated(scores: np.ndarray) -> np.ndarray:
    top = 2**63 - 1
    return np.array([max(-top - 1, min(top, int(s))) for s in scores.ravel()], np.int64).reshape(scores.shape)


def _exact(queries: np.ndarray, cands: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly."""
    most = np.abs(queries).max(initial=0) * np.abs(cands).max(initial=0) * queries.shape[-1]
    if most < EXACT:
        return (queries @ cands.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], object) for m in (queries, cands)]
    return _saturated(whole[0].dot(whole[1].T))


class Block:
    """Candidates in descending length, with what the bounds need of them."""

    def __init__(self, ids: np.ndarray, cands: np.ndarray, basis: np.ndarray):
        length = np.linalg.norm(cands, axis=1)
        order = np.lexsort((ids, -length))
        self.ids, self.cands, self.length = ids[order], cands[order], length[order]
        self.lead, self.rest = _turned(self.cands, basis)


def _turned(vectors: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leading rotated coordinates, and the lengths of the others."""
    lead = max(1, vectors.shape[1] // LEADING)
    turned = vectors @ basis
    return turned[:, :lead].copy(), np.linalg.norm(turned[:, lead:], axis=1)


class Best:
    """The k best of each query among the blocks it has met."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, basis: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.length = np.linalg.norm(queries, axis=1)
        self.lead, self.rest = _turned(queries, basis)
        self.bar = floor.astype(np.float64)
        self.found_ids = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.filled = np.zeros(len(ids), np.int64)

    def meet(self, block: Block) -> None:
        for a in range(0, len(block.ids), STEP):
            b = min(len(block.ids), a + STEP)
            # 1e-9 of the product of the lengths is far above the rounding error of these sums.
            live = np.flatnonzero(self.length * block.length[a] * (1 + 1e-9) + 1 >= self.bar)
            if not len(live):
                break
            bound = self.lead[live] @ block.lead[a:b].T + self.rest[live, None] * block.rest[None, a:b]
            slack = 1e-9 * self.length[live, None] * block.length[None, a:b] + 1
            keep = (bound + slack >= self.bar[live, None]) & (self.ids[live, None] != block.ids[None, a:b])
            rows, cols = np.flatnonzero(keep.any(1)), np.flatnonzero(keep.any(0))
            if not len(rows):
                continue
            keep, who, c_ids = keep[np.ix_(rows, cols)], live[rows], block.ids[a:b][cols]
            scores = _exact(self.queries[who], block.cands[a:b][cols])
            last, last_id = self.found[who, -1:], self.found_ids[who, -1:]
            ahead = (scores > last) | (scores == last) & (c_ids < last_id) | (self.filled[who] < self.k)[:, None]
            keep &= ahead & (scores >= self.bar[who, None])
            for i in np.flatnonzero(keep.any(1)):
                self._merge(who[i], scores[i][keep[i]], c_ids[keep[i]])

    def _merge(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        n = self.filled[q]
        s, ids = np.concatenate([self.found[q, :n], scores]), np.concatenate([self.found_ids[q, :n], ids])
        top = np.lexsort((ids, ~s))[: self.k]  # ~s falls as s rises and cannot overflow
        self.filled[q] = n = len(top)
        self.found[q, :n], self.found_ids[q, :n] = s[top], ids[top]
        if n == self.k:
            self.bar[q] = max(self.bar[q], float(self.found[q, -1]))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, vector, score) of what was found."""
        has = np.arange(self.k)[None, :] < self.filled[:, None]
        return np.repeat(self.ids, self.filled), self.found_ids[has], self.found[has]


def best(q_ids, queries, floor, c_ids, cands, basis, k) -> list[tuple[int, int, int]]:
    """(query, vector, score) of the candidates of a block that can be among the k best of each query."""
    asked = Best(q_ids, queries, floor, basis, k)
    asked.meet(Block(c_ids, cands, basis))
    return list(zip(*(x.tolist() for x in asked.rows())))


def _meet(basis: np.ndarray, k: int):
    """Rows (cell, whether queries, number, ids, data) in this order: the candidates of a cell are held, the queries pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for cell, asks, _, ids, data in zip(*batch.columns):
                if cell.as_py() != at:
                    at, held = cell.as_py(), []
                ids = np.frombuffer(ids.as_buffer(), "<i8")
                data = np.frombuffer(data.as_buffer(), "<f8").reshape(len(ids), -1)
                if not asks.as_py():
                    held.append(Block(ids, data, basis))
                elif held:
                    asked = Best(ids, data[:, :-1].copy(), data[:, -1], basis, k)
                    for block in held:
                        asked.meet(block)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in asked.rows()], names=["query_id", "vec_id", "score"])

    return run


def _meetings(asked: DataFrame, packs: DataFrame, cells: int, basis: np.ndarray, k: int) -> DataFrame:
    """The best of each query among the packs of candidates that have a ``cell`` in common with its pack."""
    held = packs.select("cell", F.lit(False).alias("asks"), "nth", "cand_ids", "cand_data")
    both = held.union(asked.select("cell", F.lit(True), "nth", "query_ids", "query_data"))
    # One exchange of both sides: a join might be planned as a broadcast from a size that ``explode`` has outgrown.
    dealt = both.repartitionById(cells, "cell").sortWithinPartitions("cell", "asks", "nth")
    found = dealt.mapInArrow(_meet(basis, k), "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def _everywhere(packs: DataFrame, cells: int) -> DataFrame:
    return packs.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` greatest inner products of each query row among all other rows."""
    rows = usable(vectors, id_col, vec_col, scale)
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").limit(1).collect()
    fits = F.size("v") == (sizes[0].n if sizes else 0)
    rows = rows.where(fits)
    asked = usable(queries, id_col, vec_col, scale).where(fits).groupBy("vec_id").agg(F.min("v").alias("v"))
    total, n_asked = rows.count(), asked.count()
    if not total or not n_asked:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    basis = rotation(rows)
    blocks, asking = -(-total // BLOCK), -(-n_asked // QUERY_BLOCK)
    cells = max(CELLS, vectors.sparkSession.sparkContext.defaultParallelism, -(-total * 8 * len(basis) // CELL_BYTES))
    cells = min(cells, blocks)
    # Equal lengths are dealt by a hash, so every range gets about as many rows.
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    packs = (
        rows.repartitionByRange(cells, length.desc(), F.xxhash64("vec_id"))
        .sortWithinPartitions(length.desc(), "vec_id")
        .mapInArrow(_pack("cand", BLOCK), "nth int, cand_ids binary, cand_data binary")
        .withColumn("block", F.spark_partition_id())
    )
    packs = materialize(packs, "topk-packs")

    # A range is a cell; what one has beyond its share of blocks (rows that no key tells apart) goes to the next ones.
    share = -(-blocks // cells) + 1
    dealt = packs.withColumn("cell", ((F.col("block") + F.floor(F.col("nth") / share)) % cells).cast("int"))

    def packed(rows: DataFrame) -> DataFrame:
        schema = "nth int, query_ids binary, query_data binary"
        return rows.repartition(asking, "vec_id").mapInArrow(_pack("query", QUERY_BLOCK), schema)

    nothing = F.lit(float("-inf"))
    some = packed(asked.withColumn("bar", nothing)).withColumn("cell", F.spark_partition_id() % asking)
    first = _meetings(some, _everywhere(packs.where("block = 0 and nth = 0"), asking), asking, basis, k)
    reached = first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("bar"))
    asked = asked.join(reached, "vec_id", "left").withColumn("bar", F.coalesce("bar", nothing))
    found = _meetings(_everywhere(packed(asked), cells), dealt, cells, basis, k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
