"""Hard negatives by threshold joins in the manner of L2AP: only pairs whose score can reach a threshold are formed.

Vectors become integers (``floor(scale * x)``); the score of two rows is their inner product. For every anchor the
positives are its ``positives`` best rows of the same label, and for each positive the negatives are the ``negatives``
best rows of another label whose score lies in ``[low * p, high * p]`` (``p`` the positive's score, bounds in percent).

Thresholds, and how they prune:

* A threshold per anchor is seeded from a bounded sample (``SEED_ROWS`` rows picked by a hash): the k-th best score
  that the sample already reaches can only be beaten, so rows below it are never needed. Where the sample does not fill
  a window, the threshold falls to the window's own lower bound (or to nothing at all), so results never depend on the
  sample: it only prunes.
* Rows are dealt into blocks of similar norm (``BLOCK_ROWS`` rows, by norm band and a salt), anchors into blocks of
  ``ANCHOR_ROWS``. A pair of blocks is formed only if the largest anchor norm times the largest row norm reaches the
  smallest threshold of the anchor block (Cauchy-Schwarz), before anything is shipped.
* Inside a task, partial scores over the dimensions that carry most of the anchors' mass are accumulated first; the
  remaining dimensions can add at most the product of the remaining norms, and rows whose bound stays below an anchor's
  threshold are dropped before their full score is taken. For dense vectors this plays the part of L2AP's inverted
  index over the suffixes that the norm bounds do not cover.

Merging keeps at most ``positives`` (or ``negatives``) rows per anchor (and positive) and block; a window sort of
those gives the result. Exact: every row that can belong to a result is scored.

Cases: rows with a null id, label or vector, or a null or non-finite component take no part; vectors of another length
than the anchor's are not compared with it. A row is never its own partner (equal ids). Repeated rows count as often as
they occur (a repeated anchor row is an anchor each time, as a repeated positive is); ties go to the smaller
id. A positive with a negative score has an empty window. An empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import Window

from tradeloom.session import broadcast_checked, materialize

BLOCK_ROWS = 2048
ANCHOR_ROWS = 256
#: Rows of the sample that seeds the thresholds; it bounds only the memory of the seed.
SEED_ROWS = 4096
#: Width of a norm band: norms within a factor of 1 + BAND share blocks.
BAND = 0.05
#: Share of the dimensions in the partial score.
LEADING = 0.25
EXACT = 2.0**52
#: The floor of an anchor without a threshold: below every score.
NO_FLOOR = -1e300


def prepare(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int, relabel: Column | None) -> DataFrame:
    """Usable rows as ``(vec_id, lab, q, norm, dim, _row)``, written once so that block assignment stays fixed."""
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & ~bad)
    q = F.transform("vec", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    v = v.select("vec_id", (relabel if relabel is not None else F.col("label")).alias("lab"), q.alias("q"))
    v = v.withColumn("norm", F.sqrt(F.aggregate("q", F.lit(0.0), lambda a, x: a + x.cast("double") * x)))
    v = v.withColumn("dim", F.size("q")).withColumn("_row", F.xxhash64(F.monotonically_increasing_id(), F.spark_partition_id()))
    return materialize(v, "negatives-rows")


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows with their block ``(dim, band, salt)``: bands of norm, salted so that no block holds more than about
    ``BLOCK_ROWS`` rows, however many rows share a norm."""
    band = F.floor(F.log1p(F.col("norm")) / np.log1p(BAND)).cast("long")
    rows = rows.withColumn("band", band)
    sizes = rows.groupBy("dim", "band").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("_salts"))
    rows = rows.join(broadcast_checked(sizes), ["dim", "band"])
    return rows.withColumn("salt", F.pmod(F.col("_row"), F.col("_salts"))).drop("_salts")


def _seed(rows: DataFrame) -> pd.DataFrame:
    """The sample that seeds thresholds: ``SEED_ROWS`` rows of least hash (a bounded top-k, no group)."""
    return rows.orderBy(F.xxhash64("_row", F.lit(11))).limit(SEED_ROWS).select("vec_id", "lab", "q").toPandas()


def _matrix(series) -> np.ndarray:
    if len(series) == 0:
        return np.zeros((0, 0), np.int64)
    return np.stack([np.asarray(x, dtype=np.int64) for x in series])


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in floating point where the sums cannot lose a unit, else in integers."""
    if a.size == 0 or b.size == 0:
        return np.zeros((a.shape[0], b.shape[0]), np.int64)
    bound = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if bound < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _best(scores: np.ndarray, ids: np.ndarray, mask: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best masked entries, score descending then id ascending."""
    where = np.flatnonzero(mask)
    if len(where) > k:
        order = np.lexsort((ids[where], -scores[where]))
        where = where[order[:k]]
    return where


def _floor_positives(anchors: pd.DataFrame, seed: pd.DataFrame, k: int) -> np.ndarray:
    """Per anchor the k-th best score among seed rows of its label, or -inf when the seed holds fewer."""
    out = np.full(len(anchors), -np.inf)
    for d in set(map(len, anchors.q)):
        a_at = np.flatnonzero(anchors.q.map(len).to_numpy() == d)
        s_at = np.flatnonzero(seed.q.map(len).to_numpy() == d) if len(seed) else np.zeros(0, int)
        if len(s_at) == 0:
            continue
        s = _dot(_matrix(anchors.q.iloc[a_at]), _matrix(seed.q.iloc[s_at]))
        labs, ids = seed.lab.to_numpy()[s_at], seed.vec_id.to_numpy()[s_at]
        for row, i in enumerate(a_at):
            fit = (labs == anchors.lab.iat[i]) & (ids != anchors.vec_id.iat[i])
            if fit.sum() >= k:
                out[i] = np.sort(s[row][fit])[-k]
    return out


def _floor_windows(windows: pd.DataFrame, seed: pd.DataFrame, k: int, low: int, high: int) -> np.ndarray:
    """Per (anchor, positive) the lowest score a negative may have: the window's lower bound, raised to the k-th best
    seed score inside the window where the seed fills it; +inf for an empty window."""
    p = windows.positive_score.to_numpy()
    out = np.where(low * p <= high * p, np.ceil(low * p / 100.0), np.inf)
    if len(seed) == 0 or len(windows) == 0:
        return out
    for d in set(map(len, windows.q)):
        w_at = np.flatnonzero(windows.q.map(len).to_numpy() == d)
        s_at = np.flatnonzero(seed.q.map(len).to_numpy() == d)
        if len(s_at) == 0:
            continue
        s = _dot(_matrix(windows.q.iloc[w_at]), _matrix(seed.q.iloc[s_at]))
        labs, ids = seed.lab.to_numpy()[s_at], seed.vec_id.to_numpy()[s_at]
        for row, i in enumerate(w_at):
            sc = s[row]
            fit = (labs != windows.lab.iat[i]) & (ids != windows.anchor_id.iat[i])
            fit &= (low * p[i] <= 100 * sc) & (100 * sc <= high * p[i])
            if fit.sum() >= k:
                out[i] = max(out[i], np.sort(sc[fit])[-k])
    return out


def _meet(kind: str, k: int, low: int, high: int):
    """The task of one (anchor block, row block): pruned scores, best ``k`` per anchor (and positive)."""

    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"anchor_row": [], "positive_id": [], "vec_id": [], "score": []}).astype("int64")
        if len(anchors) == 0 or len(rows) == 0:
            return empty
        a, x = _matrix(anchors.q), _matrix(rows.q)
        floor = anchors.floor.to_numpy(dtype=np.float64)
        lead = np.argsort(-np.abs(a).sum(axis=0), kind="stable")[: max(1, int(a.shape[1] * LEADING))]
        rest = np.setdiff1d(np.arange(a.shape[1]), lead)
        partial = _dot(a[:, lead], x[:, lead]).astype(np.float64)
        bound = partial + np.sqrt((a[:, rest].astype(np.float64) ** 2).sum(1))[:, None] * np.sqrt(
            (x[:, rest].astype(np.float64) ** 2).sum(1)
        )[None, :]
        live = bound + 1e-6 * np.abs(bound) + 1.0 >= floor[:, None]
        cols = np.flatnonzero(live.any(axis=0))
        if len(cols) == 0:
            return empty
        scores = _dot(a, x[cols])
        live = live[:, cols]
        ids, labs = rows.vec_id.to_numpy()[cols], rows.lab.to_numpy()[cols]
        out = []
        for i in range(len(anchors)):
            mask = live[i] & (scores[i] >= floor[i]) & (ids != anchors.anchor_id.iat[i])
            if kind == "positives":
                mask &= labs == anchors.lab.iat[i]
                pick = _best(scores[i], ids, mask, k)
                out.append((anchors._row.iat[i], -1, ids[pick], scores[i][pick]))
            else:
                mask &= labs != anchors.lab.iat[i]
                for entry in anchors.positives.iat[i]:
                    pid, p = entry["positive_id"], entry["positive_score"]
                    fit = mask & (low * p <= 100 * scores[i]) & (100 * scores[i] <= high * p)
                    pick = _best(scores[i], ids, fit, k)
                    out.append((anchors._row.iat[i], pid, ids[pick], scores[i][pick]))
        return pd.DataFrame(
            {
                "anchor_row": np.concatenate([np.full(len(o[2]), o[0], np.int64) for o in out]),
                "positive_id": np.concatenate([np.full(len(o[2]), o[1], np.int64) for o in out]),
                "vec_id": np.concatenate([o[2] for o in out]).astype(np.int64),
                "score": np.concatenate([o[3] for o in out]).astype(np.int64),
            }
        )

    return run


def _scan(anchors: DataFrame, rows: DataFrame, kind: str, k: int, low: int, high: int) -> DataFrame:
    """Best ``k`` per anchor (and positive) over all blocks that can reach the anchors' floors."""
    spark = anchors.sparkSession
    n = anchors.count()
    ablocks = max(1, -(-n // ANCHOR_ROWS))
    anchors = anchors.withColumn("ab", F.pmod(F.xxhash64("anchor_id", "_row"), F.lit(ablocks)))
    astats = anchors.groupBy("ab", "dim").agg(F.max("norm").alias("amax"), F.min("floor").alias("afloor"))
    rstats = rows.groupBy("dim", "band", "salt").agg(F.max("norm").alias("rmax"))
    reach = F.col("amax") * F.col("rmax") + 1.0 >= F.col("afloor")
    pairs = rstats.join(broadcast_checked(astats), "dim").where(reach).select("ab", "dim", "band", "salt")
    pairs = materialize(pairs, f"negatives-pairs-{kind}")
    shipped_rows = rows.join(pairs, ["dim", "band", "salt"]).select("ab", "dim", "band", "salt", "vec_id", "lab", "q")
    shipped_anchors = anchors.join(pairs, ["ab", "dim"])
    cols = ["ab", "dim", "band", "salt", "anchor_id", "_row", "lab", "q", "floor"]
    if kind == "negatives":
        cols += ["positives"]
    schema = "anchor_row long, positive_id long, vec_id long, score long"
    met = (
        shipped_anchors.select(*cols)
        .groupBy("ab", "dim", "band", "salt")
        .cogroup(shipped_rows.groupBy("ab", "dim", "band", "salt"))
        .applyInPandas(_meet(kind, k, low, high), schema)
    )
    return materialize(met, f"negatives-met-{kind}")


def mine(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
    relabel: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for every anchor (rows where
    ``anchor``, an expression over the id column ``vec_id``, holds) and each of its positives."""
    spark = vectors.sparkSession
    rows = _blocks(prepare(vectors, id_col, vec_col, label_col, scale, relabel))
    rows = materialize(rows, "negatives-blocks")
    seed = _seed(rows)
    anchors_df = rows.where(anchor).select(F.col("vec_id").alias("anchor_id"), "lab", "q", "norm", "dim", "_row")

    # Positives: seeded threshold per anchor, then the pruned scan.
    def seeded(batches):
        for a in batches:
            a = a.rename(columns={"anchor_id": "vec_id"})
            floor = _floor_positives(a, seed, positives)
            yield a.rename(columns={"vec_id": "anchor_id"}).assign(floor=np.where(np.isinf(floor), NO_FLOOR, floor))

    anchors = anchors_df.mapInPandas(seeded, StructType([*anchors_df.schema.fields, StructField("floor", DoubleType())]))
    anchors = materialize(anchors, "negatives-anchors")
    found = _scan(anchors, rows, "positives", positives, low, high)
    first = Window.partitionBy("anchor_row").orderBy(F.col("score").desc(), "vec_id")
    pos = found.withColumn("k", F.row_number().over(first)).where(F.col("k") <= positives)
    pos = pos.select("anchor_row", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    pos = materialize(pos, "negatives-positives")

    # Negatives: one window per positive; the anchor's floor is the least of its windows' floors.
    windows = anchors.drop("floor").join(pos, F.col("_row") == F.col("anchor_row")).drop("anchor_row")

    def window_floors(batches):
        for w in batches:
            yield w.assign(wfloor=_floor_windows(w, seed, negatives, low, high))

    windows = windows.mapInPandas(window_floors, StructType([*windows.schema.fields, StructField("wfloor", DoubleType())]))
    windows = windows.where(~F.isnan("wfloor") & (F.col("wfloor") != float("inf")))
    wanted = windows.groupBy("anchor_id", "lab", "q", "norm", "dim", "_row").agg(
        F.min("wfloor").alias("floor"),
        F.array_distinct(F.collect_list(F.struct("positive_id", "positive_score"))).alias("positives"),
    )
    wanted = materialize(wanted, "negatives-windows")
    hits = _scan(wanted, rows, "negatives", negatives, low, high)
    best = Window.partitionBy("anchor_row", "positive_id").orderBy(F.col("score").desc(), "vec_id")
    neg = hits.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= negatives)
    ids = anchors.select(F.col("_row").alias("anchor_row"), "anchor_id")
    return neg.join(pos, ["anchor_row", "positive_id"]).join(ids, "anchor_row").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
