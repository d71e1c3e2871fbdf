"""A Merkle manifest of a document table, addressed by nested intervals of leaf ranks.

Every row is a leaf: the SHA-256 (lowercase hex) of its fields ``doc_id, source, lang, n_chars, text`` in that order,
each written ``-`` when null and else as its UTF-8 byte count, ``:`` and its value (integers in decimal). Per language the
leaves ascend by ``doc_id``; rows with equal ids follow the order of their leaf digests. Runs of ``FAN`` consecutive
nodes (the last run shorter, even of one) become the digest of their digests written one after another, level after level,
until one node remains: the language's subroot (a lone leaf is its own subroot). The subroots, ordered by language (null
first, then UTF-8 bytewise), are folded the same way into the root.

A node of level ``k`` with index ``j`` covers leaf ranks ``[j * FAN**k, (j + 1) * FAN**k)``: the label says which leaves
lie under it, so the ancestors of a leaf are found by arithmetic on its rank and joined level-bucketed (level, run), and
its siblings are the other members of the run it belongs to. No group of leaves is ever held whole: a run holds ``FAN``
nodes at most, and ranks come from a range partitioning with per-partition counts, so a language holding a third of all
rows is spread over as many tasks as its size asks for.

``proof_sha256`` is the digest of all siblings' digests, level by level from the leaf up through the subroot to the root,
left to right within a level. ``folded_root`` recomputes the root from a possibly altered leaf and the original
siblings; ``verified`` says whether it equals the root.

Cases: null fields are ``-``; an empty text is ``0:``; very long texts are hashed whole. Repeated rows are separate
leaves (adjacent, their order among themselves does not change any digest). A null ``doc_id`` sorts first in its
language. An empty table gives no rows. Columns other than the five fields are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType
from pyspark.sql.window import Window

from tradeloom.session import broadcast_checked, materialize

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels a tree may have: FAN ** MOST_LEVELS exceeds any count of rows a table can hold.
MOST_LEVELS = 20
#: Bytes up to which the per-language paths above the subroots are sent to every task.
PATH_BROADCAST_BYTES = 32 << 20


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column | None = None) -> Column:
    """The leaf of a row, with ``text`` in place of the row's own text."""
    text = F.col("text") if text is None else text
    parts = [_field(F.col(c)) for c in FIELDS[:-1]] + [_field(text)]
    return F.sha2(F.concat(*parts), 256)


def tampered(text: Column | None = None, id_col: str = "doc_id") -> Column:
    """The text as a test alters it: A-Z lower-cased where 3 divides the unsigned CRC-32 of the decimal id."""
    text = F.col("text") if text is None else text
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    hit = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 0, F.lit(False))
    return F.when(hit, F.translate(text, upper, lower)).otherwise(text)


def levels(n: str) -> Column:
    """Levels above the leaves of a tree over ``n`` nodes: the least L with FAN**L >= n (0 for one node)."""
    return F.expr(f"aggregate(sequence(0, {MOST_LEVELS}), 0, (acc, k) -> acc + IF(`{n}` > shiftleft(1L, k * 3), 1, 0))")


def ranked(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``df`` with ``idx``, the 0-based rank of a row inside its ``group`` by ``order``, and ``n``, the group's size.

    Rows are range-partitioned by (group, order) and sorted inside partitions; each partition counts its rows per group,
    and the offsets of a group in later partitions are sums over that small table (one row per partition and group in
    it), so no task holds a whole group.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = [F.col(group).asc_nulls_first(), *order]
    placed = (
        df.repartitionByRange(parts, *key)
        .sortWithinPartitions(*key)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    )
    placed = materialize(placed, "merkle-placed")
    counts = placed.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_count"), F.min("_pos").alias("_start"))
    before = F.sum("_count").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    whole = F.sum("_count").over(Window.partitionBy(group))
    counts = counts.select(
        F.col("_part").alias("_p"), F.col(group).alias("_g"), F.coalesce(before, F.lit(0)).alias("_offset"),
        "_start", whole.alias("n"),
    )
    joined = placed.join(
        broadcast_checked(counts), (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g"))
    )
    return joined.withColumn("idx", F.col("_offset") + F.col("_pos") - F.col("_start")).drop(
        "_part", "_pos", "_p", "_g", "_offset", "_start"
    )


def build(nodes: DataFrame, group: str, carry: str | None = None) -> tuple[DataFrame, DataFrame, int]:
    """Fold ranked nodes ``(group, n, idx, h)`` per group. Returns the tops ``(group, h)``, every run
    ``(group, lvl, run, kids, tkids)`` (``kids`` the digests of the run's members in order; ``tkids``, in runs of
    leaves only, the column ``carry`` of the members) and the number of levels."""
    spark = nodes.sparkSession
    most = nodes.agg(F.max("n")).first()[0] or 0
    current = nodes.select(group, "n", "idx", "h", F.col(carry if carry else "h").alias("t"))
    tops, runs, k = [current.where(F.col("n") <= 1).select(group, "h")], [], 0
    while most > FAN**k:
        active = current.where(F.col("n") > FAN**k)
        member = F.struct("idx", "h", "t") if k == 0 and carry else F.struct("idx", "h")
        run = (
            active.groupBy(group, "n", F.shiftright("idx", 3).alias("run"))
            .agg(F.array_sort(F.collect_list(member)).alias("kids"))
            .select(
                group, "n", F.lit(k).alias("lvl"), "run", F.transform("kids", lambda x: x["h"]).alias("kids"),
                (F.transform("kids", lambda x: x["t"]) if k == 0 and carry else F.lit(None).cast("array<string>")).alias("tkids"),
            )
        )
        run = materialize(run, f"merkle-runs-{k}")
        runs.append(run.select(group, "lvl", "run", "kids", "tkids"))
        k += 1
        current = run.select(group, "n", F.col("run").alias("idx"), F.sha2(F.array_join("kids", ""), 256).alias("h"))
        current = current.withColumn("t", F.col("h"))
        tops.append(current.where(F.col("n") <= FAN**k).select(group, "h"))
    kinds = nodes.select(group).schema.add("lvl", IntegerType()).add("run", LongType()).add("kids", ArrayType(StringType()))
    empty = spark.createDataFrame([], kinds.add("tkids", ArrayType(StringType())))
    all_runs = runs[0] if runs else empty
    for r in runs[1:]:
        all_runs = all_runs.unionByName(r)
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    return top.select(group, "h"), all_runs, k


def _sides(path: DataFrame, runs: DataFrame, group: str, key: list[str], step: int) -> DataFrame:
    """For each row of ``path`` ``(key..., group, n, idx)``: the members left and right of its ancestor at each level,
    as ``(key..., sides)`` with ``sides`` an array of ``(step, left, right)`` from the bottom up."""
    climbs = path.where(levels("n") > 0).select(
        *key, group, "idx", F.explode(F.sequence(F.lit(0), levels("n") - 1)).alias("lvl")
    )
    climbs = climbs.withColumn("run", F.expr("shiftright(idx, lvl * 3 + 3)")).withColumn(
        "pos", F.expr(f"cast(shiftright(idx, lvl * 3) & {FAN - 1} as int)")
    )
    r = runs.select(F.col(group).alias("_g"), F.col("lvl").alias("_lvl"), F.col("run").alias("_run"), "kids")
    met = climbs.join(
        r, F.col(group).eqNullSafe(F.col("_g")) & (F.col("lvl") == F.col("_lvl")) & (F.col("run") == F.col("_run"))
    )
    side = F.struct(
        (F.col("lvl") + step).alias("step"),
        F.array_join(F.slice("kids", 1, F.col("pos")), "").alias("left"),
        F.array_join(F.slice("kids", F.col("pos") + 2, FAN), "").alias("right"),
    )
    return met.groupBy(*key).agg(F.array_sort(F.collect_list(side)).alias("sides"))


SIDES = "array<struct<left:string,right:string>>"


def _side(p: Column) -> Column:
    """The members of a run left and right of member ``p``, each written one after another."""
    left = F.array_join(F.slice("kids", F.lit(1), p), "")
    right = F.array_join(F.slice("kids", p + 2, F.lit(FAN)), "")
    return F.struct(left.alias("left"), right.alias("right"))


def _down(runs: DataFrame, group: str, depth: int) -> DataFrame | None:
    """``(group, node, up)`` for every node of level 1: the sides of the node and of each ancestor below the top,
    bottom-up. Built from the top down, one level at a time: a run's path is joined once and handed to its
    members, so a path travels once per run rather than once per leaf."""
    paths = None
    for k in range(depth - 1, 0, -1):
        level = runs.where(F.col("lvl") == k).select(group, "run", "kids")
        if paths is None:
            up = F.array().cast(SIDES)
        else:
            above = paths.select(F.col(group).alias("_g"), F.col("node").alias("_node"), "up")
            cond = F.col(group).eqNullSafe(F.col("_g")) & (F.col("run") == F.col("_node"))
            level = level.join(above, cond, "left").drop("_g", "_node")
            up = F.coalesce(F.col("up"), F.array().cast(SIDES))
        members = F.transform(
            F.sequence(F.lit(0), F.size("kids") - 1),
            lambda p: F.struct((F.col("run") * FAN + p).alias("node"), F.concat(F.array(_side(p)), up).alias("up")),
        )
        paths = level.select(group, F.explode(members).alias("m")).select(group, "m.node", "m.up")
        paths = materialize(paths, f"merkle-down-{k}")
    return paths


def _fold(start: Column, sides: Column) -> Column:
    return F.aggregate(sides, start, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def _joined(sides: Column) -> Column:
    return F.array_join(F.transform(sides, lambda s: F.concat(s["left"], s["right"])), "")


def _with_path(leaves: DataFrame, path: DataFrame, n_langs: int, by: str = "idx") -> DataFrame:
    """Each leaf with the path of its language above the subroot. The path table has one row per language, of at most
    ``levels * (FAN - 1)`` digests; it is broadcast when that bound times the number of languages is small, and else
    joined with the leaves salted, so that a language holding most rows is still read by many tasks."""
    depth = 1
    while FAN**depth < n_langs:
        depth += 1
    if n_langs * (100 + 65 * (FAN - 1) * depth) <= PATH_BROADCAST_BYTES:
        return leaves.join(F.broadcast(path), F.col("lang").eqNullSafe(F.col("_lang")))
    salts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = leaves.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)))
    spread = path.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    cond = F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("_salt") == F.col("_s"))
    return salted.join(spread, cond).drop("_salt", "_s")


def manifest(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and the root folded from the altered leaf (``altered``: the text
    to hash instead, by default :func:`tampered`) with the original siblings.

    Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` (extra columns of ``docs`` are dropped).
    """
    spark = docs.sparkSession
    rows = docs.select(*FIELDS)
    # Texts are hashed where they are read: only digests travel through the shuffles.
    rows = rows.select(
        "doc_id", "lang", leaf_digest().alias("leaf"),
        leaf_digest(tampered() if altered is None else altered).alias("tleaf"),
    )
    leaves = ranked(rows, "lang", [F.col("doc_id").asc_nulls_first(), F.col("leaf")])
    leaves = materialize(leaves.select("doc_id", "lang", "n", "idx", "leaf", "tleaf"), "merkle-leaves")
    subroots, runs, depth = build(leaves.withColumnRenamed("leaf", "h"), "lang", carry="tleaf")
    subroots = materialize(subroots, "merkle-subroots")

    langs = ranked(subroots.withColumn("_all", F.lit(0)), "_all", [F.col("lang").asc_nulls_first()])
    langs = materialize(langs.select("_all", "lang", "n", "idx", "h"), "merkle-langs")
    tops, lang_runs, _ = build(langs, "_all")
    root = tops.first()
    if root is None:
        schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return spark.createDataFrame([], schema)
    upper = _sides(langs, lang_runs, "_all", ["lang"], 1 << 20).withColumnRenamed("sides", "upper")
    path = langs.select(F.col("lang").alias("_lang"), F.col("h").alias("subroot")).join(
        upper.withColumnRenamed("lang", "_l"), F.col("_lang").eqNullSafe(F.col("_l")), "left"
    )
    plain = F.transform("upper", lambda x: F.struct(x["left"].alias("left"), x["right"].alias("right")))
    path = path.select("_lang", "subroot", F.coalesce(plain, F.array().cast(SIDES)).alias("upper"))
    n_langs = langs.count()

    # Runs of leaves with the path above them; each member's proof and fold are taken inside its run.
    firsts = runs.where(F.col("lvl") == 0).select("lang", "run", "kids", "tkids")
    down = _down(runs, "lang", depth)
    if down is not None:
        above = down.select(F.col("lang").alias("_g"), F.col("node").alias("_node"), "up")
        cond = F.col("lang").eqNullSafe(F.col("_g")) & (F.col("run") == F.col("_node"))
        firsts = firsts.join(above, cond, "left").drop("_g", "_node")
        up = F.coalesce(F.col("up"), F.array().cast(SIDES))
    else:
        up = F.array().cast(SIDES)
    firsts = _with_path(firsts.withColumn("up", up), path, n_langs, by="run")

    def member(p: Column) -> Column:
        chain = F.concat(F.array(_side(p)), F.col("up"), F.col("upper"))
        return F.struct(
            (F.col("run") * FAN + p).alias("idx"),
            F.sha2(_joined(chain), 256).alias("proof_sha256"),
            _fold(F.col("tkids")[p], chain).alias("folded_root"),
        )

    members = F.transform(F.sequence(F.lit(0), F.size("kids") - 1), member)
    proved = firsts.select("lang", "subroot", F.explode(members).alias("m")).select("lang", "subroot", "m.*")
    # A language of one document: its leaf is its subroot, the path starts above it.
    alone = _with_path(leaves.where(F.col("n") == 1), path, n_langs).select(
        "lang", "subroot", "idx", F.sha2(_joined(F.col("upper")), 256).alias("proof_sha256"),
        _fold(F.col("tleaf"), F.col("upper")).alias("folded_root"),
    )
    proved = proved.unionByName(alone).withColumnRenamed("lang", "_l2").withColumnRenamed("idx", "_i2")
    each = leaves.join(proved, F.col("lang").eqNullSafe(F.col("_l2")) & (F.col("idx") == F.col("_i2")))
    return each.select(
        "doc_id", "leaf", "subroot", F.lit(root["h"]).alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == F.lit(root["h"])).alias("verified"),
    )
