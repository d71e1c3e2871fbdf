"""URL rules by a sort-merge range join.

A rule (host, path) covers its host and all subdomains, for paths that start with the rule's. Hosts are reversed label
by label, so a host and a path give one canonical key, ``com.example/en/``, and a rule covers the interval of keys that
begin with its own. A URL probes with one key for its host and one for each parent domain (there are as many as labels).
Rules and probes are dealt out by ranges of the key and sorted; a sweep keeps the stack of intervals that are open at
the current key. Intervals are nested or disjoint, so the top of the stack is the longest rule of that host. The
longest over the probes of a page wins (ties: the longer host).

Range borders come from a bounded sample of the pages; they only spread the work. Equal (host, path) are judged once,
so one hot page is one probe, and a hot host spreads by its paths. A rule goes to every range that its interval meets.

Cases: a null URL, or one without ``://``, has an empty host and path and meets no rule. Without rules every page gets
the default. Equal rules: the smallest verdict in alphabetical order. Repeated pages are judged row by row; columns
other than the id and the URL are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pages sampled (about) for the borders of the ranges.
BORDER_SAMPLE = 5_000

#: Between host and path in a key, below every character of a host; and above every key with a given beginning.
SPLIT, LAST = "\x00", "\U0010ffff"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit(SPLIT), path)


PROBE = "part int, key string, probe boolean, host string, path string, rule string, verdict string"
FOUND = "host string, path string, rule string, verdict string, rank long"


def _deal(borders: list[str], probe: bool):
    """Give each probe the range of its key, and each rule every range that its interval meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.to_pydict()
            take, parts = [], []
            for i, key in enumerate(col["key"]):
                low = bisect_right(borders, key)
                high = low if probe else bisect_right(borders, key + LAST)
                take.extend([i] * (high - low + 1))
                parts.extend(range(low, high + 1))
            names = ["host", "path", "rule", "verdict"]
            rest = [[col[n][i] for i in take] if n in col else [None] * len(take) for n in names]
            arrays = [pa.array(parts, pa.int32()), pa.array([col["key"][i] for i in take], pa.string())]
            arrays += [pa.array([probe] * len(take), pa.bool_()), *(pa.array(x, pa.string()) for x in rest)]
            yield pa.RecordBatch.from_arrays(arrays, names=["part", "key", "probe", *names])

    return run


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole ranges, sorted by range and key, rules before probes; a row for each probe inside an interval."""
    stack: list[tuple[str, str, str]] = []
    at = None
    for batch in batches:
        col = batch.to_pydict()
        out: list[tuple] = []
        for part, key, probe, host, path, rule, verdict in zip(*(col[n] for n in batch.schema.names)):
            if part != at:
                stack, at = [], part
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not probe:
                stack.append((key, rule, verdict))
            elif stack:
                top, rule, verdict = stack[-1]
                out.append((host, path, rule, verdict, (len(rule) << 20) + top.index(SPLIT)))
        types = [pa.string()] * 4 + [pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 5, types)],
            names=["host", "path", "rule", "verdict", "rank"],
        )


def judge(
    pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page; ``rules`` has host, path and verdict."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))

    def probes_of(rows: DataFrame) -> DataFrame:
        spread = rows.select("host", "path", _reversed_labels(F.col("host")).alias("labels"))
        spread = spread.select("*", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("n"))
        return spread.select(_key(F.slice("labels", F.lit(1), F.col("n")), F.col("path")).alias("key"), "host", "path")

    named = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .groupBy(F.translate("host", UPPER, LOWER).alias("host"), "path")
        .agg(F.min("verdict").alias("verdict"))
        .select(_key(_reversed_labels(F.col("host")), F.col("path")).alias("key"), F.concat("host", "path").alias("rule"), "verdict")
    )
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    share = min(1.0, BORDER_SAMPLE / max(1, pages.count()))
    sample = sorted({r.key for r in probes_of(parsed.sample(share, seed=1)).select("key").collect()})
    borders = sorted({sample[len(sample) * k // ranges] for k in range(1, ranges)}) if sample else []
    dealt = (
        probes_of(parsed.select("host", "path").distinct())
        .mapInArrow(_deal(borders, True), PROBE)
        .unionByName(named.mapInArrow(_deal(borders, False), PROBE))
    )
    found = (
        dealt.repartition(ranges, "part")
        .sortWithinPartitions("part", "key", "probe")
        .mapInArrow(_sweep, FOUND)
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "verdict"), "rank").alias("best"))
    )
    return parsed.join(found, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
