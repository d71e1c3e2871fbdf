"""Archives: one task opens one archive and streams its lines or documents; all parsing is left to Spark."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Lines, and bytes of documents, handed to Spark at a time.
BATCH_LINES = 20_000
BATCH_BYTES = 4 << 20


def members(content: bytes) -> Iterator[tuple[str, Callable[[], io.BufferedIOBase]]]:
    """All files of an archive and of the archives inside it, to any depth."""
    archive = zipfile.ZipFile(io.BytesIO(content))
    for name in archive.namelist():
        if name.lower().endswith(".zip"):
            for inner, opened in members(archive.read(name)):
                yield f"{name}/{inner}", opened
        elif not name.endswith("/"):
            yield name, lambda n=name: archive.open(n)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    )


def archive_lines(spark: SparkSession, path: str, charset: str = "utf-8", wanted: str | None = None) -> DataFrame:
    """``(file, member, line)`` for every text line of every archive under ``path``."""
    return lines_of(_archives(spark, path), charset, wanted)


def lines_of(archives: DataFrame, charset: str = "utf-8", wanted: str | None = None) -> DataFrame:
    """The lines of archives given as ``(file, content)``.

    With ``wanted`` only members whose path matches are opened, and an archive without one fails the read.
    """

    def chosen(file: str, content: bytes):
        found = [(m, opened) for m, opened in members(content) if wanted is None or re.search(wanted, m)]
        if wanted is not None and not found:
            raise FileNotFoundError(f"no file in {file} matches {wanted}")
        return found

    def read(batches):
        names = ["file", "member", "line"]
        for batch in batches:
            lines: list[tuple[str, str, str]] = []
            for file, content in zip(batch["file"], batch["content"]):
                for member, opened in chosen(file, content):
                    with opened() as handle:
                        for line in io.TextIOWrapper(handle, encoding=charset, newline=None):
                            lines.append((file, member, line.rstrip("\n")))
                            if len(lines) == BATCH_LINES:
                                yield pd.DataFrame(lines, columns=names)
                                lines = []
            yield pd.DataFrame(lines, columns=names).astype(str)

    lines = archives.select("file", "content").mapInPandas(read, "file string, member string, line string")
    # One task unpacks an archive; what follows is spread over all of them.
    return lines.hint("rebalance")


def archive_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(file, document, content)`` for every file inside the archives under ``path``, spread over all tasks."""
    return documents_of(_archives(spark, path))


def documents_of(archives: DataFrame) -> DataFrame:
    """The files inside archives given as ``(file, content)``."""

    def batch_of(rows: list[tuple[str, str, bytes]]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * 3
        types = [pa.string(), pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["file", "document", "content"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, str, bytes]] = []
            size = 0
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for member, opened in members(content):
                    with opened() as handle:
                        rows.append((file, member.rsplit("/", 1)[-1], handle.read()))
                    size += len(rows[-1][2])
                    if size > BATCH_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
            yield batch_of(rows)

    documents = archives.select("file", "content").mapInArrow(read, "file string, document string, content binary")
    return documents.repartition("file", "document")


def tab_fields(lines: DataFrame, names: list[str], rest: str, sep: str = "\t", line: str = "line") -> DataFrame:
    """Split lines into named leading fields and the non-empty remaining ones joined by commas.

    A line without a remaining field is dropped; quotes are removed; an empty field stays an empty text.
    """
    parts = F.split(F.col(line), sep, -1)
    split = lines.withColumn("_parts", parts).where(F.size("_parts") > len(names))
    bare = lambda c: F.replace(c, F.lit('"'), F.lit(""))
    tail = F.filter(F.slice("_parts", len(names) + 1, F.size("_parts")), lambda v: v != "")
    return split.select(
        "*",
        *[bare(F.col("_parts")[i]).alias(n) for i, n in enumerate(names)],
        bare(F.array_join(tail, ",")).alias(rest),
    ).drop("_parts", line)


def member_date(member: Column, pattern: str, date_format: str) -> Column:
    """Date named in a member's path, NULL when the member is not the wanted one."""
    found = F.regexp_extract(member, pattern, 1)
    return F.when(member.rlike(pattern), F.try_to_timestamp(F.initcap(found), F.lit(date_format)).cast("date"))

