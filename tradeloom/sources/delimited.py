"""Delimited files: read by position against a declared schema, or by name against a model."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tradeloom.functions.charset import from_latin
from tradeloom.functions.text import TABLE_NULL_TOKENS, null_if_token
from tradeloom.session import broadcast_checked, materialize

LATIN = "ISO-8859-1"


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: str,
    sep: str = ",",
    quote: str = '"',
    header: bool = True,
    charset: str = "UTF-8",
) -> DataFrame:
    """Columns by position, whatever the header calls them; a value of the wrong type fails the read.

    Single-byte charsets the reader does not know are read as ISO-8859-1 and translated.
    """
    direct = charset.upper() in ("UTF-8", LATIN)
    rows = (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", True)
        .option("sep", sep)
        .option("quote", quote)
        .option("escape", quote)
        .option("ignoreLeadingWhiteSpace", True)
        .option("timestampFormat", "yyyy-M-d H:mm:ss[.SSSSSS]")
        .option("dateFormat", "yyyy-M-d")
        .option("encoding", charset if direct else LATIN)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    if direct:
        return rows
    texts = {f.name: from_latin(F.col(f.name), charset) for f in rows.schema if f.dataType == T.StringType()}
    return rows.withColumns(texts)


def read_without_empty_quotes(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """Quoted-empty cells are NULL and quotes inside a cell are dropped."""
    rows = read_delimited(spark, path, schema, **options)
    texts = {
        f.name: F.nullif(F.replace(F.col(f.name), F.lit('"'), F.lit("")), F.lit(""))
        for f in rows.schema
        if f.dataType == T.StringType()
    }
    return rows.withColumns(texts)


def read_by_name(
    spark: SparkSession,
    path: str,
    schema: str,
    header_map: dict[str, str] | None = None,
    null_tokens: list[str] = TABLE_NULL_TOKENS,
) -> DataFrame:
    """Columns by header name; null tokens fill a whole cell; unknown headers, rows of another length than the header
    and bad values are errors."""
    reader = spark.read.option("header", True).option("escape", '"').option("nullValue", "\u0000")
    # Without pruning the reader sees every cell, and so every row that is too long or too short.
    texts = reader.option("mode", "FAILFAST").option("columnPruning", False).csv(path)
    struct = T.StructType.fromDDL(schema)
    if header_map is not None:
        missing = [c for c in texts.columns if c not in header_map]
        if missing:
            raise KeyError(f"headers without a column: {', '.join(missing)}")
        texts = texts.withColumnsRenamed(header_map)
    unknown = [c for c in texts.columns if c not in struct.fieldNames()]
    if unknown:
        raise KeyError(f"unknown columns: {', '.join(unknown)}")
    cells = [
        model_cell(F.col(f.name) if f.name in texts.columns else F.lit(None).cast("string"), f.dataType, null_tokens)
        for f in struct
    ]
    return texts.select([cell.alias(f.name) for cell, f in zip(cells, struct)])


def model_cell(text, dtype: T.DataType, null_tokens: list[str] = TABLE_NULL_TOKENS):
    value = null_if_token(text, null_tokens)
    if isinstance(dtype, T.TimestampType):
        return F.to_timestamp(value, "yyyy-M-d H:mm:ss")
    return value.cast(dtype)


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, line_number, line)``: lines numbered from 1 within each file.

    Blocks of a file are counted separately and their starts summed up, so a large file is still read by
    many tasks. The lines are not sorted.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
    )
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("position").alias("first"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = blocks.select(
        "file", "block", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) + 1 - F.col("first")).alias("shift")
    )
    return lines.join(broadcast_checked(materialize(starts, "block-starts")), ["file", "block"]).select(
        "file", "block", (F.col("position") + F.col("shift")).alias("line_number"), "line"
    )


def cell_count(line, sep: str = ",", quote: str = '"'):
    """Number of cells of a line: separators outside quotes plus one."""
    mark = re.escape(quote)
    bare = F.regexp_replace(line, f"{mark}[^{mark}]*{mark}", "")
    without = F.length(F.replace(bare, F.lit(sep), F.lit("")))
    return ((F.length(bare) - without) / len(sep)).cast("int") + 1


def ragged_rows(lines: DataFrame, n_columns: int, sep: str = ",", quote: str = '"', line: str = "line") -> DataFrame:
    """Lines whose number of cells differs from the header's, with both numbers."""
    return (
        lines.withColumn("n_cells", cell_count(F.col(line), sep, quote))
        .where(F.col("n_cells") != n_columns)
        .withColumn("n_headers", F.lit(n_columns))
    )


def files_matching(names: DataFrame, pattern: str, column: str = "path", ignored: tuple[str, ...] = ("[Content_Types].xml",)) -> DataFrame:
    """Discovered files whose name fits ``pattern``; names of packaging entries are left out."""
    base = F.element_at(F.split(F.col(column), "/"), -1)
    return names.where(F.col(column).rlike(pattern) & ~base.isin(*ignored))


def discover(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``(path, modified, length)`` of the files below a folder; their content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(folder)
        .select("path", F.col("modificationTime").alias("modified"), "length")
    )
