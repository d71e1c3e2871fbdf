"""User uploads: check the header, profile the columns, infer types, load strictly."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.functions.charset import from_latin
from tradeloom.functions.text import IDENTIFIER, remove_null_tokens
from tradeloom.sources.delimited import LATIN, cell_count, file_lines, ragged_rows
from tradeloom.spec import RESERVED_COLUMNS, UPLOAD_TYPES

SAMPLE_ROWS = 4

# Spellings of each type, tried in this order; text fits everything.
TYPE_PATTERNS = {
    "integer": r"^[+-]?\d+$",
    "boolean": r"^(true|True|TRUE|false|False|FALSE)$",
    "date": r"^\d{4}-\d{2}-\d{2}$",
    "timestamp": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$",
    "numeric": r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$",
}


class UploadError(ValueError):
    """What is wrong with an uploaded file, in words for the user."""


def unique_headers(headers: list[str]) -> list[str]:
    """Number repeated headers until all differ."""
    while True:
        repeats = Counter(headers)
        if len(repeats) == len(headers):
            return headers
        seen: Counter[str] = Counter()
        numbered = []
        for name in headers:
            seen[name] += 1
            numbered.append(f"{name}_{seen[name]}" if repeats[name] > 1 else name)
        headers = numbered


def check_headers(headers: list[str]) -> None:
    if not any(headers):
        raise UploadError("no headers found: the first row of the file has to name the columns")
    invalid = [h for h in headers if h and not re.match(IDENTIFIER, h)]
    if invalid:
        raise UploadError(
            "a column name is a lowercase letter followed by lowercase letters, digits or underscores; "
            f"not valid: {', '.join(f'\"{h}\"' for h in invalid)}"
        )


def inspect_lines(spark: SparkSession, path: str, quote: str = '"') -> tuple[bool, bool]:
    """Whether a quoted cell may contain line breaks (a line with an odd number of quotes), and whether the file is
    UTF-8; both from one pass over all lines."""
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit(quote), F.lit("")))
    row = spark.read.text(path).agg(F.bool_or(quotes % 2 == 1).alias("odd"), F.bool_and(F.is_valid_utf8(value)).alias("utf8")).first()
    return bool(row.odd), row.utf8 is not False


def read_header(spark: SparkSession, path: str, sep: str = ",", quote: str = '"') -> list[str]:
    first = spark.read.option("sep", sep).option("quote", quote).option("escape", quote).csv(path).limit(1).collect()
    return [] if not first else [(cell or "").strip() for cell in first[0]]


def first_ragged(spark: SparkSession, path: str, n_columns: int, sep: str, quote: str, multi_line: bool):
    """``(line_number, n_cells)`` of the first row whose number of cells differs from the header's, or ``None``.

    A row with line breaks inside quotes only exists for the reader, so such files are numbered by record.
    """
    if multi_line:
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(n_columns)])
        reader = _reader(spark, schema.add("_broken", T.StringType()), sep, quote, multi_line)
        records = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").csv(path)
        numbered = records.select("*", (F.monotonically_increasing_id() + 2).alias("line_number"))
        # Every column stays in the result: a pruned column would not be parsed, and its absence not noticed.
        bad = numbered.where("_broken is not null")
        return bad.withColumn("n_cells", cell_count(F.col("_broken"), sep, quote)).orderBy("line_number").first()
    lines = spark.read.text(path).where("value <> ''").withColumnRenamed("value", "line")
    if ragged_rows(lines, n_columns, sep, quote).isEmpty():
        return None
    numbered = file_lines(spark, path).where("line <> ''")
    return ragged_rows(numbered, n_columns, sep, quote).orderBy("line_number").first()


def _reader(spark: SparkSession, schema: T.StructType, sep: str, quote: str, multi_line: bool, direct: bool = True):
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("encoding", "UTF-8" if direct else LATIN)
        .option("sep", sep)
        .option("quote", quote)
        .option("escape", quote)
        .option("emptyValue", "")
        .option("multiLine", multi_line)
    )


def read_upload(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    quote: str = '"',
    whole_cell: bool = False,
    multi_line: bool | None = None,
    encoding: str | None = None,
) -> DataFrame:
    """Checked text columns of an upload: ragged rows fail, null tokens are blank, unnamed columns are ignored.

    Unless they are given, the file itself tells whether quoted cells contain line breaks (each such file is then read
    by one task) and whether it is UTF-8; if it isn't, it is taken for Windows-1252.
    """
    odd, utf8 = inspect_lines(spark, path, quote)
    multi_line = odd if multi_line is None else multi_line
    charset = encoding or ("UTF-8" if utf8 else "cp1252")
    direct = charset.upper() in ("UTF-8", "UTF8", "ASCII")
    headers = read_header(spark, path, sep, quote)
    check_headers(headers)
    bad = first_ragged(spark, path, len(headers), sep, quote, multi_line)
    if bad is not None:
        raise UploadError(
            f"row {bad.line_number} has {bad.n_cells} cells, but the header has {len(headers)}"
        )
    names = unique_headers([h or f"unnamed{i}" for i, h in enumerate(headers)])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = _reader(spark, schema, sep, quote, multi_line, direct).option("mode", "FAILFAST").csv(path)
    if not direct and charset.upper() != LATIN:
        rows = rows.select([from_latin(F.col(n), charset).alias(n) for n in names])
    kept = [n for n, h in zip(names, headers) if h]
    blank = lambda c: remove_null_tokens(F.coalesce(F.col(c), F.lit("")), whole_cell=whole_cell)
    return rows.select([blank(c).alias(c) for c in kept])


# One bit per type; an integer is also a numeric, so a column of both is numeric.
TYPE_BITS = {name: 1 << i for i, name in enumerate(TYPE_PATTERNS)}


def fitting_types(text: Column) -> Column:
    """Bits of the types a text fits. Patterns are tried in order and at most one is evaluated in full;
    dates must exist in the calendar."""
    day_exists = F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")).isNotNull()
    bits = F.lit(0)
    for name in reversed(TYPE_PATTERNS):
        fits = text.rlike(TYPE_PATTERNS[name])
        if name in ("date", "timestamp"):
            fits = fits & day_exists
        value = TYPE_BITS[name] | (TYPE_BITS["numeric"] if name == "integer" else 0)
        bits = F.when(fits, F.lit(value)).otherwise(bits)
    return F.when(text.isNotNull(), bits)


def infer_types(rows: DataFrame) -> DataFrame:
    """``(position, column, type)``: the first type that every non-blank value fits, in one aggregation."""
    texts = rows.select([F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).alias(c) for c in rows.columns])
    common = texts.select([fitting_types(F.col(c)).alias(c) for c in rows.columns]).agg(
        *[F.bit_and(c).alias(c) for c in rows.columns]
    )

    def choose(c: str) -> Column:
        chosen = F.lit("text")
        for name in reversed(TYPE_PATTERNS):
            chosen = F.when(F.col(c).bitwiseAND(TYPE_BITS[name]) != 0, F.lit(name)).otherwise(chosen)
        return chosen

    described = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), choose(c).alias("type"))
            for i, c in enumerate(rows.columns, 1)
        ]
    )
    return common.select(F.inline(described))


def sample_values(rows: DataFrame, n: int = SAMPLE_ROWS, order_by: str | None = None) -> DataFrame:
    """``(column, samples)``: the first ``n`` values of every column."""
    first = (rows.orderBy(order_by) if order_by else rows).limit(n)
    placed = first.withColumn("_at", F.col(order_by) if order_by else F.monotonically_increasing_id())
    packed = placed.agg(
        *[
            F.transform(
                F.array_sort(F.collect_list(F.struct("_at", F.col(c).cast("string").alias("v")))),
                lambda s: s["v"],
            ).alias(c)
            for c in rows.columns
        ]
    )
    described = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("samples")) for c in rows.columns])
    return packed.select(F.inline(described))


def profile(rows: DataFrame, order_by: str | None = None) -> DataFrame:
    """``(column, type, samples)`` of an upload, types from all of its rows."""
    return (
        infer_types(rows)
        .join(sample_values(rows, order_by=order_by), "column")
        .select("column", "type", "samples")
    )


def profile_upload(spark: SparkSession, path: str, sep: str = ",", quote: str = '"', **options) -> DataFrame:
    rows = read_upload(spark, path, sep, quote, **options)
    if rows.isEmpty():
        raise UploadError("no data found below the header")
    return profile(rows)


def apply_types(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """Load with the confirmed types; a value that does not fit fails the load, a blank is NULL."""
    return rows.select(
        [F.nullif(F.col(c), F.lit("")).cast(UPLOAD_TYPES[types[c]]).alias(c) for c in rows.columns]
    )


def names_missing(latest: Column, uploaded: Column) -> Column:
    """Sorted names of the latest version that an upload lacks, from arrays of names."""
    return F.array_sort(F.array_except(latest, uploaded))


def names_reserved(uploaded: Column) -> Column:
    """Names in an upload that are reserved."""
    return F.array_intersect(uploaded, F.array(*map(F.lit, RESERVED_COLUMNS)))


def missing_columns(latest: list[str], uploaded: list[str]) -> list[str]:
    """Columns of the latest version that the upload lacks."""
    return sorted(set(latest) - set(uploaded))


def reserved_columns(uploaded: list[str]) -> list[str]:
    return [c for c in uploaded if c in RESERVED_COLUMNS]
