"""Column functions for cleaning text, codes, dates and names."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that stand for "no value", in the order they are removed.
UPLOAD_NULL_TOKENS = ["NULL", "None", "N/A", "''"]
TABLE_NULL_TOKENS = ["null", "NULL", ""]

# Naming rules.
IDENTIFIER = "^[a-z][a-z0-9_]*$"
DATASET_NAME = r"^[a-zA-Z0-9_\.]+$"
ACCOUNTS_DOCUMENT = r"^(Prod\d+_\d+)_([^_]+)_(\d{8})\.(html|xml)"

PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)$"
NUMBER_TYPE = "decimal(38,6)"

# Spellings of a date, tried in order: numbers are month first unless that gives no date.
DATE_FORMATS = [
    "yyyy-M-d", "yyyyMMdd", "yyyy/M/d", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss",
    "d MMMM yyyy", "d MMM yyyy", "d MMMM, yyyy", "MMMM d, yyyy", "MMMM d yyyy", "MMM d, yyyy", "MMM d yyyy",
    "d-MMM-yyyy", "M/d/yyyy", "d/M/yyyy", "M.d.yyyy", "d.M.yyyy", "M-d-yyyy", "d-M-yyyy", "M/d/yy", "d/M/yy",
]


def month_start(code: Column) -> Column:
    """``'201905'`` to the first moment of that month, NULL when it is not a month."""
    return F.try_to_timestamp(code, F.lit("yyyyMM"))


def month_date(code: Column) -> Column:
    return month_start(code).cast("date")


def clean_name(name: Column) -> Column:
    return F.lower(F.trim(name))


def joined_address(*lines: Column) -> Column:
    """Address lines joined by one space; empty lines keep their separator, nothing at all is NULL."""
    return F.nullif(F.lower(F.trim(F.concat_ws(" ", *lines))), F.lit(""))


def clean_postcode(postcode: Column) -> Column:
    return F.upper(F.replace(postcode, F.lit(" "), F.lit("")))


def postcode_key(postcode: Column) -> Column:
    """Spelling-independent form used to look a postcode up."""
    return F.lower(F.replace(postcode, F.lit(" "), F.lit("")))


def split_codes(codes: Column) -> Column:
    """Comma-separated codes to an array: empty items are NULL, an empty text is an empty array."""
    items = F.transform(F.split(codes, ","), lambda item: F.nullif(item, F.lit("")))
    return F.when(codes == "", F.array().cast("array<string>")).otherwise(items)


def row_hash(*columns: str) -> Column:
    """Fingerprint of a row; NULL and the empty text give different fingerprints."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def remove_null_tokens(text: Column, tokens: list[str] = UPLOAD_NULL_TOKENS, whole_cell: bool = False) -> Column:
    """Blank out null tokens: anywhere in the text, or only when they fill the whole cell."""
    if whole_cell:
        return F.when(text.isin(tokens), F.lit("")).otherwise(text)
    return reduce(lambda c, token: F.replace(c, F.lit(token), F.lit("")), tokens, text)


def null_if_token(text: Column, tokens: list[str] = TABLE_NULL_TOKENS) -> Column:
    return F.when(~text.isin(tokens), text)


def is_identifier(name: Column) -> Column:
    return name.rlike(IDENTIFIER)


def is_dataset_name(name: Column) -> Column:
    return name.rlike(DATASET_NAME)


def normalised_name(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit("."), F.lit("_"))


def document_name_parts(name: Column) -> dict[str, Column]:
    """Parts of an accounts document name; all NULL when the name has another shape."""

    def part(i: int) -> Column:
        return F.when(name.rlike(ACCOUNTS_DOCUMENT), F.regexp_extract(name, ACCOUNTS_DOCUMENT, i))

    return {
        "run_code": part(1),
        "company_id": part(2),
        "date": F.try_to_timestamp(part(3), F.lit("yyyyMMdd")).cast("date"),
        "file_type": part(4),
    }


def scaled_number(text: Column, sign: Column, scale: Column, strip_prefix: bool = False) -> Column:
    """A reported number as a decimal: thousands separators dropped, negated by a ``-`` sign, shifted by ``scale``
    digits. Anything but digits, a sign and a point is no number."""
    if strip_prefix:
        text = F.regexp_replace(text, ".*: ", "")
    digits = F.replace(F.trim(text), F.lit(","), F.lit(""))
    shift = F.when(scale.rlike(r"^\s*[+-]?\d{1,4}\s*$"), F.trim(scale)).otherwise(F.lit("0"))
    # The exponent shifts the decimal point, so no digit is lost; what does not fit is NULL.
    number = F.when(digits.rlike(PLAIN_NUMBER), F.concat(digits, F.lit("e"), shift).try_cast(NUMBER_TYPE))
    return F.when(sign == "-", -number).otherwise(number)


def free_date(text: Column, formats: list[str] = DATE_FORMATS) -> Column:
    """First format that fits, as a date. Weekdays and the endings of ordinal numbers are ignored."""
    plain = F.regexp_replace(F.trim(text), r"(?i)^[a-z]+day,?\s+|(?<=\d)(st|nd|rd|th)\b", "")
    tidy = F.initcap(plain)
    # A format is only tried on text of its shape: a failed attempt costs far more than the pattern.
    tries = [F.when(tidy.rlike(date_shape(f)), F.try_to_timestamp(tidy, F.lit(f))) for f in formats]
    return F.coalesce(*tries).cast("date")


def date_shape(date_format: str) -> str:
    """Pattern of the texts that a date format can read."""
    pieces = {"yyyy": r"\d{4}", "yy": r"\d{2}", "MMMM": "[A-Za-z]+", "MMM": "[A-Za-z]{3}", "d": r"\d{1,2}", "M": r"\d{1,2}"}
    parts = []
    for token in (m.group(0) for m in re.finditer(r"'[^']*'|([A-Za-z])\1*|.", date_format)):
        if token.startswith("'"):
            parts.append(re.escape(token.strip("'")))
        elif token[0].isalpha():
            parts.append(pieces.get(token, rf"\d{{{len(token)}}}"))
        else:
            parts.append(re.escape(token))
    return f"(?i)^{''.join(parts)}$"


def strict_bool(text: Column, reverse: bool = False) -> Column:
    """``true`` and ``false`` only; any other spelling is NULL."""
    return F.when(text == "true", F.lit(not reverse)).when(text == "false", F.lit(reverse))


def clean_value(text: Column) -> Column:
    """Reported text on one line without quotes; blank and ``-`` are NULL."""
    tidy = F.regexp_replace(text, r"^\s+|\s+$", "")
    tidy = F.when(~tidy.isin("", "-"), tidy)
    return F.replace(F.replace(tidy, F.lit("\n"), F.lit(" ")), F.lit('"'), F.lit(""))


def joined_allowed(values: Column, allowed: list[str]) -> Column:
    """The allowed values among those of an array, each once, sorted and joined by semicolons."""
    return F.array_join(F.array_sort(F.array_intersect(F.array(*map(F.lit, allowed)), values)), ";")


def name_date(name: Column, pattern: str, date_format: str, group: int = 1) -> Column:
    """Date found in a file name by ``pattern``; month names match in any case.

    Two-digit years from 69 on belong to the last century.
    """
    found = F.nullif(F.regexp_extract(name, pattern, group), F.lit(""))
    date = F.try_to_timestamp(F.initcap(found), F.lit(date_format)).cast("date")
    if date_format.count("y") == 2:
        return F.when(F.year(date) >= 2069, F.add_months(date, -1200)).otherwise(date)
    return date


def dated_name(date: Column, date_format: str, prefix: str = "", suffix: str = "", upper: bool = False) -> Column:
    stamp = F.date_format(date, date_format)
    return F.concat(F.lit(prefix), F.upper(stamp) if upper else stamp, F.lit(suffix))


def camel_case(name: str) -> str:
    first, *rest = name.split("_")
    return first + "".join(word[:1].upper() + word[1:] for word in rest)
