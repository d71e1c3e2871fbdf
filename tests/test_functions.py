import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradeloom.functions import charset
from tradeloom.functions import text as X
from tradeloom.sources.delimited import cell_count


def one(spark, column, value=None, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(column).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2020-03-31", dt.date(2020, 3, 31)),
        ("2020-3-1", dt.date(2020, 3, 1)),
        ("20200331", dt.date(2020, 3, 31)),
        ("31 March 2020", dt.date(2020, 3, 31)),
        ("31 MAR 2020", dt.date(2020, 3, 31)),
        ("31st march 2020", dt.date(2020, 3, 31)),
        ("Tuesday, 31 March 2020", dt.date(2020, 3, 31)),
        ("March 31, 2020", dt.date(2020, 3, 31)),
        ("03/04/2020", dt.date(2020, 3, 4)),
        ("31/03/2020", dt.date(2020, 3, 31)),
        ("31.03.2020", dt.date(2020, 3, 31)),
        ("31/03/20", dt.date(2020, 3, 31)),
        ("2020-03-31T10:00:00", dt.date(2020, 3, 31)),
        ("no date", None),
        ("2020-02-30", None),
    ],
)
def test_free_dates(spark, text, expected):
    assert one(spark, X.free_date(F.col("x")), text) == expected


@pytest.mark.parametrize(
    "text, sign, scale, expected",
    [
        ("1,234", None, None, "1234"), ("1.5", "-", "3", "-1500"), ("-2", "-", "0", "2"), (" 7 ", None, "-1", "0.7"),
        ("(5)", None, None, None), ("5d", None, None, None), ("NaN", None, None, None), ("1e3", None, None, None),
        ("1", None, "40", None), ("12345678901234567890.25", None, "3", "12345678901234567890250"), ("7", None, "x", "7"),
    ],
)
def test_scaled_numbers(spark, text, sign, scale, expected):
    df = spark.createDataFrame([(text, sign, scale)], "t string, s string, k string")
    got = df.select(X.scaled_number(F.col("t"), F.col("s"), F.col("k"))).first()[0]
    assert got == (None if expected is None else Decimal(expected))


def test_code_lists(spark):
    split = X.split_codes(F.col("x"))
    assert one(spark, split, "") == []
    assert one(spark, split, "1,,2") == ["1", None, "2"]
    assert one(spark, split, None) is None


@pytest.mark.parametrize("name", ["cp1252", "mac-roman", "iso-8859-15"])
def test_charsets_go_both_ways(spark, name):
    raw = bytes(b for b in range(0x20, 0x100) if bytes([b]).decode(name, errors="ignore"))
    meant = raw.decode(name)
    assert one(spark, charset.from_latin(F.col("x"), name), raw.decode("latin-1")) == meant
    assert one(spark, charset.to_latin(F.col("x"), name), meant) == raw.decode("latin-1")


@pytest.mark.parametrize(
    "line, sep, quote, n",
    [("a,b", ",", '"', 2), ('"a,b",c', ",", '"', 2), ('"a""b,",c', ",", '"', 2), ("", ",", '"', 1), ("a||b||c", "||", '"', 3), ("^a;b^;c", ";", "^", 2)],
)
def test_cell_counts(spark, line, sep, quote, n):
    assert one(spark, cell_count(F.col("x"), sep, quote), line) == n


def test_names():
    assert X.camel_case("app_rate") == "appRate" and X.camel_case("id") == "id" and X.camel_case("lep1_code_x") == "lep1CodeX"


@pytest.mark.parametrize("text, expected", [("", None), (" - ", None), (' a\n"b" ', "a b"), (None, None)])
def test_clean_values(spark, text, expected):
    assert one(spark, X.clean_value(F.col("x")), text) == expected


def test_document_names(spark):
    parts = X.document_name_parts(F.col("x"))
    good, bad = "Prod223_2798_12345_20200331.html", "Prod223_12345.html"
    assert [one(spark, parts[p], good) for p in parts] == ["Prod223_2798", "12345", dt.date(2020, 3, 31), "html"]
    assert [one(spark, parts[p], bad) for p in parts] == [None] * 4
