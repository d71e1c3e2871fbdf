from decimal import Decimal

import pytest

from tradeloom.plans import tariff

COUNTRIES = [
    (0, "WLD"), (48, "BHR"), (262, "DJI"), (266, "GAB"), (380, "ITAF"), (918, "EU"), (36, "AUS"),
    (705, "SVN"), (724, "ESP"), (24, "AGO"), (76, "BRA"), (710, "ZAF"), (12, "DZA"),
]
RAW = "reporter int, year int, product int, partner int, duty_type string, simple_average decimal(20,6)"


def _cube(spark, raw, bound=(), years=(2018, 2018), required=(), **options):
    codes = spark.createDataFrame(COUNTRIES, "cty_code int, iso3_digit_alpha string")
    members = spark.createDataFrame(
        [(iso3, year, "EUN" if year >= since else None)
         for iso3, since in (("ITA", 1958), ("SVN", 2004), ("ESP", 1958))
         for year in range(1990, 2021)],
        "iso3 string, year int, tariff_code string",
    )
    decimals = [(*r[:5], None if r[5] is None else Decimal(r[5])) for r in raw]
    return tariff.tariff_cube(
        spark.createDataFrame(decimals, RAW),
        spark.createDataFrame(
            [(r, p, Decimal(b)) for r, p, b in bound], "reporter int, product int, bound_rate decimal(20,6)"
        ),
        codes,
        members,
        spark.createDataFrame([(i, n, True) for i, n in required], "iso3 string, iso_num int, requirement boolean"),
        years[0],
        years[1],
        **options,
    )


def _rows(df):
    def plain(v):
        return float(v) if isinstance(v, Decimal) else v

    return {tuple(r[c] for c in tariff.CUBE_COLUMNS[:4]): tuple(plain(r[c]) for c in tariff.MEASURES) for r in df.collect()}


N = None


def test_country_to_country(spark):
    rows = _rows(_cube(spark, [(705, 2018, 201, 380, "AHS", 10)], [(705, 201, 80)], required=[("SVN", 705), ("ITA", 380)]))
    assert rows == {
        (201, 380, 705, 2018): (0, N, N, N, N, N, 0, N),
        (201, 705, 380, 2018): (0, 10, N, 80, N, 10, 0, N),
    }


def test_eu_to_country(spark):
    raw = [
        (918, 2017, 201, 36, "AHS", 10),
        (705, 2017, 201, 36, "AHS", 20),
        (36, 2017, 201, 705, "AHS", 30),
    ]
    rows = _rows(_cube(spark, raw, [(705, 201, 80)], (2017, 2017), [("SVN", 705), ("AUS", 36), ("ESP", 724)]))
    assert rows == {
        (201, 36, 705, 2017): (30, 30, N, N, N, 30, N, N),
        (201, 36, 724, 2017): (30, N, N, N, N, 30, N, N),
        (201, 705, 36, 2017): (20, 20, N, 80, 10, N, N, N),
        (201, 705, 724, 2017): (0, N, N, 80, N, N, 0, N),
        (201, 724, 36, 2017): (10, N, N, N, 10, N, N, N),
        (201, 724, 705, 2017): (0, N, N, N, N, N, 0, N),
    }


def test_country_to_world(spark):
    raw = [
        (12, 2017, 201, 0, "MFN", 30),
        (12, 2017, 201, 76, "AHS", 21),
        (24, 2017, 201, 0, "MFN", 5),
        (24, 2017, 201, 710, "AHS", 10),
    ]
    required = [("BRA", 76), ("ZAF", 710), ("DZA", 12), ("AGO", 24)]
    rows = _rows(_cube(spark, raw, years=(2017, 2017), required=required))
    assert len(rows) == 12
    assert rows[(201, 12, 24, 2017)] == (30, N, 30, N, N, N, N, 17.5)
    assert rows[(201, 12, 76, 2017)] == (21, 21, 30, N, N, N, N, 17.5)
    assert rows[(201, 24, 710, 2017)] == (10, 10, 5, N, N, N, N, 17.5)
    assert rows[(201, 24, 12, 2017)] == (5, N, 5, N, N, N, N, 17.5)
    for partner in (12, 24, 710):
        assert rows[(201, 76, partner, 2017)] == (17.5, N, N, N, N, N, N, 17.5)


def test_two_years(spark):
    raw = [(12, 2017, 201, 76, "AHS", 10), (12, 2018, 201, 76, "AHS", 20)]
    rows = _rows(_cube(spark, raw, years=(2017, 2018), required=[("BRA", 76), ("DZA", 12)]))
    assert rows == {
        (201, 12, 76, 2017): (10, 10, N, N, N, N, N, N),
        (201, 12, 76, 2018): (20, 20, N, N, N, N, N, N),
        (201, 76, 12, 2017): (N,) * 8,
        (201, 76, 12, 2018): (N,) * 8,
    }


THREE = [
    (12, 2018, 201, 76, "AHS", 21),
    (24, 2018, 301, 710, "AHS", 10),
    (36, 2018, 401, 710, "AHS", 10),
]
FIVE = [("BRA", 76), ("ZAF", 710), ("DZA", 12), ("AGO", 24), ("AUS", 36)]


@pytest.mark.parametrize(
    "option, expected", [(None, {201, 301, 401}), ("201,401", {201, 401}), ("301", {301}), ("Hello", {201, 301, 401})]
)
def test_products(spark, option, expected):
    rows = _rows(_cube(spark, THREE, required=FIVE, products=tariff.parse_products(option)))
    assert {k[0] for k in rows} == expected
    assert len(rows) == 20 * len(expected)
    filled = {k: v for k, v in rows.items() if v[0] is not None}
    reported = {(p, r, t, y): (float(x), float(x), N, N, N, N, N, N) for r, y, p, t, _, x in THREE}
    assert filled == {k: v for k, v in reported.items() if k[0] in expected}


def test_resume_skips_finished_products(spark):
    done = spark.createDataFrame([(201,), (201,)], "product int")
    rows = _rows(_cube(spark, THREE, required=FIVE, done=done))
    assert {k[0] for k in rows} == {301, 401}


def test_forward_fill(spark):
    raw = [
        (918, 2015, 201, 724, "AHS", 5),
        (12, 2016, 201, 710, "AHS", 10),
        (12, 2016, 201, 705, "AHS", 15),
        (12, 2015, 201, 0, "MFN", 20),
        (12, 2016, 201, 0, "MFN", 30),
        (705, 2016, 201, 0, "MFN", 40),
        (705, 2016, 201, 724, "AHS", 60),
    ]
    rows = _rows(_cube(spark, raw, years=(2015, 2017), required=[("ESP", 724), ("DZA", 12), ("SVN", 705)]))
    assert len(rows) == 18
    # own rate, and the mean of the single EU partner rate for the other member
    assert rows[(201, 12, 705, 2016)] == (15, 15, 30, N, N, 15, N, 35)
    assert rows[(201, 12, 724, 2016)] == (15, N, 30, N, N, 15, N, 35)
    # carried forward from 2016
    assert rows[(201, 12, 705, 2017)] == (15, N, N, N, N, N, N, N)
    # the MFN rate fills what has no applied rate
    assert rows[(201, 12, 705, 2015)] == (20, N, 20, N, N, N, N, 20)
    assert rows[(201, 705, 12, 2017)][0] == 40
    # nothing before the first value but the world mean
    assert rows[(201, 705, 12, 2015)] == (20, N, N, N, N, N, N, 20)
    assert rows[(201, 724, 12, 2016)] == (35, N, N, N, N, N, N, 35)
    assert rows[(201, 724, 12, 2017)] == (N,) * 8


def test_code_change_applies_after_the_row_filter(spark):
    raw = [(231, 2018, 1, 729, "AHS", 1), (231, 2018, 2, 736, "AHS", 2)]
    stats = tariff.rate_statistics(
        spark.createDataFrame([(*r[:5], Decimal(r[5])) for r in raw], RAW), 2000, 2018
    )
    got = {(r.product, r.reporter, r.partner): r.a_min for r in stats.collect()}
    assert got == {(1, None, None): None, (2, 231, 729): Decimal(2)}
