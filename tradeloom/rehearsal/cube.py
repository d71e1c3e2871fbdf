"""The tariff cube and its relations over orders, lines and nations.

A supplier's nation reports, a customer's nation is the partner (line 1 stands for the whole world), the
part size is the product and the return flag the duty type. Nations of region EUROPE join the union over
four years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.plans import countries as C
from tradeloom.plans import tariff
from tradeloom.rehearsal.registry import Tables, query
from tradeloom.session import materialize

YEARS = (1995, 2001)


def tariff_lines(t: Tables) -> DataFrame:
    """One row per order line with the cube's key columns; suppliers and customers join by checked size."""
    supplier = t.supplier.select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.when(F.col("s_suppkey") % 10 == 0, F.lit(tariff.EU)).otherwise(F.col("s_nationkey") + 1).alias("reporter"),
    )
    customer = t.customer.select(F.col("c_custkey").alias("o_custkey"), (F.col("c_nationkey") + 1).alias("nation"))
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("product"))
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.year("o_orderdate").alias("year"))
    return (
        t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
        .join(orders, "l_orderkey")
        .join(customer, "o_custkey")
        .join(supplier, "l_suppkey")
        .join(part, "l_partkey")
        .select(
            "reporter",
            "year",
            "product",
            F.when(F.col("l_linenumber") == 1, F.lit(tariff.WORLD)).otherwise(F.col("nation")).alias("partner"),
            F.when(F.col("l_returnflag") == "A", "AHS").when(F.col("l_returnflag") == "R", "MFN").otherwise("BND").alias("duty_type"),
            F.col("l_quantity").alias("rate"),
        )
    )


def raw_tariffs(t: Tables) -> DataFrame:
    keys = ["reporter", "year", "product", "partner", "duty_type"]
    return tariff_lines(t).groupBy(keys).agg(F.max("rate").alias("simple_average"))


def raw_tariffs_with_duplicates(t: Tables) -> DataFrame:
    """Two rates per key, the lower one empty when it is 1."""
    keys = ["reporter", "year", "product", "partner", "duty_type"]
    both = F.array(F.max("rate"), F.nullif(F.min("rate"), F.lit(1.0)))
    return tariff_lines(t).groupBy(keys).agg(both.alias("rates")).select(*keys, F.explode("rates").alias("simple_average"))


def bound_rates(t: Tables, copies: bool = False) -> DataFrame:
    rows = t.supplier.groupBy((F.col("s_nationkey") + 1).alias("reporter")).agg(F.count("*").alias("n"))
    sizes = t.part.groupBy(F.col("p_size").alias("product")).agg(
        F.max("p_retailprice").alias("high"), F.min("p_retailprice").alias("low")
    )
    # Pairs by an equal remainder, so no pairwise join is needed.
    out = rows.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(6)))).where("(reporter + bucket) % 2 = 0").join(
        sizes.withColumn("bucket", F.col("product") % 7), "bucket"
    )
    if copies:
        return out.select("reporter", "product", F.explode(F.array("high", "high", "low")).alias("bound_rate"))
    return out.select("reporter", "product", F.col("high").alias("bound_rate"))


def country_codes(t: Tables) -> DataFrame:
    """Nation names play the country codes; NATION_3 arrives under an alias of its own."""
    return t.nation.select((F.col("n_nationkey") + 1).alias("cty_code"), F.col("n_name").alias("iso3_digit_alpha"))


def memberships(t: Tables) -> DataFrame:
    europe = t.nation.join(t.region.where("r_name = 'EUROPE'"), F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    return (
        europe.select(
            F.col("n_name").alias("iso3"),
            F.explode(F.sequence(F.lit(YEARS[0]), F.lit(YEARS[1]))).alias("year"),
            "n_nationkey",
        )
        .withColumn("tariff_code", F.when(F.col("year") >= YEARS[0] + F.col("n_nationkey") % 4, F.lit("EUN")))
        .drop("n_nationkey")
    )


def required(t: Tables) -> DataFrame:
    """The last nation is in the list under another number, so it never gets a world rate as a partner."""
    number = F.when(F.col("n_nationkey") == 24, F.lit(999)).otherwise(F.col("n_nationkey") + 1)
    return t.nation.select(F.col("n_name").alias("iso3"), number.alias("iso_num"), F.lit(True).alias("requirement"))


RAW_SQL = """
lines AS (
  SELECT CASE WHEN s_suppkey % 10 = 0 THEN 918 ELSE s_nationkey + 1 END AS reporter,
         CAST(year(o_orderdate) AS INTEGER) AS year, p_size AS product,
         CASE WHEN l_linenumber = 1 THEN 0 ELSE c_nationkey + 1 END AS partner,
         CASE l_returnflag WHEN 'A' THEN 'AHS' WHEN 'R' THEN 'MFN' ELSE 'BND' END AS duty_type,
         l_quantity AS rate
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey),
"""

SINGLE_SQL = """
raw AS (SELECT reporter, year, product, partner, duty_type, max(rate) AS simple_average
        FROM lines GROUP BY ALL),
bound AS (SELECT r.reporter, s.product, s.high AS bound_rate FROM reps r JOIN sizes s
          ON EXISTS (SELECT 1 FROM range(0, 7) b(i) WHERE (r.reporter + i) % 2 = 0 AND s.product % 7 = i)),
"""

DUPLICATE_SQL = """
raw AS (SELECT reporter, year, product, partner, duty_type, max(rate) AS simple_average
        FROM lines GROUP BY ALL
        UNION ALL
        SELECT reporter, year, product, partner, duty_type, nullif(min(rate), 1.0)
        FROM lines GROUP BY ALL),
bound AS (SELECT r.reporter, s.product, u.bound_rate FROM reps r JOIN sizes s
          ON EXISTS (SELECT 1 FROM range(0, 7) b(i) WHERE (r.reporter + i) % 2 = 0 AND s.product % 7 = i),
          LATERAL (SELECT unnest([s.high, s.high, s.low]) AS bound_rate) u),
"""

SMALL_SQL = """
reps AS (SELECT DISTINCT s_nationkey + 1 AS reporter FROM supplier),
sizes AS (SELECT p_size AS product, max(p_retailprice) AS high, min(p_retailprice) AS low FROM part GROUP BY p_size),
"""

RELATIONS_SQL = """
required AS (SELECT n_name AS iso3, CASE WHEN n_nationkey = 24 THEN 999 ELSE n_nationkey + 1 END AS iso_num FROM nation),
dictionary AS (SELECT n_name AS iso3, n_nationkey + 1 AS iso_number FROM nation),
products AS (SELECT DISTINCT product FROM raw WHERE year >= 1995 AND product IS NOT NULL),
years AS (SELECT CAST(i AS INTEGER) AS year FROM range(1995, 2002) y(i)),
spine AS (SELECT p.product, y.year, r.iso_number AS reporter, q.iso_number AS partner
          FROM products p, years y, dictionary r, dictionary q WHERE r.iso_number <> q.iso_number),
tariffs AS (SELECT product, year, CASE WHEN reporter = 736 THEN 729 ELSE reporter END AS reporter,
                   CASE WHEN partner = 736 THEN 729 ELSE partner END AS partner, duty_type, simple_average
            FROM raw WHERE NOT (reporter = 231 AND partner = 729)),
all_tariffs AS (SELECT DISTINCT product, year, reporter, partner, a.simple_average AS app_rate, m.simple_average AS mfn_rate
                FROM (SELECT * FROM tariffs WHERE duty_type = 'AHS') a
                FULL JOIN (SELECT * FROM tariffs WHERE duty_type = 'MFN') m USING (product, year, reporter, partner)),
eu AS (SELECT CAST(i AS INTEGER) AS year, n_nationkey + 1 AS iso_number
       FROM nation JOIN region ON r_regionkey = n_regionkey, range(1995, 2002) y(i)
       WHERE r_name = 'EUROPE' AND i >= 1995 + n_nationkey % 4),
eu_reported AS (SELECT DISTINCT product, year, partner, app_rate FROM all_tariffs
                WHERE reporter = 918 AND (product, year, partner) IN (SELECT (product, year, partner) FROM spine)),
eu_rep AS (SELECT DISTINCT product, year, eu.iso_number AS reporter, partner, app_rate AS eu_rep_rate
           FROM eu_reported JOIN eu USING (year) WHERE partner <> eu.iso_number),
with_eu AS (SELECT t.*, e.eu_rep_rate, CASE WHEN is_rep AND is_part THEN 0.0 END AS eu_eu_rate
            FROM (SELECT DISTINCT product, s.year, s.reporter, s.partner, app_rate,
                         r.iso_number IS NOT NULL AS is_rep, p.iso_number IS NOT NULL AS is_part
                  FROM spine s LEFT JOIN all_tariffs USING (product, year, reporter, partner)
                  LEFT JOIN eu r ON r.year = s.year AND r.iso_number = s.reporter
                  LEFT JOIN eu p ON p.year = s.year AND p.iso_number = s.partner) t
            LEFT JOIN eu_rep e USING (product, year, reporter, partner)),
eu_part AS (SELECT product, year, reporter, TRUE AS is_part, sum(app_rate) / count(app_rate) AS eu_part_rate
            FROM with_eu WHERE is_part GROUP BY product, year, reporter HAVING count(app_rate) > 0),
world AS (SELECT DISTINCT a.product, a.year, a.reporter, iso_num AS partner, a.mfn_rate
          FROM all_tariffs a, required WHERE a.partner = 0 AND a.reporter <> iso_num
            AND (a.product, a.year, a.reporter) IN (SELECT (product, year, reporter) FROM spine)),
"""

CUBE_SQL = """
joined AS (SELECT product, year, reporter, partner, app_rate, w.mfn_rate, b.bound_rate AS bnd_rate, eu_rep_rate,
                  eu_part_rate, eu_eu_rate
           FROM with_eu LEFT JOIN eu_part USING (product, year, reporter, is_part)
           LEFT JOIN world w USING (product, year, partner, reporter)
           LEFT JOIN (SELECT * FROM bound WHERE reporter IN (SELECT iso_num FROM required)) b USING (product, reporter)),
averaged AS (SELECT DISTINCT *, sum(mfn_rate) OVER py / nullif(count(mfn_rate) OVER py, 0) AS world_average
             FROM joined WINDOW py AS (PARTITION BY product, year)),
grouped AS (SELECT *, coalesce(app_rate, eu_rep_rate, eu_part_rate) AS ahs,
                   count(coalesce(app_rate, eu_rep_rate, eu_part_rate)) OVER k AS ahs_group,
                   count(mfn_rate) OVER k AS mfn_group
            FROM averaged WINDOW k AS (PARTITION BY product, reporter, partner ORDER BY year)),
filled AS (SELECT *,
             first_value(ahs) OVER (PARTITION BY product, reporter, partner, ahs_group ORDER BY year, ahs NULLS LAST) AS ahs_filled,
             first_value(mfn_rate) OVER (PARTITION BY product, reporter, partner, mfn_group ORDER BY year, mfn_rate NULLS LAST) AS mfn_filled
           FROM grouped),
assumed AS (SELECT *, coalesce(eu_eu_rate, ahs_filled, mfn_filled, world_average) AS assumed_tariff FROM filled)
SELECT product, reporter, partner, year,
""" + ",\n".join(f"  floor(avg({m}) * 1000 + 0.5) / 1000 AS {m}" for m in tariff.MEASURES) + """
FROM assumed GROUP BY product, reporter, partner, year
"""


def _cube(t: Tables, raw: DataFrame, copies: bool) -> DataFrame:
    return tariff.tariff_cube(raw, bound_rates(t, copies), country_codes(t), memberships(t), required(t), *YEARS)


@query("tariff_cube", "WITH" + RAW_SQL + SMALL_SQL + SINGLE_SQL + RELATIONS_SQL + CUBE_SQL)
def tariff_cube(t: Tables) -> DataFrame:
    return _cube(t, raw_tariffs(t), copies=False)


@query("tariff_cube_duplicates", "WITH" + RAW_SQL + SMALL_SQL + DUPLICATE_SQL + RELATIONS_SQL + CUBE_SQL)
def tariff_cube_duplicates(t: Tables) -> DataFrame:
    return _cube(t, raw_tariffs_with_duplicates(t), copies=True)


def _relations(t: Tables):
    dictionary = C.country_dictionary(country_codes(t))
    numbers = tariff.dimension(C.required_numbers(dictionary, required(t)), "numbers")
    members = tariff.dimension(C.eu_countries(memberships(t), dictionary, required(t), YEARS[0]), "members")
    stats = materialize(tariff.rate_statistics(raw_tariffs_with_duplicates(t), *YEARS), "tariff-rates")
    return stats, members, numbers


PARTS_SQL = "WITH" + RAW_SQL + SMALL_SQL + DUPLICATE_SQL + RELATIONS_SQL


@query(
    "eu_reporter_rates",
    PARTS_SQL + """done AS (SELECT 1)
    SELECT product, year, reporter, partner, count(*) AS n_rates, min(eu_rep_rate) AS lowest, sum(eu_rep_rate) AS total
    FROM eu_rep GROUP BY product, year, reporter, partner""",
)
def eu_reporter_rates(t: Tables) -> DataFrame:
    rates = tariff.eu_reporter_rates(*_relations(t))
    return rates.select(
        "product", "year", "reporter", "partner", F.col("e_n").alias("n_rates"), F.col("e_min").alias("lowest"), F.col("e_sum").alias("total")
    )


@query(
    "avg_having",
    PARTS_SQL + """done AS (SELECT 1)
    SELECT product, year, reporter, floor(eu_part_rate * 1000 + 0.5) / 1000 AS eu_part_rate FROM eu_part""",
)
def avg_having(t: Tables) -> DataFrame:
    stats, members, numbers = _relations(t)
    rates = tariff.eu_partner_rates(tariff.observed_keys(stats, members, numbers), members)
    dtype = rates.schema["eu_part_rate"].dataType
    return rates.select("product", "year", "reporter", tariff.round_half_up(F.col("eu_part_rate"), 3, dtype).alias("eu_part_rate"))


@query(
    "spine_cross_join",
    PARTS_SQL + "done AS (SELECT 1) SELECT product, year, reporter, partner FROM spine",
)
def spine_cross_join(t: Tables) -> DataFrame:
    numbers = C.required_numbers(C.country_dictionary(country_codes(t)), required(t))
    products = tariff_lines(t).select("product", "year").where(F.col("year") >= YEARS[0]).select("product").distinct()
    return tariff.spine(products, numbers, *YEARS)
