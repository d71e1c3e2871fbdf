"""The complete product x reporter x partner x year tariff cube.

The definition works row by row: reported rates are joined to a dense grid, duplicates of one key
multiply each other, means are taken before duplicates are removed, and only the last step averages a
key back to one row. Three facts let this plan keep one row per key from the start:

* the duplicates of one key are a full cross product of independent value sets, so the final mean of a
  measure is the mean of its own distinct values;
* a forward fill sees every duplicate of a year as a peer, so one value per key and year (the smallest
  non-null one) is all it can return;
* the world mean weights a reporter's rate by its joined row count, and that count is the number of
  partners plus a correction for the few keys that have several values.

Reported rates are therefore reduced to per-key statistics first. Means are rounded there too: everything
after them only selects among values, and rounding keeps their order. The grid is generated from arrays, so
no pairwise join is needed, and everything per (product, reporter) shares one hash partitioning: the
dense cube itself is never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tradeloom.functions.numeric import mean_of, round_half_up
from tradeloom.plans import countries as C
from tradeloom.session import broadcast_checked, materialize

WORLD = 0
EU = 918
FIRST_YEAR, LAST_YEAR = 2000, 2018

# Sudan's code changed from 736 to 729; 231 -> 729 was reported twice.
OLD_SUDAN, SUDAN, ETHIOPIA = 736, 729, 231

KEY = ["product", "year", "reporter", "partner"]
MEASURES = [
    "assumed_tariff", "app_rate", "mfn_rate", "bnd_rate",
    "eu_rep_rate", "eu_part_rate", "eu_eu_rate", "world_average",
]
CUBE_COLUMNS = ["product", "reporter", "partner", "year", *MEASURES]


# Rows of the cube that a task builds.
CELLS_PER_TASK = 2_000_000


def dimension(df: DataFrame, name: str) -> DataFrame:
    """A short list that joins read: written once, broadcast while it is small."""
    return broadcast_checked(materialize(df, name))


def parse_products(option: str | None) -> list[int] | None:
    """``'201,401'`` to a list; anything that is not all integers means no restriction."""
    if not option:
        return None
    try:
        return [int(p) for p in option.split(",")]
    except ValueError:
        return None


def restrict_products(
    df: DataFrame, products: Iterable[int] | None = None, done: DataFrame | None = None
) -> DataFrame:
    """Keep the chosen products and leave out those already present in ``done`` (resume)."""
    if products is not None:
        df = df.where(F.col("product").isin(list(products)))
    if done is not None:
        df = df.join(dimension(done.select("product").distinct(), "finished"), "product", "left_anti")
    return df


def sudan(code: Column) -> Column:
    return F.when(code == OLD_SUDAN, F.lit(SUDAN)).otherwise(code)


def rate_statistics(raw: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """One row per reported key with statistics of its distinct applied (a) and MFN (m) rates.

    Rows of another duty type, a later year or a doubly reported pair still prove that a product exists.
    They collapse to one keyless row per product, so a single pass over the raw table is enough. Distinct
    rates are reduced by two hash aggregations, both with a partial step before the shuffle.
    """
    reporter, partner = F.col("reporter"), F.col("partner")
    usable = (
        ~((reporter == ETHIOPIA) & (partner == SUDAN))
        & F.col("duty_type").isin("AHS", "MFN")
        & (F.col("year") <= last_year)
    )
    rows = raw.where((F.col("year") >= first_year) & F.col("product").isNotNull()).select(
        "product",
        F.when(usable, F.col("year")).alias("year"),
        F.when(usable, sudan(reporter)).alias("reporter"),
        F.when(usable, sudan(partner)).alias("partner"),
        F.when(usable, F.col("duty_type")).alias("duty_type"),
        F.when(usable, F.col("simple_average")).alias("rate"),
    )
    applied, mfn = F.col("duty_type") == "AHS", F.col("duty_type") == "MFN"
    rate = F.col("rate")
    return (
        rows.distinct()
        .groupBy(KEY)
        .agg(
            F.count_if(applied).alias("a_n"),
            F.count(F.when(applied, rate)).alias("a_cnt"),
            F.sum(F.when(applied, rate)).alias("a_sum"),
            F.min(F.when(applied, rate)).alias("a_min"),
            F.count(F.when(mfn, rate)).alias("m_cnt"),
            F.sum(F.when(mfn, rate)).alias("m_sum"),
            F.min(F.when(mfn, rate)).alias("m_min"),
        )
    )


def eu_reporter_rates(stats: DataFrame, members: DataFrame, numbers: DataFrame) -> DataFrame:
    """Rates reported by the EU as a whole, one row per member that year (never to itself)."""
    return (
        stats.where(F.col("reporter") == EU)
        .join(numbers.select(F.col("iso_number").alias("partner")), "partner", "left_semi")
        .join(members, "year")
        .where(F.col("iso_number") != F.col("partner"))
        .select(
            "product",
            "year",
            F.col("iso_number").alias("reporter"),
            "partner",
            F.greatest("a_n", F.lit(1)).alias("e_n"),
            F.col("a_cnt").alias("e_cnt"),
            F.col("a_sum").alias("e_sum"),
            F.col("a_min").alias("e_min"),
        )
    )


def observed_keys(stats: DataFrame, members: DataFrame, numbers: DataFrame) -> DataFrame:
    """Every grid key with a rate of its own or through EU membership, one row each."""
    direct = (
        stats.where(F.col("reporter") != F.col("partner"))
        .join(numbers.select(F.col("iso_number").alias("reporter")), "reporter", "left_semi")
        .join(numbers.select(F.col("iso_number").alias("partner")), "partner", "left_semi")
        .select(*KEY, "a_n", "a_cnt", "a_sum", "a_min")
    )
    spread = eu_reporter_rates(stats, members, numbers)
    measures = ["a_n", "a_cnt", "a_sum", "a_min", "e_n", "e_cnt", "e_sum", "e_min"]
    return (
        direct.unionByName(spread, allowMissingColumns=True)
        .groupBy(KEY)
        .agg(*[F.max(m).alias(m) for m in measures])
    )


def eu_partner_rates(observed: DataFrame, members: DataFrame) -> DataFrame:
    """Mean applied rate towards EU members, per product, year and reporter."""
    dtype = observed.schema["a_sum"].dataType
    copies = F.coalesce("e_n", F.lit(1))
    return (
        observed.join(members.withColumnRenamed("iso_number", "partner"), ["year", "partner"], "left_semi")
        .groupBy("product", "year", "reporter")
        .agg(
            F.sum(F.col("a_sum") * copies).alias("total"),
            F.sum(F.col("a_cnt") * copies).alias("n"),
        )
        .select("product", "year", "reporter", mean_of(F.col("total"), F.col("n"), dtype).alias("eu_part_rate"))
        .where("eu_part_rate is not null")
    )


def world_partner_rates(stats: DataFrame) -> DataFrame:
    """MFN rates a reporter applies to the whole world."""
    return stats.where((F.col("partner") == WORLD) & F.col("reporter").isNotNull()).select(
        "product", "year", "reporter", "m_cnt", "m_sum", "m_min"
    )


def bound_statistics(bound_rates: DataFrame, listed: DataFrame) -> DataFrame:
    """Joined row count and mean of the distinct bound rates per product and reporter."""
    return (
        bound_rates.join(listed.select(F.col("iso_num").alias("reporter")), "reporter", "left_semi")
        .groupBy("product", "reporter", "bound_rate")
        .agg(F.count("*").alias("copies"))
        .groupBy("product", "reporter")
        .agg(F.sum("copies").alias("b_n"), F.avg("bound_rate").alias("bnd_rate"))
    )


def number_array(df: DataFrame, column: str) -> Column:
    """All values of a country list as one array, usable in another frame's expressions."""
    return df.agg(F.array_sort(F.collect_set(column)).alias("numbers")).scalar()


def spine(products: DataFrame, numbers: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Every (product, year, reporter, partner) of the required countries, reporter and partner different."""
    codes = number_array(numbers, "iso_number")
    return (
        products.select("product", F.explode(codes).alias("reporter"))
        .select("*", F.explode(codes).alias("partner"))
        .where("reporter != partner")
        .select("product", F.explode(F.sequence(F.lit(first_year), F.lit(last_year))).alias("year"), "reporter", "partner")
    )


def _rounded(value: Column, dtype: T.DataType) -> Column:
    return round_half_up(value, 3, dtype)


def _reporter_years(
    products: DataFrame,
    stats: DataFrame,
    observed: DataFrame,
    bounds: DataFrame,
    members: DataFrame,
    numbers: DataFrame,
    listed: DataFrame,
    years: tuple[int, int],
) -> DataFrame:
    """One row per (product, reporter) with an array of everything that does not depend on the partner."""
    dtype = stats.schema["m_sum"].dataType
    codes, listed_codes = number_array(numbers, "iso_number"), number_array(listed, "iso_num")
    # Grid keys that are missing from the data contribute one joined row per listed partner.
    partners = F.size(F.array_intersect(codes, listed_codes)) - F.array_contains(
        listed_codes, F.col("reporter")
    ).cast("int")
    extra = (
        observed.join(listed.select(F.col("iso_num").alias("partner")), "partner", "left_semi")
        .groupBy("product", "year", "reporter")
        .agg(
            F.sum(
                F.greatest(F.coalesce("a_n", F.lit(0)), F.lit(1)) * F.coalesce("e_n", F.lit(1)) - 1
            ).alias("extra")
        )
    )
    by_key = ["product", "year", "reporter"]
    grid = (
        products.select("product", F.explode(codes).alias("reporter"))
        .join(bounds, ["product", "reporter"], "left")
        .select("*", F.explode(F.sequence(F.lit(years[0]), F.lit(years[1]))).alias("year"))
        .join(world_partner_rates(stats), by_key, "left")
        .join(extra, by_key, "left")
        .join(eu_partner_rates(observed, members), by_key, "left")
        .join(
            members.select("year", F.col("iso_number").alias("reporter"), F.lit(True).alias("eu_rep")),
            ["year", "reporter"],
            "left",
        )
    )
    weight = F.coalesce("b_n", F.lit(1)) * (partners + F.coalesce("extra", F.lit(0)))
    # Both windows hold at most one row per reporter, or per year.
    per_year = W.partitionBy("product", "year")
    so_far = W.partitionBy("product", "reporter").orderBy("year").rowsBetween(W.unboundedPreceding, 0)
    totals = grid.withColumn("weight", weight).withColumns(
        {
            "world_sum": F.sum(F.col("m_sum") * F.col("weight")).over(per_year),
            "world_n": F.sum(F.col("m_cnt") * F.col("weight")).over(per_year),
        }
    )
    filled = totals.withColumn("mfn_filled", F.last("m_min", ignorenulls=True).over(so_far))
    rounded = {
        "mfn_rate": mean_of(F.col("m_sum"), F.col("m_cnt"), dtype),
        "mfn_filled": F.col("mfn_filled"),
        "bnd_rate": F.col("bnd_rate"),
        "eu_part_rate": F.col("eu_part_rate"),
        "world_average": mean_of(F.col("world_sum"), F.col("world_n"), dtype),
    }
    year = ["year", "eu_rep", "mfn_rate", "mfn_filled", "eu_part_rate", "world_average"]
    return (
        filled.withColumns({name: _rounded(value, dtype) for name, value in rounded.items()})
        .groupBy("product", "reporter", "bnd_rate")
        .agg(F.collect_list(F.struct(*year)).alias("years"))
    )


def _reporter_partners(products: DataFrame, observed: DataFrame, numbers: DataFrame, parts: int) -> DataFrame:
    """One row per (product, reporter, partner) with its observations as a map from year.

    The grid keys and the observations are brought together by one aggregation over a partitioning by
    (product, reporter), which the join to the reporter's years reuses. A map holds at most one entry per
    year.
    """
    codes = number_array(numbers, "iso_number")
    grid = (
        products.select("product", F.explode(codes).alias("reporter"))
        .select("*", F.explode(codes).alias("partner"))
        .where("reporter != partner")
    )
    dtype = observed.schema["a_sum"].dataType
    # A key without an applied rate (or with an empty one) falls through to the EU rates.
    applied_missing = (F.coalesce("a_n", F.lit(0)) == 0) | (F.col("a_cnt") < F.col("a_n"))
    eu_missing = F.col("e_n").isNull() | (F.col("e_cnt") < F.col("e_n"))
    seen = observed.select(
        "product",
        "reporter",
        "partner",
        F.struct(
            "year",
            _rounded(mean_of(F.col("a_sum"), F.col("a_cnt"), dtype), dtype).alias("app_rate"),
            _rounded(mean_of(F.col("e_sum"), F.col("e_cnt"), dtype), dtype).alias("eu_rep_rate"),
            _rounded(F.least("a_min", F.when(applied_missing, F.col("e_min"))), dtype).alias("applied"),
            (applied_missing & eu_missing).alias("open"),
        ).alias("seen"),
    )
    return (
        grid.unionByName(seen, allowMissingColumns=True)
        .repartition(parts, "product", "reporter")
        .groupBy("product", "reporter", "partner")
        .agg(F.collect_list("seen").alias("seen"))
        .select(
            "product",
            "reporter",
            "partner",
            F.map_from_entries(F.transform("seen", lambda s: F.struct(s["year"], s))).alias("seen"),
        )
    )


def tariff_cube(
    raw: DataFrame,
    bound_rates: DataFrame,
    country_codes: DataFrame,
    memberships: DataFrame,
    required: DataFrame | None = None,
    first_year: int = FIRST_YEAR,
    last_year: int = LAST_YEAR,
    products: Iterable[int] | None = None,
    done: DataFrame | None = None,
) -> DataFrame:
    """Fill every grid key with the best available rate; see ``CUBE_COLUMNS`` for the result.

    Priority: zero inside the EU, then the carried-forward applied rate (own, EU reporter, EU partner),
    then the carried-forward MFN rate, then the world mean of the year.
    """
    spark = raw.sparkSession
    if required is None:
        required = C.required_countries(spark)
    dictionary = C.country_dictionary(country_codes)
    numbers = dimension(C.required_numbers(dictionary, required), "numbers")
    members = dimension(C.eu_countries(memberships, dictionary, required, first_year), "members")
    listed = dimension(required.where("requirement is not null").select("iso_num").distinct(), "listed")

    stats = materialize(
        rate_statistics(restrict_products(raw, products, done), first_year, last_year), "tariff-rates"
    )
    all_products = stats.select("product").distinct()
    observed = materialize(observed_keys(stats, members, numbers), "tariff-observed")
    years = _reporter_years(
        all_products, stats, observed, bound_statistics(bound_rates, listed), members, numbers, listed,
        (first_year, last_year),
    )
    # The pairs are few bytes, but each becomes a row per year: the parts follow the size of the grid.
    cells = all_products.count() * numbers.count() ** 2 * (last_year - first_year + 1)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-cells // CELLS_PER_TASK))
    pairs = _reporter_partners(all_products, observed, numbers, parts)
    return _assume(pairs, years, members, listed, stats.schema["a_sum"].dataType)


def _assume(
    pairs: DataFrame, years: DataFrame, members: DataFrame, listed: DataFrame, dtype: T.DataType
) -> DataFrame:
    """Explode to the cube, carry applied rates forward and pick the assumed tariff."""
    rows = (
        pairs.join(years, ["product", "reporter"])
        .select("product", "reporter", "partner", "bnd_rate", "seen", F.explode("years").alias("y"))
        .select("product", "reporter", "partner", "bnd_rate", "y.*", F.try_element_at("seen", F.col("y.year")).alias("o"))
        .join(
            members.select("year", F.col("iso_number").alias("partner"), F.lit(True).alias("eu_part")),
            ["year", "partner"],
            "left",
        )
        .join(listed.select(F.col("iso_num").alias("partner"), F.lit(True).alias("is_listed")), "partner", "left")
    )
    eu_part_rate = F.when(F.col("eu_part"), F.col("eu_part_rate"))
    applied = F.least(F.col("o.applied"), F.when(F.coalesce("o.open", F.lit(True)), eu_part_rate))
    so_far = (
        W.partitionBy("product", "reporter", "partner").orderBy("year").rowsBetween(W.unboundedPreceding, 0)
    )
    measures = {
        "app_rate": F.col("o.app_rate"),
        "mfn_rate": F.when(F.col("is_listed"), F.col("mfn_rate")),
        "bnd_rate": F.col("bnd_rate"),
        "eu_rep_rate": F.col("o.eu_rep_rate"),
        "eu_part_rate": eu_part_rate,
        "eu_eu_rate": F.when(F.col("eu_rep") & F.col("eu_part"), _rounded(F.lit(0).cast(dtype), dtype)),
        "world_average": F.col("world_average"),
    }
    measures["assumed_tariff"] = F.coalesce(
        measures["eu_eu_rate"],
        F.last(applied, ignorenulls=True).over(so_far),
        F.when(F.col("is_listed"), F.col("mfn_filled")),
        F.col("world_average"),
    )
    return rows.select("product", "reporter", "partner", "year", *[measures[m].alias(m) for m in MEASURES])
