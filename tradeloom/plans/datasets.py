"""The datasets: how each source file is read and what its two layers hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.functions import text as X
from tradeloom.operators.keyed import latest_revision
from tradeloom.operators.lifecycle import unpivot_years
from tradeloom.plans.accounts import ACCOUNTS_SCHEMA, read_accounts, read_accounts_with_errors
from tradeloom.sources.archives import archive_lines, member_date, tab_fields
from tradeloom.sources.delimited import read_delimited, read_without_empty_quotes
from tradeloom.spec import INCREMENTAL, SNAPSHOT, DatasetSpec


def texts(names: str) -> str:
    return ", ".join(f"`{n}` string" for n in names.split())


# --- exporters -------------------------------------------------------------------------------------

EXPORTER_FIELDS = "month row_type company_name address1 address2 address3 address4 address5 postcode"


def read_exporters(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated lines inside an archive of archives; goods codes fill the fields after the postcode."""
    lines = archive_lines(spark, path, "mac-roman").select("line")
    return tab_fields(lines, EXPORTER_FIELDS.split(), "export_item_codes")


def exporter_columns() -> dict[str, Column]:
    return {
        "datetime": X.month_start(F.col("month")),
        "company_name": X.clean_name(F.col("company_name")),
        "address": X.joined_address(*[F.col(f"address{i}") for i in range(1, 6)]),
        "postcode": X.clean_postcode(F.col("postcode")),
        "export_item_codes": X.split_codes(F.col("export_item_codes")),
    }


EXPORTERS = DatasetSpec(
    "hmrc",
    "exporters",
    INCREMENTAL,
    texts(EXPORTER_FIELDS + " export_item_codes"),
    read_exporters,
    ["datetime", "company_name", "address", "postcode", "export_item_codes"],
    exporter_columns,
)

# --- postcode directory ----------------------------------------------------------------------------

POSTCODE_MEMBER = r"(?:.*?)/ONSPD_(\w{3}_\d{4})_UK\.csv$"

# Columns of the published file, in file order.
POSTCODE_FIELDS = """
pcd pcd2 pcds dointr doterm oscty ced oslaua osward parish usertype oseast1m osnrth1m osgrdind oshlthau nhser
ctry rgn streg pcon eer teclec ttwa pct nuts statsward oa01 casward park lsoa01 msoa01 ur01ind oac01 oa11
lsoa11 msoa11 wz11 ccg bua11 buasd11 ru11ind oac11 lat long lep1 lep2 pfa imd calncv stp
"""


def read_postcodes(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the one member named for its month; quotes around cells are optional."""
    rows = archive_lines(spark, path, wanted=POSTCODE_MEMBER)
    schema = T.StructType.fromDDL(texts(POSTCODE_FIELDS))
    cells = F.from_csv("line", schema.simpleString()[len("struct<") : -1].replace(":", " "), {"quote": '"', "escape": '"'})
    parsed = rows.withColumn("cells", cells).where(F.lower("cells.pcd") != "pcd")
    return parsed.select(
        *[F.nullif(F.trim(F.replace(F.col(f"cells.{c}"), F.lit('"'), F.lit(""))), F.lit("")).alias(c) for c in schema.fieldNames()],
        member_date(F.col("member"), POSTCODE_MEMBER, "MMM_yyyy").alias("publication_date"),
    )


def postcode_columns() -> dict[str, Column]:
    return {"dointr": X.month_date(F.col("dointr")), "doterm": X.month_date(F.col("doterm"))}


POSTCODE_DIRECTORY = DatasetSpec(
    "ons",
    "postcode_directory",
    INCREMENTAL,
    texts(POSTCODE_FIELDS) + ", publication_date date",
    read_postcodes,
    [*POSTCODE_FIELDS.split(), "publication_date"],
    postcode_columns,
)

REFERENCE_POSTCODES = DatasetSpec(
    "dit",
    "reference_postcodes",
    SNAPSHOT,
    texts(
        "postcode local_authority_district_code local_authority_district_name "
        "local_enterprise_partnership_lep1_code local_enterprise_partnership_lep1_name "
        "local_enterprise_partnership_lep2_code local_enterprise_partnership_lep2_name "
        "region_code region_name national_grid_ref_easting national_grid_ref_northing"
    )
    + ", date_of_introduction date, date_of_termination date",
    lambda spark, path: read_without_empty_quotes(spark, path, REFERENCE_POSTCODES.l0_schema),
    [
        "postcode", "local_authority_district_code", "local_authority_district_name",
        "local_enterprise_partnership_lep1_code", "local_enterprise_partnership_lep1_name",
        "local_enterprise_partnership_lep2_code", "local_enterprise_partnership_lep2_name",
        "region_code", "region_name", "national_grid_ref_easting", "national_grid_ref_northing",
        "date_of_introduction", "date_of_termination",
    ],
)

# --- trade flows and tariffs -----------------------------------------------------------------------

# Short column names of the trade flow file and what they stand for.
TRADE_FLOW_NAMES = {
    "t": "year",
    "hs6": "product_category",
    "i": "exporter",
    "j": "importer",
    "v": "trade_flow_value",
    "q": "quantity",
}


def rename_trade_flows(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed(TRADE_FLOW_NAMES)


TRADE_FLOWS = DatasetSpec(
    "dit",
    "baci",
    INCREMENTAL,
    "t int, hs6 int, i int, j int, v decimal(20,6), q decimal(20,6)",
    lambda spark, path: read_delimited(spark, path, TRADE_FLOWS.l0_schema),
    list(TRADE_FLOW_NAMES.values()),
    lambda: {name: F.col(short) for short, name in TRADE_FLOW_NAMES.items()},
)

RAW_TARIFF = DatasetSpec(
    "world_bank",
    "tariff",
    INCREMENTAL,
    "reporter int, year int, product int, partner int, duty_type string, simple_average decimal(20,6), "
    "number_of_total_lines int",
    lambda spark, path: read_without_empty_quotes(spark, path, RAW_TARIFF.l0_schema),
    requires=("dit.eu_country_membership", "comtrade.country_code_and_iso", "world_bank.bound_rates"),
)

BOUND_RATES = DatasetSpec(
    "world_bank",
    "bound_rates",
    SNAPSHOT,
    "nomen_code string, reporter int, product int, bound_rate decimal(20,6), total_number_of_lines int",
    lambda spark, path: read_delimited(spark, path, BOUND_RATES.l0_schema),
    ["reporter", "product", "bound_rate"],
    to_l1=latest_revision,
)

# --- countries -------------------------------------------------------------------------------------

COUNTRY_CODES = DatasetSpec(
    "comtrade",
    "country_code_and_iso",
    SNAPSHOT,
    "cty_code int, "
    + texts(
        "cty_name_english cty_fullname_english cty_abbreviation cty_comments iso2_digit_alpha iso3_digit_alpha "
        "start_valid_year end_valid_year"
    ),
    lambda spark, path: read_delimited(spark, path, COUNTRY_CODES.l0_schema, charset="cp1252"),
    [
        "cty_code", "cty_name_english", "cty_fullname_english", "cty_abbreviation", "cty_comments",
        "iso2_digit_alpha", "iso3_digit_alpha", "start_valid_year", "end_valid_year",
    ],
)

MEMBERSHIP_YEARS = range(1958, 2019)


def membership_rows(l0: DataFrame) -> DataFrame:
    return unpivot_years(l0, ["id", "country", "iso3"], "tariff_code")


EU_MEMBERSHIP = DatasetSpec(
    "dit",
    "eu_country_membership",
    SNAPSHOT,
    texts("country iso3 " + " ".join(map(str, MEMBERSHIP_YEARS))),
    lambda spark, path: read_delimited(spark, path, EU_MEMBERSHIP.l0_schema),
    ["country", "iso3", "year", "tariff_code"],
    to_l1=membership_rows,
    repeats_source=True,
)

# --- company accounts ------------------------------------------------------------------------------

ACCOUNTS = DatasetSpec(
    "companies_house", "accounts_legacy", INCREMENTAL, ACCOUNTS_SCHEMA, read_accounts,
    read_with_errors=read_accounts_with_errors,
)

ALL = {
    spec.id: spec
    for spec in (
        EXPORTERS, POSTCODE_DIRECTORY, REFERENCE_POSTCODES, TRADE_FLOWS, EU_MEMBERSHIP, COUNTRY_CODES, BOUND_RATES,
        RAW_TARIFF, ACCOUNTS,
    )
}
