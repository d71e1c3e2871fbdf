"""Country reference data: the required list, the code dictionary and membership years."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.session import broadcast_checked

# The countries every cube covers, ISO 3166 alpha-3 and numeric code.
REQUIRED_COUNTRIES = """
ABW 533, AFG 4, AGO 24, ALB 8, ARE 784, ARG 32, ARM 51, ATG 28, AUS 36, AUT 40, AZE 31, BDI 108,
BEL 56, BEN 204, BFA 854, BGD 50, BGR 100, BHR 48, BHS 44, BIH 70, BLR 112, BLZ 84, BOL 68, BRA 76,
BRB 52, BRN 96, BTN 64, CAF 140, CAN 124, CHE 756, CHL 152, CHN 156, CIV 384, CMR 120, COD 180,
COG 178, COL 170, COM 174, CPV 132, CRI 188, CYP 196, CZE 203, DEU 276, DJI 262, DMA 212, DNK 208,
DOM 214, DZA 12, ECU 218, EGY 818, ERI 232, ESP 724, EST 233, ETH 231, FIN 246, FJI 242, FRA 250,
FSM 583, GAB 266, GBR 826, GEO 268, GHA 288, GIN 324, GMB 270, GNB 624, GNQ 226, GRC 300, GRD 308,
GTM 320, GUY 328, HKG 344, HND 340, HRV 191, HTI 332, HUN 348, IDN 360, IND 356, IRL 372, IRN 364,
IRQ 368, ISL 352, ISR 376, ITA 380, JAM 388, JOR 400, JPN 392, KAZ 398, KEN 404, KGZ 417, KHM 116,
KIR 296, KNA 659, KOR 410, KWT 414, LAO 418, LBN 422, LBR 430, LBY 434, LCA 662, LKA 144, LTU 440,
LVA 428, MAC 446, MAR 504, MDA 498, MDG 450, MDV 462, MEX 484, MHL 584, MKD 807, MLI 466, MLT 470,
MMR 104, MNG 496, MOZ 508, MRT 478, MUS 480, MWI 454, MYS 458, NER 562, NGA 566, NIC 558, NLD 528,
NOR 578, NPL 524, NRU 520, NZL 554, OMN 512, PAK 586, PAN 591, PER 604, PHL 608, PLW 585, PNG 598,
POL 616, PRT 620, PRY 600, QAT 634, ROU 642, RUS 643, RWA 646, SAU 682, SDN 729, SEN 686, SGP 702,
SLB 90, SLE 694, SLV 222, SMR 674, SOM 706, STP 678, SUR 740, SVK 703, SVN 705, SWE 752, SYC 690,
TCD 148, TGO 768, THA 764, TJK 762, TKM 795, TON 776, TTO 780, TUN 788, TUR 792, TUV 798, TWN 490,
TZA 834, UGA 800, UKR 804, URY 858, USA 840, UZB 860, VCT 670, VEN 862, VNM 704, VUT 548, WSM 882,
YEM 887, ZAF 710, ZMB 894, ZWE 716
"""

# Trade-statistics codes that stand for a required country.
CODE_ALIASES = {"INDXSIK": "IND", "FRAXM": "FRA", "ITAF": "ITA"}

# Codes of former or combined territories, never used as a country.
IGNORED_CODES = [
    "IND", "ANTABW", "ITA", "BELLUX", "CHELIE", "DEUF", "FRA", "ETHF", "KNAXA",
    "NORF", "PAKF", "PANF", "USAF", "USAV", "VNMF", "YEMF", "ZAFF",
]

EU_CODE = "EUN"


def required_countries(spark: SparkSession) -> DataFrame:
    rows = [
        (iso3, int(number), True)
        for iso3, number in (pair.split() for pair in REQUIRED_COUNTRIES.split(","))
    ]
    return spark.createDataFrame(rows, "iso3 string, iso_num int, requirement boolean")


def remap_codes(code, aliases: dict[str, str] = CODE_ALIASES):
    """Replace aliased codes; every other value, NULL included, passes through."""
    out = code
    for alias, target in aliases.items():
        out = F.when(code == alias, F.lit(target)).otherwise(out)
    return out


def country_dictionary(
    country_codes: DataFrame, ignored: list[str] = IGNORED_CODES, aliases: dict[str, str] = CODE_ALIASES
) -> DataFrame:
    """``(iso3, iso_number)``: the row filter sees the raw code, the alias applies afterwards."""
    code = F.col("iso3_digit_alpha")
    return country_codes.where(~code.isin(ignored)).select(
        remap_codes(code, aliases).alias("iso3"), F.col("cty_code").alias("iso_number")
    )


def required_numbers(dictionary: DataFrame, required: DataFrame) -> DataFrame:
    """Distinct dictionary numbers of the required countries."""
    wanted = required.where("requirement").select("iso3")
    return (
        dictionary.join(broadcast_checked(wanted), "iso3", "left_semi")
        .where("iso_number is not null")
        .select("iso_number")
        .distinct()
    )


def eu_countries(
    memberships: DataFrame, dictionary: DataFrame, required: DataFrame, first_year: int
) -> DataFrame:
    """``(year, iso_number)`` of required countries that were members in that year."""
    wanted = required.where("requirement").select("iso3")
    numbers = dictionary.join(broadcast_checked(wanted), "iso3", "left_semi")
    return (
        memberships.where((F.col("tariff_code") == EU_CODE) & (F.col("year") >= first_year))
        .join(numbers, "iso3")
        .where("iso_number is not null")
        .select("year", "iso_number")
        .distinct()
    )
