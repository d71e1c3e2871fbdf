"""Projections, filters, joins, sets, aggregations and windows of the tariff and lifecycle plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions import text as X
from tradeloom.operators import keyed
from tradeloom.operators import lifecycle as L
from tradeloom.operators import registry as R
from tradeloom.plans import countries as C
from tradeloom.plans import datasets as D
from tradeloom.plans import tariff
from tradeloom.rehearsal.registry import Tables, query
from tradeloom.functions.text import joined_allowed
from tradeloom.session import broadcast_checked
from tradeloom.sources.upload import names_missing, names_reserved

# --- projections and filters -----------------------------------------------------------------------


@query(
    "declared_projection",
    """SELECT c_custkey, lower(c_name) AS c_name, c_acctbal * 2 AS c_acctbal, c_mktsegment FROM customer""",
)
def declared_projection(t: Tables) -> DataFrame:
    """Columns without a transform are copied."""
    columns = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    return L.standardise(t.customer, columns, {"c_name": "lower(c_name)", "c_acctbal": F.col("c_acctbal") * 2})


@query(
    "baci_rename",
    """SELECT l_linenumber AS year, l_partkey AS product_category, l_suppkey AS exporter, l_orderkey AS importer,
              l_extendedprice AS trade_flow_value, l_quantity AS quantity FROM lineitem""",
)
def baci_rename(t: Tables) -> DataFrame:
    short = {"t": "l_linenumber", "hs6": "l_partkey", "i": "l_suppkey", "j": "l_orderkey", "v": "l_extendedprice", "q": "l_quantity"}
    return D.rename_trade_flows(t.lineitem.select([F.col(c).alias(n) for n, c in short.items()]))


SEGMENT_CODES = {"BUILDING": "INDXSIK", "FURNITURE": "FRAXM", "HOUSEHOLD": "IND"}


def coded_customers(t: Tables) -> DataFrame:
    """Market segments play country codes: two aliases, one ignored code, and an empty one."""
    code = F.col("c_mktsegment")
    for segment, value in SEGMENT_CODES.items():
        code = F.when(F.col("c_mktsegment") == segment, F.lit(value)).otherwise(code)
    code = F.when(F.col("c_nationkey") != 3, code)
    return t.customer.select(F.col("c_custkey").cast("int").alias("cty_code"), code.alias("iso3_digit_alpha"))


CODED_SQL = """WITH coded AS (SELECT CAST(c_custkey AS INTEGER) AS cty_code, CASE WHEN c_nationkey <> 3 THEN
    CASE c_mktsegment WHEN 'BUILDING' THEN 'INDXSIK' WHEN 'FURNITURE' THEN 'FRAXM' WHEN 'HOUSEHOLD' THEN 'IND' ELSE c_mktsegment END
    END AS code FROM customer) """


@query(
    "case_remap",
    CODED_SQL
    + """SELECT cty_code, CASE code WHEN 'INDXSIK' THEN 'IND' WHEN 'FRAXM' THEN 'FRA' WHEN 'ITAF' THEN 'ITA' ELSE code END AS iso3
    FROM coded""",
)
def case_remap(t: Tables) -> DataFrame:
    return coded_customers(t).select("cty_code", C.remap_codes(F.col("iso3_digit_alpha")).alias("iso3"))


@query(
    "country_dictionary",
    CODED_SQL
    + """SELECT CASE code WHEN 'INDXSIK' THEN 'IND' WHEN 'FRAXM' THEN 'FRA' ELSE code END AS iso3, cty_code AS iso_number
    FROM coded WHERE code <> 'IND'""",
)
def country_dictionary(t: Tables) -> DataFrame:
    """The ignored code is removed before an alias turns into the same code."""
    return C.country_dictionary(coded_customers(t))


@query(
    "not_in_list",
    CODED_SQL + "SELECT cty_code, code FROM coded WHERE code NOT IN ('INDXSIK', 'MACHINERY')",
)
def not_in_list(t: Tables) -> DataFrame:
    """An empty code is not outside the list either."""
    return coded_customers(t).where(~F.col("iso3_digit_alpha").isin("INDXSIK", "MACHINERY")).select(
        "cty_code", F.col("iso3_digit_alpha").alias("code")
    )


SUDAN_SQL = """WITH pairs AS (SELECT l_orderkey, l_linenumber, l_partkey,
    CASE l_suppkey % 4 WHEN 0 THEN 231 WHEN 1 THEN 736 WHEN 2 THEN 729 END AS reporter,
    CASE l_linenumber % 4 WHEN 0 THEN 736 WHEN 1 THEN 729 WHEN 2 THEN 4 END AS partner FROM lineitem) """


def sudan_pairs(t: Tables) -> DataFrame:
    rest = F.col("l_suppkey") % 4
    line = F.col("l_linenumber") % 4
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(rest == 0, 231).when(rest == 1, 736).when(rest == 2, 729).alias("reporter"),
        F.when(line == 0, 736).when(line == 1, 729).when(line == 2, 4).alias("partner"),
    )


@query(
    "filter_before_remap",
    SUDAN_SQL
    + """SELECT reporter_code AS reporter, partner_code AS partner, count(*) AS n FROM (
      SELECT CASE WHEN reporter = 736 THEN 729 ELSE reporter END AS reporter_code,
             CASE WHEN partner = 736 THEN 729 ELSE partner END AS partner_code
      FROM pairs WHERE NOT (reporter = 231 AND partner = 729)) GROUP BY ALL""",
)
def filter_before_remap(t: Tables) -> DataFrame:
    """(231, 736) passes the filter and then becomes (231, 729)."""
    kept = sudan_pairs(t).where(~((F.col("reporter") == 231) & (F.col("partner") == 729)))
    return (
        kept.select(tariff.sudan(F.col("reporter")).alias("reporter"), tariff.sudan(F.col("partner")).alias("partner"))
        .groupBy("reporter", "partner")
        .agg(F.count("*").alias("n"))
    )


@query(
    "not_and_nulls",
    SUDAN_SQL + "SELECT l_orderkey, l_linenumber, l_partkey, reporter, partner FROM pairs WHERE NOT (reporter = 231 AND partner = 729)",
)
def not_and_nulls(t: Tables) -> DataFrame:
    return sudan_pairs(t).where(~((F.col("reporter") == 231) & (F.col("partner") == 729)))


@query("product_subset", "SELECT p_partkey, p_size AS product FROM part WHERE p_size IN (7, 12, 30)")
def product_subset(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.col("p_size").alias("product"))
    return tariff.restrict_products(rows, tariff.parse_products("7,12,30"))


@query(
    "resume_anti_join",
    """SELECT p_partkey, p_size AS product FROM part WHERE p_size IN (1, 2, 3, 4, 5, 6)
       AND p_size NOT IN (SELECT DISTINCT p_size FROM part WHERE p_retailprice > 1000 AND p_size > 3)""",
)
def resume_anti_join(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.col("p_size").alias("product"))
    done = t.part.where("p_retailprice > 1000 and p_size > 3").select(F.col("p_size").alias("product"))
    return tariff.restrict_products(rows, [1, 2, 3, 4, 5, 6], done)


@query(
    "coalesce_priority",
    """SELECT l_orderkey, l_linenumber, l_partkey, coalesce(nullif(l_discount, 0.0), nullif(l_tax, 0.0), l_quantity) AS rate FROM lineitem""",
)
def coalesce_priority(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.coalesce(F.nullif("l_discount", F.lit(0.0)), F.nullif("l_tax", F.lit(0.0)), "l_quantity").alias("rate"),
    )


STATES = ["uploading", "uploaded", "verified", "processing_store", "processing_export", "completed", "failed", ""]


@query(
    "state_progress",
    """SELECT event_id, CAST([10, 20, 30, 40, 70, 100, 100, 0][event_id % 8 + 1] AS INTEGER) AS progress FROM events""",
)
def state_progress(t: Tables) -> DataFrame:
    states = F.array(*map(F.lit, STATES))
    return t.events.select("event_id", R.progress(F.element_at(states, (F.col("event_id") % 8 + 1).cast("int"))).alias("progress"))


# --- joins -----------------------------------------------------------------------------------------


@query(
    "left_join_null_reject",
    """SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
       LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') r ON r_regionkey = n_regionkey WHERE r_name IS NOT NULL""",
)
def left_join_null_reject(t: Tables) -> DataFrame:
    """The filter on the outer side makes both joins inner ones; the small sides are checked before a broadcast."""
    nation = broadcast_checked(t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey"))
    region = broadcast_checked(t.region.where("r_name <> 'ASIA'").select(F.col("r_regionkey").alias("n_regionkey"), "r_name"))
    joined = t.supplier.join(nation, "s_nationkey", "left").join(region, "n_regionkey", "left")
    return joined.where("r_name is not null").select("s_suppkey", "n_name", "r_name")


@query(
    "double_dim_left_join",
    """WITH members AS (SELECT n_nationkey, 1995 + n_nationkey % 4 AS since, n_name FROM nation WHERE n_nationkey < 12)
    SELECT o_orderkey, c.n_name AS customer_member, n.n_name AS order_member
    FROM orders JOIN customer ON c_custkey = o_custkey
    LEFT JOIN members c ON c.since = year(o_orderdate) AND c.n_nationkey = c_nationkey
    LEFT JOIN members n ON n.since = year(o_orderdate) AND n.n_nationkey = o_orderkey % 25""",
)
def double_dim_left_join(t: Tables) -> DataFrame:
    """Two lookups in one small relation under different keys."""
    members = broadcast_checked(
        t.nation.where("n_nationkey < 12").select(
            (F.col("n_nationkey") % 4 + 1995).alias("year"), F.col("n_nationkey").alias("key"), "n_name"
        )
    )
    customer = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("customer_key"))
    orders = t.orders.select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"), (F.col("o_orderkey") % 25).cast("int").alias("order_key")
    )
    as_dim = lambda key, name: members.select("year", F.col("key").alias(key), F.col("n_name").alias(name))
    return (
        orders.join(customer, "o_custkey")
        .join(as_dim("customer_key", "customer_member"), ["year", "customer_key"], "left")
        .join(as_dim("order_key", "order_member"), ["year", "order_key"], "left")
        .select("o_orderkey", "customer_member", "order_member")
    )


@query(
    "full_outer_pivot",
    """WITH r AS (SELECT l_partkey, l_suppkey, l_returnflag, max(l_quantity) AS q FROM lineitem GROUP BY ALL)
    SELECT l_partkey, l_suppkey, a.q AS app_rate, m.q AS mfn_rate
    FROM (SELECT * FROM r WHERE l_returnflag = 'A') a FULL JOIN (SELECT * FROM r WHERE l_returnflag = 'R') m USING (l_partkey, l_suppkey)""",
)
def full_outer_pivot(t: Tables) -> DataFrame:
    """Rows to columns: the full join of two filtered copies is one aggregation over one scan."""
    quantity = F.col("l_quantity")
    return (
        t.lineitem.where(F.col("l_returnflag").isin("A", "R"))
        .groupBy("l_partkey", "l_suppkey")
        .agg(
            F.max(F.when(F.col("l_returnflag") == "A", quantity)).alias("app_rate"),
            F.max(F.when(F.col("l_returnflag") == "R", quantity)).alias("mfn_rate"),
        )
    )


@query(
    "world_expand",
    """SELECT DISTINCT p_size AS product, s_nationkey + 1 AS reporter, n_nationkey + 1 AS partner, rate FROM (
      SELECT p_size, s_nationkey, max(l_quantity) AS rate FROM lineitem JOIN part ON p_partkey = l_partkey
      JOIN supplier ON s_suppkey = l_suppkey WHERE l_linenumber = 1 GROUP BY ALL), nation WHERE s_nationkey <> n_nationkey""",
)
def world_expand(t: Tables) -> DataFrame:
    """A world rate for every other listed partner: the list arrives as an array, so no join is needed."""
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("product"))
    supplier = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), (F.col("s_nationkey") + 1).alias("reporter"))
    partners = tariff.number_array(t.nation.select((F.col("n_nationkey") + 1).alias("iso_num")), "iso_num")
    return (
        t.lineitem.where("l_linenumber = 1")
        .select("l_partkey", "l_suppkey", "l_quantity")
        .join(part, "l_partkey")
        .join(supplier, "l_suppkey")
        .groupBy("product", "reporter")
        .agg(F.max("l_quantity").alias("rate"))
        .select("product", "reporter", F.explode(partners).alias("partner"), "rate")
        .where("reporter <> partner")
    )


@query(
    "fanout_join",
    """WITH rates AS (SELECT year(o_orderdate) AS year, c_nationkey + 1 AS partner, max(o_totalprice) AS rate
                      FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
    members AS (SELECT 1995 + i AS year, n_nationkey + 1 AS iso_number FROM nation, range(0, 7) r(i) WHERE n_nationkey % 4 <= i)
    SELECT CAST(rates.year AS INTEGER) AS year, iso_number AS reporter, partner, rate FROM rates JOIN members USING (year)
    WHERE partner <> iso_number""",
)
def fanout_join(t: Tables) -> DataFrame:
    """Every rate of a year for every member of that year, except towards itself."""
    customer = t.customer.select(F.col("c_custkey").alias("o_custkey"), (F.col("c_nationkey") + 1).alias("partner"))
    rates = (
        t.orders.select("o_custkey", F.year("o_orderdate").alias("year"), "o_totalprice")
        .join(customer, "o_custkey")
        .groupBy("year", "partner")
        .agg(F.max("o_totalprice").alias("rate"))
    )
    since = F.col("n_nationkey") % 4 + 1995
    members = broadcast_checked(
        t.nation.select(F.explode(F.sequence(since, F.lit(2001))).alias("year"), (F.col("n_nationkey") + 1).alias("reporter"))
    )
    return rates.join(members, "year").where("partner <> reporter").select("year", "reporter", "partner", "rate")


@query(
    "unpivot_years",
    """SELECT l_orderkey, l_linenumber, l_partkey, v.year, v.value FROM lineitem,
       LATERAL (VALUES (1995, l_quantity), (1996, nullif(l_discount, 0.0)), (2001, l_tax)) v(year, value)""",
)
def unpivot_years(t: Tables) -> DataFrame:
    """Columns named like years become rows; empty cells stay."""
    wide = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
        F.col("l_quantity").alias("1995"), F.nullif("l_discount", F.lit(0.0)).alias("1996"), F.col("l_tax").alias("2001"),
    )
    return L.unpivot_years(wide, ["l_orderkey", "l_linenumber", "l_partkey"], "value")


# --- aggregation, distinct and sets ----------------------------------------------------------------


@query(
    "tariff_rollup",
    """SELECT p_size AS product, s_nationkey AS reporter, CAST(year(l_shipdate) AS INTEGER) AS year,
              floor(avg(l_quantity) * 1000 + 0.5) / 1000 AS avg_quantity, floor(avg(l_discount * 100) * 1000 + 0.5) / 1000 AS avg_discount
    FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL""",
)
def tariff_rollup(t: Tables) -> DataFrame:
    """Means rounded half up to three digits."""
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("product"))
    supplier = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("reporter"))
    means = (
        t.lineitem.select("l_partkey", "l_suppkey", F.year("l_shipdate").alias("year"), "l_quantity", "l_discount")
        .join(part, "l_partkey")
        .join(supplier, "l_suppkey")
        .groupBy("product", "reporter", "year")
        .agg(F.avg("l_quantity").alias("q"), F.avg(F.col("l_discount") * 100).alias("d"))
    )
    dtype = means.schema["q"].dataType
    return means.select(
        "product", "reporter", "year",
        tariff.round_half_up(F.col("q"), 3, dtype).alias("avg_quantity"),
        tariff.round_half_up(F.col("d"), 3, dtype).alias("avg_discount"),
    )


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, nullif(l_linestatus, 'O') AS status FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_suppkey", "l_returnflag", F.nullif("l_linestatus", F.lit("O")).alias("status")).distinct()


@query("distinct_products", "SELECT DISTINCT p_size AS product FROM part WHERE p_size IS NOT NULL")
def distinct_products(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_size").alias("product")).distinct().orderBy("product")


@query(
    "latest_revision",
    """SELECT reporter, product, bound_rate FROM (
      SELECT s_nationkey AS reporter, p_size AS product, l_extendedprice AS bound_rate,
        row_number() OVER (PARTITION BY s_nationkey, p_size ORDER BY
          CASE WHEN l_linenumber < 7 THEN l_linenumber END DESC NULLS FIRST, l_orderkey * 1000000 + l_partkey * 10 + l_linenumber, l_extendedprice) AS rn
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey) WHERE rn = 1""",
)
def latest_revision(t: Tables) -> DataFrame:
    """The line number plays the revision; line 7 has none and sorts first."""
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("product"))
    supplier = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("reporter"))
    rows = (
        t.lineitem.join(part, "l_partkey")
        .join(supplier, "l_suppkey")
        .select(
            "reporter",
            "product",
            F.when(F.col("l_linenumber") < 7, F.concat(F.lit("H"), "l_linenumber")).alias("nomen_code"),
            F.col("l_extendedprice").alias("bound_rate"),
            F.struct(F.col("l_orderkey") * 1000000 + F.col("l_partkey") * 10 + F.col("l_linenumber"), "l_extendedprice").alias("id"),
        )
    )
    return keyed.latest_revision(rows).select("reporter", "product", "bound_rate")


@query(
    "latest_completed",
    """SELECT user_id, event_id AS id FROM (SELECT user_id, event_id,
      row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN value > 5 THEN ts END DESC NULLS FIRST, event_id DESC) AS rn
      FROM events WHERE event_type = 'purchase') WHERE rn = 1""",
)
def latest_completed(t: Tables) -> DataFrame:
    versions = t.events.select(
        "user_id",
        F.col("event_id").alias("id"),
        F.when(F.col("event_type") == "purchase", F.lit("completed")).otherwise(F.lit("failed")).alias("state"),
        F.when(F.col("value") > 5, F.col("ts")).alias("processed_at"),
    )
    return R.latest_completed(versions, ["user_id"]).select("user_id", "id")


@query(
    "union_distinct",
    """SELECT l_partkey AS part, l_suppkey AS supplier, 'EUN' AS code FROM lineitem WHERE l_returnflag = 'A'
       UNION SELECT l_partkey, l_suppkey, CASE WHEN l_linenumber < 4 THEN 'EUN' END FROM lineitem WHERE l_returnflag = 'R'""",
)
def union_distinct(t: Tables) -> DataFrame:
    first = t.lineitem.where("l_returnflag = 'A'").select(
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.lit("EUN").alias("code")
    )
    second = t.lineitem.where("l_returnflag = 'R'").select(
        F.col("l_suppkey").alias("supplier"),
        F.col("l_partkey").alias("part"),
        F.when(F.col("l_linenumber") < 4, F.lit("EUN")).alias("code"),
    )
    return first.unionByName(second).distinct()


@query(
    "schema_missing_columns",
    """WITH columns AS (SELECT DISTINCT user_id, event_type FROM events), newest AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-20')
    SELECT user_id AS upload, event_type AS missing FROM columns EXCEPT SELECT user_id, event_type FROM newest""",
)
def schema_missing_columns(t: Tables) -> DataFrame:
    """A user plays an uploaded dataset, an event type one of its columns: which did the latest version lose?"""
    newest = F.when(F.col("ts") >= F.lit("2024-01-20").cast("timestamp"), F.col("event_type"))
    names = t.events.groupBy(F.col("user_id").alias("upload")).agg(
        F.collect_set("event_type").alias("latest"), F.collect_set(newest).alias("uploaded")
    )
    return names.select("upload", F.explode(names_missing(F.col("latest"), F.col("uploaded"))).alias("missing"))


@query(
    "reserved_columns",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'id' WHEN 'view' THEN 'datafile_created' END AS reserved FROM events
       WHERE event_type IN ('click', 'view')""",
)
def reserved_columns(t: Tables) -> DataFrame:
    first = (
        F.when(F.col("event_type") == "click", F.lit("id"))
        .when(F.col("event_type") == "view", F.lit("datafile_created"))
        .otherwise(F.col("event_type"))
    )
    header = F.array(first, F.lit("value"), F.lit("props"))
    return t.events.select("event_id", F.explode(names_reserved(header)).alias("reserved"))


@query(
    "taxonomy_intersect",
    """SELECT doc_id, array_to_string(list_sort(list_intersect(list_distinct(string_split(lower(text), ' ')), ['the', 'and', 'der', 'la', 'de'])), ';') AS taxonomy
    FROM documents""",
)
def taxonomy_intersect(t: Tables) -> DataFrame:
    """Allowed values present in a document, sorted and joined."""
    words = F.split(F.lower("text"), " ")
    return t.documents.select("doc_id", joined_allowed(words, ["the", "and", "der", "la", "de"]).alias("taxonomy"))


@query(
    "year_series",
    """SELECT CAST(y.year AS INTEGER) AS year, c_custkey, count(o_orderkey) AS n_orders
    FROM (SELECT c_custkey FROM customer) c CROSS JOIN range(1994, 2003) y(year)
    LEFT JOIN orders ON o_custkey = c_custkey AND year(o_orderdate) = y.year GROUP BY ALL""",
)
def year_series(t: Tables) -> DataFrame:
    """Every year of every customer, also those without an order."""
    years = t.customer.select("c_custkey", F.explode(F.sequence(F.lit(1994), F.lit(2002))).alias("year"))
    counts = (
        t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year"))
        .agg(F.count("*").alias("n_orders"))
    )
    return years.join(counts, ["c_custkey", "year"], "left").fillna(0, ["n_orders"])


# --- windows ---------------------------------------------------------------------------------------

STEPS_SQL = """WITH rows AS (SELECT l_suppkey AS supplier, CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INTEGER) AS step,
    CASE WHEN l_quantity > 47 THEN l_quantity END AS rate, CASE WHEN l_discount > 0.09 THEN l_extendedprice END AS price FROM lineitem),
  counted AS (SELECT *, count(rate) OVER k AS rate_group, count(price) OVER k AS price_group FROM rows
    WINDOW k AS (PARTITION BY supplier ORDER BY step)) """


def steps(t: Tables) -> DataFrame:
    """Many lines per supplier and month, most without a value."""
    return t.lineitem.select(
        F.col("l_suppkey").alias("supplier"),
        (F.year("l_shipdate") * 12 + F.month("l_shipdate")).alias("step"),
        F.when(F.col("l_quantity") > 47, F.col("l_quantity")).alias("rate"),
        F.when(F.col("l_discount") > 0.09, F.col("l_extendedprice")).alias("price"),
    )


@query("ffill_groups", STEPS_SQL + "SELECT DISTINCT supplier, step, rate_group FROM counted")
def ffill_groups(t: Tables) -> DataFrame:
    return keyed.running_groups(steps(t), ["supplier"], "step", "rate").select("supplier", "step", "rate_group")


@query(
    "forward_fill",
    STEPS_SQL
    + """SELECT DISTINCT supplier, step, first_value(rate) OVER (PARTITION BY supplier, rate_group ORDER BY step, rate NULLS LAST) AS rate_filled
    FROM counted""",
)
def forward_fill(t: Tables) -> DataFrame:
    return keyed.forward_fill(steps(t), ["supplier"], "step", "rate").select("supplier", "step", "rate_filled")


@query(
    "forward_fill_fused",
    STEPS_SQL
    + """SELECT DISTINCT supplier, step, first_value(rate) OVER (PARTITION BY supplier, rate_group ORDER BY step, rate NULLS LAST) AS rate_filled,
      first_value(price) OVER (PARTITION BY supplier, price_group ORDER BY step, price NULLS LAST) AS price_filled FROM counted""",
)
def forward_fill_fused(t: Tables) -> DataFrame:
    filled = keyed.forward_fill_fused(steps(t), ["supplier"], "step", ["rate", "price"])
    return filled.select("supplier", "step", "rate_filled", "price_filled")


@query(
    "window_avg_before_distinct",
    """SELECT DISTINCT supplier, year, rate, floor(avg(rate) OVER (PARTITION BY year) * 1000000 + 0.5) / 1000000 AS world_average FROM (
      SELECT l_suppkey AS supplier, CAST(year(l_shipdate) AS INTEGER) AS year, CASE WHEN l_quantity > 10 THEN l_quantity END AS rate FROM lineitem)""",
)
def window_avg_before_distinct(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.col("l_suppkey").alias("supplier"),
        F.year("l_shipdate").alias("year"),
        F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("rate"),
    )
    means = keyed.distinct_with_group_mean(rows, ["year"], "rate", "world_average")
    dtype = means.schema["world_average"].dataType
    return means.withColumn("world_average", tariff.round_half_up(F.col("world_average"), 6, dtype))


# --- identifiers -----------------------------------------------------------------------------------


@query(
    "valid_identifiers",
    r"""SELECT p_partkey, regexp_full_match(name, '[a-z][a-z0-9_]*') AS is_column, regexp_full_match(dataset, '[a-zA-Z0-9_\.]+') AS is_dataset,
        replace(lower(dataset), '.', '_') AS table_name
    FROM (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN replace(p_name, ' ', '_') ELSE p_name END AS name,
                 CASE WHEN p_size % 3 = 0 THEN p_brand ELSE p_type || '.' || p_size END AS dataset FROM part)""",
)
def valid_identifiers(t: Tables) -> DataFrame:
    name = F.when(F.col("p_size") % 2 == 0, F.replace("p_name", F.lit(" "), F.lit("_"))).otherwise(F.col("p_name"))
    dataset = F.when(F.col("p_size") % 3 == 0, F.col("p_brand")).otherwise(F.concat_ws(".", "p_type", "p_size"))
    return t.part.select(
        "p_partkey",
        X.is_identifier(name).alias("is_column"),
        X.is_dataset_name(dataset).alias("is_dataset"),
        X.normalised_name(dataset).alias("table_name"),
    )
