"""Serving reads over orders and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.operators import serving as S
from tradeloom.rehearsal.registry import Tables, query


@query(
    "point_lookup_normalised",
    """SELECT c_custkey AS id, postcode FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'AB' || c_nationkey || ' 1x' ELSE 'ab' || c_nationkey || '1X' END AS postcode
       FROM customer) WHERE lower(replace(postcode, ' ', '')) = 'ab71x' ORDER BY id LIMIT 1""",
)
def point_lookup_normalised(t: Tables) -> DataFrame:
    nation = F.col("c_nationkey")
    postcode = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("AB"), nation, F.lit(" 1x"))).otherwise(
        F.concat(F.lit("ab"), nation, F.lit("1X"))
    )
    return S.lookup_postcode(t.customer.select(F.col("c_custkey").alias("id"), postcode.alias("postcode")), "Ab7 1X")


@query(
    "keyset_page",
    """WITH reach AS (SELECT l_orderkey * 8 + l_linenumber AS id, min(l_partkey) AS part FROM lineitem GROUP BY ALL HAVING id >= 5000 ORDER BY id LIMIT 1001)
    SELECT id, part, (SELECT max(id) FROM reach) AS next_id FROM reach WHERE id < (SELECT max(id) FROM reach)""",
)
def keyset_page(t: Tables) -> DataFrame:
    """One page of the default size from id 5000 on."""
    rows = t.lineitem.groupBy((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id")).agg(F.min("l_partkey").alias("part"))
    return S.keyset_page(rows, 5000)


@query(
    "keyset_last_page",
    "SELECT o_orderkey AS id, CAST(NULL AS BIGINT) AS next_id FROM orders WHERE o_orderkey >= (SELECT max(o_orderkey) - 9 FROM orders)",
)
def keyset_last_page(t: Tables) -> DataFrame:
    start = t.orders.agg(F.max("o_orderkey") - 9).first()[0]
    return S.keyset_page(t.orders.select(F.col("o_orderkey").alias("id")), start)


@query(
    "assign_pages",
    "SELECT id, CAST((row_number() OVER (ORDER BY id) - 1) // 1000 AS BIGINT) AS page FROM (SELECT DISTINCT l_orderkey * 8 + l_linenumber AS id FROM lineitem)",
)
def assign_pages(t: Tables) -> DataFrame:
    """Pages of all rows at once; narrow id ranges make several levels of totals even here."""
    rows = t.lineitem.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id")).distinct()
    return S.assign_pages(rows, width=100)


@query(
    "records_json",
    """SELECT '{"cCustkey":' || c_custkey || ',"cName":"' || c_name || '","marketSegment":' ||
      CASE WHEN c_mktsegment = 'BUILDING' THEN 'null' ELSE '"' || c_mktsegment || '"' END || '}' AS record FROM customer""",
)
def records_json(t: Tables) -> DataFrame:
    rows = t.customer.select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("market_segment"), F.lit("f.csv").alias("datafile_created")
    )
    return S.records_json(rows)


@query(
    "tabular_json",
    """SELECT '["' || c_custkey || '","' || c_name || '",' || CASE WHEN c_mktsegment = 'BUILDING' THEN 'null' ELSE '"' || c_mktsegment || '"' END || ']' AS record
    FROM customer""",
)
def tabular_json(t: Tables) -> DataFrame:
    return S.tabular_json(t.customer.select("c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")))


@query(
    "servable_tables",
    """SELECT event_id, name FROM (SELECT event_id, CASE event_type WHEN 'click' THEN 'public' WHEN 'view' THEN 'operations' ELSE event_type END AS name FROM events)
       WHERE name NOT IN ('public', 'operations')""",
)
def servable_tables(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    name = F.when(kind == "click", "public").when(kind == "view", "operations").otherwise(kind)
    return t.events.select("event_id", name.alias("name")).where(S.is_servable(F.col("name")))
