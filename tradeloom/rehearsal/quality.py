"""Declared rules checked over the tables; broken values are put in on purpose."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.operators import quality as Q
from tradeloom.plans.licensing import BY_NAME
from tradeloom.rehearsal.registry import Tables, query

LINE_CHECKS = {
    "quantity": "l_quantity between 1 and 45",
    "discount": "discount <= 0.08",
    "flag and status": "(l_returnflag = 'N' and l_linestatus is not null) or (l_returnflag in ('A', 'R') and l_linenumber <= 5)",
}


@query(
    "check_violations",
    """SELECT l_orderkey, l_linenumber, l_partkey, rule FROM lineitem, LATERAL (VALUES
      ('quantity', l_quantity BETWEEN 1 AND 45), ('discount', nullif(l_discount, 0.10) <= 0.08),
      ('flag and status', (l_returnflag = 'N' AND l_linestatus IS NOT NULL) OR (l_returnflag IN ('A', 'R') AND l_linenumber <= 5))) v(rule, ok)
    WHERE NOT ok""",
)
def check_violations(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("discount", F.nullif("l_discount", F.lit(0.10)))
    return Q.check_violations(rows, LINE_CHECKS, ["l_orderkey", "l_linenumber", "l_partkey"])


@query(
    "check_null_passes",
    """SELECT c_custkey, 'balance' AS rule FROM customer WHERE NOT (CASE WHEN c_nationkey > 4 THEN c_acctbal END > 0)
       UNION ALL SELECT c_custkey, 'segment' FROM customer WHERE NOT (nullif(c_mktsegment, 'BUILDING') IN ('HOUSEHOLD', 'MACHINERY'))""",
)
def check_null_passes(t: Tables) -> DataFrame:
    """A check on a missing value is unknown, and unknown passes."""
    rows = t.customer.select(
        "c_custkey",
        F.when(F.col("c_nationkey") > 4, F.col("c_acctbal")).alias("balance"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
    )
    checks = {"balance": "balance > 0", "segment": "segment in ('HOUSEHOLD', 'MACHINERY')"}
    return Q.check_violations(rows, checks, ["c_custkey"])


@query(
    "licensing_checks",
    """WITH rows AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'C' || o_orderkey ELSE 'B' || o_orderkey END AS batch_ref,
        CASE o_orderstatus WHEN 'F' THEN 'RELEASED' WHEN 'O' THEN 'STAGING' ELSE 'OPEN' END AS status,
        CASE WHEN o_orderkey % 6 <> 0 THEN o_orderdate END AS start_date,
        CASE WHEN o_orderkey % 5 = 1 THEN o_orderdate - INTERVAL 1 DAY WHEN o_orderkey % 5 = 2 THEN o_orderdate + INTERVAL 90 MINUTE
             WHEN o_orderkey % 6 <> 0 THEN o_orderdate END AS end_date FROM orders)
    SELECT id, 'status' AS rule FROM rows WHERE NOT (status IN ('RELEASED', 'STAGING'))
    UNION ALL SELECT id, 'dates' FROM rows WHERE NOT ((batch_ref LIKE 'C%' AND start_date IS NULL AND end_date IS NULL)
      OR (batch_ref NOT LIKE 'C%' AND start_date IS NOT NULL AND date_trunc('day', start_date) = start_date
          AND end_date IS NOT NULL AND date_trunc('day', end_date) = end_date AND start_date <= end_date))""",
)
def licensing_checks(t: Tables) -> DataFrame:
    """The rules of the batches table over orders."""
    key, date = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    rows = t.orders.select(
        key.alias("id"),
        F.concat(F.when(key % 3 == 0, F.lit("C")).otherwise(F.lit("B")), key).alias("batch_ref"),
        F.when(F.col("o_orderstatus") == "F", "RELEASED").when(F.col("o_orderstatus") == "O", "STAGING").otherwise("OPEN").alias("status"),
        F.when(key % 6 != 0, date).alias("start_date"),
        F.when(key % 5 == 1, date - F.expr("interval 1 day")).when(key % 5 == 2, date + F.expr("interval 90 minutes"))
        .when(key % 6 != 0, date).alias("end_date"),
    )
    return Q.check_violations(rows, BY_NAME["batches"].checks, ["id"])


@query(
    "fk_orphans",
    """SELECT l_suppkey, l_partkey, count(*) AS n_rows FROM (
      SELECT CASE WHEN l_linenumber <> 7 THEN l_suppkey END AS l_suppkey, l_partkey FROM lineitem) c
    WHERE l_suppkey IS NOT NULL AND NOT EXISTS (
      SELECT 1 FROM lineitem p WHERE p.l_returnflag <> 'N' AND p.l_suppkey = c.l_suppkey AND p.l_partkey = c.l_partkey)
    GROUP BY ALL""",
)
def fk_orphans(t: Tables) -> DataFrame:
    """A key of two columns into a parent that lacks some pairs; an incomplete key refers to nothing."""
    child = t.lineitem.select(F.when(F.col("l_linenumber") != 7, F.col("l_suppkey")).alias("l_suppkey"), "l_partkey")
    parent = t.lineitem.where("l_returnflag <> 'N'").select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p"))
    return Q.orphans(child, ["l_suppkey", "l_partkey"], parent, ["s", "p"])


@query(
    "pk_duplicates",
    """SELECT l_orderkey, line, count(*) AS n_rows FROM (SELECT l_orderkey, nullif(l_linenumber, 7) AS line FROM lineitem)
    GROUP BY ALL HAVING count(*) > 1 OR line IS NULL""",
)
def pk_duplicates(t: Tables) -> DataFrame:
    return Q.duplicate_keys(t.lineitem.select("l_orderkey", F.nullif("l_linenumber", F.lit(7)).alias("line")), ["l_orderkey", "line"])


@query(
    "not_null_violations",
    """SELECT o_orderkey, 'status' AS "column" FROM orders WHERE o_orderstatus = 'P'
       UNION ALL SELECT o_orderkey, 'priority' FROM orders WHERE o_orderpriority = '5-LOW'""",
)
def not_null_violations(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey",
        "o_totalprice",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
    )
    return Q.not_null_violations(rows, ["status", "priority", "o_totalprice"], ["o_orderkey"])


@query(
    "cast_failures",
    """SELECT o_orderkey, 'priority' AS "column", o_orderpriority AS value FROM orders WHERE o_orderpriority <> '1-URGENT'
       UNION ALL SELECT o_orderkey, 'day', strftime(o_orderdate, '%d of %m') FROM orders WHERE o_orderstatus = 'O'""",
)
def cast_failures(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(" 1 ")).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "dd 'of' MM"))
        .when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
    )
    return Q.cast_failures(rows, {"priority": "int", "day": "date"}, ["o_orderkey"])


@query(
    "table_report",
    """SELECT kind, rule, count(*) AS n_lines, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM (
      SELECT 'primary key' AS kind, 'l_orderkey, l_linenumber' AS rule, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
      UNION ALL SELECT 'check', 'quantity', 1 FROM lineitem WHERE l_quantity > 45
      UNION ALL SELECT 'not null', 'flag', 1 FROM lineitem WHERE l_returnflag = 'N'
      UNION ALL SELECT 'foreign key', 'l_suppkey -> supplier', count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey <> 3) GROUP BY l_suppkey
    ) GROUP BY ALL""",
)
def table_report(t: Tables) -> DataFrame:
    rules = Q.TableRules(
        "lineitem",
        "l_orderkey bigint, l_linenumber int, l_suppkey bigint, l_quantity double, flag string",
        ("l_orderkey", "l_linenumber"),
        ("flag",),
        {"quantity": "l_quantity <= 45"},
        (Q.ForeignKey(("l_suppkey",), "supplier", ("s_suppkey",)),),
    )
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", F.nullif("l_returnflag", F.lit("N")).alias("flag"))
    report = Q.table_report(rows, rules, {"supplier": t.supplier.where("s_nationkey <> 3")})
    return report.groupBy("kind", "rule").agg(F.count("*").alias("n_lines"), F.sum("n_rows").alias("n_rows"))
