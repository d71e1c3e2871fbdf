"""Source jobs and link harvesting over order lines, customers and web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.operators import lifecycle as L
from tradeloom.plans import accounts, datasets, harvest
from tradeloom.rehearsal.registry import Tables, query
from tradeloom.sources.archives import tab_fields


@query(
    "exporters_l1",
    """SELECT o_orderkey, date_trunc('month', o_orderdate)::TIMESTAMP AS datetime, lower(trim(' ' || c_name || ' ')) AS company_name,
      nullif(lower(trim(concat_ws(' ', 'Unit ' || c_nationkey, '', c_mktsegment, '', ''))), '') AS address, 'AB' || c_nationkey || 'XY' AS postcode,
      CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_custkey || '|' || o_orderkey END AS codes
    FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'F'""",
)
def exporters_l1(t: Tables) -> DataFrame:
    """Orders as tab-separated export lines: finished ones lack the codes field, pending ones have an empty one."""
    customer = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", "c_mktsegment")
    codes = (
        F.when(F.col("o_orderstatus") == "O", F.concat_ws("\t", "o_custkey", F.lit(""), "o_orderkey"))
        .when(F.col("o_orderstatus") == "P", F.lit(""))
    )
    line = F.concat_ws(
        "\t",
        F.date_format("o_orderdate", "yyyyMM"), F.lit("1"), F.concat(F.lit(' "'), "c_name", F.lit('" ')),
        F.concat(F.lit("Unit "), "c_nationkey"), F.lit(""), "c_mktsegment", F.lit(""), F.lit(""),
        F.concat(F.lit("ab"), "c_nationkey", F.lit(" xy")), codes,
    )
    lines = t.orders.join(customer, "o_custkey").select("o_orderkey", line.alias("line"))
    l0 = tab_fields(lines, datasets.EXPORTER_FIELDS.split(), "export_item_codes")
    spec = datasets.EXPORTERS
    l1 = L.standardise(l0, ["o_orderkey", *spec.l1_columns], spec.transforms())
    return l1.withColumn("codes", F.array_join("export_item_codes", "|")).drop("export_item_codes")


# Columns of the postcode directory that are copied as they are.
COPIED = [c for c in datasets.POSTCODE_DIRECTORY.l1_columns if c not in ("pcd", "dointr", "doterm", "ctry", "publication_date")]


@query(
    "postcode_l1",
    """SELECT c_custkey, 'AB' || c_custkey AS pcd, CAST(make_date(1980 + c_nationkey, 1 + c_nationkey % 12, 1) AS DATE) AS dointr,
      CASE WHEN c_nationkey % 2 = 0 THEN make_date(2010, 5, 1) END AS doterm, c_mktsegment AS ctry, DATE '2019-05-01' AS publication_date, """
    + ", ".join(f"""'{c}' || c_nationkey AS "{c}\"""" for c in COPIED)
    + " FROM customer",
)
def postcode_l1(t: Tables) -> DataFrame:
    """Month codes become dates, everything else is copied."""
    spec = datasets.POSTCODE_DIRECTORY
    nation = F.col("c_nationkey")
    known = {
        "pcd": F.concat(F.lit("AB"), "c_custkey"),
        "dointr": F.concat(nation + 1980, F.lpad((nation % 12 + 1).cast("string"), 2, "0")),
        "doterm": F.when(nation % 2 == 0, F.lit("201005")),
        "ctry": F.col("c_mktsegment"),
        "publication_date": F.lit("2019-05-01").cast("date"),
    }
    l0 = t.customer.select("c_custkey", *[known.get(c, F.concat(F.lit(c), nation)).alias(c) for c in spec.l0_columns])
    return L.standardise(l0, ["c_custkey", *spec.l1_columns], spec.transforms())


FACTS_SQL = """WITH facts AS (
    SELECT 'Prod1_1_' || l_orderkey || '_20200331.html' AS doc, l_orderkey,
      row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS position,
      [ 'Debtors', 'PropertyPlantEquipment', 'FixedAssets', 'Debtors', 'EntityCurrentLegalOrRegisteredName', 'EntityDormant', 'Equity'][l_linenumber] AS tag,
      CAST(1995 + l_suppkey % 2 AS VARCHAR) AS context,
      CASE WHEN l_linenumber = 5 THEN 'Part ' || l_partkey WHEN l_linenumber = 6 THEN CASE WHEN l_returnflag = 'A' THEN 'true' WHEN l_returnflag = 'R' THEN 'false' ELSE 'unknown' END
           WHEN l_returnflag = 'N' THEN ' - ' ELSE CAST(l_partkey AS VARCHAR) END AS text,
      CASE WHEN l_returnflag = 'A' THEN -1 ELSE 1 END AS sign, l_linenumber, l_returnflag
    FROM lineitem),
  amounts AS (SELECT *, CASE WHEN l_returnflag <> 'N' THEN CAST(text AS DOUBLE) * sign * 1000 END AS amount,
      CASE tag WHEN 'Debtors' THEN 'debtors' WHEN 'Equity' THEN 'shareholder_funds' ELSE 'tangible_fixed_assets' END AS attribute,
      CASE tag WHEN 'PropertyPlantEquipment' THEN 2 ELSE 0 END AS priority FROM facts WHERE l_linenumber NOT IN (5, 6)),
  picked AS (SELECT *, row_number() OVER (PARTITION BY doc, context, attribute ORDER BY amount IS NULL, priority, position) AS rn FROM amounts),
  periods AS (SELECT doc, context, max(CASE WHEN attribute = 'debtors' THEN amount END) AS debtors,
      max(CASE WHEN attribute = 'tangible_fixed_assets' THEN amount END) AS tangible_fixed_assets,
      max(CASE WHEN attribute = 'shareholder_funds' THEN amount END) AS shareholder_funds FROM picked WHERE rn = 1 GROUP BY ALL),
  general AS (SELECT doc, tag, text, row_number() OVER (PARTITION BY doc, tag ORDER BY position DESC) AS rn FROM facts WHERE l_linenumber IN (5, 6))
"""


@query(
    "xbrl_facts_pivot",
    FACTS_SQL
    + """SELECT d.l_orderkey AS order_key, p.context AS year, debtors, tangible_fixed_assets, shareholder_funds, n.text AS legal_name,
      CASE b.text WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END AS dormant
    FROM (SELECT DISTINCT doc, l_orderkey FROM facts) d LEFT JOIN periods p USING (doc)
    LEFT JOIN (SELECT * FROM general WHERE rn = 1 AND tag = 'EntityCurrentLegalOrRegisteredName') n USING (doc)
    LEFT JOIN (SELECT * FROM general WHERE rn = 1 AND tag = 'EntityDormant') b USING (doc)""",
)
def xbrl_facts_pivot(t: Tables) -> DataFrame:
    """An order is a document, a line a tagged element: the line number chooses the tag, the supplier the period."""
    line = F.col("l_linenumber")
    flag = F.col("l_returnflag")
    tags = ["Debtors", "PropertyPlantEquipment", "FixedAssets", "Debtors", "EntityCurrentLegalOrRegisteredName", "EntityDormant", "Equity"]
    dormant = F.when(flag == "A", "true").when(flag == "R", "false").otherwise("unknown")
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    text = (
        F.when(line == 5, F.concat(F.lit("Part "), "l_partkey")).when(line == 6, dormant).when(flag == "N", " - ")
        .otherwise(F.col("l_partkey").cast("string"))
    )
    doc = F.concat(F.lit("Prod1_1_"), "l_orderkey", F.lit("_20200331.html"))
    none = F.lit(None).cast("string")
    elements = t.lineitem.select(
        doc.alias("doc"), F.lit("element").alias("kind"), order.alias("position"), F.lit("nonFraction").alias("element"),
        F.element_at(F.array(*map(F.lit, tags)), line).alias("tag"), (F.col("l_suppkey") % 2 + 1995).cast("string").alias("context"),
        F.when(flag == "A", F.lit("-")).alias("sign"), F.lit("3").alias("scale"), text.alias("text"),
        none.alias("period_start"), none.alias("period_end"),
    )
    years = F.explode(F.array(F.lit("1995"), F.lit("1996")))
    orders = t.lineitem.groupBy("l_orderkey").agg(F.min(order).alias("position"))  # numbers sort faster than names
    contexts = orders.select(doc.alias("doc"), "position", years.alias("tag")).select(
        "doc", "position", F.lit("context").alias("kind"), "tag", F.concat("tag", F.lit("-01-01")).alias("period_start"),
        F.concat("tag", F.lit("-12-31")).alias("period_end"),
    )
    rows = accounts.accounts_rows(elements.unionByName(contexts, allowMissingColumns=True), accounts.rule_table(t.spark))
    return rows.select(
        F.col("company_id").cast("bigint").alias("order_key"),
        F.year("period_end").cast("string").alias("year"),
        *[F.col(c).cast("double").alias(c) for c in ("debtors", "tangible_fixed_assets", "shareholder_funds")],
        F.col("entity_current_legal_name").alias("legal_name"),
        F.col("company_dormant").alias("dormant"),
    )


# --- links and freshness ---------------------------------------------------------------------------


@query(
    "harvest_links",
    r"""WITH p AS (SELECT page_id, html, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS host,
      regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') AS folder FROM pages),
    own AS (SELECT page_id, host, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']([^"'']+)["'']', 1)) AS href FROM p),
    added AS (
      SELECT page_id, '/Plain' AS href, host || '/Plain' AS link FROM p
      UNION ALL SELECT page_id, '/Q?a=1&b=2', host || '/Q?a=1&b=2' FROM p
      UNION ALL SELECT page_id, '../Up', CASE WHEN folder = host || '/' THEN folder ELSE regexp_replace(folder, '[^/]+/$', '') END || 'Up' FROM p
      UNION ALL SELECT page_id, '/a/./b/../Down', host || '/a/Down' FROM p)
    SELECT page_id, href, link, count(*) AS n FROM (
      SELECT page_id, href, host || href AS link FROM own WHERE regexp_matches(href, '^/[a-zA-Z]+$') UNION ALL SELECT * FROM added)
    GROUP BY ALL""",
)
def harvest_links(t: Tables) -> DataFrame:
    """Each page gets an unquoted link, one with a character reference, two with dot segments, and one in a comment."""
    added = (
        """<!-- <a href="/Hidden">no</a> --><a class=x href=/Plain>x</a><a href="/Q?a=1&amp;b=2">x</a>"""
        """<a data-href="/Other" href='../Up'>x</a><a href="/a/./b/../Down">x</a>"""
    )
    pages = t.pages.select("page_id", "url", F.concat(F.lit(added), "html").alias("html"))
    links = harvest.harvest_links(pages, r"(?:/[a-zA-Z]+|/Q\?a=1&b=2|\.\./Up|/a/\./b/\.\./Down)$")
    return links.groupBy("page_id", "href", "link").agg(F.count("*").alias("n"))


@query(
    "pages_without_links",
    r"""SELECT page_id FROM pages WHERE NOT regexp_matches(html, '(?i)<a\s[^>]*?href\s*=\s*["'']/[Tt]h[^"'']*["'']')""",
)
def pages_without_links(t: Tables) -> DataFrame:
    pages = t.pages.select("page_id", "url", "html")
    return harvest.pages_without_links(pages, harvest.harvest_links(pages, "/[Tt]h"), "page_id")


@query(
    "needs_refresh",
    """WITH online AS (SELECT user_id, max(CAST(ts AS DATE)) AS online_date FROM events WHERE event_type = 'view' GROUP BY ALL),
    stored AS (SELECT user_id, max(CAST(ts AS DATE)) AS stored_date FROM events WHERE event_type = 'purchase' AND value > 10 GROUP BY ALL)
    SELECT user_id, online_date, stored_date, stored_date IS NULL OR online_date - stored_date >= 1 AS due FROM online LEFT JOIN stored USING (user_id)""",
)
def needs_refresh(t: Tables) -> DataFrame:
    dated = t.events.select("user_id", F.to_date("ts").alias("date"), "event_type", "value")
    return harvest.needs_refresh(
        dated.where("event_type = 'view'"), dated.where("event_type = 'purchase' and value > 10"), ["user_id"]
    )


@query(
    "latest_by_date",
    """SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, o_orderkey AS name FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn FROM orders
      WHERE o_orderstatus <> 'P') WHERE rn = 1""",
)
def latest_by_date(t: Tables) -> DataFrame:
    day = F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate"))
    files = t.orders.select("o_custkey", day.alias("date"), F.col("o_orderkey").alias("name"))
    return harvest.latest_by_date(files, ["o_custkey"])
