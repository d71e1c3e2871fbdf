"""Finding newer source files: links on pages, dates in names, and whether a fetch is due."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.text import name_date

REFRESH_DAYS = 1

# Comments, which hold no links, and an anchor's target in double quotes, single quotes or none.
COMMENT = r"(?s)<!--.*?(?:-->|$)"
ANCHOR = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""

# Character references in link targets; the ampersand itself comes last, so nothing is decoded twice.
ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&#x27;", "'"), ("&#34;", '"'),
    ("&#x22;", '"'), ("&#47;", "/"), ("&#x2F;", "/"), ("&#38;", "&"), ("&#x26;", "&"), ("&amp;", "&"),
]


def without_dot_segments(url: Column) -> Column:
    """``.`` and ``..`` in the path of an absolute URL are followed; above the root there is nothing."""
    host = F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    tail = F.regexp_extract(url, r"([?#].*)$", 1)
    parts = F.split(path, "/")
    folded = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda kept, part: F.when(part == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(part == ".", kept)
        .otherwise(F.concat(kept, F.array(part))),
    )
    folder = F.when(path.rlike(r"/\.\.?$") & (F.size(folded) > 0), F.lit("/")).otherwise(F.lit(""))
    folded = F.concat(F.lit("/"), F.array_join(folded, "/"), folder)
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(host, folded, tail)).otherwise(url)


def absolute_url(base: Column, link: Column) -> Column:
    """The link seen from its page: absolute, from the host, or from the page's folder."""
    host = F.regexp_extract(base, r"^([a-z]+://[^/?#]+)", 1)
    scheme = F.regexp_extract(base, r"^([a-z]+:)", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.when(page.rlike(r"^[a-z]+://[^/]+$"), F.concat(page, F.lit("/"))).otherwise(
        F.regexp_replace(page, r"[^/]*$", "")
    )
    return without_dot_segments(
        F.when(link.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(host, link))
        .when(link.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), link))
        .when(link.startswith("?"), F.concat(page, link))
        .otherwise(F.concat(folder, link))
    )


def harvest_links(
    pages: DataFrame, pattern: str, date_format: str | None = None, group: int = 1, url: str = "url", html: str = "html"
) -> DataFrame:
    """Every anchor whose target matches ``pattern``: page columns plus ``link`` and its ``date``."""
    anchors = pages.select(
        *[c for c in pages.columns if c != html],
        F.explode(F.regexp_extract_all(F.regexp_replace(html, COMMENT, ""), F.lit(ANCHOR), F.lit(0))).alias("_anchor"),
    )
    target = F.concat(*(F.regexp_extract("_anchor", ANCHOR, i) for i in (1, 2, 3)))
    for written, character in ENTITIES:
        target = F.replace(target, F.lit(written), F.lit(character))
    found = anchors.withColumn("href", target).drop("_anchor").where(F.col("href").rlike(f"^(?:{pattern})"))
    date = F.lit(None).cast("date") if date_format is None else name_date(F.col("href"), pattern, date_format, group)
    return found.select("*", absolute_url(F.col(url), F.col("href")).alias("link"), date.alias("date"))


def pages_without_links(pages: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """Pages on which no link matched; the reference point for a changed page layout."""
    return pages.select(key).join(links.select(key).distinct(), key, "left_anti")


def needs_refresh(online: DataFrame, stored: DataFrame, keys: list[str], delay: int = REFRESH_DAYS) -> DataFrame:
    """Newest online and stored date per key and whether the online file should be fetched."""
    newest = online.groupBy(*keys).agg(F.max("date").alias("online_date"))
    kept = stored.groupBy(*keys).agg(F.max("date").alias("stored_date"))
    due = F.col("stored_date").isNull() | (F.datediff("online_date", "stored_date") >= delay)
    return newest.join(kept, keys, "left").withColumn("due", due)


def latest_by_date(files: DataFrame, keys: list[str], name: str = "name", date: str = "date") -> DataFrame:
    """Newest file per key; of several with one date, the last name."""
    return (
        files.where(F.col(date).isNotNull())
        .groupBy(*keys)
        .agg(F.max(F.struct(F.col(date).alias("date"), F.col(name).alias("name"))).alias("f"))
        .select(*keys, "f.date", "f.name")
    )
