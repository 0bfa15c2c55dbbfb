"""Lines that a site repeats on many of its pages, dropped by their site-relative frequency.

A line's frequency is the number of the site's pages that contain it over the number of the
site's pages. Lines above ``ratio`` are boilerplate. A site has at most (mean lines per page)
/ ratio of them, so the list a page is held against is bounded by the pages' own length.

Defined results: lines end at a line feed and are compared without spaces, tabs and carriage
returns at their ends; blank lines are never counted or dropped; a line needs ``min_pages``
pages as well, so that small sites keep their texts; pages with a null site form one site; a
page all of whose lines are boilerplate is a copy of other pages rather than a page with
boilerplate and is left as it is; a null text stays null; repeated rows count as pages of
their own; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimstar.session import settled

RATIO = 0.1
MIN_PAGES = 4
_ENDS = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """What two equal lines share; null for a blank line."""
    bare = F.btrim(line, F.lit(_ENDS))
    return F.when(F.length(bare) > 0, F.unhex(F.md5(bare)))


def boilerplate(
    pages: DataFrame,
    site_column: str,
    text_column: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """One row per site with boilerplate: site, keys (of its boilerplate lines)."""
    rows = pages.select(
        F.col(site_column).alias("site"), F.col(text_column).cast("string").alias("body")
    )
    totals = rows.groupBy("site").agg(F.count("*").alias("pages"))
    found = rows.select(
        "site", F.explode(F.array_distinct(F.transform(_lines(F.col("body")), _key))).alias("key")
    )
    counts = (
        found.where("key is not null")
        .groupBy("site", "key")
        .agg(F.count("*").alias("with_line"))
        .where(F.col("with_line") >= min_pages)
    )
    t = totals.withColumnRenamed("site", "of_site")
    return (
        counts.join(t, F.col("site").eqNullSafe(F.col("of_site")))
        .where(F.col("with_line") > F.lit(ratio) * F.col("pages"))
        .groupBy("site")
        .agg(F.collect_list("key").alias("keys"))
    )


def drop_boilerplate(
    pages: DataFrame,
    site_column: str,
    text_column: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """One row per page: row (its columns as they were), text (what is left), n_lines, n_dropped."""
    # Written, so that its size is known before the pages would be shuffled for the join.
    bad = settled(boilerplate(pages, site_column, text_column, ratio, min_pages))
    bad = bad.select(F.col("site").alias("of_site"), "keys")
    rows = pages.select(
        F.struct("*").alias("row"),
        F.col(site_column).alias("site"),
        F.col(text_column).cast("string").alias("body"),
    )
    joined = rows.join(bad, F.col("site").eqNullSafe(F.col("of_site")), "left")
    marked = joined.select(
        "row",
        "body",
        _lines(F.col("body")).alias("lines"),
        F.when(F.col("keys").isNotNull(), F.transform(_lines(F.col("body")), _key)).alias("own"),
        "keys",
    ).withColumn("hits", F.array_intersect("own", "keys"))
    some_left = F.size(F.array_compact(F.array_except("own", "hits"))) > 0
    drops = F.col("hits").isNotNull() & (F.size("hits") > 0) & some_left
    kept = F.filter(
        F.col("lines"), lambda line, i: ~F.coalesce(F.array_contains("hits", F.get("own", i)), F.lit(False))
    )
    left = marked.withColumn("left", F.when(drops, kept).otherwise(F.col("lines")))
    return left.select(
        "row",
        F.when(drops, F.array_join("left", "\n")).otherwise(F.col("body")).alias("text"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("left"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def without_boilerplate(
    pages: DataFrame,
    site_column: str,
    text_column: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``pages`` with the same columns, the text cleaned."""
    cleaned = drop_boilerplate(pages, site_column, text_column, ratio, min_pages)
    return cleaned.select(
        *[F.col("text") if c == text_column else F.col(f"row.`{c}`").alias(c) for c in pages.columns]
    )
