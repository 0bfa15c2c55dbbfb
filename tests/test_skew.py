"""Operators for groups of any size, against plain windows on fixtures with one hot group."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dimstar.functions.labels import asc, desc
from dimstar.operators import skew, windows


@pytest.fixture(scope="module")
def rows(spark):
    """A third of all rows share one group, some values tie, one group key is NULL."""
    base = spark.range(600).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string")))
        .alias("g"),
        F.when(F.col("id") % 11 == 0, F.lit(None))
        .otherwise((F.col("id") * 37 % 40).cast("decimal(9,2)"))
        .alias("v"),
    )
    return base.cache()


def same(a, b):
    cols = sorted(a.columns)
    left = sorted(map(str, a.select(cols).collect()))
    assert left == sorted(map(str, b.select(cols).collect()))


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_running_equals_window(rows, ranges):
    w = Window.partitionBy("g").orderBy(desc("v"), asc("id"))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    expected = rows.select(
        "*",
        F.row_number().over(w).cast("bigint").alias("at"),
        F.sum("v").over(upto).alias("total"),
        F.count("*").over(Window.partitionBy("g")).alias("n"),
        F.sum("v").over(Window.partitionBy("g")).alias("whole"),
    )
    found = skew.running(
        rows, ["g"], [desc("v"), asc("id")], position="at", sums={"total": F.col("v")},
        group_rows="n", group_sums={"whole": "total"}, ranges=ranges,
    )
    same(found, expected)


def test_running_spreads_the_hot_group(rows):
    placed = skew.running(rows, [], [asc("id")], position="at", ranges=8)
    assert placed.filter("at <> id + 1").count() == 0


def test_group_stats_equal_window(rows):
    g = Window.partitionBy("g")
    expected = rows.select(
        "*", F.count("*").over(g).alias("n"), F.sum("v").over(g).alias("total")
    )
    found = skew.attach_group_stats(rows, ["g"], {"total": F.sum("v")}, size="n")
    same(found, expected)


@pytest.mark.parametrize("n", [10, 7, 700])
def test_ntile_equals_window(rows, n):
    w = Window.partitionBy("g").orderBy(desc("v"), asc("id"))
    expected = rows.select("*", F.ntile(n).over(w).alias("tile"))
    same(windows.ntile_in(rows, ["g"], [desc("v"), asc("id")], n, "tile", ranges=5), expected)


def test_ntile_sizes(spark):
    rows = spark.range(23).select("id", F.lit(1).alias("g"), (F.col("id") / 2).cast("int").alias("v"))
    tiles = windows.ntile_in(rows, ["g"], [desc("v"), asc("id")], 10, "tile", ranges=4)
    sizes = [r["count"] for r in tiles.groupBy("tile").count().orderBy("tile").collect()]
    assert sizes == [3, 3, 3, 2, 2, 2, 2, 2, 2, 2]


def test_ranks_with_ties_and_null(rows):
    g = Window.partitionBy("g")
    expected = rows.select(
        "*",
        F.dense_rank().over(g.orderBy(desc("v"))).cast("bigint").alias("place"),
        F.round(100 * F.percent_rank().over(g.orderBy(asc("v"))), 1)
        .cast("double")
        .alias("pct"),
        F.count("*").over(g).alias("n"),
        F.sum("v").over(g).alias("total"),
        F.count("v").over(g).alias("known"),
    )
    found = windows.ranked_by_value(
        rows, ["g"], "v", dense_rank_desc="place", percent_rank="pct", group_rows="n",
        group_sum="total", group_known="known", ranges=5,
    )
    cast = found.withColumn("pct", F.col("pct").cast("double")).withColumn(
        "total", F.col("total").cast("decimal(19,2)")
    )
    same(cast, expected)


def test_ranks_when_one_value_is_hot(spark):
    rows = spark.range(100).select(
        "id", F.lit("g").alias("g"), F.when(F.col("id") < 60, 5).otherwise(F.col("id")).alias("v")
    )
    counts = rows.groupBy("g", "v").agg(F.count("*").alias("n"))
    back = skew.join_back(rows, counts, ["g", "v"])
    assert back.count() == 100
    assert back.filter("v = 5").select("n").distinct().collect()[0][0] == 60


def test_share_of_group(rows):
    g = Window.partitionBy("g")
    hit = F.col("id") % 2 == 0
    found = windows.share_of_group(rows, ["g"], hit, "pct")
    expected = rows.select(
        "*",
        F.round(
            F.lit(100).cast("decimal(5,1)") * F.sum(hit.cast("int")).over(g).cast("decimal(20,0)")
            / F.count("*").over(g).cast("decimal(20,0)"),
            1,
        ).cast("double").alias("pct"),
    )
    same(found.withColumn("pct", F.col("pct").cast("double")), expected)
