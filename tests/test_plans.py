"""Physical plans: what must and must not be in them."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from dimstar.operators import facts, joins
from dimstar.plans import reports as r
from dimstar.plans.load import Warehouse
from dimstar.registry import QUERIES
from dimstar.sources.adapter import SalesStar

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n[0] in "rf"])
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name].run(spark, FOLDER))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "CollectLimit"):
        assert word not in text


def test_scan_reads_only_its_columns(spark):
    text = plan(SalesStar(spark, FOLDER)["hcp_snapshots"])
    assert "l_extendedprice" not in text and "p_name" not in text and "o_totalprice" not in text


def test_lookback_filter_reaches_the_scan(spark):
    display = (dt.date(2001, 8, 1), dt.date(2001, 10, 31))
    text = plan(r.rolling_trend(Warehouse(spark, FOLDER), display, None))
    # the weekly fact is stored by week: the look-back prunes its folders
    assert re.search(r"PartitionFilters: \[isnotnull\(week_end_date_key#\d+\), \(week_end_date_key#\d+ >= 2001-05-02\)", text)
    assert text.count("Window ") == 1  # mean and lag share one pass
    window, scan = text.index("Window "), text.index("PartitionFilters: [isnotnull(week_end_date_key")
    assert "week_end_date_key" in text[:window] and window < scan


def test_quarter_filter_reaches_the_scan(spark):
    text = plan(r.yoy_attainment(Warehouse(spark, FOLDER), dt.date(1999, 2, 1)))
    assert "Exchange" in text  # the ranged rows have been written; the scan is behind them


def test_semi_join_of_indication_report(spark):
    assert "LeftSemi" in plan(r.indication_impact(Warehouse(spark, FOLDER), "PROMO"))


def test_top_members_are_limited_before_the_shuffle(spark):
    totals = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("m"), F.col("id").alias("q"))
    text = plan(facts.top_members(totals, ["g"], "m", "q", 2))
    assert text.count("WindowGroupLimit") == 2


def test_partial_aggregation_before_the_shuffle(spark):
    text = plan(SalesStar(spark, FOLDER)["weekly_sums"])
    assert "partial_sum" in text


def test_anti_join_is_an_equi_join(spark):
    a = spark.range(10).select(F.col("id").alias("k"))
    assert "LeftAnti" in plan(joins.gaps(a, a.filter("k > 3"), ["k"]))


def test_quarter_of_visits_prunes_date_folders(spark):
    # R1 and R12 meet the visits through a filtered date dimension: pruned at run time;
    # their quota and coverage facts by a literal quarter
    for df in (r.below_quota_coverage(Warehouse(spark, FOLDER)), r.drill_across_top_decile(Warehouse(spark, FOLDER))):
        text = plan(df)
        assert "dynamicpruningexpression(date_key" in text
        assert re.search(r"PartitionFilters: \[isnotnull\(fiscal_quarter_key#\d+\), \(fiscal_quarter_key#\d+ = 2023-08-01\)\]", text)


def test_builders_join_the_sales_once(spark):
    star = SalesStar(spark, FOLDER)
    for name in ("fct_quota_attainment", "bridge_hcp_rep_alignment", "shared_rx"):
        assert "l_orderkey" not in plan(star[name])  # the written sales, or sums of them


def test_weights_of_bounded_groups_take_one_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 50 AS g", "id AS r", "id % 9 AS q")
    assert plan(facts.bridge_weights(df, ["g"], "r", "q")).count("Exchange") == 1


def test_weekly_sums_go_to_their_hcp_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(SalesStar(spark, FOLDER)["fct_prescription_weekly"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # sums, their HCP, customers, snapshots, versions
    assert text.count("Exchange") <= 5


def test_market_share_sums_the_fact_once(spark):
    df = spark.range(100).selectExpr("id % 5 AS m", "id % 3 AS b", "id AS u")
    assert "Range " not in plan(facts.market_share(df, ["m"], ["b"], "u"))


def test_credit_is_shuffled_as_sums_only(spark):
    # the multiplied rows were hashed by the names, and then ranged for their order
    text = plan(r.co_promotion_credit(Warehouse(spark, FOLDER)))
    assert "hashpartitioning" not in text and text.count("rangepartitioning") == 1


def test_credit_is_sorted_as_whole_numbers(spark):
    # sums of decimals took most of the time, and half of the bytes that are sorted
    optimized = r.co_promotion_credit(Warehouse(spark, FOLDER))._jdf.queryExecution().optimizedPlan()
    written = optimized.collectLeaves().head().schema().simpleString()
    assert re.findall(r"decimal[^)]*\)", written) == ["decimal(10,9)"], written
