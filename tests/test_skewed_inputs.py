"""Reports and windows when one rep, one HCP and one brand hold a third of all rows each."""

import shutil

import pytest
from pyspark.sql import functions as F

from dimstar.registry import QUERIES
from tests.compare import connect, difference

SOURCE = "/root/testdata/sf0.001"
NAMES = [
    "r01_below_quota_coverage_lowest_tier", "r02_rolling_trend", "r03_attainment_ranking",
    "r04_transfer_attribution", "r05_co_promotion_credit", "r06_tier_change_impact",
    "r07_yoy_attainment", "r10_decile_validation", "r11_indication_impact",
    "r12_drill_across_top_decile", "w_partition_share", "w_partition_avg_gap",
    "w_row_number_period", "w_ntile_decile", "d_scd2", "f_stamp_keys", "f_visit",
    "f_market_share", "f_bridge_weights", "f_timespan_compress",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name in ("nation", "region", "supplier", "customer", "part"):
        shutil.copy(f"{SOURCE}/{name}.parquet", folder / f"{name}.parquet")

    def third(col, salt, value):
        return F.when(F.xxhash64(*salt) % 3 == 0, F.lit(value)).otherwise(F.col(col)).alias(col)

    lines = spark.read.parquet(f"{SOURCE}/lineitem.parquet")
    key = [F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
    lines = lines.withColumn("l_suppkey", third("l_suppkey", [*key, F.lit(1)], 3).cast("bigint"))
    orders = spark.read.parquet(f"{SOURCE}/orders.parquet")
    orders = orders.withColumn("o_custkey", third("o_custkey", [F.col("o_orderkey")], 7).cast("bigint"))
    # single files, as the SQL engine reads them by name
    lines.toPandas().to_parquet(folder / "lineitem.parquet", coerce_timestamps="us")
    orders.toPandas().to_parquet(folder / "orders.parquet", coerce_timestamps="us")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_same_results_under_skew(spark, skewed, name):
    query = QUERIES[name]
    assert difference(query.run(spark, skewed), connect(skewed), query.sql()) is None
