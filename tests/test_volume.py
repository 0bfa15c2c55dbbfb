"""What the star shuffles and writes: each row once per layout, and nothing that follows from it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dimstar.plans import reports as r
from dimstar.plans.load import Warehouse
from dimstar.sources import io
from dimstar.sources.adapter import SalesStar

FIRST = dt.datetime(1998, 1, 5)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """300 lines; customer 1 stands twice, line items of customers 7 and NULL have no customer,
    supplier 9 and part 5 are unknown."""
    root = str(tmp_path_factory.mktemp("trade"))

    def save(name, rows, kind):
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{root}/{name}.parquet")

    lines = [
        (k // 3, k % 6, k % 4 if k % 31 else 9, k % 7 + 1, float(k % 50 + 1), "ANR"[k % 3],
         "FO"[k % 2], FIRST + dt.timedelta(days=k * 2))
        for k in range(300)
    ]
    save("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
         "l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    save("orders", [(o, o % 8 if o % 11 else None, "5-LOW") for o in range(100)],
         "o_orderkey long, o_custkey long, o_orderpriority string")
    save("part", [(p, ["PROMO", "SMALL"][p % 2]) for p in range(5)], "p_partkey long, p_type string")
    save("customer", [(c, f"C{c}", c % 2, "AUTO") for c in [0, 1, 1, 2, 3, 4, 5, 6]],
         "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    save("supplier", [(s, f"S{s}", s % 2) for s in range(4)], "s_suppkey long, s_name string, s_nationkey int")
    save("nation", [(0, "X", 0), (1, "Y", 0)], "n_nationkey int, n_name string, n_regionkey int")
    save("region", [(0, "R")], "r_regionkey int, r_name string")
    return root


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(x) for x in df.collect()), key=str)


def test_lines_go_to_their_hcp_and_are_summed_there(spark, folder, no_broadcast):
    star = SalesStar(spark, folder)
    assert "hashpartitioning(week_end_date_key" not in plan(star["fct_prescription_weekly"])
    assert "hashpartitioning(day" not in plan(star["fct_hcp_visit"])
    assert "hashpartitioning(fiscal_quarter_key" not in plan(star["fct_hcp_coverage_target"])


def test_weekly_rows_of_a_customer_that_stands_twice(spark, folder):
    weekly = SalesStar(spark, folder)["weekly_market"]
    sales = SalesStar(spark, folder)["sales"]
    week = F.date_add(F.trunc("day", "week"), 6)
    sums = sales.groupBy(week.alias("week_end_date_key"), "custkey", "brand").agg(
        F.sum("qty").alias("total_rx_count"), F.sum(F.col("qty") * F.col("line_no")).alias("total_units")
    )
    market = sums.groupBy("week_end_date_key", "custkey").agg(F.sum("total_units").alias("total_market_units"))
    homes = spark.read.parquet(f"{folder}/customer.parquet").select(F.col("c_custkey").alias("custkey"))
    want = sums.join(market, ["week_end_date_key", "custkey"]).join(homes, "custkey")
    cols = ["week_end_date_key", "custkey", "brand", "total_rx_count", "total_units", "total_market_units"]
    assert rows(weekly.select(*cols)) == rows(want.select(*cols))
    assert weekly.where("custkey = 1").count() == 2 * sums.where("custkey = 1").count()


def test_a_rollup_alone_writes_no_sales(spark, folder):
    star = SalesStar(spark, folder)
    assert "l_orderkey" in plan(star["fct_prescription_territory_monthly"])
    assert "kept_sales" not in star._built
    both = SalesStar(spark, folder)
    both["fct_prescription_weekly"]
    assert "l_orderkey" not in plan(both["fct_prescription_territory_monthly"])
    cols = ["month_key", "territory_rollup_key", "product_key", *["total_units", "total_market_units"]]
    one, other = (s["fct_prescription_territory_monthly"].select(*cols) for s in (star, both))
    assert rows(one) == rows(other)
    stored = Warehouse(spark, folder)
    assert rows(stored["fct_prescription_territory_monthly"].select(*cols)) == rows(one)
    assert not stored.has_written_sales()


def test_stored_facts_get_their_derived_columns_after_the_shuffle(spark, folder, monkeypatch):
    spread = []
    real = io._spread_for
    monkeypatch.setattr(io, "_spread_for", lambda df, f: spread.append(df.columns) or real(df, f))
    stored, derived = Warehouse(spark, folder), SalesStar(spark, folder)
    for name in ("fct_hcp_visit", "fct_prescription_weekly"):
        assert stored[name].columns == derived[name].columns
        assert rows(stored[name]) == rows(derived[name])
    shuffled = {c for columns in spread for c in columns}
    assert not shuffled & {"visit_id", "program_type", "brand_units", "market_share_pct", "audit_key"}


def test_coverage_of_all_quarters_reads_the_facts_once(spark, folder):
    text = plan(r.below_quota_coverage(Warehouse(spark, folder), quarter=None, segment="D"))
    assert "date_key" not in text.replace("fiscal_quarter_key", "")
    assert "FileScan" in text and "hashpartitioning(hcp_key" not in text


def test_groups_without_weights_are_those_of_the_bridge(spark, folder):
    star = SalesStar(spark, folder)
    groups = star["alignment_groups"]
    assert rows(groups) == rows(star["bridge_hcp_rep_alignment"].select("hcp_key", "group_key").distinct())
    fact = SalesStar(spark, folder)
    fact["shared_rx"]
    assert "rep_shares" not in fact._built
