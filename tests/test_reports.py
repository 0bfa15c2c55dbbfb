"""Reports on small hand-written stars with exact expected rows."""

import datetime as dt
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from dimstar.plans import reports as r
from tests.bag import rows

D = dt.date
Q1 = D(2023, 8, 1)


def frame(spark, ddl, data):
    return spark.createDataFrame(data, ddl)


REP = (
    "rep_key bigint, rep_durable_key string, rep_name string, district string, "
    "territory_key bigint, current_territory_name string, effective_date date, is_current boolean"
)
HCP = (
    "hcp_key bigint, hcp_durable_key string, full_name string, specialty string, segment string, "
    "decile_rank smallint, city string, state string, effective_date date, expiration_date date, "
    "is_current boolean"
)
PRODUCT = (
    "product_key bigint, brand_name string, indication string, effective_date date, "
    "is_current boolean"
)
QUOTA = (
    "fiscal_quarter_key date, rep_key bigint, product_key bigint, quota_units int, "
    "actual_units int, prior_year_actual_units int, attainment_pct decimal(9,2)"
)
RX = (
    "week_end_date_key date, hcp_key bigint, product_key bigint, territory_key bigint, "
    "group_key bigint, audit_key bigint, new_rx_count int, total_rx_count int, total_units int"
)


def hcp(key, name, segment="A", decile=5, start=D(2022, 1, 1), end=None, durable=None, spec="Onc"):
    return (
        key, durable or f"H{key}", name, spec, segment, decile, "City", "ST", start, end, end is None
    )


def rep(key, name, district="D", territory=1, now="T1", start=D(2020, 1, 1), current=True, durable=None):
    return (key, durable or f"R{key}", name, district, territory, now, start, current)


def quota(rep_key, pct, quota_=100, actual=None, prior=0, quarter=Q1, product=1):
    actual = int(float(pct or 0)) if actual is None else actual
    return (quarter, rep_key, product, quota_, actual, prior, None if pct is None else Dec(str(pct)))


@pytest.fixture(scope="module")
def base(spark):
    from dimstar.operators.dims import date_dim

    return {
        "dim_date": date_dim(spark, D(2022, 1, 1), D(2024, 12, 31)),
        "dim_product": frame(
            spark, PRODUCT, [(1, "Alpha", "one", D(2014, 1, 1), True), (3, "Beta", "one", D(2014, 1, 1), True)]
        ),
        "dim_territory": frame(
            spark, "territory_key bigint, territory_name string, district_name string",
            [(1, "North", "N"), (2, "South", "S")],
        ),
    }


def rx(week, hcp_key, n, product=1, units=None, group=None, audit=2, territory=1, new=0):
    return (week, hcp_key, product, territory, group, audit, new, n, units if units is not None else n * 10)


VISIT = (
    "visit_id string, date_key date, rep_key bigint, hcp_key bigint, product_key bigint, "
    "samples_dropped int, visit_duration_minutes int"
)


def visit(i, day, rep_key, hcp_key, product=1):
    return (f"V{i:03d}", day, rep_key, hcp_key, product, 1, 30)


TARGET = "fiscal_quarter_key date, rep_key bigint, hcp_key bigint, product_key bigint"


def coverage(spark, base, quotas, targets, visits, hcps):
    tables = {
        **base,
        "dim_rep": frame(spark, REP, [rep(1, "Ann"), rep(2, "Bob"), rep(9, "Old", current=False)]),
        "dim_hcp": frame(spark, HCP, hcps),
        "fct_quota_attainment": frame(spark, QUOTA, quotas),
        "fct_hcp_coverage_target": frame(spark, TARGET, targets),
        "fct_hcp_visit": frame(spark, VISIT, visits),
    }
    return r.below_quota_coverage(tables, Q1)


def test_coverage_effort_miss(spark, base):
    out = coverage(
        spark, base, [quota(1, 67)], [(Q1, 1, h, 1) for h in (1, 2, 3, 4)],
        [visit(1, D(2024, 8, 5), 1, 1)],  # a year later: not in the quarter
        [hcp(h, f"Dr {h}") for h in (1, 2, 3, 4)],
    )
    assert rows(out, "hcp_name", "coverage_status", "pct_a_tier_unvisited", "total_visits_in_quarter") == [
        (f"Dr {h}", "No visits", Dec("100.0"), 0) for h in (1, 2, 3, 4)
    ]


def test_coverage_targeting_miss(spark, base):
    visits = [visit(i, D(2023, 9, i), 1, 10 + i % 2) for i in range(1, 6)]
    hcps = [hcp(1, "Dr A"), hcp(10, "Dr B", "B"), hcp(11, "Dr C", "C")]
    targets = [(Q1, 1, 1, 1), (Q1, 1, 10, 1), (Q1, 1, 11, 1)]
    out = coverage(spark, base, [quota(1, 71)], targets, visits, hcps)
    assert rows(out, "hcp_name", "coverage_status", "total_visits_in_quarter", "unique_hcps_visited") == [
        ("Dr A", "No visits", 5, 2)
    ]


def test_coverage_three_labels(spark, base):
    visits = [visit(1, D(2023, 8, 1), 1, 2), visit(2, D(2023, 10, 31), 1, 3), visit(3, D(2023, 9, 9), 1, 3)]
    out = coverage(
        spark, base,
        [quota(1, "79.99"), quota(2, 80), quota(9, 10)],  # at the threshold, and not current
        [(Q1, 1, h, 1) for h in (1, 2, 3)] + [(Q1, 2, 1, 1), (Q1, 9, 1, 1)],
        visits, [hcp(h, f"Dr {h}") for h in (1, 2, 3)],
    )
    found = [tuple(x) for x in out.select("hcp_name", "coverage_status", "pct_a_tier_unvisited").collect()]
    assert found == [  # ordered by rep, status, name
        ("Dr 3", "Adequately covered", Dec("33.3")),
        ("Dr 1", "No visits", Dec("33.3")),
        ("Dr 2", "Undercovered", Dec("33.3")),
    ]


def test_rolling_trend_counts_rows_not_weeks(spark, base):
    start = D(2023, 4, 2)
    weeks = [start + dt.timedelta(weeks=i) for i in range(25)]
    values = {w: (5 if D(2023, 8, 6) <= w <= D(2023, 9, 3) else 45) for w in weeks}
    del values[D(2023, 7, 16)]
    tables = {
        **base,
        "dim_hcp": frame(spark, HCP, [hcp(5, "Dr Drop"), hcp(6, "Dr D-tier", "D")]),
        "fct_prescription_weekly": frame(
            spark, RX, [rx(w, h, n) for w, n in values.items() for h in (5, 6)]
        ),
    }
    out = {x["week_end_date_key"]: x for x in r.rolling_trend(tables).collect()}
    assert len(out) == 15 and {x["hcp_name"] for x in out.values()} == {"Dr Drop"}
    drop = out[D(2023, 8, 6)]
    assert (drop["prior_week_rx"], drop["wow_change"], drop["wow_pct_change"]) == (45, -40, Dec("-88.9"))
    assert drop["trend_flag"] == "Significant drop"
    assert drop["rolling_avg"] == Dec("41.9")  # (12 * 45 + 5) / 13
    assert out[D(2023, 7, 23)]["prior_week_rx"] == 45  # across the missing week
    assert out[D(2023, 9, 10)]["trend_flag"] == "Significant increase"
    assert out[D(2023, 9, 3)]["rolling_avg"] == Dec("29.6")  # (8 * 45 + 5 * 5) / 13


def test_trend_flags_and_zero_prior(spark, base):
    values = [0, 10, 8, 8, 12, 0]
    tables = {
        **base,
        "dim_hcp": frame(spark, HCP, [hcp(5, "Dr")]),
        "fct_prescription_weekly": frame(
            spark, RX, [rx(D(2023, 6, 4) + dt.timedelta(weeks=i), 5, n) for i, n in enumerate(values)]
        ),
    }
    out = r.rolling_trend(tables, display=None).collect()
    assert [x["trend_flag"] for x in out] == [
        "Stable", "Stable", "Moderate drop", "Stable", "Significant increase", "Significant drop",
    ]
    assert out[1]["wow_pct_change"] is None


def ranking_tables(spark, base, quotas, reps):
    return {**base, "dim_rep": frame(spark, REP, reps), "fct_quota_attainment": frame(spark, QUOTA, quotas)}


def test_ranking_ties_and_null(spark, base):
    pcts = [None, 110, 85, 85, 60]
    tables = ranking_tables(
        spark, base, [quota(i, p) for i, p in enumerate(pcts, 1)], [rep(i, f"Rep {i}") for i in range(1, 6)]
    )
    out = r.attainment_ranking(tables, Q1)
    assert rows(out, "rep_name", "district_rank", "percentile_in_district", "reps_in_district",
                "district_avg_attainment", "vs_district_avg", "attainment_status") == [
        ("Rep 1", 1, Dec("100.0"), 5, Dec("85.0"), None, "Significantly below quota"),
        ("Rep 2", 2, Dec("75.0"), 5, Dec("85.0"), Dec("25.0"), "At or above quota"),
        ("Rep 3", 3, Dec("25.0"), 5, Dec("85.0"), Dec("0.0"), "Near quota"),
        ("Rep 4", 3, Dec("25.0"), 5, Dec("85.0"), Dec("0.0"), "Near quota"),
        ("Rep 5", 4, Dec("0.0"), 5, Dec("85.0"), Dec("-25.0"), "Below quota"),
    ]


def test_transfer(spark, base):
    move = D(2024, 3, 1)
    tables = {
        **base,
        "dim_rep": frame(spark, REP, [
            rep(3, "Mover", territory=1, now="South", current=False, durable="R-M", start=D(2019, 5, 20)),
            rep(4, "Mover", territory=2, now="South", durable="R-M", start=move),
            rep(5, "Stayer", durable="R-S"),
        ]),
        "dim_hcp": frame(spark, HCP, [hcp(29, "Dr P")]),
        "fct_hcp_visit": frame(spark, VISIT, [
            *[visit(i, D(2024, 1, 10) + dt.timedelta(weeks=i), 3, 29) for i in range(4)],
            *[visit(10 + i, D(2024, 3, 5) + dt.timedelta(weeks=i), 4, 29) for i in range(4)],
            visit(20, D(2024, 3, 5), 5, 29),
        ]),
    }
    expected = [
        *[("Pre-transfer", "North", "South", 4, i) for i in range(1, 5)],
        *[("Post-transfer", "South", "South", 4, i) for i in range(1, 5)],
    ]
    cols = ["transfer_period", "territory_at_time_of_visit", "current_territory_name", "visits_in_period",
            "visit_num_in_period"]
    assert rows(r.transfer_attribution(tables, "R-M", move), *cols) == expected
    assert rows(r.transfer_attribution(tables), *cols) == expected


def credit_tables(spark, base):
    bridge = frame(
        spark, "group_key bigint, rep_key bigint, product_key bigint, w string, is_current boolean",
        [(1, 1, 3, "0.600", True), (1, 2, 3, "0.400", True), (1, 9, 3, "0.500", False)],
    )
    return {
        **base,
        "dim_rep": frame(spark, REP, [rep(1, "Ann"), rep(2, "Bob")]),
        "dim_hcp": frame(spark, HCP, [hcp(4, "Dr K")]),
        "bridge_hcp_rep_alignment": bridge.withColumn(
            "credit_split_weight", F.col("w").cast("decimal(4,3)")
        ),
        "fct_prescription_weekly": frame(spark, RX, [
            rx(D(2024, 1, 7), 4, 7702, units=455978, group=1), rx(D(2024, 1, 14), 4, 7, units=101, group=1),
            rx(D(2024, 1, 21), 4, 7, units=101, group=1), rx(D(2024, 1, 7), 4, 10, product=3, group=1),
            rx(D(2024, 1, 7), 4, 99),
        ]),
    }


def test_credit_split(spark, base):
    out = r.co_promotion_credit(credit_tables(spark, base), 4, 1, current_only=True)
    # 7702 and twice 7 prescriptions; units are rounded per row before they are summed
    assert rows(out.filter("brand_name = 'Alpha'"), "rep_name", "total_attributed_rx", "total_attributed_units",
                "total_unweighted_rx", "rx_overcount_without_bridge") == [
        ("Ann", Dec("4629.6"), Dec(273587 + 61 + 61), 7716, Dec("3086.4")),
        ("Bob", Dec("3086.4"), Dec(182391 + 40 + 40), 7716, Dec("4629.6")),
    ]


def test_credit_in_whole_numbers_is_that_of_decimals(spark, base, monkeypatch):
    """Halves, negative and missing measures, equal names, and values only decimals can hold."""
    tables = credit_tables(spark, base)
    bridge = [(1, 1, 3, "0.650", True), (1, 2, 3, "0.350", True), (1, 2, 3, "0.350", True), (1, 1, 1, None, True)]
    tables["bridge_hcp_rep_alignment"] = frame(
        spark, "group_key bigint, rep_key bigint, product_key bigint, w string, is_current boolean", bridge
    ).withColumn("credit_split_weight", F.col("w").cast("decimal(4,3)"))
    counted = [(7, 110), (-7, -110), (-3, 30), (13, 130), (None, 90), (1, -10), (0, 0), (7, 110)]
    weeks = [rx(D(2024, 1, 7) + dt.timedelta(weeks=i), 4, n, units=u, group=1) for i, (n, u) in enumerate(counted)]

    def both(factor):
        units = F.col("total_units") * F.lit(factor).cast("bigint")
        tables["fct_prescription_weekly"] = frame(spark, RX, weeks).withColumn("total_units", units)
        got = r.co_promotion_credit(tables, current_only=True)
        with monkeypatch.context() as patched:
            patched.setattr(r, "_fits_whole_units", lambda *_: False)
            want = r.co_promotion_credit(tables, current_only=True)
        assert got.schema == want.schema
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []
        return got

    out = both(1).filter("credit_split_weight = 0.650")
    # 4.55 twice, -4.55, -1.95, 8.45, 0.65, 0; units: 71.5 twice, -71.5, 19.5, 84.5, 58.5, -6.5, 0
    assert rows(out, "rep_name", "total_attributed_rx", "total_attributed_units") == [("Ann", Dec("11.8"), Dec(229))]
    both(10**15)


def test_reports_read_what_earlier_versions_recorded(spark, base):
    """Two versions of one HCP and of one rep: all rows by default, the last version's by choice."""
    hcps = frame(spark, HCP, [
        hcp(2, "Dr M", "B", end=D(2024, 1, 14), durable="H-M"), hcp(3, "Dr M", "A", start=D(2024, 1, 15), durable="H-M"),
    ])
    bridge = frame(
        spark, "group_key bigint, hcp_key bigint, rep_key bigint, product_key bigint, w string, is_current boolean",
        [(1, 3, 2, 1, "0.600", True), (1, 3, 3, 1, "0.400", True)],
    ).withColumn("credit_split_weight", F.col("w").cast("decimal(10,9)"))
    weeks = [rx(D(2024, 1, 7), 2, 10), rx(D(2024, 1, 14), 2, 20), rx(D(2024, 1, 21), 3, 30)]
    tables = {
        **base,
        "dim_hcp": hcps,
        "dim_rep": frame(spark, REP, [
            rep(1, "Ann", durable="R-A", current=False), rep(2, "Ann", durable="R-A"), rep(3, "Bob"),
        ]),
        "bridge_hcp_rep_alignment": bridge,
        "fct_prescription_weekly": frame(spark, RX, weeks),
        "fct_quota_attainment": frame(spark, QUOTA, [quota(1, 70), quota(3, 90)]),
    }
    trend = r.rolling_trend(tables, display=(D(2024, 1, 14), D(2024, 1, 21)))
    assert rows(trend, "total_rx_count", "rolling_avg", "prior_week_rx") == [
        (20, Dec("15.0"), 10), (30, Dec("20.0"), 20),
    ]
    literal = r.rolling_trend(tables, display=(D(2024, 1, 14), D(2024, 1, 21)), current_only=True)
    assert rows(literal, "total_rx_count", "prior_week_rx") == [(30, None)]
    assert rows(r.attainment_ranking(tables), "rep_name", "district_rank") == [("Ann", 2), ("Bob", 1)]
    assert r.attainment_ranking(tables, current_only=True).count() == 1
    assert rows(r.decile_validation(tables, mismatches_only=False), "lifetime_rx_count") == [(60,)]
    credit = r.co_promotion_credit(tables)
    assert rows(credit, "rep_name", "total_attributed_rx") == [("Ann", Dec("36.0")), ("Bob", Dec("24.0"))]


def test_credit_split_by_product(spark, base):
    out = r.co_promotion_credit(
        credit_tables(spark, base), match_product=True, current_only=True
    )
    assert rows(out, "rep_name", "brand_name", "total_attributed_rx") == [
        ("Ann", "Beta", Dec("6.0")), ("Bob", "Beta", Dec("4.0")),
    ]


def test_tier_change(spark, base):
    up = D(2024, 1, 15)
    tables = {
        **base,
        "dim_hcp": frame(spark, HCP, [
            hcp(2, "Dr M", "B", end=D(2024, 1, 14), durable="H-M"), hcp(3, "Dr M", "A", start=up, durable="H-M"),
            hcp(8, "Dr X"),
        ]),
        "fct_prescription_weekly": frame(spark, RX, [
            *[rx(D(2023, 12, 3) + dt.timedelta(weeks=i), 2, n) for i, n in enumerate([20, 30, 25, 26, 28])],
            *[rx(D(2024, 1, 21) + dt.timedelta(weeks=i), 3, n) for i, n in enumerate([50, 52, 54, 56, 58])],
            rx(D(2024, 1, 21), 8, 5), rx(D(2024, 7, 7), 3, 999),
        ]),
    }
    labels = {"B": "Pre-upgrade (B-tier)", "A": "Post-upgrade (A-tier)"}
    out = r.tier_change_impact(tables, "H-M", (D(2023, 7, 1), D(2024, 6, 30)), labels)
    assert rows(out, "tier_period", "weeks_in_period", "total_rx", "avg_weekly_rx", "peak_weekly_rx",
                "floor_weekly_rx", "avg_rx_change_vs_prior_period", "avg_rx_pct_change") == [
        ("Pre-upgrade (B-tier)", 5, 129, Dec("25.8"), 30, 20, None, None),
        ("Post-upgrade (A-tier)", 5, 270, Dec("54.0"), 58, 50, Dec("28.2"), Dec("109.3")),
    ]


def test_year_over_year(spark, base):
    cases = [(50, 0), (100, 100), (105, 100), (115, 100), (95, 100), (85, 100)]
    quotas = [quota(i, 100 - i, actual=a, prior=p) for i, (a, p) in enumerate(cases, 1)]
    tables = ranking_tables(spark, base, quotas, [rep(i, f"Rep {i}") for i in range(1, 7)])
    out = [tuple(x) for x in r.yoy_attainment(tables, Q1).select(
        "rep_name", "yoy_growth_pct", "yoy_trend", "district_cumulative_yoy_growth").collect()]
    assert out == [
        ("Rep 1", None, "Growing (>10%)", 50), ("Rep 4", Dec("15.0"), "Growing (>10%)", 70),
        ("Rep 3", Dec("5.0"), "Growing (<10%)", 55), ("Rep 2", Dec("0.0"), "Flat", 50),
        ("Rep 5", Dec("-5.0"), "Declining (<10%)", 65), ("Rep 6", Dec("-15.0"), "Declining (>10%)", 50),
    ]


def test_batch_audit(spark, base):
    bad, fix = D(2024, 3, 3), D(2024, 3, 10)
    true_units = [20, 40, 60, 80, 100, 0]
    tables = {
        **base,
        "dim_hcp": frame(spark, HCP, [hcp(h, f"Dr {h}") for h in range(1, 7)]),
        "dim_audit": frame(spark, "audit_key bigint, batch_id string, dq_notes string",
                           [(5, "B5", "inflated"), (6, "B6", None)]),
        "fct_prescription_weekly": frame(spark, RX, [
            *[rx(bad, h, 3, units=u * 135 // 100, audit=5) for h, u in enumerate(true_units, 1)],
            *[rx(fix, h, 3, units=u, audit=6) for h, u in enumerate(true_units, 1)],
            rx(bad, 1, 3, units=5, audit=2, product=3),
        ]),
    }
    out = r.superseded_batch_audit(tables, ("B5", bad), ("B6", fix)).select(
        "hcp_name", "units_discrepancy", "pct_inflation", "dq_notes").collect()
    assert [tuple(x) for x in out] == [
        (f"Dr {h}", -7 * h, Dec("35.0"), "inflated") for h in (5, 4, 3, 2, 1)
    ] + [("Dr 6", 0, None, "inflated")]


def test_market_share(spark, base):
    from dimstar.operators.dims import month_dim

    months = [D(2023, m, 1) for m in (8, 9, 10, 11)]
    shares = {1: [50, 52, 51, 51], 2: [30, 30, 40, 10], 3: [20, 18, 9, 39]}
    data = [(m, t, 1, 5, shares[t][i], 100) for i, m in enumerate(months) for t in shares]
    data += [(m, t, 3, 5, 100 - shares[t][i], 0 if (t, i) == (3, 3) else 100)
             for i, m in enumerate(months) for t in shares]
    tables = {
        **base,
        "dim_month": month_dim(spark, D(2023, 1, 1), D(2024, 12, 1)),
        "dim_territory_rollup": frame(
            spark, "territory_rollup_key bigint, territory_name string, district string, region string",
            [(1, "T1", "D1", "R"), (2, "T2", "D1", "R"), (3, "T3", "D1", "R")],
        ),
        "fct_prescription_territory_monthly": frame(
            spark, "month_key date, territory_rollup_key bigint, product_key bigint, total_rx_count int, "
            "brand_units int, total_market_units int", data,
        ),
    }
    out = r.market_share_trend(tables, 2024)
    assert out.count() == 24 and r.market_share_trend(tables, 2023).count() == 0
    alpha = out.filter("brand_name = 'Alpha' and territory_name = 'T2'").collect()
    assert [x["market_share_pct"] for x in alpha] == [Dec("30.00"), Dec("30.00"), Dec("40.00"), Dec("10.00")]
    assert [x["share_trend"] for x in alpha] == ["Holding share", "Holding share", "Gaining share", "Losing share"]
    assert [x["rolling_3mo_avg_share"] for x in alpha] == [Dec("30.00"), Dec("30.00"), Dec("33.33"), Dec("26.67")]
    assert [x["territory_rank_in_district"] for x in alpha] == [2, 2, 2, 3]
    zero = out.filter("brand_name = 'Beta' and territory_name = 'T3' and month_key = date'2023-11-01'").first()
    assert zero["market_share_pct"] is None and zero["share_trend"] == "Holding share"
    assert zero["territory_rank_in_district"] == 1  # NULL is the largest


def test_decile_validation(spark, base):
    tables = {
        **base,
        "dim_hcp": frame(spark, HCP, [hcp(h, f"Dr {h}", decile=d) for h, d in [(1, 1), (2, 1), (3, 9)]]),
        "fct_prescription_weekly": frame(spark, RX, [rx(D(2024, 1, 7), h, n) for h, n in [(1, 9), (2, 5), (3, 1)]]),
    }
    out = r.decile_validation(tables)
    assert rows(out, "full_name", "stored_decile", "calculated_decile", "decile_drift", "decile_status") == [
        ("Dr 3", 9, 3, 6, "Needs refresh"), ("Dr 2", 1, 2, -1, "Minor drift"),
    ]
    assert r.decile_validation(tables, mismatches_only=False).filter("decile_status = 'Accurate'").count() == 1
    flipped = r.decile_validation(tables, direction="highest_last", mismatches_only=False)
    assert rows(flipped, "full_name", "calculated_decile") == [("Dr 1", 10), ("Dr 2", 9), ("Dr 3", 8)]


def test_indication(spark, base):
    split = D(2023, 11, 1)
    tables = {
        **base,
        "dim_product": frame(spark, PRODUCT, [
            (2, "Gamma", "first", D(2002, 12, 31), False), (3, "Gamma", "both", split, True),
            (1, "Alpha", "one", D(2014, 1, 1), True),
        ]),
        "dim_hcp": frame(spark, HCP, [hcp(1, "Dr 1"), hcp(2, "Dr 2")]),
        "fct_prescription_weekly": frame(spark, RX, [
            # per HCP means 10 and 40: the mean of means is 25, the mean of rows would be 20
            rx(D(2023, 10, 1), 1, 10, 2, new=1), rx(D(2023, 10, 8), 1, 10, 2, new=1), rx(D(2023, 10, 1), 2, 40, 2),
            rx(D(2023, 11, 5), 1, 30, 3), rx(D(2023, 11, 5), 2, 45, 3), rx(D(2023, 11, 5), 2, 9, 1),
        ]),
    }
    out = r.indication_impact(tables, "Gamma")
    cols = ["indication_period", "unique_prescribers", "weeks_of_data", "total_rx", "avg_weekly_rx_per_hcp",
            "avg_rx_change_vs_prior", "avg_rx_pct_change"]
    assert rows(out, *cols) == [
        ("Pre-expansion", 2, 3, 60, Dec("25.0"), None, None),
        ("Post-expansion", 2, 2, 75, Dec("37.5"), Dec("12.5"), Dec("50.0")),
    ]
    assert rows(r.indication_impact(tables, "Gamma", current_only=True), "indication_period") == [("Post-expansion",)]
    assert r.indication_impact(tables).count() == 3


def test_drill_across(spark, base):
    tables = {
        **base,
        "dim_rep": frame(spark, REP, [rep(1, "Ann"), rep(2, "Bob"), rep(3, "Cy")]),
        "dim_hcp": frame(spark, HCP, [hcp(1, "Dr 1", decile=10), hcp(2, "Dr 2", decile=9)]),
        "fct_quota_attainment": frame(spark, QUOTA, [quota(1, 50), quota(2, 70), quota(3, 120)]),
        "fct_hcp_visit": frame(spark, VISIT, [
            visit(1, D(2023, 9, 1), 2, 1), visit(2, D(2023, 9, 2), 3, 1), visit(3, D(2023, 9, 3), 3, 1),
            visit(4, D(2023, 9, 4), 1, 2),
        ]),
    }
    out = r.drill_across_top_decile(tables, Q1)
    assert rows(out, "rep_name", "attainment_pct", "top_decile_visits", "avg_top_decile_visits", "visit_effort") == [
        ("Ann", Dec("50.00"), 0, Dec("1.00"), "Below average"),
        ("Bob", Dec("70.00"), 1, Dec("1.00"), "At average"),
    ]
