"""The analytical reports. ``tables`` maps the names of the star schema to DataFrames.

Every literal of a report is a parameter. ``None`` for a quarter, key or brand means all
of them; the groups of the windows then include it.
"""

from __future__ import annotations

import datetime
from collections import ChainMap
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimstar.functions import calendar as cal
from dimstar.functions import numeric as num
from dimstar.functions.labels import asc, desc, label_ladder
from dimstar.operators import joins, windows
from dimstar.operators.corrections import batch_rows
from dimstar.operators.dims import current_rows
from dimstar.operators.skew import attach_group_stats, running
from dimstar.session import settled

Tables = Mapping[str, DataFrame]
Day = datetime.date

# fixed values: label texts, most specific first, with the thresholds they stand for
NO_VISITS, UNDERCOVERED, COVERED = "No visits", "Undercovered", "Adequately covered"
BIG_DROP, DROP, BIG_RISE, STABLE = (
    "Significant drop", "Moderate drop", "Significant increase", "Stable"
)
DROP_BELOW = {BIG_DROP: -30, DROP: -10}
RISE_ABOVE = {BIG_RISE: 30}
ATTAINMENT_FROM = {"At or above quota": 100, "Near quota": 80, "Below quota": 60}
ATTAINMENT_ELSE = "Significantly below quota"
PRE_TRANSFER, POST_TRANSFER = "Pre-transfer", "Post-transfer"
GAINING, LOSING, HOLDING = "Gaining share", "Losing share", "Holding share"
ACCURATE, MINOR_DRIFT, NEEDS_REFRESH = "Accurate", "Minor drift", "Needs refresh"
PRE_EXPANSION, POST_EXPANSION = "Pre-expansion", "Post-expansion"


def _only(df: DataFrame, col: str, value) -> DataFrame:
    return df if value is None else df.filter(F.col(col) == F.lit(value))


# Where the key of a version leads to the entity it is a version of.
ENTITIES = {
    "rep_key": ("dim_rep", "rep_durable_key"),
    "hcp_key": ("dim_hcp", "hcp_durable_key"),
    "product_key": ("dim_product", "brand_name"),
}


def under_current_keys(tables: Tables, **keys: Sequence[str]) -> Tables:
    """The tables, with the named keys of facts replaced by those of the current versions.

    Facts carry the versions valid at their time; a join to current versions on these keys
    alone would lose what was recorded under earlier ones.
    """
    replaced = {}
    for name, columns in keys.items():
        df = tables[name]
        for key in columns:
            dim, durable = ENTITIES[key]
            now = current_rows(tables[dim]).select(durable, F.col(key).alias("_now"))
            versions = tables[dim].select(key, durable).join(now, durable).select(key, "_now")
            df = df.join(versions, key).withColumn(key, F.col("_now")).drop("_now")
        replaced[name] = df
    return ChainMap(replaced, tables)


def _product_names(tables: Tables) -> DataFrame:
    return current_rows(tables["dim_product"]).select("product_key", "brand_name")


def _quota_rows(tables: Tables, quarter: Day | None) -> DataFrame:
    """Quota facts of current reps and products."""
    quotas = _only(tables["fct_quota_attainment"], "fiscal_quarter_key", quarter).select(
        "fiscal_quarter_key",
        "rep_key",
        "product_key",
        "quota_units",
        "actual_units",
        "prior_year_actual_units",
        "attainment_pct",
    )
    reps = current_rows(tables["dim_rep"]).select(
        "rep_key", "rep_name", "district", "current_territory_name"
    )
    return quotas.join(reps, "rep_key").join(_product_names(tables), "product_key")


def _visits_in(tables: Tables, quarter: Day | None) -> DataFrame:
    """Visits with their fiscal quarter, taken from the date dimension."""
    dates = tables["dim_date"].select(
        "date_key",
        cal.quarter_key(F.col("fiscal_year").cast("int"), F.col("fiscal_quarter").cast("int")).alias(
            "fiscal_quarter_key"
        ),
    )
    return tables["fct_hcp_visit"].join(_only(dates, "fiscal_quarter_key", quarter), "date_key")


def below_quota_coverage(
    tables: Tables,
    quarter: Day | None = Day(2023, 8, 1),
    threshold: int = 80,
    segment: str = "A",
    min_visits: int = 2,
) -> DataFrame:
    """Do reps who miss their quota visit too little, or the wrong HCPs?"""
    below = _quota_rows(tables, quarter).filter(F.col("attainment_pct") < threshold)
    visits = _visits_in(tables, quarter).select(
        "fiscal_quarter_key", "rep_key", "hcp_key", "product_key"
    )
    # Counted once per rep, HCP and product; the totals per rep are sums of those counts.
    made = visits.groupBy("fiscal_quarter_key", "rep_key", "hcp_key", "product_key").agg(
        F.count(F.lit(1)).alias("visits_made")
    )
    if quarter is None:
        # read twice below; one quarter is cheap to read again, all of them are not
        made = settled(made)
    effort = made.groupBy("fiscal_quarter_key", "rep_key").agg(
        F.sum("visits_made").alias("total_visits_in_quarter"),
        F.countDistinct("hcp_key").alias("unique_hcps_visited"),
    )
    hcps = current_rows(tables["dim_hcp"]).filter(F.col("segment") == segment)
    targets = _only(tables["fct_hcp_coverage_target"], "fiscal_quarter_key", quarter).join(
        hcps.select("hcp_key", F.col("full_name").alias("hcp_name"), "segment"), "hcp_key"
    )
    at_rep = ["fiscal_quarter_key", "rep_key", "product_key"]
    rows = joins.zero_fill(
        below.join(targets, at_rep), made, [*at_rep, "hcp_key"], ["visits_made"]
    )
    rows = joins.zero_fill(
        rows,
        effort,
        ["fiscal_quarter_key", "rep_key"],
        ["total_visits_in_quarter", "unique_hcps_visited"],
    )
    visited = F.col("visits_made")
    rows = rows.withColumn(
        "coverage_status",
        label_ladder(
            [(visited == 0, NO_VISITS), (visited < min_visits, UNDERCOVERED)],
            COVERED,
        ),
    )
    rows = windows.share_of_group(
        settled(rows) if quarter is None else rows, at_rep, visited == 0, "pct_a_tier_unvisited"
    )
    return rows.select(
        "fiscal_quarter_key",
        "rep_name",
        "current_territory_name",
        "brand_name",
        "attainment_pct",
        "total_visits_in_quarter",
        "unique_hcps_visited",
        "hcp_name",
        "segment",
        "visits_made",
        "coverage_status",
        "pct_a_tier_unvisited",
    ).orderBy(asc("rep_name"), asc("coverage_status"), asc("hcp_name"))


def rolling_trend(
    tables: Tables,
    display: tuple[Day, Day] | None = (Day(2023, 6, 1), Day(2023, 10, 1)),
    lookback_from: Day | None = None,
    segments: Sequence[str] = ("A", "B"),
    rows: int = 13,
    current_only: bool = False,
) -> DataFrame:
    """Weekly volume against its mean over the last reported weeks and against the week before.

    The look-back filter goes to the scan; the display filter stays above the window.
    Without a date the look-back starts ``rows`` weeks before the display.
    """
    if not current_only:
        tables = under_current_keys(tables, fct_prescription_weekly=["hcp_key", "product_key"])
    rx = tables["fct_prescription_weekly"].select(
        "week_end_date_key", "hcp_key", "product_key", "total_rx_count"
    )
    if display is not None:
        start = lookback_from or display[0] - datetime.timedelta(weeks=rows)
        rx = rx.filter(F.col("week_end_date_key").between(F.lit(start), F.lit(display[1])))
    hcps = current_rows(tables["dim_hcp"]).filter(F.col("segment").isin(*segments))
    hcps = hcps.select("hcp_key", F.col("full_name").alias("hcp_name"), "segment", "decile_rank")
    group, order, value = ["hcp_key", "product_key"], ["week_end_date_key"], "total_rx_count"
    # The windows run on keys and counts only; names are joined to their result.
    trend = rx.join(hcps.select("hcp_key"), "hcp_key", "left_semi").withColumns(
        {
            "rolling_avg": windows.rolling_mean(group, order, value, rows, 1),
            "prior_week_rx": windows.prior(group, order, value),
        }
    )
    if display is not None:
        trend = trend.filter(
            F.col("week_end_date_key").between(F.lit(display[0]), F.lit(display[1]))
        )
    wow = windows.change(value, "prior_week_rx")
    pct = F.col("wow_pct_change")
    return (
        trend.join(hcps, "hcp_key")
        .join(_product_names(tables), "product_key")
        .withColumn("wow_change", wow)
        .withColumn("wow_pct_change", num.percent(wow, F.col("prior_week_rx"), 1))
        .withColumn(
            "trend_flag",
            label_ladder(
                [(pct < limit, name) for name, limit in DROP_BELOW.items()]
                + [(pct > limit, name) for name, limit in RISE_ABOVE.items()],
                STABLE,
            ),
        )
        .select(
            "week_end_date_key",
            "hcp_name",
            "segment",
            "decile_rank",
            "brand_name",
            "total_rx_count",
            "rolling_avg",
            "prior_week_rx",
            "wow_change",
            "wow_pct_change",
            "trend_flag",
        )
        .orderBy(asc("hcp_name"), asc("brand_name"), asc("week_end_date_key"))
    )


def attainment_status(attainment: Column) -> Column:
    return label_ladder(
        [(attainment >= floor, name) for name, floor in ATTAINMENT_FROM.items()], ATTAINMENT_ELSE
    )


def attainment_ranking(
    tables: Tables, quarter: Day | None = Day(2023, 8, 1), current_only: bool = False
) -> DataFrame:
    """Each rep against the peers of the district, for the same product and quarter."""
    if not current_only:
        tables = under_current_keys(tables, fct_quota_attainment=["rep_key", "product_key"])
    group = ["district", "product_key", "fiscal_quarter_key"]
    ranked = windows.ranked_by_value(
        _quota_rows(tables, quarter),
        group,
        "attainment_pct",
        dense_rank_desc="district_rank",
        percent_rank="percentile_in_district",
        group_rows="reps_in_district",
        group_sum="_sum",
        group_known="_known",
    )
    mean = F.col("_sum") / F.nullif(F.col("_known"), F.lit(0))
    return (
        ranked.withColumn("district_avg_attainment", F.round(mean, 1))
        .withColumn("vs_district_avg", F.round(F.col("attainment_pct") - mean, 1))
        .withColumn("attainment_status", attainment_status(F.col("attainment_pct")))
        .select(
            "fiscal_quarter_key",
            "district",
            "district_rank",
            "rep_name",
            "current_territory_name",
            "brand_name",
            "quota_units",
            "actual_units",
            "attainment_pct",
            "reps_in_district",
            "percentile_in_district",
            "district_avg_attainment",
            "vs_district_avg",
            "attainment_status",
        )
        .orderBy(asc("district"), asc("brand_name"), asc("district_rank"))
    )


def transfer_attribution(
    tables: Tables,
    durable_key: str | None = None,
    transfer_date: Day | None = None,
    current_only: bool = False,
) -> DataFrame:
    """Visits of reps who moved, by the territory of the visit and the one of today.

    Without a date the transfer is the start of the rep's current version. Without a
    durable key all reps with more than one version are reported. ``current_only`` keeps
    the visits recorded under the current versions of HCP and product.
    """
    if not current_only:
        tables = under_current_keys(tables, fct_hcp_visit=["hcp_key", "product_key"])
    versions = _only(tables["dim_rep"], "rep_durable_key", durable_key)
    if durable_key is None:
        moved = versions.filter(~F.col("is_current")).select("rep_durable_key").distinct()
        versions = versions.join(moved, "rep_durable_key", "left_semi")
    now = current_rows(tables["dim_rep"]).select(
        "rep_durable_key", F.col("effective_date").alias("_moved_on")
    )
    territory = tables["dim_territory"].select(
        "territory_key", F.col("territory_name").alias("territory_at_time_of_visit"), "district_name"
    )
    reps = joins.with_outrigger(
        versions.select(
            "rep_key", "rep_durable_key", "rep_name", "territory_key", "current_territory_name"
        ),
        territory,
        "territory_key",
    ).join(now, "rep_durable_key", "left")
    hcps = current_rows(tables["dim_hcp"]).select(
        "hcp_key", F.col("full_name").alias("hcp_name"), "city", "state"
    )
    visits = (
        joins.as_was(tables["fct_hcp_visit"], reps, "rep_key")
        .join(hcps, "hcp_key")
        .join(_product_names(tables), "product_key")
    )
    moved_on = F.lit(transfer_date) if transfer_date else F.col("_moved_on")
    visits = visits.withColumn(
        "transfer_period",
        F.when(F.col("date_key") < moved_on, PRE_TRANSFER).otherwise(POST_TRANSFER),
    )
    # One rep may have made a large share of all visits.
    numbered = running(
        visits.select(
            "rep_durable_key", "transfer_period", "territory_at_time_of_visit",
            "current_territory_name", "rep_name", "date_key", "hcp_key", "product_key", "visit_id",
            "hcp_name", "city", "state", "brand_name", "samples_dropped",
            "visit_duration_minutes",
        ),
        ["rep_durable_key", "transfer_period"],
        [asc("date_key"), asc("hcp_key"), asc("product_key"), asc("visit_id")],
        position="visit_num_in_period",
        group_rows="visits_in_period",
    )
    return numbered.drop("hcp_key", "product_key", "visit_id").orderBy(
        asc("rep_durable_key"), asc("date_key"), asc("transfer_period"), asc("visit_num_in_period")
    )


def _fits_whole_units(rx: DataFrame, measures: Sequence[str], weight: T.DataType) -> bool:
    """Whether credit of ``rx`` under weights of this type can be summed in 64 bits.

    The factor of 10,000 is left for alignments of one group that share rep name and weight.
    """
    if not isinstance(weight, T.DecimalType) or weight.precision > 18 or not weight.scale:
        return False
    if not all(isinstance(rx.schema[m].dataType, T.IntegralType) for m in measures):
        return False
    sizes = [F.abs(F.col(m).cast("decimal(38,0)")) for m in measures]
    totals = [F.sum(x * F.col("_times")) for x in sizes]
    largest, *totals = (x or 0 for x in rx.agg(F.max(F.greatest(*sizes)), *totals).first())
    above = 10 ** (weight.precision - weight.scale + 1)
    return largest * 10**weight.precision < 1 << 62 and max(totals) * above * 10_000 < 1 << 62


def co_promotion_credit(
    tables: Tables,
    hcp_key: int | None = None,
    group_key: int | None = None,
    match_product: bool = False,
    current_only: bool = False,
) -> DataFrame:
    """Weighted credit per rep, and what counting every rep in full would report.

    Credit is rounded per row before it is summed. ``match_product`` restricts the split
    to the product the alignment names. An HCP's group is the one the bridge gives it;
    ``current_only`` reads the group stored with the rows of current versions.
    """
    if not current_only:
        tables = under_current_keys(
            tables,
            fct_prescription_weekly=["hcp_key", "product_key"],
            bridge_hcp_rep_alignment=["hcp_key", "rep_key", "product_key"],
        )
        rx = tables["fct_prescription_weekly"]
        groups = current_rows(tables["bridge_hcp_rep_alignment"]).select("hcp_key", "group_key")
        rx = rx.drop("group_key").join(groups.distinct(), "hcp_key")
        tables = ChainMap({"fct_prescription_weekly": rx}, tables)
    rx = _only(_only(tables["fct_prescription_weekly"], "hcp_key", hcp_key), "group_key", group_key)
    rx = rx.filter(F.col("group_key").isNotNull()).select(
        "hcp_key", "product_key", "group_key", "total_rx_count", "total_units"
    )
    # Equal rows earn equal credit: counting them first shrinks what the bridge multiplies.
    rx = rx.groupBy(*rx.columns).agg(F.count(F.lit(1)).alias("_times"))
    hcps = current_rows(tables["dim_hcp"]).select("hcp_key", F.col("full_name").alias("hcp_name"))
    bridge = current_rows(tables["bridge_hcp_rep_alignment"]).select(
        "group_key", "rep_key", F.col("product_key").alias("_for_product"), "credit_split_weight"
    )
    reps = current_rows(tables["dim_rep"]).select("rep_key", "rep_name")
    # Volume and alignments meet where the HCP's name sends them, so that what the bridge
    # multiplies is summed in the task that makes it and only sums are shuffled again.
    named = settled(
        rx.join(hcps, "hcp_key")
        .join(_product_names(tables), "product_key")
        .withColumn("_at", F.xxhash64("hcp_name"))
    )
    places = named.select("group_key", "_at").distinct()
    shares = bridge.join(places, "group_key").join(reps, "rep_key")
    # Where it cannot overflow, credit is computed on whole numbers, several times as fast as on
    # decimals: weights in units of their last digit, credit in units of 10**-digits.
    weight, times = F.col("credit_split_weight"), F.col("_times")
    kind = bridge.schema["credit_split_weight"].dataType
    digits = {"total_rx_count": 1, "total_units": 0}
    whole = _fits_whole_units(named, list(digits), kind)
    if whole:
        shares = shares.withColumn("_share", (weight * F.lit(Decimal(10) ** kind.scale)).cast("bigint"))
    split = named.repartition("_at").join(shares.repartition("_at"), ["_at", "group_key"])
    if match_product:
        split = split.filter(F.col("product_key") == F.col("_for_product"))

    def in_decimals(m: str) -> Column:
        return F.sum(F.round(F.col(m).cast("decimal(18,0)") * weight, digits[m]) * times)

    def in_units(m: str) -> Column:
        unit = 10 ** (kind.scale - digits[m])
        full = F.col(m).cast("bigint") * F.col("_share")
        half = F.when(full < 0, -(unit // 2)).otherwise(unit // 2).cast("bigint")  # away from zero
        return F.sum(F.call_function("div", full + half, F.lit(unit).cast("bigint")) * times)

    names = ["rep_name", "hcp_name", "brand_name", "credit_split_weight"]
    out = (
        split.groupBy("_at", *names)
        .agg(
            *[(in_units if whole else in_decimals)(m).alias(f"_own_{m}") for m in digits],
            *[F.sum(F.col(m) * times).alias(f"_all_{m}") for m in digits],
        )
        .drop("_at")
    )
    # Both sides already lie by name, which is all the join needs. Written, so that ranging
    # the rows for their order does not multiply and sum them a second time. A task has more
    # groups than the first of two maps holds, which every row would ask in vain.
    out = settled(
        out,
        {
            "spark.sql.requireAllClusterKeysForCoPartition": "false",
            "spark.sql.codegen.aggregate.map.twolevel.enabled": "false",
        },
    )

    def attributed(m: str) -> Column:
        own = F.col(f"_own_{m}")
        if whole:
            own = own.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits[m]))
        return own.cast(split.agg(in_decimals(m)).schema[0].dataType)

    # Whole numbers become decimals behind the sort: it moves half as many bytes.
    own_rx, own_units = (attributed(m) for m in digits)
    all_rx, all_units = (F.col(f"_all_{m}") for m in digits)
    return out.orderBy(asc("rep_name"), asc("hcp_name"), asc("brand_name")).select(
        *names,
        own_rx.alias("total_attributed_rx"),
        own_units.alias("total_attributed_units"),
        all_rx.alias("total_unweighted_rx"),
        all_units.alias("total_unweighted_units"),
        (all_rx - own_rx).alias("rx_overcount_without_bridge"),
        (all_units - own_units).alias("units_overcount_without_bridge"),
    )


def _against_prior(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Change and percent change of a rounded mean against the previous period."""
    before = F.col("_before")
    return (
        df.withColumn("_before", windows.prior(group, order, value))
        .withColumn("avg_rx_change", F.round(F.col(value) - before, 1))
        .withColumn("avg_rx_pct_change", num.percent_of_decimal(F.col(value) - before, before, 1))
        .drop("_before")
    )


def tier_change_impact(
    tables: Tables,
    durable_key: str | None = None,
    between: tuple[Day, Day] | None = None,
    tier_labels: Mapping[str, str] | None = None,
) -> DataFrame:
    """Volume of an HCP under each version of its tier."""
    rx = tables["fct_prescription_weekly"].select(
        "week_end_date_key", "hcp_key", "product_key", "total_rx_count", "total_units"
    )
    if between is not None:
        rx = rx.filter(F.col("week_end_date_key").between(F.lit(between[0]), F.lit(between[1])))
    hcps = _only(tables["dim_hcp"], "hcp_durable_key", durable_key).select(
        "hcp_key",
        "hcp_durable_key",
        "full_name",
        "segment",
        F.col("effective_date").alias("tier_effective_date"),
        F.col("expiration_date").alias("tier_expiration_date"),
    )
    if durable_key is not None:
        rx = rx.join(hcps.select("hcp_key"), "hcp_key", "left_semi")
    # Summed on keys; the version's attributes are joined to one row per version and product.
    sums = rx.groupBy("hcp_key", "product_key").agg(
        F.countDistinct("week_end_date_key").alias("weeks_in_period"),
        F.sum("total_rx_count").alias("total_rx"),
        num.mean(F.col("total_rx_count"), 1).alias("avg_weekly_rx"),
        F.max("total_rx_count").alias("peak_weekly_rx"),
        F.min("total_rx_count").alias("floor_weekly_rx"),
        F.sum("total_units").alias("total_units"),
    )
    rows = joins.as_was(sums, hcps, "hcp_key").join(_product_names(tables), "product_key")
    labels = [(F.col("segment") == s, text) for s, text in (tier_labels or {}).items()]
    tier = label_ladder(labels) if labels else F.concat(F.lit("Tier "), F.col("segment"))
    rows = rows.withColumn("tier_period", tier)
    group = ["hcp_durable_key", "brand_name"]
    return (
        _against_prior(rows, group, ["tier_effective_date"], "avg_weekly_rx")
        .select(
            "hcp_durable_key",
            "full_name",
            "tier_period",
            "brand_name",
            "segment",
            "tier_effective_date",
            "tier_expiration_date",
            "weeks_in_period",
            "total_rx",
            "avg_weekly_rx",
            "peak_weekly_rx",
            "floor_weekly_rx",
            "total_units",
            F.col("avg_rx_change").alias("avg_rx_change_vs_prior_period"),
            "avg_rx_pct_change",
        )
        .orderBy(asc("hcp_durable_key"), asc("brand_name"), asc("tier_effective_date"))
    )


def yoy_trend(actual: Column, before: Column, band: str = "0.10") -> Column:
    up, down = F.lit(1 + Decimal(band)), F.lit(1 - Decimal(band))
    pct = f"{Decimal(band) * 100:.0f}%"
    return label_ladder(
        [
            (actual > before * up, f"Growing (>{pct})"),
            (actual > before, f"Growing (<{pct})"),
            (actual == before, "Flat"),
            (actual > before * down, f"Declining (<{pct})"),
        ],
        f"Declining (>{pct})",
    )


def yoy_attainment(
    tables: Tables, quarter: Day | None = Day(2023, 8, 1), current_only: bool = False
) -> DataFrame:
    """This quarter against the same quarter a year before, with a running district total."""
    if not current_only:
        tables = under_current_keys(tables, fct_quota_attainment=["rep_key", "product_key"])
    actual, before = F.col("actual_units"), F.col("prior_year_actual_units")
    rows = (
        _quota_rows(tables, quarter)
        .withColumn("yoy_unit_growth", actual - before)
        .withColumn("yoy_growth_pct", num.percent(actual - before, before, 1))
        .withColumn("yoy_trend", yoy_trend(num.as_number(actual), num.as_number(before)))
    )
    rows = windows.running_total(
        rows,
        ["district", "product_key", "fiscal_quarter_key"],
        [desc("attainment_pct"), asc("rep_key")],
        F.col("yoy_unit_growth"),
        "district_cumulative_yoy_growth",
    )
    return rows.select(
        "rep_name",
        "district",
        "current_territory_name",
        "brand_name",
        "fiscal_quarter_key",
        "quota_units",
        "actual_units",
        "attainment_pct",
        "prior_year_actual_units",
        "yoy_unit_growth",
        "yoy_growth_pct",
        "yoy_trend",
        "district_cumulative_yoy_growth",
    ).orderBy(asc("district"), asc("brand_name"), desc("yoy_growth_pct"))


def superseded_batch_audit(
    tables: Tables,
    bad: tuple[str, Day | None],
    corrected: tuple[str, Day | None],
    current_only: bool = True,
    fact: str = "fct_prescription_weekly",
) -> DataFrame:
    """Rows of a bad batch against those of its correction.

    ``current_only`` drops rows stamped with an HCP or product version that has expired.
    """
    rx, audit = tables[fact], tables["dim_audit"].select("audit_key", "batch_id", "dq_notes")
    key, week = ["hcp_key", "product_key", "territory_key"], "week_end_date_key"
    old = batch_rows(rx, audit, bad[0], week, bad[1]).select(
        week,
        *key,
        F.col("total_rx_count").alias("superseded_rx"),
        F.col("total_units").alias("superseded_units"),
        F.col("batch_id").alias("superseded_batch"),
        "dq_notes",
    )
    new = batch_rows(rx, audit, corrected[0], week, corrected[1]).select(
        *key,
        F.col("total_rx_count").alias("corrected_rx"),
        F.col("total_units").alias("corrected_units"),
        F.col("batch_id").alias("corrected_batch"),
    )
    hcps, products = tables["dim_hcp"], tables["dim_product"]
    if current_only:
        hcps, products = current_rows(hcps), current_rows(products)
    hcps = hcps.select("hcp_key", F.col("full_name").alias("hcp_name"), "segment")
    units = F.col("corrected_units") - F.col("superseded_units")
    return (
        old.join(new, key)
        .join(hcps, "hcp_key")
        .join(products.select("product_key", "brand_name"), "product_key")
        .withColumn("rx_discrepancy", F.col("corrected_rx") - F.col("superseded_rx"))
        .withColumn("units_discrepancy", units)
        .withColumn("pct_inflation", num.percent(-units, F.col("corrected_units"), 1))
        .select(
            week,
            "hcp_name",
            "segment",
            "brand_name",
            "superseded_batch",
            "corrected_batch",
            "dq_notes",
            "superseded_rx",
            "corrected_rx",
            "rx_discrepancy",
            "superseded_units",
            "corrected_units",
            "units_discrepancy",
            "pct_inflation",
        )
        .orderBy(desc(F.abs("units_discrepancy")), asc("hcp_name"), asc("brand_name"))
    )


def market_share_trend(
    tables: Tables, fiscal_year: int | None = 2024, band: int = 1
) -> DataFrame:
    """Monthly share per territory and brand, its change, short mean and rank in the district.

    Reads the monthly rollup. The trend windows hold the months of one territory and
    brand; the rank window holds the territories of one district.
    """
    months = _only(tables["dim_month"], "fiscal_year", fiscal_year).select(
        "month_key", "month_name", "fiscal_quarter", "fiscal_year"
    )
    territories = tables["dim_territory_rollup"].select(
        "territory_rollup_key", "territory_name", "district", "region"
    )
    share = num.percent(F.col("brand_units"), F.col("total_market_units"), 2)
    rows = (
        tables["fct_prescription_territory_monthly"]
        .select(
            "month_key", "territory_rollup_key", "product_key", "total_rx_count", "brand_units",
            "total_market_units",
        )
        .join(months, "month_key")
        .join(territories, "territory_rollup_key")
        .join(_product_names(tables), "product_key")
        .withColumn("market_share_pct", share)
    )
    group, order = ["territory_name", "brand_name"], ["month_key"]
    district = Window.partitionBy("district", "brand_name", "month_key")
    moved = F.col("mom_share_change")
    return (
        rows.withColumns(
            {
                "prior_month_share": windows.prior(group, order, "market_share_pct"),
                "rolling_3mo_avg_share": windows.rolling_mean_decimal(
                    group, order, "market_share_pct", 3, 2
                ),
            }
        )
        .withColumn("mom_share_change", windows.change("market_share_pct", "prior_month_share"))
        .withColumn(
            "share_trend",
            label_ladder([(moved > band, GAINING), (moved < -band, LOSING)], HOLDING),
        )
        .withColumn(
            "territory_rank_in_district",
            F.dense_rank().over(district.orderBy(desc("market_share_pct"))),
        )
        .select(
            "fiscal_year",
            "fiscal_quarter",
            "month_key",
            "month_name",
            "territory_name",
            "district",
            "region",
            "brand_name",
            "total_rx_count",
            "brand_units",
            "total_market_units",
            "market_share_pct",
            "prior_month_share",
            "mom_share_change",
            "rolling_3mo_avg_share",
            "share_trend",
            "territory_rank_in_district",
        )
        .orderBy(asc("brand_name"), asc("district"), asc("territory_name"), asc("month_key"))
    )


def decile_validation(
    tables: Tables,
    n: int = 10,
    direction: str = "highest_first",
    mismatches_only: bool = True,
    current_only: bool = False,
) -> DataFrame:
    """Stored deciles that observed volume no longer supports."""
    if not current_only:
        tables = under_current_keys(tables, fct_prescription_weekly=["hcp_key", "product_key"])
    volume = (
        tables["fct_prescription_weekly"]
        .groupBy("hcp_key", "product_key")
        .agg(F.sum("total_rx_count").alias("lifetime_rx_count"))
    )
    hcps = current_rows(tables["dim_hcp"]).select(
        "hcp_key", "full_name", "specialty", "segment", F.col("decile_rank").alias("stored_decile")
    )
    rows = volume.join(hcps, "hcp_key").join(_product_names(tables), "product_key")
    rows = windows.ntile_in(
        rows,
        ["product_key"],
        [desc("lifetime_rx_count"), asc("hcp_key")],
        n,
        "calculated_decile",
    )
    if direction != "highest_first":
        rows = rows.withColumn("calculated_decile", F.lit(n + 1) - F.col("calculated_decile"))
    stored, found = F.col("stored_decile").cast("int"), F.col("calculated_decile")
    drift = stored - found
    if mismatches_only:
        rows = rows.filter(stored != found)
    return (
        rows.withColumn("decile_drift", drift)
        .withColumn(
            "decile_status",
            label_ladder(
                [(drift == 0, ACCURATE), (F.abs(drift) == 1, MINOR_DRIFT)], NEEDS_REFRESH
            ),
        )
        .select(
            "full_name",
            "specialty",
            "segment",
            "brand_name",
            "lifetime_rx_count",
            "stored_decile",
            "calculated_decile",
            "decile_drift",
            "decile_status",
        )
        .orderBy(desc(F.abs("decile_drift")), desc("lifetime_rx_count"), asc("full_name"))
    )


def indication_impact(
    tables: Tables,
    brand: str | None = None,
    current_only: bool = False,
    current_hcps_only: bool = False,
) -> DataFrame:
    """Volume before and after a product's indication was extended, by specialty.

    All versions of a product are read; ``current_only`` keeps just the current one.
    ``current_hcps_only`` keeps the rows recorded under the current versions of HCPs.
    """
    if not current_hcps_only:
        tables = under_current_keys(tables, fct_prescription_weekly=["hcp_key"])
    products = _only(tables["dim_product"], "brand_name", brand)
    if current_only:
        products = current_rows(products)
    products = products.select(
        "product_key",
        "brand_name",
        "indication",
        F.col("effective_date").alias("indication_effective_date"),
        F.when(F.col("is_current"), POST_EXPANSION)
        .otherwise(PRE_EXPANSION)
        .alias("indication_period"),
    )
    rx = joins.only_in(
        tables["fct_prescription_weekly"].select(
            "week_end_date_key", "hcp_key", "product_key", "total_rx_count", "new_rx_count"
        ),
        products.select("product_key"),
        ["product_key"],
    )
    # First per HCP and product on keys alone, then the mean over HCPs of their weekly means.
    per_hcp = rx.groupBy("hcp_key", "product_key").agg(
        F.sum("total_rx_count").alias("total_rx"),
        F.sum("new_rx_count").alias("total_new_rx"),
        F.countDistinct("week_end_date_key").alias("weeks_of_data"),
    )
    weekly = num.ratio(F.col("total_rx"), F.col("weeks_of_data"), 10)
    hcps = current_rows(tables["dim_hcp"]).select("hcp_key", "specialty")
    periods = (
        per_hcp.withColumn("_weekly", weekly)
        .join(products, "product_key")
        .join(hcps, "hcp_key")
        .groupBy(
            "brand_name", "indication_period", "indication", "indication_effective_date", "specialty"
        )
        .agg(
            F.countDistinct("hcp_key").alias("unique_prescribers"),
            F.sum("weeks_of_data").alias("weeks_of_data"),
            F.sum("total_rx").alias("total_rx"),
            F.round(F.sum("_weekly") / F.count("_weekly"), 1).alias("avg_weekly_rx_per_hcp"),
            F.sum("total_new_rx").alias("total_new_rx"),
        )
    )
    return (
        _against_prior(
            periods,
            ["brand_name", "specialty"],
            ["indication_effective_date"],
            "avg_weekly_rx_per_hcp",
        )
        .withColumnRenamed("avg_rx_change", "avg_rx_change_vs_prior")
        .orderBy(asc("brand_name"), asc("specialty"), asc("indication_effective_date"))
    )


def drill_across_top_decile(
    tables: Tables,
    quarter: Day | None = Day(2023, 8, 1),
    threshold: int = 80,
    decile: int = 10,
    current_only: bool = False,
) -> DataFrame:
    """Are reps below quota also below average on visits to HCPs of the top decile?

    Quota and visits are each brought to rep and quarter before they are joined. The
    average is over all reps with a quota in the quarter, those without a visit included.
    """
    if not current_only:
        tables = under_current_keys(
            tables, fct_quota_attainment=["rep_key"], fct_hcp_visit=["rep_key", "hcp_key"]
        )
    quotas = _only(tables["fct_quota_attainment"], "fiscal_quarter_key", quarter)
    at = ["fiscal_quarter_key", "rep_key"]
    per_rep = quotas.groupBy(*at).agg(
        F.sum("quota_units").alias("quota_units"), F.sum("actual_units").alias("actual_units")
    )
    reps = current_rows(tables["dim_rep"]).select("rep_key", "rep_name", "district")
    top = current_rows(tables["dim_hcp"]).filter(F.col("decile_rank") == decile).select("hcp_key")
    visits = (
        _visits_in(tables, quarter)
        .join(top, "hcp_key", "left_semi")
        .groupBy(*at)
        .agg(F.count(F.lit(1)).alias("top_decile_visits"))
    )
    rows = joins.zero_fill(per_rep.join(reps, "rep_key"), visits, at, ["top_decile_visits"])
    rows = attach_group_stats(
        rows,
        ["fiscal_quarter_key"],
        {"_visits": F.sum("top_decile_visits")},
        size="reps_in_quarter",
    )
    made, n = F.col("top_decile_visits"), F.col("reps_in_quarter")
    return (
        rows.withColumn("attainment_pct", num.percent(F.col("actual_units"), F.col("quota_units"), 2))
        .filter(F.col("attainment_pct") < threshold)
        .withColumn("avg_top_decile_visits", num.ratio(F.col("_visits"), n, 2))
        .withColumn(
            "visit_effort",
            label_ladder(
                [
                    (made * n < F.col("_visits"), "Below average"),
                    (made * n == F.col("_visits"), "At average"),
                ],
                "Above average",
            ),
        )
        .select(
            "fiscal_quarter_key",
            "rep_key",
            "rep_name",
            "district",
            "quota_units",
            "actual_units",
            "attainment_pct",
            "top_decile_visits",
            "reps_in_quarter",
            "avg_top_decile_visits",
            "visit_effort",
        )
        .orderBy(asc("fiscal_quarter_key"), asc("attainment_pct"), asc("rep_key"))
    )
