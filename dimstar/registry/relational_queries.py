"""Windows, joins and aggregations over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimstar.functions import numeric as num
from dimstar.functions.calendar import quarter_key
from dimstar.functions.labels import asc, desc, label_ladder
from dimstar.operators import dims, joins, windows
from dimstar.operators.skew import attach_group_stats
from dimstar.registry.base import Query, rounded, rounded_units
from dimstar.sources import adapter as ad
from dimstar.sources.adapter import SalesStar

RX, VISITS = "fct_prescription_weekly", "fct_hcp_visit"
QUOTA, TARGETS = "fct_quota_attainment", "fct_hcp_coverage_target"
HCP_WEEKS = "PARTITION BY hcp_key, product_key ORDER BY week_end_date_key"
PEERS = "PARTITION BY district, product_key, fiscal_quarter_key"
RX_KEYS = "hcp_key:i product_key:i week_end_date_key:t total_rx_count:i"
QUOTA_KEYS = "rep_key:i product_key:i fiscal_quarter_key:t district:s attainment_pct:d"


def rx(s: SalesStar) -> DataFrame:
    return s[RX].select("hcp_key", "product_key", "week_end_date_key", "total_rx_count")


def rolling(s: SalesStar, rows: int) -> DataFrame:
    by = (["hcp_key", "product_key"], ["week_end_date_key"])
    return rx(s).withColumn("mean", windows.rolling_mean(*by, "total_rx_count", rows, 1))


def lagged(s: SalesStar) -> DataFrame:
    by = (["hcp_key", "product_key"], ["week_end_date_key"])
    out = rx(s).withColumn("before", windows.prior(*by, "total_rx_count"))
    return out.withColumn("change", windows.change("total_rx_count", "before"))


def rolling_sql(rows: int) -> str:
    frame = f"({HCP_WEEKS} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    mean = rounded(f"sum(total_rx_count) OVER {frame}", f"count(*) OVER {frame}", 1)
    return f"SELECT *, {mean} AS mean FROM {RX}"


def quotas(s: SalesStar) -> DataFrame:
    """Every quota row with the district of the version it was stamped with."""
    reps = s["dim_rep"].select("rep_key", "district")
    cols = ["rep_key", "product_key", "fiscal_quarter_key", "attainment_pct"]
    units = ["quota_units", "actual_units", "prior_year_actual_units"]
    return joins.as_was(s[QUOTA].select(*cols, *units), reps, "rep_key")


QUOTAS_SQL = (
    f"(SELECT q.*, r.district, attainment_cents / 100.0 AS attainment_pct "
    f"FROM {QUOTA} q JOIN dim_rep r USING (rep_key))"
)


def gap_to_mean(s: SalesStar) -> DataFrame:
    group = ["district", "product_key", "fiscal_quarter_key"]
    out = attach_group_stats(
        quotas(s), group, {"total": F.sum("attainment_pct")}, size="peers"
    )
    mean = F.col("total") / F.col("peers")
    return out.withColumn("peer_mean", F.round(mean, 1)).withColumn(
        "gap", F.round(F.col("attainment_pct") - mean, 1)
    )


def visits_by_rep_number(s: SalesStar) -> DataFrame:
    rows = s[VISITS].select("rep_key", "date_key", "hcp_key", "product_key")
    order = [asc("date_key"), asc("hcp_key"), asc("product_key")]
    return windows.row_number_in(rows, ["rep_key"], order, "visit_number")


def all_visits_in_order(s: SalesStar) -> DataFrame:
    """One group that holds every row."""
    rows = s[VISITS].select("rep_key", "date_key", "hcp_key", "product_key", "samples_dropped")
    order = [asc(c) for c in ["date_key", "rep_key", "hcp_key", "product_key"]]
    return windows.running_total(rows, [], order, F.col("samples_dropped"), "samples_so_far")


def deciles(s: SalesStar) -> DataFrame:
    volume = s[RX].groupBy("hcp_key", "product_key").agg(F.sum("total_rx_count").alias("volume"))
    return windows.ntile_in(
        volume, ["product_key"], [desc("volume"), asc("hcp_key")], 10, "decile"
    )


def rx_with_names(s: SalesStar) -> DataFrame:
    hcps = s["dim_hcp"].select("hcp_key", "full_name", "segment", "is_current")
    products = s["dim_product"].select("product_key", "brand_name", "is_current")
    named = joins.with_current(rx(s), hcps, "hcp_key").drop("is_current")
    return joins.with_current(named, products, "product_key")


def visits_as_was(s: SalesStar) -> DataFrame:
    reps = s["dim_rep"].select("rep_key", "district", "current_territory_name")
    per = s[VISITS].groupBy("rep_key").agg(F.count(F.lit(1)).alias("visits"))
    return joins.as_was(per, reps, "rep_key")


def rep_territories(s: SalesStar) -> DataFrame:
    return joins.with_outrigger(
        s["dim_rep"].select("rep_key", "rep_durable_key", "territory_key"),
        s["dim_territory"].select("territory_key", "territory_name", "district_name", "zone_name"),
        "territory_key",
    )


def visits_with_quarter(s: SalesStar) -> DataFrame:
    dates = s["dim_date"].select("date_key", "fiscal_year", "fiscal_quarter")
    return (
        s[VISITS]
        .groupBy("date_key")
        .agg(F.count(F.lit(1)).alias("visits"), F.sum("samples_dropped").alias("samples"))
        .join(dates, "date_key")
        .groupBy("fiscal_year", "fiscal_quarter")
        .agg(F.sum("visits").alias("visits"), F.sum("samples").alias("samples"))
    )


TARGET_KEYS = ["fiscal_quarter_key", "rep_key", "hcp_key", "product_key"]


def visits_per_target(s: SalesStar) -> DataFrame:
    dates = s["dim_date"].select("date_key", "fiscal_year", "fiscal_quarter")
    quarter = quarter_key(F.col("fiscal_year").cast("int"), F.col("fiscal_quarter").cast("int"))
    return (
        s[VISITS]
        .join(dates, "date_key")
        .groupBy(quarter.alias("fiscal_quarter_key"), "rep_key", "hcp_key", "product_key")
        .agg(F.count(F.lit(1)).alias("visits_made"))
    )


def split_credit(s: SalesStar) -> DataFrame:
    bridge = s["bridge_hcp_rep_alignment"].select("group_key", "rep_key", "credit_split_weight")
    fact = s["shared_rx"].filter("group_key IS NOT NULL")
    credit = F.round(
        F.col("total_rx_count").cast("decimal(18,0)") * F.col("credit_split_weight"), 1
    )
    return fact.join(bridge, "group_key").withColumn("attributed_rx", credit)


def overcount(s: SalesStar) -> DataFrame:
    sums = split_credit(s).groupBy("rep_key").agg(
        F.sum("attributed_rx").alias("attributed_rx"), F.sum("total_rx_count").alias("unweighted_rx")
    )
    return sums.withColumn("overcount", F.col("unweighted_rx") - F.col("attributed_rx"))


def versions_at_visits(s: SalesStar) -> DataFrame:
    """Visits of each HCP version and its tier on the day of the visit: equi-join plus range."""
    sales = s["sales"].filter("status = 'F'").groupBy("custkey", "day").agg(
        F.count(F.lit(1)).alias("lines")
    )
    versions = s["hcp_versions"]
    on = (
        (sales["custkey"] == versions["custkey"])
        & (versions["effective_date"] <= sales["day"])
        & (versions["expiration_date"].isNull() | (versions["expiration_date"] >= sales["day"]))
    )
    return sales.join(versions, on).groupBy("hcp_key", "segment").agg(F.sum("lines").alias("lines"))


def batches_side_by_side(s: SalesStar) -> DataFrame:
    keys = ["hcp_key", "product_key", "territory_key"]
    fact = s["rx_with_batches"]
    bad = fact.filter(F.col("audit_key") == ad.BAD_BATCH)
    fix = fact.filter(F.col("audit_key") == ad.FIX_BATCH)
    return bad.select(*keys, F.col("total_units").alias("bad_units")).join(
        fix.select(*keys, F.col("total_units").alias("fixed_units")), keys
    )


def rx_and_visits(s: SalesStar) -> DataFrame:
    return joins.drill_across(
        s[RX],
        s[VISITS],
        ["hcp_key", "product_key"],
        [F.sum("total_rx_count").alias("total_rx")],
        [F.count(F.lit(1)).alias("visits")],
    )


def flag_use(s: SalesStar) -> DataFrame:
    """All combinations of flags, those without a visit included."""
    flags = list(s["dim_visit_flags"].columns[1:])
    used = s[VISITS].groupBy(*flags).agg(F.count(F.lit(1)).alias("visits"))
    return joins.zero_fill(s["dim_visit_flags"], used, flags, ["visits"])


def two_level(s: SalesStar) -> DataFrame:
    per = s[RX].groupBy("hcp_key", "product_key").agg(
        F.sum("total_rx_count").alias("rx"), F.countDistinct("week_end_date_key").alias("weeks")
    )
    per = per.withColumn("weekly", num.ratio(F.col("rx"), F.col("weeks"), 10))
    named = joins.with_current(
        per, s["dim_hcp"].select("hcp_key", "specialty", "is_current"), "hcp_key"
    )
    return named.groupBy("specialty").agg(
        F.round(F.sum("weekly") / F.count("weekly"), 2).alias("mean_of_means"),
        F.countDistinct("hcp_key").alias("hcps"),
    )


def by_volume_class(s: SalesStar) -> DataFrame:
    rx_count = F.col("total_rx_count")
    size = label_ladder([(rx_count >= 40, "large"), (rx_count >= 20, "medium")], "small")
    return (
        s[RX]
        .withColumn("row_size", size)
        .groupBy("row_size", "product_key")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("total_rx_count").alias("total_rx"))
    )


def returned_share(s: SalesStar) -> DataFrame:
    """Conditional sum inside a group aggregate, and the share it makes."""
    none = F.sum(F.when(F.col("new_rx_count") == 0, 1).otherwise(0))
    per = s[RX].groupBy("product_key").agg(
        none.alias("rows_without_new"), F.count(F.lit(1)).alias("row_count")
    )
    return per.withColumn("pct", num.percent(F.col("rows_without_new"), F.col("row_count"), 1))


LEVELS = ["territory_name", "district_name", "region_name", "zone_name", "national"]


def all_levels(s: SalesStar) -> DataFrame:
    return joins.by_levels(
        s["fct_prescription_territory_monthly"],
        s["dim_territory"].withColumnRenamed("territory_key", "territory_rollup_key"),
        "territory_rollup_key",
        LEVELS,
        {"total_rx": "total_rx_count", "total_units": "total_units"},
    )


def distinct_counts(s: SalesStar) -> DataFrame:
    """Two distinct counts of a group, each from rows brought to its own grain first."""
    per_hcp = s[VISITS].groupBy("rep_key", "hcp_key").agg(F.count(F.lit(1)).alias("n"))
    per_rep = per_hcp.groupBy("rep_key").agg(
        F.sum("n").alias("visits"), F.count("hcp_key").alias("hcps")
    )
    days = s[VISITS].select("rep_key", "date_key").distinct().groupBy("rep_key").agg(
        F.count("date_key").alias("days")
    )
    return per_rep.join(days, "rep_key")


LEVELS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS level, {c} AS place, sum(total_rx_count) AS total_rx, "
    f"sum(total_units) AS total_units FROM fct_monthly JOIN dim_territory USING (territory_key) "
    f"GROUP BY {c}"
    for c in LEVELS
)

QUERIES = [
    Query("w_rolling_avg_13", f"{RX_KEYS} mean:d", lambda s: rolling(s, 13), rolling_sql(13)),
    Query("w_rolling_avg_3", f"{RX_KEYS} mean:d", lambda s: rolling(s, 3), rolling_sql(3)),
    Query(
        "w_lag_change",
        f"{RX_KEYS} before:i change:i",
        lagged,
        f"SELECT *, lag(total_rx_count) OVER w AS before, total_rx_count - before AS change "
        f"FROM {RX} WINDOW w AS ({HCP_WEEKS})",
    ),
    Query(
        "w_lag_pct",
        f"{RX_KEYS} pct:d",
        lambda s: lagged(s).withColumn("pct", num.percent(F.col("change"), F.col("before"), 1)),
        f"SELECT *, {rounded('(total_rx_count - before)', 'before', 1, 100)} AS pct FROM "
        f"(SELECT *, lag(total_rx_count) OVER ({HCP_WEEKS}) AS before FROM {RX})",
    ),
    Query(
        "w_dense_rank_district",
        f"{QUOTA_KEYS} place:i",
        lambda s: windows.ranked_by_value(
            quotas(s), ["district", "product_key", "fiscal_quarter_key"], "attainment_pct",
            dense_rank_desc="place",
        ),
        f"SELECT *, dense_rank() OVER ({PEERS} ORDER BY attainment_cents DESC NULLS FIRST) "
        f"AS place FROM {QUOTAS_SQL}",
    ),
    Query(
        "w_percent_rank",
        f"{QUOTA_KEYS} percentile:d",
        lambda s: windows.ranked_by_value(
            quotas(s), ["district", "product_key", "fiscal_quarter_key"], "attainment_pct",
            percent_rank="percentile",
        ),
        f"SELECT *, CASE WHEN n = 1 THEN 0 ELSE {rounded('(low - 1)', '(n - 1)', 1, 100)} END "
        f"AS percentile FROM (SELECT *, rank() OVER (g ORDER BY attainment_cents NULLS LAST) AS "
        f"low, count(*) OVER g AS n FROM {QUOTAS_SQL} WINDOW g AS ({PEERS}))",
    ),
    Query(
        "w_partition_avg_gap",
        f"{QUOTA_KEYS} peers:i peer_mean:d gap:d",
        gap_to_mean,
        f"SELECT *, {rounded('total', '(peers * 100)', 1)} AS peer_mean, "
        f"{rounded('(attainment_cents * peers - total)', '(peers * 100)', 1)} AS gap FROM "
        f"(SELECT *, count(*) OVER g AS peers, sum(attainment_cents) OVER g AS total "
        f"FROM {QUOTAS_SQL} WINDOW g AS ({PEERS}))",
    ),
    Query(
        "w_partition_share",
        "rep_key:i product_key:i fiscal_quarter_key:t attainment_pct:d pct_below:d",
        lambda s: windows.share_of_group(
            quotas(s), ["rep_key"], F.col("attainment_pct") < 80, "pct_below",
        ),
        f"SELECT *, {rounded('sum(CASE WHEN attainment_cents < 8000 THEN 1 ELSE 0 END) OVER g', 'count(*) OVER g', 1, 100)} "
        f"AS pct_below FROM {QUOTAS_SQL} WINDOW g AS (PARTITION BY rep_key)",
    ),
    Query(
        "w_running_total",
        f"{QUOTA_KEYS} growth_so_far:i",
        lambda s: windows.running_total(
            quotas(s), ["district", "product_key", "fiscal_quarter_key"],
            [desc("attainment_pct"), asc("rep_key")],
            F.col("actual_units") - F.col("prior_year_actual_units"), "growth_so_far",
        ),
        f"SELECT *, sum(actual_units - prior_year_actual_units) OVER ({PEERS} ORDER BY "
        f"attainment_cents DESC NULLS FIRST, rep_key ROWS UNBOUNDED PRECEDING) AS growth_so_far "
        f"FROM {QUOTAS_SQL}",
    ),
    Query(
        "w_running_total_one_group",
        "rep_key:i date_key:t hcp_key:i product_key:i samples_dropped:i samples_so_far:i",
        all_visits_in_order,
        f"SELECT *, sum(samples_dropped) OVER (ORDER BY date_key, rep_key, hcp_key, product_key "
        f"ROWS UNBOUNDED PRECEDING) AS samples_so_far FROM {VISITS}",
    ),
    Query(
        "w_row_number_period",
        "rep_key:i date_key:t hcp_key:i product_key:i visit_number:i",
        visits_by_rep_number,
        f"SELECT *, row_number() OVER (PARTITION BY rep_key ORDER BY date_key, hcp_key, "
        f"product_key) AS visit_number FROM {VISITS}",
    ),
    Query(
        "w_ntile_decile",
        "hcp_key:i product_key:i volume:i decile:i",
        deciles,
        f"SELECT *, ntile(10) OVER (PARTITION BY product_key ORDER BY volume DESC, hcp_key) AS "
        f"decile FROM (SELECT hcp_key, product_key, sum(total_rx_count) AS volume FROM {RX} "
        f"GROUP BY ALL)",
    ),
    Query(
        "j_current_dim",
        f"{RX_KEYS} full_name:s segment:s brand_name:s",
        rx_with_names,
        f"SELECT * FROM {RX} JOIN (SELECT hcp_key, full_name, segment FROM dim_hcp WHERE "
        f"is_current) USING (hcp_key) JOIN (SELECT product_key, brand_name FROM dim_product "
        f"WHERE is_current) USING (product_key)",
    ),
    Query(
        "j_as_was",
        "rep_key:i district:s current_territory_name:s visits:i",
        visits_as_was,
        f"SELECT rep_key, district, current_territory_name, count(*) AS visits FROM {VISITS} "
        f"JOIN dim_rep USING (rep_key) GROUP BY ALL",
    ),
    Query(
        "j_outrigger",
        "rep_key:i rep_durable_key:s territory_key:i territory_name:s district_name:s zone_name:s",
        rep_territories,
        "SELECT * FROM dim_rep JOIN dim_territory USING (territory_key)",
    ),
    Query(
        "j_date_period",
        "fiscal_year:i fiscal_quarter:i visits:i samples:i",
        visits_with_quarter,
        f"SELECT year(date_key) + CASE WHEN month(date_key) >= 8 THEN 1 ELSE 0 END AS "
        f"fiscal_year, (month(date_key) + 4) % 12 // 3 + 1 AS fiscal_quarter, count(*) AS visits, "
        f"sum(samples_dropped) AS samples FROM {VISITS} GROUP BY 1, 2",
    ),
    Query(
        "j_left_zero_fill",
        "fiscal_quarter_key:t rep_key:i hcp_key:i product_key:i visits_made:i",
        lambda s: joins.zero_fill(s[TARGETS], visits_per_target(s), TARGET_KEYS, ["visits_made"]),
        f"SELECT fiscal_quarter_key, rep_key, hcp_key, product_key, "
        f"coalesce(n, 0) AS visits_made FROM {TARGETS} LEFT JOIN (SELECT fiscal_quarter_key, "
        f"rep_key, hcp_key, product_key, count(*) AS n FROM {VISITS} GROUP BY ALL) "
        f"USING (fiscal_quarter_key, rep_key, hcp_key, product_key)",
    ),
    Query(
        "j_semi",
        RX_KEYS,
        lambda s: joins.only_in(
            rx(s), dims.current_rows(s["dim_hcp"]).filter("segment = 'A'"), ["hcp_key"]
        ),
        f"SELECT * FROM {RX} WHERE hcp_key IN (SELECT hcp_key FROM dim_hcp WHERE is_current AND "
        f"segment = 'A')",
    ),
    Query(
        "j_anti_gap",
        "fiscal_quarter_key:t rep_key:i hcp_key:i product_key:i",
        lambda s: joins.gaps(s[TARGETS], visits_per_target(s), TARGET_KEYS),
        f"SELECT * FROM {TARGETS} t WHERE NOT EXISTS (SELECT 1 FROM {VISITS} v WHERE "
        f"v.fiscal_quarter_key = t.fiscal_quarter_key AND v.rep_key = t.rep_key AND v.hcp_key = "
        f"t.hcp_key AND v.product_key = t.product_key)",
    ),
    Query(
        "j_bridge",
        f"{RX_KEYS} rep_key:i credit_split_weight:d attributed_rx:d",
        split_credit,
        f"SELECT *, weight_nano / 1000000000.0 AS credit_split_weight, "
        f"{rounded('total_rx_count * weight_nano', '1000000000', 1)} AS attributed_rx "
        f"FROM (SELECT hcp_key, product_key, week_end_date_key, total_rx_count FROM {RX}) "
        f"JOIN (SELECT hcp_key, rep_key, weight_nano FROM bridge) USING (hcp_key)",
    ),
    Query(
        "j_validity_range",
        "hcp_key:i segment:s lines:i",
        versions_at_visits,
        "SELECT hcp_key, segment, count(*) AS lines FROM sales s JOIN hcp_versions v ON "
        "s.custkey = v.custkey AND v.effective_date <= s.day AND (v.expiration_date IS NULL OR "
        "v.expiration_date >= s.day) WHERE status = 'F' GROUP BY ALL",
    ),
    Query(
        "j_self_batches",
        "hcp_key:i product_key:i territory_key:i bad_units:i fixed_units:i",
        batches_side_by_side,
        f"SELECT b.hcp_key, b.product_key, b.territory_key, b.total_units AS bad_units, "
        f"f.total_units AS fixed_units FROM rx_with_batches b JOIN rx_with_batches f "
        f"USING (hcp_key, product_key, territory_key) WHERE b.audit_key = {ad.BAD_BATCH} AND "
        f"f.audit_key = {ad.FIX_BATCH}",
    ),
    Query(
        "j_drill_across",
        "hcp_key:i product_key:i total_rx:i visits:i",
        rx_and_visits,
        f"SELECT * FROM (SELECT hcp_key, product_key, sum(total_rx_count) AS total_rx FROM {RX} "
        f"GROUP BY ALL) FULL JOIN (SELECT hcp_key, product_key, count(*) AS visits FROM {VISITS} "
        f"GROUP BY ALL) USING (hcp_key, product_key)",
    ),
    Query(
        "j_flags_cross",
        "visit_flags_key:i visit_type:s call_type:s access_type:s program_type:s visits:i",
        flag_use,
        f"SELECT *, coalesce(n, 0) AS visits FROM (SELECT row_number() OVER (ORDER BY v, c, a, p) "
        f"AS visit_flags_key, visit_type, call_type, access_type, program_type FROM "
        f"(VALUES (1, 'in_person'), (2, 'virtual')) AS q(v, visit_type) CROSS JOIN "
        f"(VALUES (1, 'planned'), (2, 'unplanned')) AS w(c, call_type) CROSS JOIN (VALUES (1, "
        f"'saw_physician'), (2, 'drop_off')) AS x(a, access_type) CROSS JOIN (VALUES (1, "
        f"'standard_call'), (2, 'lunch_program')) AS y(p, program_type)) LEFT JOIN (SELECT visit_type, "
        f"call_type, access_type, program_type, count(*) AS n FROM {VISITS} GROUP BY ALL) "
        f"USING (visit_type, call_type, access_type, program_type)",
    ),
    Query(
        "a_count_distinct",
        "rep_key:i visits:i hcps:i days:i",
        distinct_counts,
        f"SELECT rep_key, count(*) AS visits, count(DISTINCT hcp_key) AS hcps, "
        f"count(DISTINCT date_key) AS days FROM {VISITS} GROUP BY rep_key",
    ),
    Query(
        "a_two_level_avg",
        "specialty:s mean_of_means:d hcps:i",
        two_level,
        f"SELECT specialty, {rounded(f'sum({rounded_units('rx', 'weeks', 10)})', '(count(*) * 10000000000)', 2)} "
        f"AS mean_of_means, count(DISTINCT hcp_key) AS hcps FROM (SELECT hcp_key, product_key, "
        f"sum(total_rx_count) AS rx, count(DISTINCT week_end_date_key) AS weeks FROM {RX} "
        f"GROUP BY ALL) JOIN (SELECT hcp_key, specialty FROM dim_hcp WHERE is_current) "
        f"USING (hcp_key) GROUP BY specialty",
    ),
    Query(
        "a_case_group",
        "row_size:s product_key:i row_count:i total_rx:i",
        by_volume_class,
        f"SELECT CASE WHEN total_rx_count >= 40 THEN 'large' WHEN total_rx_count >= 20 THEN "
        f"'medium' ELSE 'small' END AS row_size, product_key, count(*) AS row_count, "
        f"sum(total_rx_count) AS total_rx FROM {RX} GROUP BY 1, 2",
    ),
    Query(
        "a_conditional_sum",
        "product_key:i rows_without_new:i row_count:i pct:d",
        returned_share,
        f"SELECT *, {rounded('rows_without_new', 'row_count', 1, 100)} AS pct FROM (SELECT "
        f"product_key, sum(CASE WHEN new_rx_count = 0 THEN 1 ELSE 0 END) AS rows_without_new, "
        f"count(*) AS row_count FROM {RX} GROUP BY product_key)",
    ),
    Query(
        "a_min_max",
        "hcp_key:i product_key:i peak:i floor:i mean:d total:i",
        lambda s: s[RX].groupBy("hcp_key", "product_key").agg(
            F.max("total_rx_count").alias("peak"),
            F.min("total_rx_count").alias("floor"),
            num.mean(F.col("total_rx_count"), 1).alias("mean"),
            F.sum("total_rx_count").alias("total"),
        ),
        f"SELECT hcp_key, product_key, max(total_rx_count) AS peak, min(total_rx_count) AS floor, "
        f"{rounded('sum(total_rx_count)', 'count(*)', 1)} AS mean, sum(total_rx_count) AS total "
        f"FROM {RX} GROUP BY hcp_key, product_key",
    ),
    Query(
        "a_overcount",
        "rep_key:i attributed_rx:d unweighted_rx:i overcount:d",
        overcount,
        f"SELECT rep_key, sum(tenths) / 10.0 AS attributed_rx, sum(total_rx_count) AS "
        f"unweighted_rx, (sum(total_rx_count) * 10 - sum(tenths)) / 10.0 AS overcount FROM "
        f"(SELECT rep_key, total_rx_count, "
        f"{rounded_units('total_rx_count * weight_nano', '1000000000', 1)} AS tenths FROM {RX} JOIN "
        f"(SELECT hcp_key, rep_key, weight_nano FROM bridge) USING (hcp_key)) GROUP BY rep_key",
    ),
    Query(
        "a_by_level", "level:s place:s total_rx:i total_units:i", all_levels, LEVELS_SQL
    ),
]
