"""Dimension builders and slowly changing dimensions over whole tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimstar.functions import calendar as cal
from dimstar.operators import dims, scd
from dimstar.registry.base import Query, fiscal_quarter, fiscal_year, quarter_start
from dimstar.sources import adapter as ad
from dimstar.sources.adapter import SalesStar

AS_OF = datetime.date(1999, 1, 15)
MERGE_FROM = datetime.date(2001, 8, 1)


def date_dim(s: SalesStar) -> DataFrame:
    days = s.raw("lineitem").select(F.to_date("l_shipdate").alias("day"))
    return dims.date_dim_of(days, "day")


HOLIDAY = """CASE
  WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year''s Day'
  WHEN month(d) = 7 AND day(d) = 4 THEN 'Independence Day'
  WHEN month(d) = 11 AND isodow(d) = 4 AND day(d) BETWEEN 22 AND 28 THEN 'Thanksgiving'
  WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas' END"""

DAYS_SQL = (
    "(SELECT CAST(unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) "
    "AS DATE) AS d FROM lineitem)"
)


def month_dim(s: SalesStar) -> DataFrame:
    return dims.month_dim_of(
        s.raw("orders").select(F.to_date("o_orderdate").alias("day")), "day"
    )


def flags(s: SalesStar) -> DataFrame:
    return dims.junk_dim(s.raw("lineitem"), ["l_returnflag", "l_linestatus"], "flags_key")


def notes(s: SalesStar) -> DataFrame:
    fact, text = dims.split_text_dim(
        s.raw("documents"), "doc_id", "text", "call_notes_key", ["lang"]
    )
    return text.join(fact.select("call_notes_key", "source"), "call_notes_key")


def customer_log(s: SalesStar) -> DataFrame:
    """Customers as they would arrive in an overwrite file: some with a new balance class."""
    return s.raw("customer").select(
        F.concat(F.lit("HCP-"), F.col("c_custkey").cast("string")).alias("hcp_durable_key"),
        F.when(F.col("c_acctbal") < 0, "overdrawn").alias("specialty"),
    )


def overwritten(s: SalesStar) -> DataFrame:
    dim = s["dim_hcp"].select("hcp_key", "hcp_durable_key", "specialty")
    return scd.scd1_overwrite(dim, customer_log(s), "hcp_durable_key", ["specialty"])


def launch_dates(s: SalesStar) -> DataFrame:
    """First order day per brand, kept where known and filled where not."""
    first = (
        s["sales"].groupBy(F.col("brand").alias("brand_name")).agg(F.min("day").alias("launch_date"))
    )
    known = F.col("brand_name").isin(ad.SPLIT_BRAND, "SMALL")
    dim = s["dim_product"].select(
        "product_key", "brand_name", F.when(known, F.col("launch_date")).alias("launch_date")
    )
    return scd.scd0_retain(dim, first, "brand_name", ["launch_date"])


def tiers(s: SalesStar) -> DataFrame:
    return scd.scd2(s["hcp_snapshots"], "custkey", ["segment"], "snapshot_date")


def merged(s: SalesStar) -> DataFrame:
    """The last year arrives as an increment to the dimension built from the years before."""
    snapshots = s["hcp_snapshots"]
    day = F.col("snapshot_date")
    before = scd.scd2(snapshots.filter(day < F.lit(MERGE_FROM)), "custkey", ["segment"], "snapshot_date")
    arriving = snapshots.filter(day >= F.lit(MERGE_FROM))
    return scd.scd2_merge(before, arriving, "custkey", ["segment"], "snapshot_date")


def overlay(s: SalesStar) -> DataFrame:
    versions = s["rep_versions"].select("rep_key", "suppkey", "territory_key", "effective_date")
    return scd.scd6_overlay(versions, "suppkey", ["territory_key"], "now_")


def keyed(s: SalesStar) -> DataFrame:
    weekly = s["weekly_sums"].select("week_end_date_key", "custkey", "brand", "total_rx_count")
    return dims.surrogate_key(weekly, ["week_end_date_key", "custkey", "brand"], "prescription_key")


def roles(s: SalesStar) -> DataFrame:
    dates = s["dim_date"].select("date_key", "fiscal_period_name")
    quotas = s["fct_quota_attainment"].groupBy("fiscal_quarter_key", "prior_year_quarter_key").agg(
        F.sum("actual_units").alias("actual_units")
    )
    now, before = dims.role_play(dates, "this_"), dims.role_play(dates, "prior_")
    return quotas.join(now, F.col("fiscal_quarter_key") == F.col("this_date_key")).join(
        before, F.col("prior_year_quarter_key") == F.col("prior_date_key")
    )


def load_log(s: SalesStar) -> DataFrame:
    """Events as a load log: one batch per day, errors count as rejected rows."""
    return dims.audit_dim(
        s.raw("events").select(
            F.date_format("ts", "yyyy-MM-dd").alias("batch_id"),
            F.lit("event_feed").alias("source_system"),
            F.col("ts").alias("loaded_at"),
            (F.col("event_type") == "error").alias("rejected"),
        )
    )


def hcp_deciles(s: SalesStar, direction: str) -> DataFrame:
    sales = s["sales"].select("custkey", "qty")
    return dims.band_decile(sales, "custkey", "qty", 10, direction)


PLACES = (
    "territory_key:i territory_code:s territory_name:s district_code:s district_name:s "
    "region_code:s region_name:s zone_code:s zone_name:s national:s"
)
DECILE = (
    "SELECT custkey, volume, {band} AS band FROM (SELECT custkey, volume, ntile(10) OVER (ORDER BY "
    "volume DESC, custkey) AS n FROM (SELECT custkey, sum(qty) AS volume FROM sales GROUP BY custkey))"
)

QUERIES = [
    Query(
        "d_date",
        "date_key:t day_of_week_num:i day_of_week_name:s day_of_month:i week_number:i month_num:i "
        "month_name:s calendar_quarter:i calendar_year:i fiscal_quarter:i fiscal_year:i "
        "fiscal_quarter_name:s fiscal_period_name:s is_weekend:b is_holiday:b holiday_name:s",
        date_dim,
        f"SELECT d AS date_key, isodow(d) % 7 + 1 AS day_of_week_num, dayname(d) AS "
        f"day_of_week_name, day(d) AS day_of_month, weekofyear(d) AS week_number, month(d) AS "
        f"month_num, monthname(d) AS month_name, quarter(d) AS calendar_quarter, year(d) AS "
        f"calendar_year, {fiscal_quarter('d')} AS fiscal_quarter, {fiscal_year('d')} AS "
        f"fiscal_year, 'FQ' || {fiscal_quarter('d')} || ' ' || {fiscal_year('d')} AS "
        f"fiscal_quarter_name, 'FY' || {fiscal_year('d')} || ' Q' || {fiscal_quarter('d')} AS "
        f"fiscal_period_name, isodow(d) >= 6 AS is_weekend, {HOLIDAY} IS NOT NULL AS is_holiday, "
        f"{HOLIDAY} AS holiday_name FROM {DAYS_SQL}",
    ),
    Query(
        "d_month",
        "month_key:t month_name:s month_num:i calendar_quarter:i calendar_year:i fiscal_quarter:i "
        "fiscal_year:i fiscal_period_name:s",
        month_dim,
        f"SELECT d AS month_key, monthname(d) AS month_name, month(d) AS month_num, quarter(d) AS "
        f"calendar_quarter, year(d) AS calendar_year, {fiscal_quarter('d')} AS fiscal_quarter, "
        f"{fiscal_year('d')} AS fiscal_year, 'FY' || {fiscal_year('d')} || ' Q' || "
        f"{fiscal_quarter('d')} AS fiscal_period_name FROM (SELECT DISTINCT "
        f"CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders)",
    ),
    Query(
        "d_fiscal_functions",
        "o_orderkey:i fiscal_year:i fiscal_quarter:i quarter_key:t week_end:t same_quarter:t",
        lambda s: s.raw("orders")
        .select("o_orderkey", F.to_date("o_orderdate").alias("d"))
        .select(
            "o_orderkey",
            cal.fiscal_year(F.col("d")).alias("fiscal_year"),
            cal.fiscal_quarter(F.col("d")).alias("fiscal_quarter"),
            cal.fiscal_quarter_start(F.col("d")).alias("quarter_key"),
            cal.week_end(F.col("d")).alias("week_end"),
            cal.quarter_key(cal.fiscal_year(F.col("d")), cal.fiscal_quarter(F.col("d"))).alias(
                "same_quarter"
            ),
        ),
        f"SELECT o_orderkey, {fiscal_year('d')} AS fiscal_year, {fiscal_quarter('d')} AS "
        f"fiscal_quarter, {quarter_start('d')} AS quarter_key, "
        f"CAST(date_trunc('week', d) AS DATE) + 6 AS week_end, {quarter_start('d')} AS "
        f"same_quarter FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)",
    ),
    Query("d_hierarchy", PLACES, lambda s: s["dim_territory"], "SELECT * FROM dim_territory"),
    Query(
        "d_shrunken",
        "territory_rollup_key:i territory_key:i territory_name:s district:s region:s",
        lambda s: s["dim_territory_rollup"],
        "SELECT territory_key AS territory_rollup_key, territory_key, territory_name, "
        "district_name AS district, region_name AS region FROM dim_territory",
    ),
    Query(
        "d_junk",
        "flags_key:i l_returnflag:s l_linestatus:s",
        flags,
        "SELECT row_number() OVER (ORDER BY l_returnflag, l_linestatus) AS flags_key, "
        "l_returnflag, l_linestatus FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem)",
    ),
    Query(
        "d_text_split",
        "call_notes_key:i note_text:s note_length:i lang:s source:s",
        notes,
        "SELECT doc_id AS call_notes_key, text AS note_text, length(text) AS note_length, lang, "
        "source FROM documents",
    ),
    Query(
        "d_scd0",
        "product_key:i brand_name:s launch_date:t",
        launch_dates,
        f"SELECT product_key, brand_name, CASE WHEN brand_name IN ('{ad.SPLIT_BRAND}', 'SMALL') "
        f"THEN launch_date ELSE first_day END AS launch_date FROM dim_product LEFT JOIN (SELECT "
        f"brand, min(day) AS first_day FROM sales GROUP BY brand) ON brand_name = brand",
    ),
    Query(
        "d_scd1",
        "hcp_key:i hcp_durable_key:s specialty:s",
        overwritten,
        "SELECT hcp_key, hcp_durable_key, CASE WHEN c_acctbal < 0 THEN 'overdrawn' ELSE specialty "
        "END AS specialty FROM dim_hcp JOIN customer ON custkey = c_custkey",
    ),
    Query(
        "d_scd2",
        "custkey:i segment:s version:i effective_date:t expiration_date:t is_current:b",
        tiers,
        "SELECT * FROM hcp_versions",
    ),
    Query(
        "d_scd2_merge",
        "custkey:i segment:s effective_date:t expiration_date:t is_current:b",
        merged,
        "SELECT * FROM hcp_versions",
    ),
    Query(
        "d_scd6",
        "rep_key:i suppkey:i territory_key:i now_territory_key:i",
        overlay,
        "SELECT *, current_territory_key AS now_territory_key FROM rep_versions",
    ),
    Query(
        "d_as_of",
        "hcp_key:i hcp_durable_key:s segment:s",
        lambda s: scd.as_of(s["dim_hcp"], AS_OF),
        f"SELECT * FROM dim_hcp WHERE effective_date <= DATE '{AS_OF}' AND (expiration_date IS "
        f"NULL OR expiration_date >= DATE '{AS_OF}')",
    ),
    Query(
        "d_current",
        "hcp_key:i hcp_durable_key:s segment:s decile_rank:i",
        lambda s: dims.current_rows(s["dim_hcp"]),
        "SELECT * FROM dim_hcp WHERE is_current",
    ),
    Query(
        "d_decile_band",
        "custkey:i volume:i band:i",
        lambda s: hcp_deciles(s, "highest_first"),
        DECILE.format(band="n"),
    ),
    Query(
        "d_decile_band_highest_last",
        "custkey:i volume:i band:i",
        lambda s: hcp_deciles(s, "highest_last"),
        DECILE.format(band="11 - n"),
    ),
    Query(
        "d_segment_band",
        "custkey:i snapshot_date:t year_qty:i segment:s",
        lambda s: s["hcp_snapshots"],
        "SELECT * FROM hcp_snapshots",
    ),
    Query(
        "d_surrogate_key",
        "prescription_key:i week_end_date_key:t custkey:i brand:s total_rx_count:i",
        keyed,
        "SELECT row_number() OVER (ORDER BY week_end_date_key, custkey, brand) AS "
        "prescription_key, * FROM weekly_sums",
    ),
    Query(
        "d_role_play",
        "fiscal_quarter_key:t prior_year_quarter_key:t this_fiscal_period_name:s "
        "prior_fiscal_period_name:s actual_units:i",
        roles,
        f"SELECT q AS fiscal_quarter_key, CAST(q - INTERVAL 12 MONTH AS DATE) AS "
        f"prior_year_quarter_key, 'FY' || {fiscal_year('q')} || ' Q' || {fiscal_quarter('q')} AS "
        f"this_fiscal_period_name, 'FY' || ({fiscal_year('q')} - 1) || ' Q' || "
        f"{fiscal_quarter('q')} AS prior_fiscal_period_name, n AS actual_units FROM (SELECT "
        f"fiscal_quarter_key AS q, sum(actual_units) AS n FROM quota_actuals GROUP BY 1)",
    ),
    Query(
        "d_audit",
        "batch_id:s source_system:s batch_start_time:n batch_end_time:n source_row_count:i "
        "loaded_row_count:i dq_flag:s batch_status:s",
        load_log,
        "SELECT strftime(ts, '%Y-%m-%d') AS batch_id, 'event_feed' AS source_system, min(ts) AS "
        "batch_start_time, max(ts) AS batch_end_time, count(*) AS source_row_count, "
        "count(*) - sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS loaded_row_count, "
        "CASE WHEN sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) > 0 THEN 'rejects' "
        "ELSE 'clean' END AS dq_flag, 'completed' AS batch_status FROM events GROUP BY 1",
    ),
]
