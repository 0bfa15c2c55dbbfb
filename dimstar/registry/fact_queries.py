"""Fact builders and corrections over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimstar.functions import calendar as cal
from dimstar.operators import facts, scd
from dimstar.operators.corrections import apply_corrections
from dimstar.registry.base import Query, apportioned, rounded, rounded_units
from dimstar.sources import adapter as ad
from dimstar.sources.adapter import SalesStar

def yearly_quotas(s: SalesStar) -> DataFrame:
    return s["quota_base"].select("suppkey", "brand", "fiscal_quarter_key", "quota_units")


def spans(s: SalesStar) -> DataFrame:
    return facts.timespan_compress(
        yearly_quotas(s), ["suppkey", "brand"], "quota_units", "fiscal_quarter_key"
    )


SPANS_SQL = """
  SELECT suppkey, brand, quota_units, start AS effective_date,
         lead(start) OVER w - 1 AS expiration_date, lead(start) OVER w IS NULL AS is_current
  FROM (SELECT suppkey, brand, quota_units, fiscal_quarter_key AS start,
               lag(quota_units) OVER (PARTITION BY suppkey, brand ORDER BY fiscal_quarter_key)
                 AS before
        FROM quota_base)
  WHERE quota_units IS DISTINCT FROM before
  WINDOW w AS (PARTITION BY suppkey, brand ORDER BY start)"""


def stamped_sales(s: SalesStar) -> DataFrame:
    """As-was keys for sales per HCP and day, without help from a version column."""
    per_day = s["sales"].groupBy("custkey", "day").agg(F.sum("qty").alias("qty"))
    return scd.stamp_keys(per_day, s["hcp_versions"], "custkey", "day", ["hcp_key", "segment"])


def territory_share(s: SalesStar) -> DataFrame:
    month = cal.month_start(F.col("week_end_date_key")).alias("month_key")
    rows = s["weekly_market_once"].select(month, "territory_key", "product_key", "brand_units")
    return facts.market_share(rows, ["month_key", "territory_key"], ["product_key"], "brand_units")


SHARED_REPS = "(SELECT custkey, suppkey, sum(qty) AS qty FROM sales GROUP BY ALL)"


def weights(s: SalesStar) -> DataFrame:
    """Shares of all reps of each HCP, as weights of three digits by largest remainder."""
    totals = s["sales"].groupBy("custkey", "suppkey").agg(F.sum("qty").alias("qty"))
    return facts.bridge_weights(totals, ["custkey"], "suppkey", "qty")


def expanded(s: SalesStar) -> DataFrame:
    """The spans as quarters again; those still open run to the last quarter of the fact."""
    last = yearly_quotas(s).agg(F.max("fiscal_quarter_key")).scalar()
    return facts.timespan_expand(spans(s), last)


def visit_rows(s: SalesStar) -> DataFrame:
    flags = s["dim_visit_flags"]
    return facts.visit_fact(
        s["fct_hcp_visit"].drop("audit_key"),
        flags,
        [c for c in flags.columns if c != "visit_flags_key"],
        F.year("date_key").cast("bigint"),
    )


def authoritative(s: SalesStar) -> DataFrame:
    return apply_corrections(
        s["rx_with_batches"],
        s["dim_audit"],
        ["week_end_date_key", "hcp_key", "product_key", "territory_key"],
        "week_end_date_key",
        "corrects_period",
    )


FLAG_KEY = """(1 + CASE WHEN visit_type = 'virtual' THEN 8 ELSE 0 END
  + CASE WHEN call_type = 'unplanned' THEN 4 ELSE 0 END
  + CASE WHEN access_type = 'drop_off' THEN 2 ELSE 0 END
  + CASE WHEN program_type = 'lunch_program' THEN 1 ELSE 0 END)"""

QUERIES = [
    Query(
        "f_weekly_snapshot",
        "week_end_date_key:t hcp_key:i product_key:i territory_key:i audit_key:i new_rx_count:i "
        "total_rx_count:i total_units:i brand_units:i total_market_units:i market_share_pct:d",
        lambda s: s["fct_prescription_weekly"],
        f"SELECT *, {rounded('brand_units', 'total_market_units', 2, 100)} AS market_share_pct "
        f"FROM fct_prescription_weekly",
    ),
    Query(
        "f_monthly_rollup",
        "month_key:t territory_rollup_key:i product_key:i new_rx_count:i total_rx_count:i "
        "total_units:i brand_units:i total_market_units:i source_row_count:i market_share_pct:d",
        lambda s: s["fct_prescription_territory_monthly"],
        f"SELECT *, territory_key AS territory_rollup_key, "
        f"{rounded('brand_units', 'total_market_units', 2, 100)} AS market_share_pct "
        f"FROM fct_monthly",
    ),
    Query(
        "f_quota",
        "fiscal_quarter_key:t prior_year_quarter_key:t rep_key:i product_key:i territory_key:i "
        "quota_units:i actual_units:i prior_year_actual_units:i attainment_pct:d",
        lambda s: s["fct_quota_attainment"],
        "SELECT *, attainment_cents / 100.0 AS attainment_pct, "
        "CAST(fiscal_quarter_key - INTERVAL 12 MONTH AS DATE) AS prior_year_quarter_key "
        "FROM fct_quota_attainment",
    ),
    Query(
        "f_timespan_compress",
        "suppkey:i brand:s quota_units:i effective_date:t expiration_date:t is_current:b",
        spans,
        SPANS_SQL,
    ),
    Query(
        "f_timespan_expand",
        "suppkey:i brand:s quota_units:i period_key:t",
        expanded,
        f"SELECT suppkey, brand, quota_units, CAST(unnest(generate_series(effective_date, "
        f"coalesce(expiration_date, (SELECT max(fiscal_quarter_key) FROM quota_base)), INTERVAL 3 "
        f"MONTH)) AS DATE) AS period_key FROM ({SPANS_SQL})",
    ),
    Query(
        "f_coverage",
        "fiscal_quarter_key:t rep_key:i hcp_key:i product_key:i",
        lambda s: facts.coverage_targets(s["fct_hcp_coverage_target"]),
        "SELECT DISTINCT * FROM fct_hcp_coverage_target",
    ),
    Query(
        "f_visit",
        "date_key:t rep_key:i hcp_key:i product_key:i visit_flags_key:i audit_key:i "
        "samples_dropped:i visit_duration_minutes:i",
        visit_rows,
        f"SELECT *, {FLAG_KEY} AS visit_flags_key, year(date_key) AS audit_key FROM fct_hcp_visit",
    ),
    Query(
        "f_stamp_keys",
        "custkey:i day:t qty:i hcp_key:i segment:s",
        stamped_sales,
        "SELECT s.custkey, day, qty, hcp_key, segment FROM (SELECT custkey, day, sum(qty) AS qty "
        "FROM sales GROUP BY ALL) s LEFT JOIN hcp_versions v ON s.custkey = v.custkey AND "
        "(v.version = 1 OR v.effective_date <= day) AND (v.expiration_date IS NULL OR "
        "v.expiration_date >= day)",
    ),
    Query(
        "f_market_share",
        "month_key:t territory_key:i product_key:i brand_units:i total_market_units:i "
        "market_share_pct:d",
        territory_share,
        f"SELECT *, {rounded('brand_units', 'market', 2, 100)} AS market_share_pct, market AS "
        f"total_market_units FROM (SELECT month_key, territory_key, product_key, brand_units, "
        f"sum(brand_units) OVER (PARTITION BY month_key, territory_key) AS market "
        f"FROM fct_monthly)",
    ),
    Query(
        "f_group_key",
        "week_end_date_key:t hcp_key:i product_key:i total_rx_count:i group_key:i",
        lambda s: s["shared_rx"],
        "SELECT w.*, group_key FROM fct_prescription_weekly w LEFT JOIN (SELECT DISTINCT hcp_key, "
        "group_key FROM bridge) b ON w.hcp_key = b.hcp_key",
    ),
    Query(
        "f_bridge",
        "group_key:i hcp_key:i rep_key:i product_key:i credit_split_weight:d",
        lambda s: s["bridge_hcp_rep_alignment"],
        "SELECT *, weight_nano / 1000000000.0 AS credit_split_weight FROM bridge",
    ),
    Query(
        "f_bridge_weights",
        "custkey:i suppkey:i qty:i alignment_rank:i credit_split_weight:d",
        weights,
        "SELECT custkey, suppkey, qty, alignment_rank, units / 1000.0 AS credit_split_weight "
        f"FROM {apportioned(SHARED_REPS, 'custkey', 'suppkey', 'qty', 3)}",
    ),
    Query(
        "f_loaded_batches",
        "week_end_date_key:t hcp_key:i product_key:i territory_key:i total_rx_count:i "
        "total_units:i audit_key:i",
        lambda s: s["rx_with_batches"],
        "SELECT * FROM rx_with_batches",
    ),
    Query(
        "f_apply_corrections",
        "effective_period:t hcp_key:i product_key:i territory_key:i total_rx_count:i "
        "total_units:i audit_key:i",
        authoritative,
        f"SELECT *, week_end_date_key - CASE WHEN audit_key = {ad.FIX_BATCH} THEN 7 ELSE 0 END AS "
        f"effective_period FROM rx_with_batches WHERE audit_key <> {ad.BAD_BATCH}",
    ),
]
