"""The reports over whole tables: every quarter, key and brand at once."""

from __future__ import annotations

import datetime
import re
from collections import ChainMap

from dimstar.plans import reports as r
from dimstar.registry.base import Query, rounded, rounded_units
from dimstar.sources import adapter as ad

BAD = ("BATCH-BAD", ad.BAD_WEEK)
FIX = ("BATCH-FIX", ad.BAD_WEEK + datetime.timedelta(weeks=1))


def _against_prior(value: str, over: str) -> str:
    """Change and percent change of a mean held in tenths."""
    before = f"lag({value}) OVER ({over})"
    return (
        f"({value} - {before}) / 10.0 AS avg_rx_change, "
        f"{rounded(f'({value} - {before})', before, 1, 100)} AS avg_rx_pct_change"
    )


def _batch_audit(extra_hcp: str, extra_product: str) -> str:
    return f"""
  SELECT s.week_end_date_key, h.full_name AS hcp_name, h.segment, p.brand_name,
         'BATCH-BAD' AS superseded_batch, 'BATCH-FIX' AS corrected_batch,
         'Unit counts inflated by vendor' AS dq_notes,
         s.total_rx_count AS superseded_rx, c.total_rx_count AS corrected_rx,
         c.total_rx_count - s.total_rx_count AS rx_discrepancy,
         s.total_units AS superseded_units, c.total_units AS corrected_units,
         c.total_units - s.total_units AS units_discrepancy,
         {rounded('(s.total_units - c.total_units)', 'c.total_units', 1, 100)} AS pct_inflation
  FROM (SELECT * FROM rx_with_batches WHERE audit_key = {ad.BAD_BATCH}) s
  JOIN (SELECT * FROM rx_with_batches WHERE audit_key = {ad.FIX_BATCH}) c
    ON s.hcp_key = c.hcp_key AND s.product_key = c.product_key
   AND s.territory_key = c.territory_key
  JOIN dim_hcp h ON s.hcp_key = h.hcp_key {extra_hcp}
  JOIN dim_product p ON s.product_key = p.product_key {extra_product}"""


BATCH_COLUMNS = (
    "week_end_date_key:t hcp_name:s segment:s brand_name:s superseded_batch:s corrected_batch:s "
    "dq_notes:s superseded_rx:i corrected_rx:i rx_discrepancy:i superseded_units:i "
    "corrected_units:i units_discrepancy:i pct_inflation:d"
)

COVERAGE_COLUMNS = (
    "fiscal_quarter_key:t rep_name:s current_territory_name:s brand_name:s attainment_pct:d "
    "total_visits_in_quarter:i unique_hcps_visited:i hcp_name:s segment:s visits_made:i "
    "coverage_status:s pct_a_tier_unvisited:d"
)

RANKING_COLUMNS = (
    "fiscal_quarter_key:t district:s district_rank:i rep_name:s current_territory_name:s "
    "brand_name:s quota_units:i actual_units:i attainment_pct:d reps_in_district:i "
    "percentile_in_district:d district_avg_attainment:d vs_district_avg:d attainment_status:s"
)

TREND_COLUMNS = (
    "week_end_date_key:t hcp_name:s segment:s decile_rank:i brand_name:s total_rx_count:i "
    "rolling_avg:d prior_week_rx:i wow_change:i wow_pct_change:d trend_flag:s"
)


def _coverage(segment: str) -> str:
    return f"""
  WITH made AS (
    SELECT fiscal_quarter_key, rep_key, hcp_key, product_key, count(*) AS visits
    FROM fct_hcp_visit GROUP BY ALL),
  effort AS (
    SELECT fiscal_quarter_key, rep_key, count(*) AS visits, count(DISTINCT hcp_key) AS hcps
    FROM fct_hcp_visit GROUP BY ALL),
  rows_ AS (
    SELECT q.fiscal_quarter_key, q.rep_key, q.product_key, q.rep_name,
           q.current_territory_name, q.brand_name, q.attainment_cents / 100.0 AS attainment_pct,
           coalesce(e.visits, 0) AS total_visits_in_quarter,
           coalesce(e.hcps, 0) AS unique_hcps_visited, h.full_name AS hcp_name, h.segment,
           coalesce(m.visits, 0) AS visits_made
    FROM quota_rows q
    LEFT JOIN effort e USING (fiscal_quarter_key, rep_key)
    JOIN fct_hcp_coverage_target t USING (fiscal_quarter_key, rep_key, product_key)
    JOIN dim_hcp h ON t.hcp_key = h.hcp_key AND h.is_current AND h.segment = '{segment}'
    LEFT JOIN made m ON m.fiscal_quarter_key = q.fiscal_quarter_key AND m.rep_key = q.rep_key
     AND m.product_key = q.product_key AND m.hcp_key = t.hcp_key
    WHERE q.attainment_cents < 8000)
  SELECT *, CASE WHEN visits_made = 0 THEN 'No visits' WHEN visits_made < 2 THEN 'Undercovered'
                 ELSE 'Adequately covered' END AS coverage_status,
         {rounded('sum(CASE WHEN visits_made = 0 THEN 1 ELSE 0 END) OVER w',
                  'count(*) OVER w', 1, 100)} AS pct_a_tier_unvisited
  FROM rows_ WINDOW w AS (PARTITION BY fiscal_quarter_key, rep_key, product_key)"""


def _trend(segments: str, window_filter: str, display_filter: str) -> str:
    return f"""
  WITH base AS (
    SELECT w.week_end_date_key, w.hcp_key, w.product_key, h.full_name AS hcp_name, h.segment,
           h.decile_rank, p.brand_name, w.total_rx_count
    FROM fct_prescription_weekly w
    JOIN dim_hcp h ON w.hcp_key = h.hcp_key AND h.is_current AND h.segment IN ({segments})
    JOIN dim_product p ON w.product_key = p.product_key AND p.is_current
    WHERE {window_filter}),
  trend AS (
    SELECT *, {rounded('sum(total_rx_count) OVER r', 'count(*) OVER r', 1)} AS rolling_avg,
           lag(total_rx_count) OVER w AS prior_week_rx,
           total_rx_count - lag(total_rx_count) OVER w AS wow_change,
           {rounded('(total_rx_count - lag(total_rx_count) OVER w)',
                    'lag(total_rx_count) OVER w', 1, 100)} AS wow_pct_change
    FROM base
    WINDOW w AS (PARTITION BY hcp_key, product_key ORDER BY week_end_date_key),
           r AS (PARTITION BY hcp_key, product_key ORDER BY week_end_date_key
                 ROWS BETWEEN 12 PRECEDING AND CURRENT ROW))
  SELECT *, CASE WHEN wow_pct_change < -30 THEN 'Significant drop'
                 WHEN wow_pct_change < -10 THEN 'Moderate drop'
                 WHEN wow_pct_change > 30 THEN 'Significant increase'
                 ELSE 'Stable' END AS trend_flag
  FROM trend WHERE {display_filter}"""


def _ranking(quarter_filter: str) -> str:
    return f"""
  WITH ranked AS (
    SELECT *, dense_rank() OVER (g ORDER BY attainment_cents DESC NULLS FIRST) AS district_rank,
           count(*) OVER g AS n, sum(attainment_cents) OVER g AS total,
           rank() OVER (g ORDER BY attainment_cents NULLS LAST) AS low_rank
    FROM quota_rows WHERE {quarter_filter}
    WINDOW g AS (PARTITION BY district, product_key, fiscal_quarter_key))
  SELECT *, attainment_cents / 100.0 AS attainment_pct, n AS reps_in_district,
         CASE WHEN n = 1 THEN 0 ELSE {rounded('(low_rank - 1)', '(n - 1)', 1, 100)} END
           AS percentile_in_district,
         {rounded('total', '(n * 100)', 1)} AS district_avg_attainment,
         {rounded('(attainment_cents * n - total)', '(n * 100)', 1)} AS vs_district_avg,
         CASE WHEN attainment_cents >= 10000 THEN 'At or above quota'
              WHEN attainment_cents >= 8000 THEN 'Near quota'
              WHEN attainment_cents >= 6000 THEN 'Below quota'
              ELSE 'Significantly below quota' END AS attainment_status
  FROM ranked"""


DISPLAY = (datetime.date(2001, 8, 1), datetime.date(2001, 10, 31))

_QUERIES = [
    Query(
        "r01_below_quota_coverage",
        COVERAGE_COLUMNS,
        lambda s: r.below_quota_coverage(s, quarter=None),
        _coverage("A"),
    ),
    Query(
        "r01_below_quota_coverage_lowest_tier",
        COVERAGE_COLUMNS,
        lambda s: r.below_quota_coverage(s, quarter=None, segment="D"),
        _coverage("D"),
    ),
    Query(
        "r02_rolling_trend_current_only",
        TREND_COLUMNS,
        lambda s: r.rolling_trend(
            s, display=None, segments=("A", "B", "C", "D"), current_only=True
        ),
        _trend("'A', 'B', 'C', 'D'", "TRUE", "TRUE"),
    ),
    Query(
        "r02_rolling_trend_display_window_current_only",
        TREND_COLUMNS,
        lambda s: r.rolling_trend(s, display=DISPLAY, current_only=True),
        _trend(
            "'A', 'B'",
            f"week_end_date_key BETWEEN DATE '{DISPLAY[0] - datetime.timedelta(weeks=13)}' "
            f"AND DATE '{DISPLAY[1]}'",
            f"week_end_date_key BETWEEN DATE '{DISPLAY[0]}' AND DATE '{DISPLAY[1]}'",
        ),
    ),
    Query(
        "r03_attainment_ranking_current_only",
        RANKING_COLUMNS,
        lambda s: r.attainment_ranking(s, quarter=None, current_only=True),
        _ranking("TRUE"),
    ),
    Query(
        "r04_transfer_attribution_current_only",
        "rep_durable_key:s transfer_period:s territory_at_time_of_visit:s "
        "current_territory_name:s rep_name:s date_key:t hcp_name:s city:s state:s brand_name:s "
        "samples_dropped:i visit_duration_minutes:i visits_in_period:i visit_num_in_period:i",
        lambda s: r.transfer_attribution(s, current_only=True),
        f"""
  SELECT r.rep_durable_key, t.territory_name AS territory_at_time_of_visit,
         r.current_territory_name, r.rep_name, v.date_key, h.full_name AS hcp_name, h.city,
         h.state, p.brand_name, v.samples_dropped, v.visit_duration_minutes,
         CASE WHEN v.date_key < DATE '{ad.TRANSFER_DATE}' THEN 'Pre-transfer'
              ELSE 'Post-transfer' END AS transfer_period,
         count(*) OVER (PARTITION BY r.rep_durable_key, v.date_key < DATE '{ad.TRANSFER_DATE}')
           AS visits_in_period,
         row_number() OVER (
           PARTITION BY r.rep_durable_key, v.date_key < DATE '{ad.TRANSFER_DATE}'
           ORDER BY v.date_key, v.hcp_key, v.product_key) AS visit_num_in_period
  FROM fct_hcp_visit v
  JOIN dim_rep r ON v.rep_key = r.rep_key
  JOIN dim_territory t ON r.territory_key = t.territory_key
  JOIN dim_hcp h ON v.hcp_key = h.hcp_key AND h.is_current
  JOIN dim_product p ON v.product_key = p.product_key AND p.is_current
  WHERE r.suppkey % 10 = {ad.TRANSFER_DIGIT}""",
    ),
    Query(
        "r05_co_promotion_credit_current_only",
        "rep_name:s hcp_name:s brand_name:s credit_split_weight:d total_attributed_rx:d "
        "total_attributed_units:d total_unweighted_rx:i total_unweighted_units:i "
        "rx_overcount_without_bridge:d units_overcount_without_bridge:d",
        lambda s: r.co_promotion_credit(
            ChainMap({"fct_prescription_weekly": s["shared_rx"]}, s), current_only=True
        ),
        f"""
  WITH credit AS (
    SELECT r.rep_name, h.full_name AS hcp_name, p.brand_name, b.weight_nano,
           {rounded_units('w.total_rx_count * b.weight_nano', '1000000000', 1)} AS rx_tenths,
           {rounded_units('w.total_units * b.weight_nano', '1000000000', 0)} AS units,
           w.total_rx_count, w.total_units
    FROM fct_prescription_weekly w
    JOIN bridge b ON w.hcp_key = b.hcp_key
    JOIN dim_hcp h ON w.hcp_key = h.hcp_key AND h.is_current
    JOIN dim_product p ON w.product_key = p.product_key AND p.is_current
    JOIN dim_rep r ON b.rep_key = r.rep_key AND r.is_current)
  SELECT rep_name, hcp_name, brand_name, weight_nano / 1000000000.0 AS credit_split_weight,
         sum(rx_tenths) / 10.0 AS total_attributed_rx, sum(units) AS total_attributed_units,
         sum(total_rx_count) AS total_unweighted_rx, sum(total_units) AS total_unweighted_units,
         (sum(total_rx_count) * 10 - sum(rx_tenths)) / 10.0 AS rx_overcount_without_bridge,
         sum(total_units) - sum(units) AS units_overcount_without_bridge
  FROM credit GROUP BY rep_name, hcp_name, brand_name, weight_nano""",
    ),
    Query(
        "r06_tier_change_impact",
        "hcp_durable_key:s full_name:s tier_period:s brand_name:s segment:s tier_effective_date:t "
        "tier_expiration_date:t weeks_in_period:i total_rx:i avg_weekly_rx:d peak_weekly_rx:i "
        "floor_weekly_rx:i total_units:i avg_rx_change_vs_prior_period:d avg_rx_pct_change:d",
        lambda s: r.tier_change_impact(s),
        f"""
  WITH periods AS (
    SELECT h.hcp_durable_key, h.full_name, 'Tier ' || h.segment AS tier_period, p.brand_name,
           h.segment, h.effective_date AS tier_effective_date,
           h.expiration_date AS tier_expiration_date,
           count(DISTINCT w.week_end_date_key) AS weeks_in_period,
           sum(w.total_rx_count) AS total_rx,
           {rounded_units('sum(w.total_rx_count)', 'count(*)', 1)} AS tenths,
           max(w.total_rx_count) AS peak_weekly_rx, min(w.total_rx_count) AS floor_weekly_rx,
           sum(w.total_units) AS total_units
    FROM fct_prescription_weekly w
    JOIN dim_hcp h ON w.hcp_key = h.hcp_key
    JOIN dim_product p ON w.product_key = p.product_key AND p.is_current
    GROUP BY 1, 2, 3, 4, 5, 6, 7)
  SELECT *, avg_rx_change AS avg_rx_change_vs_prior_period FROM (
    SELECT *, tenths / 10.0 AS avg_weekly_rx,
           {_against_prior('tenths',
                           'PARTITION BY hcp_durable_key, brand_name ORDER BY tier_effective_date')}
    FROM periods)""",
    ),
    Query(
        "r07_yoy_attainment_current_only",
        "rep_name:s district:s current_territory_name:s brand_name:s fiscal_quarter_key:t "
        "quota_units:i actual_units:i attainment_pct:d prior_year_actual_units:i "
        "yoy_unit_growth:i yoy_growth_pct:d yoy_trend:s district_cumulative_yoy_growth:i",
        lambda s: r.yoy_attainment(s, quarter=None, current_only=True),
        f"""
  SELECT *, attainment_cents / 100.0 AS attainment_pct,
         actual_units - prior_year_actual_units AS yoy_unit_growth,
         {rounded('(actual_units - prior_year_actual_units)', 'prior_year_actual_units', 1, 100)}
           AS yoy_growth_pct,
         CASE WHEN actual_units * 100 > prior_year_actual_units * 110 THEN 'Growing (>10%)'
              WHEN actual_units > prior_year_actual_units THEN 'Growing (<10%)'
              WHEN actual_units = prior_year_actual_units THEN 'Flat'
              WHEN actual_units * 100 > prior_year_actual_units * 90 THEN 'Declining (<10%)'
              ELSE 'Declining (>10%)' END AS yoy_trend,
         sum(actual_units - prior_year_actual_units) OVER (
           PARTITION BY district, product_key, fiscal_quarter_key
           ORDER BY attainment_cents DESC NULLS FIRST, rep_key
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS district_cumulative_yoy_growth
  FROM quota_rows""",
    ),
    Query(
        "r08_superseded_batch_audit",
        BATCH_COLUMNS,
        lambda s: r.superseded_batch_audit(s, BAD, FIX, fact="rx_with_batches"),
        _batch_audit("AND h.is_current", "AND p.is_current"),
    ),
    Query(
        "r08_superseded_batch_audit_as_was",
        BATCH_COLUMNS,
        lambda s: r.superseded_batch_audit(
            s, BAD, FIX, current_only=False, fact="rx_with_batches"
        ),
        _batch_audit("", ""),
    ),
    Query(
        "r09_market_share_trend",
        "fiscal_year:i fiscal_quarter:i month_key:t month_name:s territory_name:s district:s "
        "region:s brand_name:s total_rx_count:i brand_units:i total_market_units:i "
        "market_share_pct:d prior_month_share:d mom_share_change:d rolling_3mo_avg_share:d "
        "share_trend:s territory_rank_in_district:i",
        lambda s: r.market_share_trend(s, fiscal_year=None),
        f"""
  WITH shares AS (
    SELECT m.*, t.territory_name, t.district_name AS district, t.region_name AS region,
           p.brand_name,
           {rounded_units('m.brand_units', 'm.total_market_units', 2, 100)} AS cents
    FROM fct_monthly m
    JOIN dim_territory t ON m.territory_key = t.territory_key
    JOIN dim_product p ON m.product_key = p.product_key AND p.is_current),
  trend AS (
    SELECT *, lag(cents) OVER w AS before,
           {rounded('sum(cents) OVER r', '(count(cents) OVER r * 100)', 2)}
             AS rolling_3mo_avg_share
    FROM shares
    WINDOW w AS (PARTITION BY territory_name, brand_name ORDER BY month_key),
           r AS (PARTITION BY territory_name, brand_name ORDER BY month_key
                 ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
  SELECT *, year(month_key) + CASE WHEN month(month_key) >= 8 THEN 1 ELSE 0 END AS fiscal_year,
         (month(month_key) + 4) % 12 // 3 + 1 AS fiscal_quarter,
         monthname(month_key) AS month_name, cents / 100.0 AS market_share_pct,
         before / 100.0 AS prior_month_share, (cents - before) / 100.0 AS mom_share_change,
         CASE WHEN cents - before > 100 THEN 'Gaining share'
              WHEN cents - before < -100 THEN 'Losing share' ELSE 'Holding share' END
           AS share_trend,
         dense_rank() OVER (PARTITION BY district, brand_name, month_key
                            ORDER BY cents DESC NULLS FIRST) AS territory_rank_in_district
  FROM trend""",
    ),
    Query(
        "r10_decile_validation_current_only",
        "full_name:s specialty:s segment:s brand_name:s lifetime_rx_count:i stored_decile:i "
        "calculated_decile:i decile_drift:i decile_status:s",
        lambda s: r.decile_validation(s, current_only=True),
        """
  WITH placed AS (
    SELECT h.full_name, h.specialty, h.segment, p.brand_name, t.lifetime_rx_count,
           h.decile_rank AS stored_decile,
           ntile(10) OVER (PARTITION BY t.product_key
                           ORDER BY t.lifetime_rx_count DESC, t.hcp_key) AS calculated_decile
    FROM (SELECT hcp_key, product_key, sum(total_rx_count) AS lifetime_rx_count
          FROM fct_prescription_weekly GROUP BY ALL) t
    JOIN dim_hcp h ON t.hcp_key = h.hcp_key AND h.is_current
    JOIN dim_product p ON t.product_key = p.product_key AND p.is_current)
  SELECT *, stored_decile - calculated_decile AS decile_drift,
         CASE WHEN abs(stored_decile - calculated_decile) = 1 THEN 'Minor drift'
              ELSE 'Needs refresh' END AS decile_status
  FROM placed WHERE stored_decile <> calculated_decile""",
    ),
    Query(
        "r11_indication_impact_current_only",
        "brand_name:s indication_period:s indication:s indication_effective_date:t specialty:s "
        "unique_prescribers:i weeks_of_data:i total_rx:i avg_weekly_rx_per_hcp:d total_new_rx:i "
        "avg_rx_change_vs_prior:d avg_rx_pct_change:d",
        lambda s: r.indication_impact(s, current_hcps_only=True),
        f"""
  WITH per_hcp AS (
    SELECT hcp_key, product_key, sum(total_rx_count) AS total_rx,
           sum(new_rx_count) AS total_new_rx, count(DISTINCT week_end_date_key) AS weeks
    FROM fct_prescription_weekly GROUP BY ALL),
  periods AS (
    SELECT p.brand_name, p.indication, p.effective_date AS indication_effective_date,
           CASE WHEN p.is_current THEN 'Post-expansion' ELSE 'Pre-expansion' END
             AS indication_period,
           h.specialty, count(DISTINCT a.hcp_key) AS unique_prescribers,
           sum(weeks) AS weeks_of_data, sum(total_rx) AS total_rx,
           sum(total_new_rx) AS total_new_rx,
           {rounded_units(f"sum({rounded_units('total_rx', 'weeks', 10)})",
                          '(count(*) * 10000000000)', 1)} AS tenths
    FROM per_hcp a
    JOIN dim_product p ON a.product_key = p.product_key
    JOIN dim_hcp h ON a.hcp_key = h.hcp_key AND h.is_current
    GROUP BY 1, 2, 3, 4, 5)
  SELECT *, avg_rx_change AS avg_rx_change_vs_prior FROM (
    SELECT *, tenths / 10.0 AS avg_weekly_rx_per_hcp,
           {_against_prior('tenths',
                           'PARTITION BY brand_name, specialty ORDER BY indication_effective_date')}
    FROM periods)""",
    ),
    Query(
        "r12_drill_across_top_decile_current_only",
        "fiscal_quarter_key:t rep_key:i rep_name:s district:s quota_units:i actual_units:i "
        "attainment_pct:d top_decile_visits:i reps_in_quarter:i avg_top_decile_visits:d "
        "visit_effort:s",
        lambda s: r.drill_across_top_decile(s, quarter=None, current_only=True),
        f"""
  WITH per_rep AS (
    SELECT q.fiscal_quarter_key, q.rep_key, r.rep_name, r.district,
           sum(quota_units) AS quota_units, sum(actual_units) AS actual_units
    FROM fct_quota_attainment q JOIN dim_rep r ON q.rep_key = r.rep_key AND r.is_current
    GROUP BY 1, 2, 3, 4),
  made AS (
    SELECT v.fiscal_quarter_key, v.rep_key, count(*) AS n FROM fct_hcp_visit v
    JOIN dim_hcp h ON v.hcp_key = h.hcp_key AND h.is_current AND h.decile_rank = 10
    GROUP BY 1, 2),
  both_ AS (
    SELECT p.*, coalesce(m.n, 0) AS top_decile_visits,
           {rounded_units('p.actual_units', 'p.quota_units', 2, 100)} AS cents,
           count(*) OVER (PARTITION BY fiscal_quarter_key) AS reps_in_quarter,
           sum(coalesce(m.n, 0)) OVER (PARTITION BY fiscal_quarter_key) AS all_visits
    FROM per_rep p LEFT JOIN made m USING (fiscal_quarter_key, rep_key))
  SELECT *, cents / 100.0 AS attainment_pct,
         {rounded('all_visits', 'reps_in_quarter', 2)} AS avg_top_decile_visits,
         CASE WHEN top_decile_visits * reps_in_quarter < all_visits THEN 'Below average'
              WHEN top_decile_visits * reps_in_quarter = all_visits THEN 'At average'
              ELSE 'Above average' END AS visit_effort
  FROM both_ WHERE cents < 8000""",
    ),
]


def _complete(name: str, build, **tables: str) -> Query:
    """The same report over all versions: its SQL form reads facts under current keys."""
    literal = next(q for q in _QUERIES if q.name == f"{name}_current_only")
    body = literal.body
    for table, under_current_keys in tables.items():
        body = re.sub(rf"\b{table}\b", under_current_keys, body)
    return Query(name, literal.columns, build, body)


_RX, _QUOTAS = {"fct_prescription_weekly": "rx_now"}, {"quota_rows": "quota_rows_now"}
QUERIES = [
    *_QUERIES,
    _complete(
        "r02_rolling_trend",
        lambda s: r.rolling_trend(s, display=None, segments=("A", "B", "C", "D")),
        **_RX,
    ),
    _complete(
        "r02_rolling_trend_display_window",
        lambda s: r.rolling_trend(s, display=DISPLAY),
        **_RX,
    ),
    _complete("r03_attainment_ranking", lambda s: r.attainment_ranking(s, quarter=None), **_QUOTAS),
    _complete(
        "r04_transfer_attribution", r.transfer_attribution, fct_hcp_visit="visits_now"
    ),
    _complete("r05_co_promotion_credit", r.co_promotion_credit, **_RX),
    _complete("r07_yoy_attainment", lambda s: r.yoy_attainment(s, quarter=None), **_QUOTAS),
    _complete("r10_decile_validation", r.decile_validation, **_RX),
    _complete(
        "r11_indication_impact", r.indication_impact, fct_prescription_weekly="rx_hcp_now"
    ),
    _complete(
        "r12_drill_across_top_decile",
        lambda s: r.drill_across_top_decile(s, quarter=None),
        fct_quota_attainment="quota_now",
        fct_hcp_visit="rep_visits_now",
    ),
]
