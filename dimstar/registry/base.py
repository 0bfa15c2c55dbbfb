"""What registered queries share: the column contract and the SQL form of the star schema."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimstar.plans.load import Warehouse
from dimstar.session import configure
from dimstar.sources import adapter as ad
from dimstar.sources.adapter import SalesStar

# One letter per output type, the same in both engines.
SPARK_TYPES = {
    "i": "bigint", "d": "double", "s": "string", "t": "date", "b": "boolean", "n": "timestamp_ntz"
}
SQL_TYPES = {
    "i": "BIGINT", "d": "DOUBLE", "s": "VARCHAR", "t": "DATE", "b": "BOOLEAN", "n": "TIMESTAMP"
}


@dataclass(frozen=True)
class Query:
    """``columns`` reads "name:type name:type"; the run and the SQL are both cast to it.

    Reports read the loaded star; a query ``from_raw`` derives what it needs from the
    trade tables, which is what the builders themselves are tested on.
    """

    name: str
    columns: str
    build: Callable[[SalesStar], DataFrame]
    body: str | None = None
    from_raw: bool = False

    def _columns(self) -> list[tuple[str, str]]:
        return [tuple(c.split(":")) for c in self.columns.split()]

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        source = SalesStar if self.from_raw else Warehouse
        df = self.build(source(configure(spark), folder))
        return df.select(*[F.col(c).cast(SPARK_TYPES[k]).alias(c) for c, k in self._columns()])

    def sql(self) -> str | None:
        if self.body is None:
            return None
        out = ", ".join(f'CAST("{c}" AS {SQL_TYPES[k]}) AS "{c}"' for c, k in self._columns())
        return f"WITH {STAR_SQL}, answer AS ({self.body}) SELECT {out} FROM answer"


def rounded_units(num: str, den: str, digits: int = 0, factor: int = 1) -> str:
    """``factor * num / den`` in whole units of ``10**-digits``, rounded half away from zero."""
    k = factor * 10**digits
    return (
        f"(CASE WHEN ({den}) = 0 THEN NULL ELSE sign({num}) * "
        f"((2 * abs(CAST({num} AS HUGEINT)) * {k} + ({den})) // (2 * ({den}))) END)"
    )


def apportioned(source: str, group: str, member: str, measure: str, digits: int) -> str:
    """SQL rows of ``source`` with ``alignment_rank``, ``members`` and ``units``.

    ``units`` of ``10**-digits`` by largest remainder, one unit to each member first,
    written from the rule alone as an oracle for ``facts.bridge_weights``.
    """
    u = 10**digits
    by = f"PARTITION BY {group}"
    return f"""(SELECT * EXCLUDE (_x, _t, _q, _fl, _rem, _pr),
  (CASE WHEN members <= {u} OR _pr <= {u} THEN 1 ELSE 0 END) + _fl
  + (CASE WHEN _pr <= {u} - members - sum(_fl) OVER ({by}) THEN 1 ELSE 0 END) AS units
FROM (SELECT *, row_number() OVER ({by} ORDER BY _rem DESC, {member}) AS _pr
 FROM (SELECT *, _q // _t AS _fl, _q % _t AS _rem
  FROM (SELECT *, CAST(greatest({u} - members, 0) AS HUGEINT) * _x AS _q
   FROM (SELECT * EXCLUDE (_x, _t), CASE WHEN _t = 0 THEN 1 ELSE _x END AS _x,
                CASE WHEN _t = 0 THEN members ELSE _t END AS _t
    FROM (SELECT *, greatest(coalesce({measure}, 0), 0) AS _x,
                 sum(greatest(coalesce({measure}, 0), 0)) OVER ({by}) AS _t,
                 count(*) OVER ({by}) AS members,
                 row_number() OVER ({by} ORDER BY {measure} DESC NULLS LAST, {member})
                   AS alignment_rank
          FROM {source}))))))"""


def rounded(num: str, den: str, digits: int, factor: int = 1) -> str:
    """The same as a number: whole units over a power of ten, exact to the last bit."""
    return f"(CAST({rounded_units(num, den, digits, factor)} AS DOUBLE) / {10**digits})"


def fiscal_year(day: str) -> str:
    return f"(year({day}) + CASE WHEN month({day}) >= 8 THEN 1 ELSE 0 END)"


def fiscal_quarter(day: str) -> str:
    return f"((month({day}) + 4) % 12 // 3 + 1)"


def quarter_start(day: str) -> str:
    return f"CAST(date_trunc('quarter', {day} - INTERVAL 7 MONTH) + INTERVAL 7 MONTH AS DATE)"


def week_end(day: str) -> str:
    return f"(CAST(date_trunc('week', {day}) AS DATE) + 6)"


def product_key(brand: str, day: str) -> str:
    return (
        f"(CAST('0x' || substr(md5({brand}), 1, 12) AS BIGINT) * 10 + CASE WHEN {brand} = "
        f"'{ad.SPLIT_BRAND}' AND {day} >= DATE '{ad.SPLIT_DATE}' THEN 2 ELSE 1 END)"
    )


_FIRST = f"DATE '{ad.FIRST_DAY}'"
_MOVE = f"DATE '{ad.TRANSFER_DATE}'"
_SPLIT = f"DATE '{ad.SPLIT_DATE}'"
_BAD = f"DATE '{ad.BAD_WEEK}'"

STAR_SQL = f"""
sales AS (
  SELECT l_suppkey AS suppkey, o_custkey AS custkey, p_type AS brand,
         CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS BIGINT) AS qty,
         CAST(l_linenumber AS BIGINT) AS line_no, l_returnflag AS flag, l_linestatus AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
dim_territory AS (
  SELECT n_nationkey AS territory_key, 'TER-' || n_nationkey AS territory_code,
         n_name AS territory_name, 'DIST-' || r_regionkey AS district_code,
         r_name AS district_name, 'REG-' || (r_regionkey // 2) AS region_code,
         'Region ' || (r_regionkey // 2) AS region_name,
         'ZONE-' || (r_regionkey // 4) AS zone_code, 'Zone ' || (r_regionkey // 4) AS zone_name,
         'ALL' AS national
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
rep_versions AS (
  SELECT s_suppkey AS suppkey, s_name AS rep_name, v AS version,
         CASE WHEN v = 2 THEN (s_nationkey + {ad.TRANSFER_STEP}) % {ad.NATIONS}
              ELSE s_nationkey END AS territory_key,
         CASE WHEN s_suppkey % 10 = {ad.TRANSFER_DIGIT}
              THEN (s_nationkey + {ad.TRANSFER_STEP}) % {ad.NATIONS}
              ELSE s_nationkey END AS current_territory_key,
         CASE WHEN v = 2 THEN {_MOVE} ELSE {_FIRST} END AS effective_date,
         CASE WHEN v = 1 AND s_suppkey % 10 = {ad.TRANSFER_DIGIT}
              THEN {_MOVE} - 1 END AS expiration_date,
         v = 2 OR s_suppkey % 10 <> {ad.TRANSFER_DIGIT} AS is_current,
         s_suppkey * 10 + v AS rep_key
  FROM supplier CROSS JOIN (VALUES (1), (2)) AS n(v)
  WHERE v = 1 OR s_suppkey % 10 = {ad.TRANSFER_DIGIT}),
dim_rep AS (
  SELECT r.*, 'REP-' || suppkey AS rep_durable_key, t.district_name AS district,
         t.region_name AS region, c.territory_name AS current_territory_name
  FROM rep_versions r
  LEFT JOIN dim_territory t ON r.territory_key = t.territory_key
  LEFT JOIN dim_territory c ON r.current_territory_key = c.territory_key),
hcp_snapshots AS (
  SELECT custkey, make_date(fy - 1, 8, 1) AS snapshot_date, year_qty,
         CASE WHEN year_qty >= {ad.SEGMENT_FLOORS[0][1]} THEN 'A'
              WHEN year_qty >= {ad.SEGMENT_FLOORS[1][1]} THEN 'B'
              WHEN year_qty >= {ad.SEGMENT_FLOORS[2][1]} THEN 'C' ELSE 'D' END AS segment
  FROM (SELECT custkey, {fiscal_year('day')} AS fy, sum(qty) AS year_qty
        FROM sales GROUP BY ALL)),
hcp_runs AS (
  SELECT custkey, snapshot_date, segment,
         row_number() OVER (PARTITION BY custkey ORDER BY snapshot_date) AS version
  FROM (SELECT *, lag(segment) OVER (PARTITION BY custkey ORDER BY snapshot_date) AS before
        FROM hcp_snapshots)
  WHERE segment IS DISTINCT FROM before),
hcp_versions AS (
  SELECT custkey, segment, version, snapshot_date AS effective_date,
         custkey * 100 + version AS hcp_key,
         lead(snapshot_date) OVER (PARTITION BY custkey ORDER BY snapshot_date) - 1
           AS expiration_date,
         lead(snapshot_date) OVER (PARTITION BY custkey ORDER BY snapshot_date) IS NULL
           AS is_current
  FROM hcp_runs),
dim_hcp AS (
  SELECT v.*, 'HCP-' || v.custkey AS hcp_durable_key, c_name AS full_name,
         c_mktsegment AS specialty, t.territory_name AS city,
         substr(t.district_name, 1, 2) AS state,
         least(greatest(CAST(floor((lifetime - {ad.DECILE_BASE}) / {ad.DECILE_STEP}.0) AS BIGINT)
               + 1, 1), 10) AS decile_rank
  FROM hcp_versions v
  JOIN (SELECT custkey, sum(year_qty) AS lifetime FROM hcp_snapshots GROUP BY custkey) l
    ON v.custkey = l.custkey
  JOIN customer ON v.custkey = c_custkey
  LEFT JOIN dim_territory t ON c_nationkey = t.territory_key),
dim_product AS (
  SELECT CAST('0x' || substr(md5(b), 1, 12) AS BIGINT) * 10 + v AS product_key,
         b || '-00' || v AS product_code, b AS brand_name,
         CASE WHEN v = 2 THEN 'Extended indication' ELSE 'Original indication' END AS indication,
         CASE WHEN v = 2 THEN {_SPLIT} ELSE {_FIRST} END AS effective_date,
         CASE WHEN v = 1 AND b = '{ad.SPLIT_BRAND}' THEN {_SPLIT} - 1 END AS expiration_date,
         v = 2 OR b <> '{ad.SPLIT_BRAND}' AS is_current, {_FIRST} AS launch_date,
         'launched' AS market_status
  FROM (SELECT DISTINCT p_type AS b FROM part) CROSS JOIN (VALUES (1), (2)) AS n(v)
  WHERE v = 1 OR b = '{ad.SPLIT_BRAND}'),
visits AS (
  SELECT day, suppkey, custkey, brand, sum(line_no) AS samples_dropped,
         sum(qty) AS visit_duration_minutes, min(flag) AS flag, max(line_no) AS top_line
  FROM sales WHERE status = 'F' GROUP BY day, suppkey, custkey, brand),
fct_hcp_visit AS (
  SELECT day AS date_key, {quarter_start('day')} AS fiscal_quarter_key, r.rep_key, h.hcp_key,
         {product_key('brand', 'day')} AS product_key, samples_dropped, visit_duration_minutes,
         CASE WHEN top_line % 2 = 0 THEN 'virtual' ELSE 'in_person' END AS visit_type,
         CASE WHEN flag = 'N' THEN 'planned' ELSE 'unplanned' END AS call_type,
         CASE WHEN flag = 'A' THEN 'drop_off' ELSE 'saw_physician' END AS access_type,
         CASE WHEN top_line >= 6 THEN 'lunch_program' ELSE 'standard_call' END AS program_type,
         brand
  FROM visits v
  LEFT JOIN rep_versions r ON v.suppkey = r.suppkey
    AND (r.version = 1 OR r.effective_date <= day)
    AND (r.expiration_date IS NULL OR r.expiration_date >= day)
  LEFT JOIN hcp_versions h ON v.custkey = h.custkey
    AND (h.version = 1 OR h.effective_date <= day)
    AND (h.expiration_date IS NULL OR h.expiration_date >= day)),
weekly_sums AS (
  SELECT {week_end('day')} AS week_end_date_key, custkey, brand,
         sum(CASE WHEN flag = 'N' THEN qty ELSE 0 END) AS new_rx_count,
         sum(qty) AS total_rx_count, sum(qty * line_no) AS total_units,
         sum(qty * line_no) AS brand_units
  FROM sales GROUP BY 1, 2, 3),
fct_prescription_weekly AS (
  SELECT week_end_date_key, h.hcp_key, w.custkey,
         {product_key('brand', 'week_end_date_key')} AS product_key,
         c_nationkey AS territory_key, {fiscal_year('week_end_date_key')} AS audit_key,
         new_rx_count, total_rx_count, total_units, brand_units,
         sum(brand_units) OVER (PARTITION BY week_end_date_key, w.custkey) AS total_market_units
  FROM weekly_sums w
  JOIN customer ON w.custkey = c_custkey
  LEFT JOIN hcp_versions h ON w.custkey = h.custkey
    AND (h.version = 1 OR h.effective_date <= week_end_date_key)
    AND (h.expiration_date IS NULL OR h.expiration_date >= week_end_date_key)),
rep_shares AS (
  SELECT custkey, suppkey, qty, alignment_rank, members, units AS weight_nano
  FROM {apportioned(
    "(SELECT custkey, suppkey, sum(qty) AS qty FROM sales GROUP BY custkey, suppkey)",
    "custkey", "suppkey", "qty", 9)}),
bridge AS (
  SELECT t.custkey AS group_key, h.hcp_key, r.rep_key,
         {product_key(f"'{ad.SPLIT_BRAND}'", _SPLIT)} AS product_key,
         CAST(weight_nano AS BIGINT) AS weight_nano
  FROM rep_shares t
  JOIN hcp_versions h ON t.custkey = h.custkey AND h.is_current
  JOIN rep_versions r ON t.suppkey = r.suppkey AND r.is_current
  WHERE t.members > 1),
quota_actuals AS (
  SELECT suppkey, brand, {quarter_start('day')} AS fiscal_quarter_key, sum(qty) AS actual_units
  FROM sales GROUP BY 1, 2, 3),
quota_base AS (
  SELECT a.suppkey, a.brand, a.fiscal_quarter_key, a.actual_units,
         (coalesce(b.actual_units, a.actual_units) // {ad.QUOTA_STEP} + 1) * {ad.QUOTA_STEP}
           AS quota_units,
         coalesce(b.actual_units, 0) AS prior_year_actual_units
  FROM quota_actuals a
  LEFT JOIN quota_actuals b ON a.suppkey = b.suppkey AND a.brand = b.brand
    AND b.fiscal_quarter_key = CAST(a.fiscal_quarter_key - INTERVAL 12 MONTH AS DATE)),
fct_quota_attainment AS (
  SELECT fiscal_quarter_key, r.rep_key, r.territory_key,
         {product_key('brand', 'fiscal_quarter_key')} AS product_key,
         quota_units, actual_units, prior_year_actual_units,
         {rounded_units('actual_units', 'quota_units', 2, 100)} AS attainment_cents
  FROM quota_base q
  LEFT JOIN rep_versions r ON q.suppkey = r.suppkey
    AND (r.version = 1 OR r.effective_date <= fiscal_quarter_key)
    AND (r.expiration_date IS NULL OR r.expiration_date >= fiscal_quarter_key)),
fct_hcp_coverage_target AS (
  SELECT fiscal_quarter_key, r.rep_key, h.hcp_key,
         {product_key('brand', 'fiscal_quarter_key')} AS product_key
  FROM (SELECT DISTINCT {quarter_start('day')} AS fiscal_quarter_key, suppkey, custkey, brand
        FROM sales WHERE flag IN ('A', 'N')) a
  LEFT JOIN rep_versions r ON a.suppkey = r.suppkey
    AND (r.version = 1 OR r.effective_date <= fiscal_quarter_key)
    AND (r.expiration_date IS NULL OR r.expiration_date >= fiscal_quarter_key)
  LEFT JOIN hcp_versions h ON a.custkey = h.custkey
    AND (h.version = 1 OR h.effective_date <= fiscal_quarter_key)
    AND (h.expiration_date IS NULL OR h.expiration_date >= fiscal_quarter_key)),
fct_monthly AS (
  SELECT CAST(date_trunc('month', week_end_date_key) AS DATE) AS month_key, territory_key,
         product_key, sum(new_rx_count) AS new_rx_count, sum(total_rx_count) AS total_rx_count,
         sum(total_units) AS total_units, sum(brand_units) AS brand_units,
         sum(total_market_units) AS total_market_units, count(*) AS source_row_count
  FROM fct_prescription_weekly GROUP BY 1, 2, 3),
rx_with_batches AS (
  SELECT week_end_date_key, hcp_key, product_key, territory_key, new_rx_count, total_rx_count,
         total_units, audit_key
  FROM fct_prescription_weekly WHERE week_end_date_key <> {_BAD}
  UNION ALL
  SELECT week_end_date_key, hcp_key, product_key, territory_key, new_rx_count, total_rx_count,
         total_units * 135 // 100, {ad.BAD_BATCH}
  FROM fct_prescription_weekly WHERE week_end_date_key = {_BAD}
  UNION ALL
  SELECT week_end_date_key + 7, hcp_key, product_key, territory_key, new_rx_count,
         total_rx_count, total_units, {ad.FIX_BATCH}
  FROM fct_prescription_weekly WHERE week_end_date_key = {_BAD}),
quota_rows AS (
  SELECT q.*, r.rep_name, r.district, r.current_territory_name, p.brand_name
  FROM fct_quota_attainment q
  JOIN dim_rep r ON q.rep_key = r.rep_key AND r.is_current
  JOIN dim_product p ON q.product_key = p.product_key AND p.is_current),
hcp_now AS (
  SELECT v.hcp_key AS old, c.hcp_key AS now FROM hcp_versions v
  JOIN hcp_versions c ON v.custkey = c.custkey AND c.is_current),
rep_now AS (
  SELECT v.rep_key AS old, c.rep_key AS now FROM rep_versions v
  JOIN rep_versions c ON v.suppkey = c.suppkey AND c.is_current),
product_now AS (
  SELECT v.product_key AS old, c.product_key AS now FROM dim_product v
  JOIN dim_product c ON v.brand_name = c.brand_name AND c.is_current),
rx_now AS (
  SELECT w.* REPLACE (h.now AS hcp_key, p.now AS product_key) FROM fct_prescription_weekly w
  JOIN hcp_now h ON w.hcp_key = h.old JOIN product_now p ON w.product_key = p.old),
rx_hcp_now AS (
  SELECT w.* REPLACE (h.now AS hcp_key) FROM fct_prescription_weekly w
  JOIN hcp_now h ON w.hcp_key = h.old),
visits_now AS (
  SELECT v.* REPLACE (h.now AS hcp_key, p.now AS product_key) FROM fct_hcp_visit v
  JOIN hcp_now h ON v.hcp_key = h.old JOIN product_now p ON v.product_key = p.old),
rep_visits_now AS (
  SELECT v.* REPLACE (h.now AS hcp_key, r.now AS rep_key) FROM fct_hcp_visit v
  JOIN hcp_now h ON v.hcp_key = h.old JOIN rep_now r ON v.rep_key = r.old),
quota_now AS (
  SELECT q.* REPLACE (r.now AS rep_key, p.now AS product_key) FROM fct_quota_attainment q
  JOIN rep_now r ON q.rep_key = r.old JOIN product_now p ON q.product_key = p.old),
quota_rows_now AS (
  SELECT q.*, r.rep_name, r.district, r.current_territory_name, p.brand_name
  FROM quota_now q
  JOIN dim_rep r ON q.rep_key = r.rep_key JOIN dim_product p ON q.product_key = p.product_key)
"""
