"""Fact builders."""

from __future__ import annotations

import datetime
from decimal import Decimal
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimstar.functions import calendar as cal
from dimstar.functions.labels import asc
from dimstar.functions.numeric import percent
from dimstar.operators.scd import scd2
from dimstar.operators.skew import as_one, attach_group_stats, running
from dimstar.session import settled

SHARE = "decimal(9,2)"


def weekly_snapshot(
    events: DataFrame, date_col: str, keys: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """Sums per Sunday week end and keys; one shuffle, combined before it."""
    return events.groupBy(cal.week_end(F.col(date_col)).alias("week_end_date_key"), *keys).agg(
        *[F.sum(m).alias(name) for name, m in measures.items()]
    )


ADDITIVE = ["new_rx_count", "total_rx_count", "total_units", "brand_units", "total_market_units"]


def monthly_rollup(weekly: DataFrame, rebuilt_at: datetime.datetime | None = None) -> DataFrame:
    """Territory x product x month of the week end; the share comes from summed components."""
    months = weekly.groupBy(
        cal.month_start(F.col("week_end_date_key")).alias("month_key"),
        F.col("territory_key").alias("territory_rollup_key"),
        "product_key",
    ).agg(
        *[F.sum(F.col(c).cast("bigint")).alias(c) for c in ADDITIVE],
        F.count(F.lit(1)).alias("source_row_count"),
    )
    stamp = F.lit(rebuilt_at) if rebuilt_at else F.current_timestamp()
    return months.withColumn(
        "market_share_pct",
        percent(F.col("brand_units"), F.col("total_market_units"), 2).cast(SHARE),
    ).withColumn("last_rebuilt_at", stamp.cast("timestamp_ntz"))


ROLLUP_KEYS = ["month_key", "territory_rollup_key", "product_key"]


def rollup_delta(removed: DataFrame, added: DataFrame, measures: Sequence[str] = ADDITIVE) -> DataFrame:
    """Signed monthly sums of weekly rows: added rows count +1, removed rows -1.

    ``source_row_count`` is the signed number of rows. Keys whose deltas are all 0 stay:
    they name a month that was touched. Both sides are combined before their shuffle.
    """
    cols = ["week_end_date_key", "territory_key", "product_key", *measures]
    signed = added.select(*cols, F.lit(1).alias("_sign")).unionByName(
        removed.select(*cols, F.lit(-1).alias("_sign"))
    )
    return signed.groupBy(
        cal.month_start(F.col("week_end_date_key")).alias("month_key"),
        F.col("territory_key").alias("territory_rollup_key"),
        "product_key",
    ).agg(
        *[F.sum(F.col(c).cast("bigint") * F.col("_sign")).alias(c) for c in measures],
        F.sum("_sign").cast("bigint").alias("source_row_count"),
    )


def merge_rollup(
    stored: DataFrame,
    delta: DataFrame,
    measures: Sequence[str] = ADDITIVE,
    rebuilt_at: datetime.datetime | None = None,
) -> DataFrame:
    """The stored rollup rows of the touched months with their deltas added.

    ``stored`` should hold only the months that ``delta`` touches. A key whose row count
    falls to 0 goes; the share is computed again from the summed components.
    """
    old = stored.select(*ROLLUP_KEYS, *[F.col(m).alias("_o_" + m) for m in [*measures, "source_row_count"]])
    merged = old.join(delta, ROLLUP_KEYS, "full_outer").select(
        *ROLLUP_KEYS,
        *[
            (F.coalesce(F.col("_o_" + m), F.lit(0)) + F.coalesce(F.col(m), F.lit(0))).alias(m)
            for m in [*measures, "source_row_count"]
        ],
    )
    kept = merged.where(F.col("source_row_count") > 0)
    if "brand_units" in measures and "total_market_units" in measures:
        kept = kept.withColumn(
            "market_share_pct",
            percent(F.col("brand_units"), F.col("total_market_units"), 2).cast(SHARE),
        )
    stamp = F.lit(rebuilt_at) if rebuilt_at else F.current_timestamp()
    return kept.withColumn("last_rebuilt_at", stamp.cast("timestamp_ntz"))


def quota_attainment(actuals: DataFrame, quotas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Quota, actual and prior-year actual on one row per keys and quarter.

    ``actuals``: keys, fiscal_quarter_key, actual_units. ``quotas``: keys,
    fiscal_quarter_key, quota_units. Both are unique in keys and quarter. A quota
    without sales keeps its row with zero actual units.
    """
    on = [*keys, "fiscal_quarter_key"]
    year_before = actuals.select(
        *keys,
        F.add_months("fiscal_quarter_key", 12).alias("fiscal_quarter_key"),
        F.col("actual_units").alias("prior_year_actual_units"),
    )
    joined = quotas.join(actuals, on, "left").join(year_before, on, "left")
    actual = F.coalesce("actual_units", F.lit(0)).cast("bigint")
    return joined.select(
        *on,
        F.add_months("fiscal_quarter_key", -12).alias("prior_year_quarter_key"),
        F.col("quota_units").cast("bigint").alias("quota_units"),
        actual.alias("actual_units"),
        F.coalesce("prior_year_actual_units", F.lit(0)).cast("bigint").alias(
            "prior_year_actual_units"
        ),
        percent(actual, F.col("quota_units"), 2).cast(SHARE).alias("attainment_pct"),
    )


def timespan_compress(df: DataFrame, key: Sequence[str], value: str, period: str) -> DataFrame:
    """A row only where the value changes, valid to the day before the next change."""
    if len(key) == 1:
        return scd2(df, key[0], [value], period)
    whole = F.struct(*key)
    spans = scd2(df.select(whole.alias("_key"), value, period), "_key", [value], period)
    return spans.select("_key.*", *[c for c in spans.columns if c != "_key"])


def timespan_expand(spans: DataFrame, horizon: datetime.date | Column, months: int = 3) -> DataFrame:
    """A row per period a span covers; an open span runs to ``horizon``. No join is needed."""
    end = F.lit(horizon) if isinstance(horizon, datetime.date) else horizon
    last = F.coalesce("expiration_date", end)
    periods = F.when(
        F.col("effective_date") <= last,
        F.sequence(F.col("effective_date"), last, F.expr(f"interval {months} months")),
    )
    return spans.withColumn("period_key", F.explode(periods))


def coverage_targets(assignments: DataFrame) -> DataFrame:
    """Factless: each assignment once."""
    keys = ["fiscal_quarter_key", "rep_key", "hcp_key", "product_key"]
    return assignments.select(*keys).distinct()


def visit_fact(
    events: DataFrame,
    flags: DataFrame,
    flag_cols: Sequence[str],
    audit_key: Column,
    samples: str = "samples_dropped",
) -> DataFrame:
    """Transaction fact: the flags become one junk key, missing samples become 0."""
    keyed = events.join(flags, list(flag_cols), "left").drop(*flag_cols)
    return keyed.withColumn(samples, F.coalesce(samples, F.lit(0))).withColumn(
        "audit_key", audit_key
    )


def market_share(
    df: DataFrame, market: Sequence[str], brand: Sequence[str], measure: str
) -> DataFrame:
    """Brand units over market units; the market is every row that shares ``market``."""
    # written: the market and the rows that read it would each sum all of ``df``
    brands = settled(df.groupBy(*market, *brand).agg(F.sum(measure).alias("brand_units")))
    whole = attach_group_stats(brands, market, {"total_market_units": F.sum("brand_units")})
    return whole.withColumn(
        "market_share_pct", percent(F.col("brand_units"), F.col("total_market_units"), 2)
    )


def co_promo_group(fact: DataFrame, bridge: DataFrame, on: Sequence[str]) -> DataFrame:
    """Attaches ``group_key``; NULL where the entity is not shared."""
    groups = bridge.select(*on, "group_key").distinct()
    return fact.join(groups, list(on), "left")


# Members up to which one task takes a whole group when weights are shared out.
BOUNDED_MEMBERS = 10_000


def bridge_weights(
    alignments: DataFrame,
    group: Sequence[str],
    member: str,
    measure: str,
    digits: int = 3,
    bounded: int = BOUNDED_MEMBERS,
) -> DataFrame:
    """Weights in whole units of ``10**-digits`` that sum to exactly 1 per group, each above 0.

    Largest remainder with a floor of one unit: every member first gets one unit; the
    ``10**digits - members`` units left are shared in proportion to ``measure``, whole
    units down; the units that rounding leaves go one each to the members with the
    largest remainders, ties to the smaller ``member``. All arithmetic is on whole
    numbers. A NULL or negative measure counts 0; a group whose measures are all 0
    shares alike. A group of more than ``10**digits`` members cannot give each a unit:
    the first ``10**digits`` by remainder (here: by ``member``) get one, the rest 0.

    ``alignment_rank`` ranks by ``measure`` (largest first, then ``member``), ``members``
    counts the group. ``member`` must be unique inside a group. Groups of up to
    ``bounded`` members are settled by windows after one shuffle. The larger ones take
    their totals from a combined aggregate and their positions from ``running``, so no
    task holds more than ``bounded`` members of a group, however many it has.
    """
    rows = settled(alignments)
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    large = settled(sizes.filter(F.col("_n") > bounded).select(as_one(group).alias("_key")))
    if large.isEmpty():
        return _weigh(rows, group, member, measure, digits, by_window=True)
    keyed = rows.withColumn("_key", as_one(group))
    few = keyed.join(large, "_key", "left_anti").drop("_key")
    many = keyed.join(large, "_key", "left_semi").drop("_key")
    return _weigh(few, group, member, measure, digits, by_window=True).unionByName(
        _weigh(many, group, member, measure, digits, by_window=False)
    )


def _weigh(
    alignments: DataFrame,
    group: Sequence[str],
    member: str,
    measure: str,
    digits: int,
    by_window: bool,
) -> DataFrame:
    """The weights of ``bridge_weights``, by plain windows or without holding any group."""
    whole_group = Window.partitionBy(*group)
    kind = f"decimal({digits + 1},{digits})"
    units = 10**digits
    big = "decimal(38,0)"
    x = F.greatest(F.coalesce(F.col(measure), F.lit(0)), F.lit(0)).cast(big)
    valued = alignments.withColumn("_x", x)
    if by_window:
        stats = valued.withColumns(
            {
                "members": F.count(F.lit(1)).over(whole_group),
                "_total": F.sum("_x").over(whole_group),
            }
        )
    else:
        stats = attach_group_stats(valued, group, {"_total": F.sum("_x")}, size="members")
    even = F.col("_total") == 0
    share = F.when(even, F.lit(1).cast(big)).otherwise(F.col("_x"))
    whole = F.when(even, F.col("members").cast(big)).otherwise(F.col("_total"))
    rest = F.greatest(F.lit(units) - F.col("members"), F.lit(0)).cast(big)
    quota = (rest * share).cast(big)
    floored = F.call_function("div", quota, whole)
    parts = stats.withColumns({"_floor": floored, "_rem": (quota - floored * whole).cast(big)})
    by_measure = [F.col(measure).desc_nulls_last(), asc(member)]
    by_rem = [F.col("_rem").desc(), asc(member)]
    if by_window:
        placed = parts.withColumns(
            {
                "alignment_rank": F.row_number().over(whole_group.orderBy(*by_measure)).cast("long"),
                "_by_rem": F.row_number().over(whole_group.orderBy(*by_rem)).cast("long"),
                "_all_floors": F.sum("_floor").over(whole_group),
            }
        )
    else:
        ranked = running(parts, group, by_measure, position="alignment_rank")
        placed = running(
            ranked,
            group,
            by_rem,
            position="_by_rem",
            sums={"_floors": F.col("_floor")},
            group_sums={"_all_floors": "_floors"},
        )
    left = F.lit(units) - F.col("members") - F.col("_all_floors")
    first = (F.col("members") <= units) | (F.col("_by_rem") <= units)
    got = (
        first.cast("long")
        + F.col("_floor")
        + (F.col("_by_rem") <= left).cast("long")
    )
    weight = (got.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(kind)
    return placed.select(
        *alignments.columns, "alignment_rank", "members", weight.alias("credit_split_weight")
    )


def top_members(
    totals: DataFrame, group: Sequence[str], member: str, measure: str, k: int
) -> DataFrame:
    """The ``k`` largest members of a group; Spark limits each group before the shuffle."""
    ranked = Window.partitionBy(*group).orderBy(F.col(measure).desc_nulls_last(), asc(member))
    return (
        totals.withColumn("alignment_rank", F.row_number().over(ranked))
        .filter(F.col("alignment_rank") <= k)
    )
