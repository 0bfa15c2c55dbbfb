"""Window functions of the reports.

The first half is for groups the grain bounds, such as the weeks of one entity and
product, where a plain window is the right plan. The second half takes groups of any
size. All orders need a unique tie-break, given by the caller.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimstar.functions.labels import asc
from dimstar.functions.numeric import percent, ratio
from dimstar.operators.skew import attach_group_stats, join_back, running

# --- groups bounded by the grain ---------------------------------------------------


def in_order(group: Sequence[str], order: Sequence[str]) -> "Window":
    return Window.partitionBy(*group).orderBy(*[asc(o) for o in order])


def rolling_mean(
    group: Sequence[str], order: Sequence[str], value: str, rows: int, digits: int
) -> Column:
    """Mean of a whole-number column over the last ``rows`` rows, not calendar periods."""
    frame = in_order(group, order).rowsBetween(-(rows - 1), 0)
    return ratio(F.sum(F.col(value).cast("bigint")).over(frame), F.count(value).over(frame), digits)


def rolling_mean_decimal(
    group: Sequence[str], order: Sequence[str], value: str, rows: int, digits: int
) -> Column:
    """The same for a decimal column, such as a rounded share."""
    frame = in_order(group, order).rowsBetween(-(rows - 1), 0)
    total, n = F.sum(value).over(frame), F.count(value).over(frame)
    return F.round(total / F.nullif(n, F.lit(0)), digits)


def prior(group: Sequence[str], order: Sequence[str], value: str) -> Column:
    return F.lag(value, 1).over(in_order(group, order))


def change(value: str, prior_value: str) -> Column:
    return F.col(value) - F.col(prior_value)


# --- groups of any size ------------------------------------------------------------


def row_number_in(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column], out: str, **kw
) -> DataFrame:
    return running(rows, group, order, position=out, **kw)


def running_total(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column], value: Column, out: str, **kw
) -> DataFrame:
    return running(rows, group, order, sums={out: value}, **kw)


def ntile_in(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, out: str, **kw
) -> DataFrame:
    """Tiles of equal size; the first ``rows % n`` tiles hold one row more."""
    placed = running(rows, group, order, position="_at", group_rows="_of", **kw)
    size = F.floor(F.col("_of") / n)
    larger = F.col("_of") % n
    in_larger = larger * (size + 1)
    at = F.col("_at") - 1
    tile = F.when(at < in_larger, F.floor(at / (size + 1))).otherwise(
        larger + F.floor((at - in_larger) / F.greatest(size, F.lit(1)))
    )
    return placed.withColumn(out, (tile + 1).cast("int")).drop("_at", "_of")


def ranked_by_value(
    rows: DataFrame,
    group: Sequence[str],
    value: str,
    dense_rank_desc: str | None = None,
    percent_rank: str | None = None,
    group_rows: str | None = None,
    group_sum: str | None = None,
    group_known: str | None = None,
    digits: int = 1,
    **kw,
) -> DataFrame:
    """Dense rank (highest first) and percent rank (lowest first, in percent) of a value.

    Both depend on the value alone, so they are found on one row per (group, value) and
    joined back; a NULL value counts as the largest. The same rows give the size of the
    group, the sum of its values and how many are known.
    """
    counts = rows.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_ties"))
    ties = F.col("_ties")
    placed = running(
        counts,
        group,
        [asc(value)],
        position="_at",
        sums={
            "_upto": ties,
            "_total": F.col(value) * ties,
            "_known": F.when(F.col(value).isNotNull(), ties).otherwise(0),
        },
        group_rows="_values",
        group_sums={"_group_rows": "_upto", "_group_sum": "_total", "_group_known": "_known"},
        **kw,
    )
    below = F.col("_upto") - ties
    in_percent = F.coalesce(percent(below, F.col("_group_rows") - 1, digits), F.lit(Decimal("0.0")))
    found = {
        dense_rank_desc: F.col("_values") - F.col("_at") + 1,
        percent_rank: in_percent,
        group_rows: F.col("_group_rows"),
        group_sum: F.col("_group_sum"),
        group_known: F.col("_group_known"),
    }
    stats = placed.select(
        *group, value, *[c.alias(name) for name, c in found.items() if name]
    )
    return join_back(rows, stats, [*group, value])


def share_of_group(
    rows: DataFrame,
    group: Sequence[str],
    condition: Column,
    out: str,
    digits: int = 1,
) -> DataFrame:
    """Percentage of the rows of a group that meet a condition, on every row."""
    hits = F.sum(F.when(condition, 1).otherwise(0))
    found = attach_group_stats(rows, group, {"_hits": hits}, size="_of")
    return found.withColumn(out, percent(F.col("_hits"), F.col("_of"), digits)).drop("_hits", "_of")
