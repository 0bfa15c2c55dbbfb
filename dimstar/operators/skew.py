"""Building blocks for groups that may hold a large share of all rows.

A plain ``Window`` puts a whole group into one task. It is used in this package only
where the grain bounds the group (the weeks of one entity, the versions of one key).
Everything else goes through the operators below:

* ``attach_group_stats`` aggregates with partial aggregation and joins the result back in a
  join whose hot partitions adaptive execution splits;
* ``running`` ranges the rows over all tasks by (group, order), keeps a small summary
  per range, and adds the summary of the earlier ranges to positions found inside one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimstar.session import settled

def as_one(keys: Sequence[str], *more: Column) -> Column:
    """Keys as one struct: equal where all fields are equal, NULL fields included."""
    return F.struct(*[F.col(k) for k in keys], *more)


def join_back(rows: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of ``stats``, which is unique in ``keys``, to ``rows``.

    The stats are written first: they are few, and a join whose sides are both plain
    exchanges lets adaptive execution split the rows of a hot key over many tasks, however
    many rows the key has.
    """
    added = [c for c in stats.columns if c not in keys]
    found = settled(stats.select(as_one(keys).alias("_key"), *added))
    return rows.withColumn("_key", as_one(keys)).join(found, "_key").select(*rows.columns, *added)


def attach_group_stats(
    rows: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], size: str | None = None
) -> DataFrame:
    """Aggregates over a group, on every row of it: a window without order, safe for hot groups.

    One aggregation, combined before its shuffle, and one join.
    """
    counted = [F.count(F.lit(1)).alias(size)] if size else []
    stats = rows.groupBy(*keys).agg(*counted, *[agg.alias(name) for name, agg in aggs.items()])
    return join_back(rows, stats, keys)


def running(
    rows: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    position: str | None = None,
    sums: Mapping[str, Column] | None = None,
    group_rows: str | None = None,
    group_sums: Mapping[str, str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Position and running sums inside ordered groups of any size.

    ``order`` must be unique inside a group. Rows are ranged by (group, order) over
    ``ranges`` tasks, so a large group covers several of them and none holds it whole.
    A group has at most one summary row per range, which bounds the window over them.
    Without a number there are up to ``spark.sql.shuffle.partitions`` ranges; adaptive
    execution merges neighbours that are small, which keeps their order.
    The ranged rows are written once: rows and summary then agree on the ranges, also
    after a lost executor. ``group_sums`` names the whole group's total of a sum.
    """
    sums = dict(sums or {})
    part = {name: f"_sum{i}" for i, name in enumerate(sums)}
    by = [*[F.col(g) for g in group], *order]
    ranged = settled(
        rows.withColumns({part[name]: value for name, value in sums.items()})
        .repartitionByRange(*([ranges] if ranges else []), *by)
        .withColumn("_run", F.spark_partition_id())
    )
    summary = ranged.groupBy(*group, "_run").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(v).alias(f"_in{v}") for v in part.values()]
    )
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    run = as_one(group, F.col("_run"))
    summary = summary.select(
        run.alias("_at_run"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
        F.sum("_n").over(whole).alias("_n_group"),
        *[F.sum(f"_in{v}").over(before).alias(f"_before{v}") for v in part.values()],
        *[F.sum(f"_in{v}").over(whole).alias(f"_group{v}") for v in part.values()],
    )
    inside = Window.partitionBy("_at_run").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_at_run", run).select(
        "*",
        F.row_number().over(inside).alias("_pos"),
        *[F.sum(v).over(upto).alias(f"_upto{v}") for v in part.values()],
    )
    added = []
    if position:
        added.append((F.col("_n_before") + F.col("_pos")).alias(position))
    if group_rows:
        added.append(F.col("_n_group").alias(group_rows))
    for name, v in part.items():
        # NULL only while no value has been seen, as for a plain running sum.
        earlier, here = F.col(f"_before{v}"), F.col(f"_upto{v}")
        added.append(F.coalesce(earlier + here, here, earlier).alias(name))
    for name, of in (group_sums or {}).items():
        added.append(F.col(f"_group{part[of]}").alias(name))
    return local.join(summary, "_at_run").select(*rows.columns, *added)
