"""Dimension builders."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimstar.functions import calendar as cal
from dimstar.functions.labels import asc, label_ladder
from dimstar.operators.skew import as_one, running
from dimstar.operators.windows import ntile_in
from dimstar.sources.io import path_exists


def day_range(spark: SparkSession, start: datetime.date, end: datetime.date) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date_key"))


def holidays(years: DataFrame) -> DataFrame:
    """Four holidays for each ``year``; Thanksgiving is the fourth Thursday of November."""

    def on(month: int, day: int) -> Column:
        return F.make_date(F.col("year"), F.lit(month), F.lit(day))

    thanksgiving = F.date_add(F.next_day(on(10, 31), "TH"), 21)
    # fixed values: the names of the holidays
    named = [
        (on(1, 1), "New Year's Day"),
        (on(7, 4), "Independence Day"),
        (thanksgiving, "Thanksgiving"),
        (on(12, 25), "Christmas"),
    ]
    pairs = [F.struct(d.alias("holiday_date"), F.lit(n).alias("holiday_name")) for d, n in named]
    return years.select(F.inline(F.array(*pairs)))


def with_date_attributes(
    days: DataFrame,
    holiday_table: DataFrame | None = None,
    fiscal_start: int = cal.FISCAL_START_MONTH,
) -> DataFrame:
    """Calendar and fiscal attributes for a table of distinct days (``date_key``)."""
    day = F.col("date_key")
    if holiday_table is None:
        holiday_table = holidays(days.select(F.year(day).alias("year")).distinct())
    return days.join(holiday_table, day == F.col("holiday_date"), "left").select(
        "date_key",
        F.dayofweek(day).cast("short").alias("day_of_week_num"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        F.dayofmonth(day).cast("short").alias("day_of_month"),
        F.weekofyear(day).cast("short").alias("week_number"),
        F.month(day).cast("short").alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).cast("short").alias("calendar_quarter"),
        F.year(day).cast("short").alias("calendar_year"),
        cal.fiscal_quarter(day, fiscal_start).cast("short").alias("fiscal_quarter"),
        cal.fiscal_year(day, fiscal_start).cast("short").alias("fiscal_year"),
        cal.fiscal_quarter_name(day, fiscal_start).alias("fiscal_quarter_name"),
        cal.fiscal_period_name(day, fiscal_start).alias("fiscal_period_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.col("holiday_date").isNotNull().alias("is_holiday"),
        "holiday_name",
    )


def date_dim(
    spark: SparkSession,
    start: datetime.date,
    end: datetime.date,
    fiscal_start: int = cal.FISCAL_START_MONTH,
    holiday_table: DataFrame | None = None,
) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    return with_date_attributes(day_range(spark, start, end), holiday_table, fiscal_start)


def date_dim_of(facts: DataFrame, day: str, fiscal_start: int = cal.FISCAL_START_MONTH) -> DataFrame:
    """One row per day between the first and the last date of a fact column."""
    span = facts.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("date_key"))
    return with_date_attributes(days, None, fiscal_start)


def month_attributes(fiscal_start: int = cal.FISCAL_START_MONTH) -> list[Column]:
    month = F.col("month_key")
    return [
        month,
        F.date_format(month, "MMMM").alias("month_name"),
        F.month(month).cast("short").alias("month_num"),
        F.quarter(month).cast("short").alias("calendar_quarter"),
        F.year(month).cast("short").alias("calendar_year"),
        cal.fiscal_quarter(month, fiscal_start).cast("short").alias("fiscal_quarter"),
        cal.fiscal_year(month, fiscal_start).cast("short").alias("fiscal_year"),
        cal.fiscal_period_name(month, fiscal_start).alias("fiscal_period_name"),
    ]


def month_dim(
    spark: SparkSession,
    start: datetime.date,
    end: datetime.date,
    fiscal_start: int = cal.FISCAL_START_MONTH,
) -> DataFrame:
    """One row per month that starts or is under way between two days."""
    first, last = F.trunc(F.lit(start), "month"), F.trunc(F.lit(end), "month")
    months = spark.range(1).select(
        F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month_key")
    )
    return months.select(*month_attributes(fiscal_start))


def month_dim_of(days: DataFrame, day: str, fiscal_start: int = cal.FISCAL_START_MONTH) -> DataFrame:
    """The months that occur in a date column."""
    months = days.select(cal.month_start(F.col(day)).alias("month_key")).distinct()
    return months.select(*month_attributes(fiscal_start))


def flatten_hierarchy(
    leaf: DataFrame, levels: Sequence[tuple[DataFrame, str, str]]
) -> DataFrame:
    """Fixed-depth hierarchy as columns: one left join per level.

    ``levels`` lists (table, key in the rows so far, key in the table). Tables are small,
    but no broadcast is forced: Spark does it where their size allows.
    """
    out = leaf
    for table, child_key, parent_key in levels:
        out = out.join(table, out[child_key] == table[parent_key], "left").drop(
            *([table[parent_key]] if child_key != parent_key else [])
        )
    return out


def shrink_dim(dim: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A rollup dimension: fewer columns, one row per combination that is left."""
    return dim.select(*cols).distinct()


def junk_dim_from_domains(
    spark: SparkSession, domains: Mapping[str, Sequence[str]], key: str = "junk_key"
) -> DataFrame:
    """Every combination of flag values: each domain is unfolded in turn, without a join."""
    out = spark.range(1).select(F.lit(0).cast("bigint").alias("_code"))
    for name, values in domains.items():
        unfolded = F.posexplode(F.array(*[F.lit(v) for v in values])).alias("_at", name)
        kept = [c for c in out.columns if c != "_code"]
        out = out.select("*", unfolded).select(
            (F.col("_code") * len(values) + F.col("_at")).alias("_code"), *kept, name
        )
    return out.select((F.col("_code") + 1).alias(key), *domains)


def junk_dim(df: DataFrame, cols: Sequence[str], key: str = "junk_key") -> DataFrame:
    """The combinations of flags that occur, with a dense key in the order of the columns."""
    return surrogate_key(df.select(*cols).distinct(), cols, key)


def split_text_dim(
    df: DataFrame, id_col: str, text_col: str, key: str, attributes: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Moves text off a fact into a 1:1 dimension; returns (fact, dimension)."""
    fact = df.withColumn(key, F.col(id_col)).drop(text_col, *attributes)
    notes = df.select(
        F.col(id_col).alias(key),
        F.col(text_col).alias("note_text"),
        F.length(text_col).alias("note_length"),
        *attributes,
    )
    return fact, notes


def audit_dim(
    loads: DataFrame, batch_id: str = "batch_id", loaded_at: str = "loaded_at"
) -> DataFrame:
    """One row per load batch from a log of loaded rows; rows without a target were rejected."""
    rejected = F.sum(F.when(F.col("rejected"), 1).otherwise(0))
    return loads.groupBy(batch_id, "source_system").agg(
        F.min(loaded_at).alias("batch_start_time"),
        F.max(loaded_at).alias("batch_end_time"),
        F.count(F.lit(1)).alias("source_row_count"),
        (F.count(F.lit(1)) - rejected).alias("loaded_row_count"),
        F.when(rejected > 0, "rejects").otherwise("clean").alias("dq_flag"),
        F.lit("completed").alias("batch_status"),
    )


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def role_play(dim: DataFrame, prefix: str) -> DataFrame:
    """A renamed copy, for a second foreign key to the same dimension."""
    return dim.select(*[F.col(c).alias(prefix + c) for c in dim.columns])


def surrogate_key(
    df: DataFrame, order_cols: Sequence[str], key: str, start: int = 1, **kw
) -> DataFrame:
    """Dense integer key in the order of ``order_cols`` (unique together), found in parallel."""
    numbered = running(df, [], [asc(c) for c in order_cols], position="_at", **kw)
    return numbered.select((F.col("_at") + F.lit(start - 1)).alias(key), *df.columns)


def registered_keys(df: DataFrame, registry: str, natural: Sequence[str], key: str) -> DataFrame:
    """``df`` with a stable dense key for each natural key, kept in a stored registry.

    Natural keys already in the registry keep their number. New ones (an anti join
    against the registry) are numbered after the largest key, densely and in the order
    of the natural key, by ``running``, so no task holds them all; they are appended to
    the registry as one new file set before the keys are attached. A late or repeated
    load therefore never renumbers an earlier key. NULL parts of a natural key compare
    equal to NULL. ``registry`` is a folder all executors share.
    """
    spark = df.sparkSession
    nk = as_one(natural).alias("_nk")
    wanted = df.select(*natural).distinct()
    known = spark.read.parquet(registry) if path_exists(spark, registry) else None
    if known is None:
        new, start = wanted, 1
    else:
        new = wanted.withColumn("_nk", as_one(natural)).join(
            known.select(nk), "_nk", "left_anti"
        ).drop("_nk")
        start = (known.agg(F.max(key)).first()[0] or 0) + 1
    surrogate_key(new, natural, key, start).write.mode("append").parquet(registry)
    keys = spark.read.parquet(registry).select(nk, key)
    return df.withColumn("_nk", as_one(natural)).join(keys, "_nk").drop("_nk")


def hash_key(cols: Sequence[str]) -> Column:
    """A key without order or shuffle, for loads that need no dense numbers."""
    return F.xxhash64(*cols)


def band_decile(
    fact: DataFrame,
    entity: str,
    measure: str,
    n: int = 10,
    direction: str = "highest_first",
    group: Sequence[str] = (),
    **kw,
) -> DataFrame:
    """Stored band from volume. ``highest_first`` puts the largest volume into band 1."""
    volume = fact.groupBy(*group, entity).agg(F.sum(measure).alias("volume"))
    order = F.col("volume").desc_nulls_first()
    placed = ntile_in(volume, group, [order, asc(entity)], n, "band", **kw)
    if direction == "highest_first":
        return placed
    return placed.withColumn("band", F.lit(n + 1) - F.col("band"))


def band_segment(volume: Column, floors: Sequence[tuple[str, int]], lowest: str) -> Column:
    """Tier from volume thresholds, highest first."""
    return label_ladder([(volume >= floor, name) for name, floor in floors], lowest)
