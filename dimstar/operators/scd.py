"""Slowly changing dimensions. Expiry is inclusive; NULL means the current version.

Windows here are over the versions of one durable key. Snapshots hold one row per key
and date, so a group has at most as many rows as there were load dates.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimstar.operators.dims import surrogate_key


def _validity(versions: Window) -> list[Column]:
    following = F.lead("effective_date").over(versions)
    return [
        F.col("effective_date"),
        F.date_sub(following, 1).alias("expiration_date"),
        following.isNull().alias("is_current"),
    ]


def scd2(
    snapshots: DataFrame,
    key: str,
    tracked: Sequence[str],
    ts: str,
    first_of_run: Sequence[str] = (),
    last_of_run: Sequence[str] = (),
) -> DataFrame:
    """A version per run of equal tracked values, so a value that returns gets a new one.

    ``first_of_run`` keeps the first non-NULL value inside a run and ``last_of_run`` the
    latest value (attributes that are overwritten, not versioned).
    """
    dated = Window.partitionBy(key).orderBy(ts)
    differs = reduce(
        lambda a, b: a | b, [~F.col(c).eqNullSafe(F.lag(c).over(dated)) for c in tracked]
    )
    starts = F.when((F.row_number().over(dated) == 1) | differs, 1).otherwise(0)
    runs = snapshots.withColumn("_start", starts).withColumn(
        "_run", F.sum("_start").over(dated.rowsBetween(Window.unboundedPreceding, 0))
    )
    in_run = Window.partitionBy(key, "_run").orderBy(ts)
    whole_run = in_run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kept = runs.select(
        key,
        *tracked,
        F.col(ts).alias("effective_date"),
        "_start",
        F.col("_run").cast("int").alias("version"),
        *[F.first(c, ignorenulls=True).over(whole_run).alias(c) for c in first_of_run],
        *[F.last(c).over(whole_run).alias(c) for c in last_of_run],
    ).filter("_start = 1")
    versions = Window.partitionBy(key).orderBy("effective_date")
    return kept.select(
        key, *tracked, *first_of_run, *last_of_run, "version", *_validity(versions)
    )


def scd2_merge(
    dim: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    ts: str,
    surrogate: str | None = None,
    next_key: int = 1,
) -> DataFrame:
    """New snapshots into an existing dimension, late ones included.

    Only keys with an incoming row are versioned again; the others pass through. A
    version that survives keeps its surrogate key, also if a late row moves its start.
    """
    keys = incoming.select(key).distinct()
    touched = dim.join(keys, key, "left_semi")
    untouched = dim.join(keys, key, "left_anti")
    carried = [surrogate] if surrogate else []
    old = touched.select(key, *tracked, F.col("effective_date").alias("_ts"), *carried)
    new = incoming.select(key, *tracked, F.col(ts).alias("_ts"))
    if surrogate:
        new = new.withColumn(surrogate, F.lit(None).cast(dim.schema[surrogate].dataType))
    # A restated date: the incoming values win over the stored version of that day.
    both = old.join(new.select(key, "_ts"), [key, "_ts"], "left_anti").unionByName(new)
    if surrogate:
        keys_of_day = old.select(key, "_ts", F.col(surrogate).alias("_kept"))
        both = (
            both.join(keys_of_day, [key, "_ts"], "left")
            .withColumn(surrogate, F.coalesce(surrogate, "_kept"))
            .drop("_kept")
        )
    versions = scd2(both, key, tracked, "_ts", first_of_run=carried)
    if surrogate:
        fresh = surrogate_key(
            versions.filter(F.col(surrogate).isNull()).drop(surrogate),
            [key, "effective_date"],
            surrogate,
            start=next_key,
        )
        versions = versions.filter(F.col(surrogate).isNotNull()).unionByName(fresh)
    columns = [key, *tracked, *carried, "effective_date", "expiration_date", "is_current"]
    return untouched.select(*columns).unionByName(versions.select(*columns))


def scd6_overlay(dim: DataFrame, key: str, cols: Sequence[str], prefix: str = "current_") -> DataFrame:
    """The latest value of each column on every version of its key."""
    versions = Window.partitionBy(key)
    latest = [F.max_by(c, "effective_date").over(versions).alias(prefix + c) for c in cols]
    return dim.select("*", *latest)


def scd1_overwrite(dim: DataFrame, incoming: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """New values on all versions of a key; ``incoming`` has one row per key."""
    new = incoming.select(key, *[F.col(c).alias("_new_" + c) for c in cols])
    joined = dim.join(new, key, "left")
    return joined.select(
        *[F.coalesce("_new_" + c, c).alias(c) if c in cols else F.col(c) for c in dim.columns]
    )


def scd0_retain(dim: DataFrame, incoming: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """The first known value stays; an incoming one only fills a NULL."""
    new = incoming.select(key, *[F.col(c).alias("_new_" + c) for c in cols])
    joined = dim.join(new, key, "left")
    return joined.select(
        *[F.coalesce(c, "_new_" + c).alias(c) if c in cols else F.col(c) for c in dim.columns]
    )


def as_of(dim: DataFrame, day: datetime.date) -> DataFrame:
    at = F.lit(day)
    return dim.filter(
        (F.col("effective_date") <= at)
        & (F.col("expiration_date").isNull() | (F.col("expiration_date") >= at))
    )


def stamp_keys(
    events: DataFrame,
    dim: DataFrame,
    on: str,
    date_col: str,
    keys: Sequence[str],
    open_start: bool = True,
    is_first: Column | None = None,
) -> DataFrame:
    """Adds the columns ``keys`` of the version valid on the day of the event.

    An equi-join on the durable key with the validity as an extra condition, never a pure
    range join. With ``open_start`` the first version also covers earlier days; ``is_first``
    names it where the dimension says which one it is. Events that find no version keep
    NULL keys, to be caught by the foreign-key check.
    """
    valid_from = F.col("effective_date")
    if open_start:
        if is_first is None:
            versions = Window.partitionBy(on).orderBy("effective_date")
            is_first = F.lag("effective_date").over(versions).isNull()
        valid_from = F.when(~is_first, valid_from)
    valid = dim.select(
        F.col(on).alias("_on"),
        valid_from.alias("_from"),
        F.col("expiration_date").alias("_to"),
        *[F.col(k).alias(k) for k in keys],
    )
    day = events[date_col]
    match = (
        (events[on] == F.col("_on"))
        & (F.col("_from").isNull() | (F.col("_from") <= day))
        & (F.col("_to").isNull() | (F.col("_to") >= day))
    )
    return events.join(valid, match, "left").drop("_on", "_from", "_to")
