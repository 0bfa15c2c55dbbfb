"""Join shapes of the reports. Whether a side is broadcast is left to Spark's size check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimstar.operators.dims import current_rows


def with_current(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Facts on current dimension rows; facts stamped with an expired version drop out."""
    return fact.join(current_rows(dim), key)


def as_was(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Facts on the version stamped at load, current or not."""
    return fact.join(dim, key)


def with_outrigger(dim: DataFrame, outrigger: DataFrame, key: str) -> DataFrame:
    return dim.join(outrigger, key)


def zero_fill(rows: DataFrame, counts: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Keeps every row; counts that are missing become 0."""
    joined = rows.join(counts, list(on), "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in cols})


def gaps(expected: DataFrame, happened: DataFrame, on: Sequence[str]) -> DataFrame:
    """What did not happen: expected rows without a match."""
    return expected.join(happened, list(on), "left_anti")


def only_in(rows: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return rows.join(keys, list(on), "left_semi")


def drill_across(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_aggs: Sequence[Column],
    right_aggs: Sequence[Column],
) -> DataFrame:
    """Two facts, each brought to the shared keys first and joined then."""
    a = left.groupBy(*keys).agg(*left_aggs)
    b = right.groupBy(*keys).agg(*right_aggs)
    return a.join(b, list(keys), "full_outer")


def by_levels(
    fact: DataFrame, dim: DataFrame, key: str, levels: Sequence[str], sums: Mapping[str, str]
) -> DataFrame:
    """Totals at every level of a hierarchy: level, place and the sums.

    The fact is read once and summed per key before it meets the dimension.
    """
    per_key = fact.groupBy(key).agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    places = F.array(*[F.struct(F.lit(v).alias("level"), F.col(v).alias("place")) for v in levels])
    return (
        per_key.join(dim.select(key, *levels), key)
        .select(F.inline(places), *sums)
        .groupBy("level", "place")
        .agg(*[F.sum(name).alias(name) for name in sums])
    )
