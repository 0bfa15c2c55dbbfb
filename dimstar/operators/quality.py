"""Integrity checks. Each returns the violating rows, or one row per rule where counts do."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimstar.functions.numeric import percent


def duplicate_grain(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def orphans(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, soft: bool = False
) -> DataFrame:
    """Rows whose key is missing in the dimension. A soft key may be NULL, a hard one may not."""
    keys = dim.select(F.col(dim_key).alias("_key")).distinct()
    rows = fact.filter(F.col(fact_key).isNotNull()) if soft else fact
    return rows.join(keys, F.col(fact_key) == F.col("_key"), "left_anti")


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column, counted in one pass."""
    counted = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in cols])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in cols]
    return counted.select(F.inline(F.array(*pairs)))


def weight_range(bridge: DataFrame, weight: str = "credit_split_weight") -> DataFrame:
    return bridge.filter((F.col(weight) <= 0) | (F.col(weight) > 1) | F.col(weight).isNull())


def weight_sums(
    bridge: DataFrame, group: Sequence[str], weight: str = "credit_split_weight"
) -> DataFrame:
    """Groups whose weights do not sum to 1, compared as decimals."""
    sums = bridge.groupBy(*group).agg(F.sum(weight).alias("weight_sum"))
    return sums.filter(F.col("weight_sum") != F.lit(1).cast("decimal(4,3)"))


def too_long(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """One row per text column with a value over its limit."""
    over = [
        F.sum((F.length(c) > n).cast("bigint")).alias(f"{c}") for c, n in limits.items()
    ]
    longest = [F.max(F.length(c)).alias(f"_max_{c}") for c in limits]
    counted = df.agg(*over, *longest)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(n).alias("max_length"),
            F.col(c).alias("rows_over"),
            F.col(f"_max_{c}").alias("longest"),
        )
        for c, n in limits.items()
    ]
    return counted.select(F.inline(F.array(*rows))).filter("rows_over > 0")


def not_fixed_width(df: DataFrame, col: str, width: int) -> DataFrame:
    return df.filter(F.length(col) != width)


def row_count_mismatch(fact: DataFrame, audit: DataFrame) -> DataFrame:
    """Batches whose stated row counts differ from the rows that carry their key."""
    loaded = fact.groupBy("audit_key").agg(F.count(F.lit(1)).alias("fact_row_count"))
    compared = audit.join(loaded, "audit_key", "left").withColumn(
        "fact_row_count", F.coalesce("fact_row_count", F.lit(0))
    )
    return compared.filter(
        (F.col("source_row_count") != F.col("loaded_row_count"))
        | (F.col("loaded_row_count") != F.col("fact_row_count"))
    )


def scd_problems(dim: DataFrame, key: str) -> DataFrame:
    """Versions that overlap or leave a gap, and keys without exactly one current row."""
    versions = Window.partitionBy(key).orderBy("effective_date")
    following = F.lead("effective_date").over(versions)
    currents = F.sum(F.col("is_current").cast("int")).over(Window.partitionBy(key))
    due = F.date_add("expiration_date", 1)
    problem = (
        F.when(currents != 1, "current rows")
        .when(following.isNotNull() & F.col("expiration_date").isNull(), "overlap")
        .when(due > following, "overlap")
        .when(due < following, "gap")
        .when(following.isNull() & F.col("expiration_date").isNotNull(), "closed")
    )
    return dim.withColumn("problem", problem).filter("problem is not null")


def outside_domain(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """Values that are not in the list, NULL included, with their row counts."""
    bad = ~F.col(col).isin(*allowed) | F.col(col).isNull()
    return df.filter(bad).groupBy(col).agg(F.count(F.lit(1)).alias("row_count"))


def rollup_drift(
    stored: DataFrame, rebuilt: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Rows in which a stored rollup and its re-aggregation differ, or that only one has."""
    a = stored.select(*keys, *[F.col(m).alias("stored_" + m) for m in measures])
    b = rebuilt.select(*keys, *[F.col(m).alias("rebuilt_" + m) for m in measures])
    differs = reduce(
        lambda x, y: x | y,
        [~F.col("stored_" + m).eqNullSafe(F.col("rebuilt_" + m)) for m in measures],
    )
    return a.join(b, list(keys), "full_outer").filter(differs)


def stored_ratio_mismatch(
    df: DataFrame, stored: str, num: Column, den: Column, digits: int = 2
) -> DataFrame:
    """Rows whose stored percentage differs from the one its components give."""
    again = df.withColumn("recomputed", percent(num, den, digits))
    return again.filter(~F.col(stored).eqNullSafe(F.col("recomputed")))


def compiled_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared rule of the stated schema, one row each: table_name, rule,
    column_name, violations.

    Rules: ``grain`` (rows beyond the first of each grain), ``not_null`` (required
    columns), ``foreign_key`` (non-NULL keys missing in the dimension; ``column_name``
    reads ``col->dim.key``), ``text_limit`` (more code points than the limit),
    ``fixed_width`` (a length other than the width; NULL not counted) and ``domain`` (a
    value outside the list; NULL not counted). Tables that are not given are skipped,
    and so are keys into them.

    Each table is compiled into one pass: a single scan, a left join to the distinct
    keys of each dimension it refers to, one grouping by its grain that carries the row
    count and a sum per rule (combined before its shuffle, so a hot grain costs nothing
    extra), and one global aggregate whose columns become rows.
    """
    from dimstar.sources.schema import (
        DOMAINS, FIXED_WIDTHS, FOREIGN_KEYS, GRAINS, TEXT_LIMITS, required,
    )

    parts = []
    for name, df in tables.items():
        flags: dict[tuple[str, str], Column] = {}
        for col in required(name):
            flags[("not_null", col)] = F.col(col).isNull()
        for col, n in TEXT_LIMITS.get(name, {}).items():
            flags[("text_limit", col)] = F.char_length(col) > n
        for col, n in FIXED_WIDTHS.get(name, {}).items():
            flags[("fixed_width", col)] = F.char_length(col) != n
        for (table, col), values in DOMAINS.items():
            if table == name:
                flags[("domain", col)] = ~F.col(col).isin(values)
        rows = df
        for i, (col, dim, key) in enumerate(FOREIGN_KEYS.get(name, [])):
            if dim not in tables:
                continue
            found = tables[dim].select(F.col(key).alias(f"_fk{i}")).distinct()
            rows = rows.join(found, F.col(col) == F.col(f"_fk{i}"), "left")
            flags[("foreign_key", f"{col}->{dim}.{key}")] = (
                F.col(col).isNotNull() & F.col(f"_fk{i}").isNull()
            )
        rules = list(flags)
        grain = GRAINS[name]
        per_grain = rows.groupBy(*grain).agg(
            F.count(F.lit(1)).alias("_n"),
            *[
                F.sum(F.coalesce(flags[r], F.lit(False)).cast("long")).alias(f"_r{j}")
                for j, r in enumerate(rules)
            ],
        )
        total = per_grain.agg(
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_grain"),
            *[F.coalesce(F.sum(f"_r{j}"), F.lit(0)).alias(f"_r{j}") for j in range(len(rules))],
        )
        entries = [
            F.struct(
                F.lit(name).alias("table_name"), F.lit("grain").alias("rule"),
                F.lit(",".join(grain)).alias("column_name"),
                F.col("_grain").cast("long").alias("violations"),
            )
        ] + [
            F.struct(
                F.lit(name).alias("table_name"), F.lit(rule).alias("rule"),
                F.lit(col).alias("column_name"), F.col(f"_r{j}").cast("long").alias("violations"),
            )
            for j, (rule, col) in enumerate(rules)
        ]
        parts.append(total.select(F.inline(F.array(*entries))))
    return reduce(DataFrame.unionByName, parts)
