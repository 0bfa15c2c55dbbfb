"""Exact decimal ratios and means, rounded half away from zero; NULL on a zero denominator."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

def as_number(value: Column) -> Column:
    """Sums and counts as a decimal that keeps every digit of a bigint."""
    return value.cast("decimal(20,0)")


def ratio(num: Column, den: Column, digits: int, factor: str = "1.0") -> Column:
    """``round(factor * num / nullif(den, 0), digits)`` for whole-number columns."""
    return F.round(F.lit(Decimal(factor)) * as_number(num) / F.nullif(as_number(den), F.lit(0)), digits)


def percent(num: Column, den: Column, digits: int = 1) -> Column:
    return ratio(num, den, digits, "100.0")


def percent_of_decimal(num: Column, den: Column, digits: int = 1) -> Column:
    """Percentage of two columns that are decimals already, such as rounded means."""
    return F.round(F.lit(Decimal("100.0")) * num / F.nullif(den, F.lit(0)), digits)


def exact_share(num: Column, den: Column, digits: int) -> Column:
    """``num / den`` of whole numbers with ``digits`` digits, where a decimal quotient has too few."""
    double = as_number(den) * 2
    units = F.call_function("div", as_number(num) * F.lit(2 * 10**digits) + as_number(den), double)
    return units.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))


def mean(value: Column, digits: int) -> Column:
    """Rounded mean of a whole-number column inside ``agg``; never a rounded mean of a mean."""
    return ratio(F.sum(value.cast("bigint")), F.count(value), digits)
