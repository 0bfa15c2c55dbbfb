"""Calendar and fiscal column functions. The fiscal year starts in August unless told otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FISCAL_START_MONTH = 8


def fiscal_year(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    """The year a fiscal year ends in: August 2023 lies in 2024."""
    if start_month == 1:
        return F.year(day)
    return F.year(day) + (F.month(day) >= start_month).cast("int")


def fiscal_quarter(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    months_in = F.pmod(F.month(day) - F.lit(start_month), F.lit(12))
    return (F.floor(months_in / 3) + 1).cast("int")


def fiscal_quarter_start(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    """First day of the fiscal quarter: the key quarterly facts are stored under."""
    shift = start_month - 1
    return F.add_months(F.trunc(F.add_months(day, -shift), "quarter"), shift)


def quarter_key(year: Column, quarter: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    """Quarter start from a fiscal year and a quarter number."""
    first = F.make_date(
        year - F.lit(0 if start_month == 1 else 1), F.lit(start_month), F.lit(1)
    )
    return F.add_months(first, ((quarter - 1) * 3).cast("int"))


def fiscal_quarter_name(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    return F.format_string(
        "FQ%d %d", fiscal_quarter(day, start_month), fiscal_year(day, start_month)
    )


def fiscal_period_name(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    return F.format_string(
        "FY%d Q%d", fiscal_year(day, start_month), fiscal_quarter(day, start_month)
    )


def week_end(day: Column) -> Column:
    """The Sunday that closes the week of ``day``; a Sunday closes its own week."""
    return F.next_day(F.date_sub(day, 1), "SU")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")
