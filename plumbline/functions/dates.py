"""Calendar columns: fiscal period ends, month ends, trailing windows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from plumbline import rules


def days_inclusive(start: Column, end: Column) -> Column:
    return F.date_diff(end, start) + 1


def fiscal_month(fye: Column) -> Column:
    return F.substring(fye, 1, 2).cast("int")


def other_fiscal_month(fye: Column) -> Column:
    """The month half a year away from the fiscal year end month."""
    m = fiscal_month(fye)
    return F.when(m > 6, m - 6).otherwise(m + 6)


def clamped(year: Column, month: Column, day: Column) -> Column:
    last = F.last_day(F.make_date(year, month, F.lit(1)))
    return F.make_date(year, month, F.least(day, F.dayofmonth(last)))


def next_period_end(fye: Column, after: Column) -> Column:
    """Earliest fiscal year end or half-year end strictly after a date."""
    month, other = fiscal_month(fye), other_fiscal_month(fye)
    day = F.substring(fye, 4, 2).cast("int")
    ends = []
    for shift in (-1, 0, 1):
        year = F.year(after) + shift
        ends.append(clamped(year, month, day))
        half_year = F.when(month > 6, year).otherwise(year - 1)
        ends.append(F.last_day(F.make_date(half_year, other, F.lit(1))))
    return F.array_min(F.filter(F.array(*ends), lambda d: d > after))


def month_index(col: Column) -> Column:
    return F.year(col) * 12 + F.month(col)


def quarter_label_end(label: Column) -> Column:
    """'Q4 2025' -> 2025-12-31."""
    quarter = F.regexp_extract(label, r"^Q([1-4]) ", 1).cast("int")
    year = F.regexp_extract(label, r" (\d{4})$", 1).cast("int")
    return F.last_day(F.make_date(year, quarter * 3, F.lit(1)))


def annualize(growth: Column, days: Column) -> Column:
    return F.pow(growth, F.lit(rules.YEAR_DAYS) / days) - 1
