"""Calendar arithmetic. No function reads the clock: pass ``as_of`` instead."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_number(d: Column | str) -> Column:
    """Months since year 0, so that a difference counts calendar months."""
    day = _col(d)
    return F.year(day) * 12 + F.month(day)


def months_between_months(start: Column | str, end: Column | str) -> Column:
    return month_number(end) - month_number(start)


def whole_years_between(start: Column | str, end: Column | str) -> Column:
    """Calendar-month difference in whole years; a negative difference is floored."""
    return F.floor(months_between_months(start, end) / 12).cast("int")


def capped(c: Column | str, cap: int) -> Column:
    """At most ``cap``; a missing value stays missing."""
    value = _col(c)
    return F.when(value.isNotNull(), F.least(value, F.lit(cap)))


def january_first(year: Column | str) -> Column:
    y = _col(year).cast("int")
    return F.when(y.between(1, 9999), F.make_date(y, F.lit(1), F.lit(1)))


def age_since_year(year: Column | str, as_of: Column, min_year: int = 1800) -> Column:
    y = _col(year).cast("int")
    return F.when(y >= min_year, whole_years_between(january_first(y), as_of))


def four_digit_year(year: Column | str) -> Column:
    y = _col(year).cast("int")
    return F.when(y.isin(98, 99), y + 1900).otherwise(y)


def date_from_parts(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """Date from three numbers; an impossible date is NULL."""
    parts = [_col(p).cast("int").cast("string") for p in (year, month, day)]
    return F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2]).try_cast("date")


def parse_date(c: Column | str, formats: Sequence[str] = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy")) -> Column:
    """First format that fits; text that fits none is NULL."""
    text = F.btrim(_col(c), F.lit(" \t\r\n"))
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def parse_day_month_year(c: Column | str, as_of: Column) -> Column:
    """``dd-Mon-yy`` text; a year after the ``as_of`` year belongs to the century before."""
    day = F.try_to_date(F.btrim(_col(c), F.lit(" \t\r\n")), "d-MMM-yy")
    return F.when(F.year(day) > F.year(as_of), F.add_months(day, -1200)).otherwise(day)


def sale_month(d: Column | str) -> Column:
    """First of the month; a sale on 29 February counts from 1 March."""
    day = _col(d)
    leap_day = (F.month(day) == 2) & (F.dayofmonth(day) == 29)
    return F.when(leap_day, F.date_add(day, 1)).otherwise(F.trunc(day, "MM")).cast("date")


def month_range(first: Column, last: Column) -> Column:
    """Inclusive monthly dates; empty instead of an error when ``first`` is after ``last``."""
    empty = F.array().cast("array<date>")
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month"))).otherwise(empty)


def month_sequence(start: Column | str, end: Column | str) -> Column:
    """Months from the sale month of ``start`` to the month of ``end``."""
    return month_range(sale_month(start), F.trunc(_col(end), "MM"))


def date_text(d: Column | str) -> Column:
    return F.date_format(_col(d), "yyyy-MM-dd")
