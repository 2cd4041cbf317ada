"""Numeric cleaning and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text to double; anything unreadable, blank or NaN becomes NULL.

    Spark's cast also takes a trailing type letter ("1d") and hexadecimal ("0x1p3"). Those are no numbers in
    a landed file.
    """
    text = F.btrim(_col(c).cast("string"), F.lit(" \t\r\n"))
    value = text.try_cast("double")
    lowered = F.lower(text)
    typed = F.right(lowered, F.lit(1)).isin("d", "f") & ~F.endswith(lowered, F.lit("inf"))
    plain = value.isNotNull() & ~F.isnan(value) & ~typed & ~F.contains(lowered, F.lit("x"))
    return F.when(plain, value)


def nan_to_null(c: Column | str) -> Column:
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def round_base(c: Column | str, base: int) -> Column:
    """Nearest multiple of ``base``, halves to the even multiple."""
    return F.bround(_col(c) / F.lit(base)) * F.lit(base)


def round_ten_thousands(c: Column | str) -> Column:
    return F.bround(_col(c), -4)


def positive_or_null(c: Column | str) -> Column:
    value = nan_to_null(c)
    return F.when(value > 0, value)


def sum_parts(*parts: Column | str) -> Column:
    """Sum that is missing as soon as one part is missing."""
    total = _col(parts[0])
    for part in parts[1:]:
        total = total + _col(part)
    return total


def sale_type_code(c: Column | str) -> Column:
    value = _col(c)
    return F.when(value.isNull(), F.lit("0")).when(value == "I", F.lit("1")).otherwise(value)


def price_interval(price: Column | str, width: float = 0.125) -> tuple[Column, Column]:
    """Lower and upper bound around an already rounded prediction, rounded again."""
    value = _col(price)
    margin = value * F.lit(width)
    return round_ten_thousands(value - margin), round_ten_thousands(value + margin)
