"""One row per key.

Every operator ranks rows and keeps rank 1. Spark cuts each map task down to one row per key before the
shuffle (a partial group limit), so a key that holds a third of the table sends at most one row per map
task, and no key's rows are ever gathered in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_RANK = "_rank"


def first_by(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under ``order``, which must leave no ties."""
    ranked = df.withColumn(_RANK, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(df: DataFrame, keys: Sequence[str], date: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Row with the latest known date per key; a known date beats a missing one."""
    order = [F.desc_nulls_last(date), *[F.desc_nulls_last(t) for t in tiebreak]]
    return first_by(df, keys, order)


def first_per_key_date(df: DataFrame, keys: Sequence[str], date: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """First row per key and day."""
    return first_by(df, [*keys, date], [F.asc_nulls_last(t) for t in (tiebreak or [date])])


def last_per_period(
    df: DataFrame, keys: Sequence[str], date: str, unit: str = "year", tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Last row per key and calendar period."""
    order = [F.desc_nulls_last(c) for c in (date, *tiebreak)]
    return first_by(df, [*keys, F.trunc(date, unit)], order)
