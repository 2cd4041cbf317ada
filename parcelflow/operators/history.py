"""Rebuilding each key's event history."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow.functions import owners
from parcelflow.operators.dedup import first_by


@dataclass(frozen=True)
class Branch:
    """A derived earlier event: its date, and its price or NULL."""

    date: Column
    price: Column


def synthetic_events(
    df: DataFrame, date: str, price: str, branches: Sequence[Branch], blank_columns: Sequence[str]
) -> DataFrame:
    """Add one derived row per branch to every actual row, leaving ``source_priority`` 0 for the first branch
    and the highest number for the actual row.

    A branch without a date adds nothing. ``blank_columns`` are missing on derived rows. The table is read
    once: the versions of a row are exploded from it.
    """
    top = len(branches)
    versions = [
        F.struct(F.lit(i).alias("priority"), b.date.alias("date"), b.price.cast("double").alias("price"))
        for i, b in enumerate(branches)
    ]
    derived = F.filter(F.array(*versions), lambda v: v["date"].isNotNull())
    actual = F.struct(F.lit(top).alias("priority"), F.col(date).alias("date"), F.col(price).cast("double").alias("price"))
    exploded = df.withColumn("_version", F.explode(F.concat(derived, F.array(actual))))
    is_actual = F.col("_version.priority") == top
    chosen = []
    for c in df.columns:
        if c == date:
            chosen.append(F.col("_version.date").alias(c))
        elif c == price:
            chosen.append(F.col("_version.price").alias(c))
        elif c in blank_columns:
            chosen.append(F.when(is_actual, F.col(c)).alias(c))
        else:
            chosen.append(F.col(c))
    return exploded.select(*chosen, F.col("_version.priority").alias("source_priority"))


def synthetic_history(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    price: str,
    branches: Sequence[Branch],
    blank_columns: Sequence[str],
    tiebreak: Sequence[str] = (),
    unit: str = "year",
) -> DataFrame:
    """Actual and derived rows, one per key and period.

    An actual row beats any branch and a later branch beats an earlier one; among equals the row derived from
    the latest actual event stays.
    """
    origin = "_origin"
    stacked = synthetic_events(df.withColumn(origin, F.col(date)), date, price, branches, blank_columns)
    order = [F.desc_nulls_last(c) for c in ("source_priority", origin, *tiebreak)]
    return first_by(stacked, [*keys, F.trunc(date, unit)], order).drop(origin)


def history_is_sane(price: str, date: str, year_built: str, address: str, value: str, rounded_value: str) -> Column:
    """Rows that may take part in a chain."""
    return (
        (F.col(price).isNull() | (F.col(price) > 0))
        & F.col(date).isNotNull()
        & (F.year(date) >= F.col(year_built))
        & F.col(address).isNotNull()
        & (F.col(value) > 0)
        & (F.col(rounded_value) > 0)
    )


def all_positive(columns: Sequence[str]) -> Column:
    """Every listed column is known and positive."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.coalesce(F.col(c) > 0, F.lit(False))
    return condition


def sale_chain(
    df: DataFrame, keys: Sequence[str], date: str, owner: str, price: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Link every event to its neighbours: owner and sale flags, and what came next.

    The input must hold one row per key and calendar period (see ``operators.dedup``), as a rebuilt history
    does. A key's group is then bounded by the calendar, whatever share of the raw rows the key had. Rows
    without a key have no neighbours and are dropped.
    """
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    w = W.partitionBy(*keys).orderBy(F.asc_nulls_last(date), *[F.asc_nulls_last(t) for t in tiebreak])
    linked = df.withColumns({"_prev_owner": F.lag(owner, 1).over(w), "_prev2_owner": F.lag(owner, 2).over(w)})
    flagged = linked.withColumns(
        {
            "business_owner": owners.is_business(owner),
            "same_owner": owners.same_owner(owner, "_prev_owner", "_prev2_owner"),
        }
    ).withColumn("good_sale", owners.good_sale("same_owner", price))
    following = {
        "next_business_owner": F.lead("business_owner", 1).over(w),
        "next_same_owner": F.lead("same_owner", 1).over(w),
        "next_good_sale": F.lead("good_sale", 1).over(w),
        "next_sale_date": F.lead(date, 1).over(w),
        "next_sale_price": F.lead(price, 1).over(w),
    }
    return flagged.withColumns(following).drop("_prev_owner", "_prev2_owner")


def with_sale_number(
    df: DataFrame, keys: Sequence[str], date: str, tiebreak: Sequence[str] = (), name: str = "total_sales"
) -> DataFrame:
    """Running number of the event within its key. Same input rule as ``sale_chain``."""
    w = W.partitionBy(*keys).orderBy(F.asc_nulls_last(date), *[F.asc_nulls_last(t) for t in tiebreak])
    return df.withColumn(name, F.row_number().over(w))
