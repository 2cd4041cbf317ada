"""Global row positions and exact quantiles without gathering a column in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow.checkpoints import checkpointed

_ROW, _SLICE, _BEFORE = "_row", "_slice", "_before"


def _numbered(df: DataFrame) -> DataFrame:
    """``df`` with the place of a row inside the whole table in ``_row`` and its partition in ``_slice``.

    Partitions may be cut differently when they are computed again, so they are fixed by a checkpoint before
    anything is counted on them.
    """
    return checkpointed(df.withColumn(_ROW, F.monotonically_increasing_id())).withColumn(_SLICE, F.shiftright(_ROW, 33))


def _sorted_slices(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` cut into sorted ranges of similar size."""
    return _numbered(df.repartitionByRange(*order).sortWithinPartitions(*order))


def _slice_offsets(numbered: DataFrame, group: Sequence[str], weight: Column) -> DataFrame:
    """Per group and slice: first place, weight inside and weight before it.

    A group covers neighbouring slices, so this has at most (slices + groups) rows.
    """
    sizes = numbered.groupBy(*group, _SLICE).agg(F.min(_ROW).alias("_first"), F.sum(weight).alias("_inside"))
    earlier = W.partitionBy(*group).orderBy(_SLICE).rowsBetween(W.unboundedPreceding, -1)
    return sizes.withColumn(_BEFORE, F.coalesce(F.sum("_inside").over(earlier), F.lit(0)))


def _placed(numbered: DataFrame, group: Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    offsets = _slice_offsets(numbered, group, F.lit(1)).select(*group, _SLICE, "_first", _BEFORE)
    placed = numbered.join(F.broadcast(offsets), [*group, _SLICE])
    place = F.col(_ROW) - F.col("_first") + F.col(_BEFORE)
    return placed.withColumn(name, place).select(*columns, name)


def with_position(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "position") -> DataFrame:
    """Add the 0-based place of each row among the rows of its group, sorted by ``order``.

    ``group`` and ``order`` together must identify a row. ``group`` must have few values (such as a column
    name) and may be empty; a group may have any number of rows.
    """
    return _placed(_sorted_slices(df, [*group, *order]), group, df.columns, name)


def with_row_place(df: DataFrame, name: str = "position") -> DataFrame:
    """Number all rows from 0, in the order in which they lie; nothing is shuffled."""
    return _placed(_numbered(df), [], df.columns, name)


def values_at(
    histogram: DataFrame, group: Sequence[str], value: str, count: str, targets: DataFrame, place: str
) -> DataFrame:
    """Value at a 0-based, possibly fractional place of each group's sorted rows, given as value counts.

    ``targets`` has one row per group with the wanted place; between two rows the value is interpolated.
    """
    numbered = _sorted_slices(histogram, [*group, value])
    offsets = _slice_offsets(numbered, group, F.col(count)).select(*group, _SLICE, "_inside", _BEFORE)
    low, high = F.floor(place).cast("long"), F.ceil(place).cast("long")
    offsets = offsets.join(F.broadcast(targets.select(*group, place)), list(group))

    def reaches(rank: Column) -> Column:
        return (rank >= F.col(_BEFORE)) & (rank < F.col(_BEFORE) + F.col("_inside"))

    # Only the slices that hold a wanted row are summed row by row.
    wanted = offsets.where(reaches(low) | reaches(high))
    rows = numbered.join(F.broadcast(wanted), [*group, _SLICE])
    running = W.partitionBy(*group, _SLICE).orderBy(_ROW).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("_end", F.col(_BEFORE) + F.sum(count).over(running))

    def value_at(rank: Column) -> Column:
        here = (rank < F.col("_end")) & (rank >= F.col("_end") - F.col(count))
        return F.max(F.when(here, F.col(value)))

    found = rows.groupBy(*group).agg(
        value_at(low).alias("_low"), value_at(high).alias("_high"), F.max(F.col(place) - F.floor(place)).alias("_part")
    )
    return found.select(*group, (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias(value))
