"""Fill open predictions with the first event that happened after they were made."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow.operators.dedup import first_per_key_date


def is_open(actual_columns: Sequence[str]) -> Column:
    """Whether the outcome is still unknown: every actual column is missing."""
    unknown = F.lit(True)
    for c in actual_columns:
        unknown = unknown & F.col(c).isNull()
    return unknown


def open_rows(predictions: DataFrame, actual_columns: Sequence[str]) -> DataFrame:
    return predictions.where(is_open(actual_columns))


def first_event_from(
    starts: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    start: str,
    date: str,
    columns: Sequence[str],
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """For every distinct key and start date, the first event of the key on or after it, if there is one.

    Starts and events are first reduced to one row per key and day and then merged into one timeline per key,
    so no (start, event) pairs are built and a key's timeline is bounded by the calendar.
    """
    payload = F.struct(F.col(date).alias("_event_date"), *columns)
    daily = first_per_key_date(events.where(F.col(date).isNotNull()), keys, date, tiebreak)
    event_side = daily.select(*keys, F.col(date).alias("_day"), F.lit(1).alias("_is_event"), payload.alias("_event"))
    start_side = (
        starts.select(*keys, F.col(start).alias("_day"))
        .distinct()
        .select(*keys, "_day", F.lit(0).alias("_is_event"), F.lit(None).alias("_event"))
    )
    timeline = event_side.unionByName(start_side)
    for key in keys:
        timeline = timeline.where(F.col(key).isNotNull())
    # Latest first, an event before a start of the same day: the last event seen is the next one in time.
    backwards = W.partitionBy(*keys).orderBy(F.desc("_day"), F.desc("_is_event"))
    upcoming = F.last("_event", ignorenulls=True).over(backwards.rowsBetween(W.unboundedPreceding, W.currentRow))
    found = timeline.withColumn("_event", upcoming).where((F.col("_is_event") == 0) & F.col("_event").isNotNull())
    return found.select(*keys, F.col("_day").alias(start), "_event")


def backfill_actuals(
    predictions: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    start: str,
    date: str,
    price: str,
    updates: Mapping[str, str],
    open_columns: Sequence[str],
    tiebreak: Sequence[str] = (),
    stamp: tuple[str, Column] | None = None,
) -> DataFrame:
    """Predictions with nothing in ``open_columns`` that now have an outcome.

    ``updates`` maps each column to set to the event column it comes from; ``stamp`` names one more column and
    its value. Events without a date or a price are no outcome.
    """
    pending = open_rows(predictions, open_columns)
    known = events.where(F.col(date).isNotNull() & F.col(price).isNotNull())
    columns = [c for c in dict.fromkeys(updates.values()) if c != date]
    found = first_event_from(pending, known, keys, start, date, columns, tiebreak)
    matched = pending.join(found, [*keys, start], "inner")
    changes = {
        target: F.col("_event._event_date" if source == date else f"_event.{source}")
        for target, source in updates.items()
    }
    if stamp is not None:
        changes[stamp[0]] = stamp[1]
    return matched.withColumns(changes).select(*predictions.columns)
