"""Attach the latest attributes of a key to its events, and round them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.numbers import nan_to_null, positive_or_null, round_base
from parcelflow.functions.text import normalize_id
from parcelflow.operators.dedup import first_by

MATCH = "_match"


def assessor_with_valuation(assessor: DataFrame, valuations: DataFrame) -> DataFrame:
    """Latest assessor rows with their latest valuation, without rows whose sale predates the building."""
    joined = assessor.join(valuations.drop("LastUpdateDate"), "source_id", "left")
    cleaned = joined.withColumn("AssessorLastSaleAmount", positive_or_null("AssessorLastSaleAmount"))
    return cleaned.where(sale_after_building("AssessorLastSaleDate", "YearBuilt"))


def sale_after_building(date: str, year_built: str):
    known = F.col(date).isNotNull() & F.col(year_built).isNotNull()
    return known & (F.year(date) >= F.col(year_built))


def attach_by_normalized_id(
    events: DataFrame, attributes: DataFrame, event_id: str, attribute_id: str, order: Sequence[str]
) -> DataFrame:
    """Left join on the identifier without punctuation.

    Several attribute rows may share an identifier. The history keeps one event per key and year, so only one
    of them could stay in the end: the last under ``order`` is taken before the join, which then cannot
    multiply rows. ``events`` must hold one row per key and period.
    """
    side = attributes.withColumn(MATCH, normalize_id(attribute_id)).drop(attribute_id)
    side = first_by(side.where(F.col(MATCH).isNotNull()), [MATCH], [F.desc_nulls_last(c) for c in order])
    keyed = events.withColumn(MATCH, normalize_id(event_id))
    joined = keyed.join(side, MATCH, "left")
    return joined.withColumn(event_id, F.coalesce(F.col(event_id), F.col(MATCH))).drop(MATCH)


def round_columns(df: DataFrame, bases: Mapping[str, int], suffix: str = "Rounded") -> DataFrame:
    """Add each column rounded to a multiple of its base, in one projection."""
    return df.withColumns({c + suffix: round_base(nan_to_null(F.col(c).cast("double")), b) for c, b in bases.items()})
