"""A look into panels and models: profiles, correlations with the label, feature importance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parcelflow.ml.importance import permutation_importance
from parcelflow.operators.aggregates import correlate, profile_dates, profile_numeric, profile_text
from parcelflow.operators.splits import LABEL
from parcelflow.plans.forecast import SALE_FEATURES, coded, encoded_categories


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def date_columns(df: DataFrame) -> list[str]:
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def describe(df: DataFrame) -> dict[str, DataFrame]:
    """Profiles of all numeric, text and date columns, for each kind that the table has."""
    kinds = {
        "numeric": (profile_numeric, numeric_columns(df)),
        "text": (profile_text, text_columns(df)),
        "dates": (profile_dates, date_columns(df)),
    }
    return {name: profile(df, columns) for name, (profile, columns) in kinds.items() if columns}


def label_correlations(panel: DataFrame, label: str = LABEL, min_abs: float = 0.005) -> DataFrame:
    """Correlation rows of the numeric columns that go along with the label."""
    return correlate(panel, numeric_columns(panel), label, min_abs)


def sale_importance(
    test: DataFrame, dictionary: DataFrame, model, features: Sequence[str] = tuple(coded(SALE_FEATURES)), seed: int = 42
) -> DataFrame:
    """Features of the sale model by the accuracy that is lost when they are permuted."""
    return permutation_importance(model, encoded_categories(test, dictionary), features, LABEL, seed=seed)
