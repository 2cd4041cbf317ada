"""Scoring: the price model only sees what the sale model lets through."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.numbers import price_interval, round_ten_thousands
from parcelflow.ml.train import MISSING_VALUE, bin_name

SCORE = "pred_sale_in_3_months"
PRICE = "pred_next_sale_price"
THRESHOLD = 0.7
INTERVAL = 0.125

_MODEL_COLUMNS = ("features", "rawPrediction", "probability", "prediction")


def _transform(df: DataFrame, model, features: Sequence[str]) -> DataFrame:
    """Model output next to the untouched columns of ``df``."""
    originals = {c: f"_original_{c}" for c in features}
    prepared = df.withColumns({kept: F.col(c) for c, kept in originals.items()})
    prepared = prepared.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(MISSING_VALUE)) for c in features})
    scored = model.transform(prepared)
    return scored.withColumns({c: F.col(kept) for c, kept in originals.items()}).drop(*originals.values(), *map(bin_name, features))


def score_sales(df: DataFrame, classifier, features: Sequence[str], name: str = SCORE) -> DataFrame:
    """Probability of a sale."""
    scored = _transform(df, classifier, features)
    return scored.withColumn(name, vector_to_array("probability")[1]).drop(*_MODEL_COLUMNS)


def score_prices(
    df: DataFrame, regressor, features: Sequence[str], interval: float = INTERVAL, name: str = PRICE
) -> DataFrame:
    """Price rounded to ten thousands, with its interval."""
    scored = _transform(df, regressor, features)
    priced = scored.withColumn(name, round_ten_thousands("prediction")).drop(*_MODEL_COLUMNS)
    lower, upper = price_interval(name, interval)
    return priced.withColumns({f"{name}_lower": lower, f"{name}_upper": upper})


def likely(scored: DataFrame, threshold: float = THRESHOLD, name: str = SCORE) -> DataFrame:
    return scored.where(F.col(name) > threshold)


def cascade_score(
    df: DataFrame,
    classifier,
    regressor,
    sale_features: Sequence[str],
    price_features: Sequence[str],
    threshold: float = THRESHOLD,
    interval: float = INTERVAL,
) -> DataFrame:
    kept = likely(score_sales(df, classifier, sale_features), threshold)
    return score_prices(kept, regressor, price_features, interval)
