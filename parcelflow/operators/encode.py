"""Ordinal codes for categorical text, kept as a dictionary table ``(column, value, code)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.operators.joins import hot_keys, spread_join
from parcelflow.operators.positions import with_position

MISSING = "nan"  # fixed value: the text that stands for a missing category
BROADCAST_BYTES = 32 << 20  # a larger dictionary column is joined by shuffle


def _as_text(c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit(MISSING))


def fit_ordinal(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Code of a value: its place among the sorted distinct values of its column, missing included."""
    pairs = [F.struct(F.lit(c).alias("column"), _as_text(c).alias("value")) for c in columns]
    values = df.select(F.explode(F.array(*pairs)).alias("_pair")).select("_pair.*").distinct()
    placed = with_position(values, ["column"], ["value"], "code")
    return placed.select("column", "value", F.col("code").cast("int").alias("code"))


def dictionary_bytes(dictionary: DataFrame) -> dict[str, int]:
    """Approximate size per encoded column; one row per column reaches the driver."""
    size = F.sum(F.octet_length("value") + 32).alias("bytes")
    return {r["column"]: r["bytes"] for r in dictionary.groupBy("column").agg(size).collect()}


def _look_up(df: DataFrame, side: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """``df`` with the dictionary column joined on ``_key``; ``keys`` holds the keys of ``df`` before other look-ups."""
    if size <= BROADCAST_BYTES:
        return df.join(F.broadcast(side), "_key", "left")
    return spread_join(df, side, ["_key"], "left", hot=hot_keys(keys, ["_key"]))


def encode(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Replace the columns by their codes (or add ``column + suffix``). An unseen value is an error."""
    sizes, plain = dictionary_bytes(dictionary), df
    for c in columns:
        side = dictionary.where(F.col("column") == c).select(F.col("value").alias("_key"), F.col("code").alias("_code"))
        key = _as_text(c)
        found = _look_up(df.withColumn("_key", key), side, plain.select(key.alias("_key")), sizes.get(c, 0))
        unseen = F.raise_error(F.concat(F.lit(f"value not in the dictionary of {c}: "), F.col("_key")))
        code = F.coalesce(F.col("_code"), unseen.cast("int"))
        df = found.withColumn(c + suffix, code).drop("_key", "_code")
    return df


def decode(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Replace codes by their text; the code of a missing value becomes NULL."""
    sizes, plain = dictionary_bytes(dictionary), df
    for c in columns:
        side = dictionary.where(F.col("column") == c).select(F.col("code").alias("_key"), F.col("value").alias("_value"))
        key = F.col(c + suffix).cast("int")
        found = _look_up(df.withColumn("_key", key), side, plain.select(key.alias("_key")), sizes.get(c, 0))
        text = F.when(F.col("_value") != MISSING, F.col("_value"))
        df = found.withColumn(c + suffix, text).drop("_key", "_value")
    return df
