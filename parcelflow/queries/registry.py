"""Registration of queries and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_DATES = {"orders": ("o_orderdate",), "lineitem": ("l_shipdate",)}


class Tables:
    """Tables of one scale-factor folder as attributes, dates as dates."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return df.withColumns({c: F.to_date(c) for c in _DATES[name]}) if name in _DATES else df


def iso_dates(df: DataFrame) -> DataFrame:
    """Dates as ISO text, which reads the same in every engine."""
    dated = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in dated}) if dated else df


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name``, with the SQL that gives the same rows."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: iso_dates(build(Tables(spark, folder)))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
