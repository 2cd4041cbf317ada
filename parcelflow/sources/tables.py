"""Relational tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    split: tuple[str, object, object, int] | None = None,
) -> DataFrame:
    """A table over JDBC; filters applied to it are run by the database.

    ``split`` is (column, lower, upper, parts): the read is divided into that many ranges of a numeric or
    date column, so that no single task reads the whole table.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(options or {}))
    if split is not None:
        column, lower, upper, parts = split
        reader = reader.options(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=parts
        )
    return reader.load()
