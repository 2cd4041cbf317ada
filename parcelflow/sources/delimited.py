"""Delimited text files, with and without a header line."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.functions.dates import parse_date
from parcelflow.functions.numbers import to_number
from parcelflow.sources.missing import BLANKS, known_text


OPENED_AT_ONCE = 32  # headers that the driver reads at a time


def typed(c: Column, kind: str) -> Column:
    """Text as ``string``, ``double``, ``int``, ``long`` or ``date``; unreadable text is NULL."""
    if kind == "string":
        return known_text(c)
    if kind == "date":
        return parse_date(c)
    if kind == "long":  # a double would lose the last digits of a long number
        return F.coalesce(F.btrim(c, F.lit(BLANKS)).try_cast("long"), to_number(c).try_cast("long"))
    return to_number(c).try_cast(kind)


def with_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Only the listed columns, each in its type."""
    return df.select(*[typed(F.col(f"`{c}`"), kind).alias(c) for c, kind in types.items()])


def cut_columns(df: DataFrame, line: str, columns: Sequence[str], separator: str = ",") -> DataFrame:
    """Text columns of delimited lines that are already in a table."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    parsed = F.from_csv(F.col(line), schema, {"sep": separator, "quote": '"', "escape": '"'})
    return df.select(parsed.alias("_row")).select("_row.*")


def read_headerless(
    spark: SparkSession, paths: str | list[str], columns: Sequence[str], types: Mapping[str, str] | None = None
) -> DataFrame:
    """Files without a header: columns by position, text unless ``types`` says otherwise."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    rows = spark.read.options(header=False, quote='"', escape='"').schema(schema).csv(paths)
    return with_types(rows, {c: (types or {}).get(c, "string") for c in columns})


def _first_line(spark: SparkSession, path: str) -> str:
    """First line of a file, wherever Spark can read it."""
    jvm = spark._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark._jsc.hadoopConfiguration()).open(file)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        reader.close()


def read_with_header(
    spark: SparkSession, path: str, types: Mapping[str, str], name_filter: str = "*", separator: str = "\t"
) -> DataFrame:
    """All files below ``path`` whose name fits ``name_filter``, columns by header name.

    Files are grouped by their header line and stacked by name, so their columns may stand in any order; a column of
    ``types`` that a file lacks is missing there, and other columns are not parsed. Only names and headers of the files
    reach the driver, which opens many files at a time.
    """
    found = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=name_filter).load(path)
    by_header: dict[str, list[str]] = {}
    listed = sorted(row["path"] for row in found.select("path").collect())
    with ThreadPoolExecutor(max_workers=OPENED_AT_ONCE) as pool:
        for file, header in zip(listed, pool.map(lambda f: _first_line(spark, f), listed)):
            by_header.setdefault(header, []).append(file)
    if not by_header:
        return with_types(spark.createDataFrame([], ", ".join(f"`{c}` string" for c in types)), types)
    options = {"sep": separator, "header": True, "quote": '"', "escape": '"', "enforceSchema": True}
    frames = []
    for header, paths in by_header.items():
        names = next(csv.reader([header], delimiter=separator), [])
        schema = T.StructType([T.StructField(n.strip(), T.StringType()) for n in names])
        rows = spark.read.options(**options).schema(schema).csv(paths)
        frames.append(rows.select(*[F.col(f"`{c}`") for c in types if c in schema.names]))
    stacked = stack_formats(frames)
    lacking = {c: F.lit(None).cast("string") for c in types if c not in stacked.columns}
    return with_types(stacked.withColumns(lacking) if lacking else stacked, types)


def without_repeated_headers(df: DataFrame, column: str, word: str) -> DataFrame:
    """Drop header lines embedded in the data: rows whose ``column`` mentions ``word``; missing text is kept."""
    return df.where(~F.coalesce(F.contains(F.lower(column), F.lit(word.lower())), F.lit(False)))


def stack_formats(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of several formats; a column that a format lacks is missing there."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked
