"""Stage tables: written once per run, reused when complete."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def file_system(spark: SparkSession, path: str):
    """A path and the file system it lies in."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str:
    """Content of one small file."""
    file, files = file_system(spark, path)
    stream = files.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    file, files = file_system(spark, path)
    stream = files.create(file, overwrite)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has finished: the committer leaves ``_SUCCESS`` last."""
    marker, files = file_system(spark, f"{path}/_SUCCESS")
    return files.exists(marker)


def write_stage(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def stage(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stage at ``path``, built and written first unless a finished one is there."""
    if not is_complete(spark, path):
        write_stage(build(), path)
    return spark.read.parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line, missing values included."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)

