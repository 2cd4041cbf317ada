"""Local sessions for tests, checks and the bench. On a cluster, use the session you are given."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str | None = None, memory: str = "8g") -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("parcelflow")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
