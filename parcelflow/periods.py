"""A table kept by period: a write replaces the periods it touches and leaves the files of all others alone.

Below the table's folder, ``data`` holds a folder for each write with one folder for each period in it, and
``manifests`` a small file for each version that names the folder of every period. A version comes into being by one
rename, so readers see all of a write or nothing, and a write that fails leaves the last version as it was. Folders that
no kept manifest names are removed after the next write.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.checkpoints import checkpointed
from parcelflow.operators.upsert import upsert
from parcelflow.stages import file_system, read_text, write_text

NO_PERIOD = "none"
_FOLDER = "in_period"
_PLAIN = re.compile(r"[\w.-]+")


@dataclass(frozen=True)
class Period:
    """Where the rows of a period lie below the table's folder, how many there are, and how many of them are open."""

    path: str
    rows: int
    open_rows: int


@dataclass(frozen=True)
class Manifest:
    version: int
    periods: dict[str, Period]


@dataclass(frozen=True)
class Merge:
    """Version that a merge made, and the rows of the touched periods by what happened to them."""

    version: int
    counts: dict[str, int]


@dataclass(frozen=True)
class PeriodTable:
    """``column`` says which period a row belongs to; its text may hold letters, digits, dots and dashes. ``is_open`` marks
    rows that later writes may still look for, so that periods without any need not be read.
    """

    root: str
    column: str
    is_open: Column | None = None
    keep: int = 2  # manifests whose folders stay, for readers of the version before

    def _name(self) -> Column:
        return F.coalesce(F.col(self.column).cast("string"), F.lit(NO_PERIOD))

    def _numbers(self, spark: SparkSession) -> list[int]:
        folder, files = file_system(spark, f"{self.root}/manifests")
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if re.fullmatch(r"\d+\.json", n))

    def manifest(self, spark: SparkSession, version: int | None = None) -> Manifest | None:
        """The newest version, or the one asked for."""
        numbers = self._numbers(spark)
        if not numbers:
            return None
        version = numbers[-1] if version is None else version
        text = read_text(spark, f"{self.root}/manifests/{version:09d}.json")
        return Manifest(version, {name: Period(**entry) for name, entry in json.loads(text).items()})

    def read(
        self, spark: SparkSession, periods: Iterable[str] | None = None, open_only: bool = False, version: int | None = None
    ) -> DataFrame | None:
        """Rows of the table, of some periods only, or of those that hold open rows; None if there are no such periods."""
        manifest = self.manifest(spark, version)
        if manifest is None:
            return None
        wanted = manifest.periods if periods is None else [p for p in periods if p in manifest.periods]
        paths = [manifest.periods[p].path for p in sorted(wanted) if manifest.periods[p].open_rows or not open_only]
        return spark.read.parquet(*[f"{self.root}/{path}" for path in paths]) if paths else None

    def merge(
        self, updates: DataFrame, keys: Sequence[str], update_columns: Sequence[str] | None = None
    ) -> Merge | None:
        """Upsert ``updates`` into the periods they belong to. ``keys`` include the period. None if nothing is there to do."""
        spark = updates.sparkSession
        updates = checkpointed(updates)
        touched = {r["name"]: r["n"] for r in updates.groupBy(self._name().alias("name")).agg(F.count("*").alias("n")).collect()}
        if not touched:
            return None
        for name in touched:
            if not _PLAIN.fullmatch(name):
                raise ValueError(f"a period cannot be a folder: {name}")
        base = self.manifest(spark) or Manifest(0, {})
        old = self.read(spark, touched, version=base.version or None)
        target = spark.createDataFrame([], updates.schema) if old is None else old
        written = self._written(upsert(target, updates, keys, update_columns), base.version + 1)
        before = sum(base.periods[n].rows for n in touched if n in base.periods)
        inserted = sum(p.rows for p in written.values()) - before
        updated = sum(touched.values()) - inserted
        self._commit(spark, Manifest(base.version + 1, {**base.periods, **written}))
        self._sweep(spark)
        return Merge(base.version + 1, {"inserted": inserted, "updated": updated, "kept": before - updated})

    def _written(self, rows: DataFrame, version: int) -> dict[str, Period]:
        spark, folder = rows.sparkSession, f"data/write-{version:09d}-{uuid.uuid4().hex}"
        named = rows.withColumn(_FOLDER, self._name())
        named.hint("rebalance", _FOLDER).write.partitionBy(_FOLDER).parquet(f"{self.root}/{folder}")
        schema = T.StructType([*rows.schema.fields, T.StructField(_FOLDER, T.StringType())])
        back = spark.read.schema(schema).parquet(f"{self.root}/{folder}")
        open_rows = F.count_if(F.lit(True) if self.is_open is None else self.is_open)
        counts = back.groupBy(_FOLDER).agg(F.count("*").alias("n"), open_rows.alias("open")).collect()  # one row a period
        return {r[_FOLDER]: Period(f"{folder}/{_FOLDER}={r[_FOLDER]}", r["n"], r["open"]) for r in counts}

    def _commit(self, spark: SparkSession, manifest: Manifest) -> None:
        final, files = file_system(spark, f"{self.root}/manifests/{manifest.version:09d}.json")
        draft, _ = file_system(spark, f"{self.root}/manifests/draft-{uuid.uuid4().hex}")
        write_text(spark, draft.toString(), json.dumps({n: asdict(p) for n, p in sorted(manifest.periods.items())}, indent=1))
        if files.exists(final) or not files.rename(draft, final):
            files.delete(draft, False)
            raise RuntimeError(f"version {manifest.version} of {self.root} was written by somebody else meanwhile")

    def _sweep(self, spark: SparkSession) -> None:
        """Remove old manifests and what none of the others names. Folders of writes to come have higher numbers."""
        numbers = self._numbers(spark)
        named = {p.path for n in numbers[-self.keep :] for p in self.manifest(spark, n).periods.values()}
        for number in numbers[: -self.keep]:
            path, files = file_system(spark, f"{self.root}/manifests/{number:09d}.json")
            files.delete(path, False)
        data, files = file_system(spark, f"{self.root}/data")
        for write in [s.getPath() for s in files.listStatus(data)]:
            if int(write.getName().split("-")[1]) > numbers[-1]:
                continue
            periods = [s.getPath() for s in files.listStatus(write) if s.isDirectory()]
            kept = [p for p in periods if f"data/{write.getName()}/{p.getName()}" in named]
            for path in [p for p in periods if p not in kept] if kept else [write]:
                files.delete(path, True)
