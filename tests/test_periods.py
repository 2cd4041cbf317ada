"""Tables kept by period: only touched periods are written."""

from __future__ import annotations

import datetime as dt
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from parcelflow.operators.upsert import upsert
from parcelflow.periods import NO_PERIOD, PeriodTable

D = dt.date
SCHEMA = "period date, id int, price double, note string"
KEYS = ["period", "id"]
JAN, FEB, MAR = D(2022, 1, 1), D(2022, 2, 1), D(2022, 3, 1)


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def files(root) -> dict[str, str]:
    """Digest of every data file."""
    return {str(p.relative_to(root)): hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(root).glob("data/*/*/*.parquet")}


def values(df):
    return sorted(map(tuple, df.select("period", "id", "price", "note").collect()), key=repr)


@pytest.fixture()
def table(spark, tmp_path):
    table = PeriodTable(str(tmp_path / "table"), "period", F.col("price").isNull())
    first = [(JAN, 1, 1.0, "a"), (JAN, 2, 2.0, None), (FEB, 1, None, "b"), (FEB, 2, 5.0, "c"), (None, 1, 3.0, "n")]
    assert table.merge(rows(spark, *first), KEYS).counts == {"inserted": 5, "updated": 0, "kept": 0}
    return table


def test_empty_table(spark, tmp_path):
    table = PeriodTable(str(tmp_path / "none"), "period")
    assert table.manifest(spark) is None and table.read(spark) is None
    assert table.merge(rows(spark, (JAN, 1, 1.0, "a")).where("false"), KEYS) is None
    assert not Path(table.root).exists()


def test_only_touched_periods_are_written(spark, table):
    before, old = files(table.root), table.manifest(spark)
    merge = table.merge(rows(spark, (FEB, 1, 9.0, None), (FEB, 7, 7.0, "new"), (MAR, 1, 4.0, "m")), KEYS)
    assert (merge.version, merge.counts) == (2, {"inserted": 2, "updated": 1, "kept": 1})
    new, now = table.manifest(spark), files(table.root)
    closed = {p for p in before if "2022-02-01" not in p}
    assert closed and {p: now[p] for p in closed} == {p: before[p] for p in closed}
    assert all(new.periods[p] == old.periods[p] for p in ("2022-01-01", NO_PERIOD))
    assert new.periods["2022-02-01"].path != old.periods["2022-02-01"].path
    assert values(table.read(spark)) == sorted(
        [(JAN, 1, 1.0, "a"), (JAN, 2, 2.0, None), (FEB, 1, 9.0, None), (FEB, 2, 5.0, "c"), (FEB, 7, 7.0, "new"), (MAR, 1, 4.0, "m"), (None, 1, 3.0, "n")], key=repr
    )
    assert values(table.read(spark, version=1)) == sorted(
        [(JAN, 1, 1.0, "a"), (JAN, 2, 2.0, None), (FEB, 1, None, "b"), (FEB, 2, 5.0, "c"), (None, 1, 3.0, "n")], key=repr
    )


def test_folders_that_no_manifest_names_are_removed(spark, table):
    for price in (1.0, 2.0, 3.0):
        table.merge(rows(spark, (FEB, 1, price, "x")), KEYS)
    manifests = sorted(p.name for p in Path(table.root, "manifests").glob("*.json"))
    assert manifests == ["000000003.json", "000000004.json"]
    named = {e.path for v in (3, 4) for e in table.manifest(spark, v).periods.values()}
    there = {str(p.relative_to(table.root)) for p in Path(table.root).glob("data/*/in_period=*")}
    assert there == named and len(there) == 4
    assert values(table.read(spark, ["2022-02-01"])) == [(FEB, 1, 3.0, "x"), (FEB, 2, 5.0, "c")]


def test_periods_without_open_rows_are_not_read(spark, table):
    assert [p.open_rows for _, p in sorted(table.manifest(spark).periods.items())] == [0, 1, 0]
    assert {r["period"] for r in table.read(spark, open_only=True).collect()} == {FEB}
    assert {Path(f).parent.name for f in table.read(spark, open_only=True).inputFiles()} == {"in_period=2022-02-01"}
    table.merge(rows(spark, (FEB, 1, 1.0, "b")), KEYS, ["price"])
    assert table.read(spark, open_only=True) is None


def test_missing_period_is_one_of_its_own(spark, table):
    assert table.merge(rows(spark, (None, 1, 8.0, "again"), (None, None, 9.0, "no id")), KEYS).counts == {"inserted": 1, "updated": 1, "kept": 0}
    assert values(table.read(spark, [NO_PERIOD])) == sorted([(None, 1, 8.0, "again"), (None, None, 9.0, "no id")], key=repr)


def test_same_rows_as_an_upsert_of_the_whole_table(spark, table):
    updates = rows(spark, *[(p, i, float(i), "u") for p in (JAN, MAR) for i in range(40)])
    whole = upsert(table.read(spark), updates, KEYS, ["price"])
    want = values(whole)
    table.merge(updates, KEYS, ["price"])
    assert values(table.read(spark)) == want
    again = table.merge(updates, KEYS, ["price"])
    assert again.counts == {"inserted": 0, "updated": 80, "kept": 0} and values(table.read(spark)) == want


def test_failed_write_leaves_the_last_version(spark, table):
    before = values(table.read(spark))
    with pytest.raises(Exception, match="more than one update"):
        table.merge(rows(spark, (JAN, 1, 1.0, "x"), (JAN, 1, 2.0, "y")), KEYS)
    assert table.manifest(spark).version == 1 and values(table.read(spark)) == before
    table.merge(rows(spark, (JAN, 1, 1.0, "x")), KEYS)
    assert len(list(Path(table.root).glob("data/write-000000002-*"))) == 1


def test_two_writers_of_one_version(spark, table):
    stale = table.manifest(spark)
    table.merge(rows(spark, (MAR, 1, 1.0, "first")), KEYS)
    with pytest.raises(RuntimeError, match="somebody else"):
        table._commit(spark, type(stale)(2, stale.periods))
    assert values(table.read(spark, ["2022-03-01"])) == [(MAR, 1, 1.0, "first")]
    assert not list(Path(table.root, "manifests").glob("draft-*"))


def test_period_that_cannot_be_a_folder(spark, tmp_path):
    odd = PeriodTable(str(tmp_path / "odd"), "note")
    with pytest.raises(ValueError, match="cannot be a folder"):
        odd.merge(rows(spark, (JAN, 1, 1.0, "a/b")), ["note", "id"])
