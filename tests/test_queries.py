"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import re

import pytest
from conftest import plan_of

import __spark_entry__ as driver
from check_queries import compare, database
from parcelflow.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
NAMES = [n for n in QUERIES if n in ORACLES]
# These train or collect a dictionary while they are built, and their plans are those of scoring.
TRAINED = {"train_classifier", "train_regressor", "train_search", "saved_model_scores", "evaluation_tables", "cascade_score", "perm_importance"}


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, connection, name):
    assert compare(spark, FOLDER, name, connection) == ""


@pytest.mark.parametrize("name", [n for n in NAMES if n not in TRAINED])
def test_plan_has_no_python_and_no_cross_join(spark, name):
    plan = plan_of(driver.queries()[name](spark, FOLDER)).split("Physical Plan")[1]
    for word in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF"):
        assert word not in plan


def test_all_queries_are_registered():
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    panel = driver.entry(spark)
    assert panel.columns[:3] == ["customer", "last_sale_date", "date"]
    assert panel.count() > 0


def test_chain_windows_share_one_shuffle(spark):
    """Neighbours, flags of neighbours and the running number: one exchange by parcel, after the reductions."""
    plan = plan_of(driver.queries()["parcel_history"](spark, FOLDER)).split("Physical Plan")[1]
    by_parcel = re.findall(r"Exchange hashpartitioning\(Parid#\d+, \d+\)", plan)
    assert len(by_parcel) == 1
    assert plan.count("row_number(), 1, Partial") == 4  # sales, history, assessor rows, valuations


def test_leak_guard_needs_no_join(spark):
    plan = plan_of(driver.queries()["leak_guard"](spark, FOLDER)).split("Physical Plan")[1]
    assert "Join" not in plan
    assert plan.count("Exchange") == 2  # last sale per year, then by customer


def test_panel_bounds_reach_the_sequence(spark):
    """Months outside of the bounds are not generated."""
    plan = plan_of(driver.queries()["train_split"](spark, FOLDER)).split("Physical Plan")[1]
    generate = next(line for line in plan.split("\n") if "Generate explode" in line)
    assert "1999-09-01" in generate and "2000-09-01" in generate and "add_months" in generate


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(driver.queries()["current_snapshot"](spark, FOLDER)).split("Physical Plan")[1]
    assert "LessThan(o_orderdate,2000-07-01" in plan
    plan = plan_of(driver.queries()["key_counts"](spark, FOLDER)).split("Physical Plan")[1]
    assert "ReadSchema: struct<l_suppkey:bigint>" in plan


def test_same_rows_after_reshuffling(spark, tmp_path):
    """Ties are settled by value, so the order of the input does not matter."""
    for table in ("orders", "lineitem", "part", "customer", "events"):
        rows = spark.read.parquet(f"{FOLDER}/{table}.parquet")
        rows.repartition(5).sortWithinPartitions(*reversed(rows.columns)).write.parquet(f"{tmp_path}/{table}.parquet")
    for name in ("owner_chain", "synthetic_history", "parcel_history", "month_panel", "event_backfill"):
        query = driver.queries()[name]
        there = {tuple(r) for r in query(spark, str(tmp_path)).collect()}
        assert there == {tuple(r) for r in query(spark, FOLDER).collect()}
