"""One key holding a third of the rows: results stay whole and no task gets the key alone."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from parcelflow.operators import backfill, dedup, joins
from parcelflow.operators.positions import with_position
from parcelflow.operators.spread import ROWS_PER_TASK
from parcelflow.queries import QUERIES, formats

ROWS = 30_000


@pytest.fixture()
def hot(spark):
    """A third of the rows on key 0, the rest on 1..2000, in 8 input partitions."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2000 + 1)
    return spark.range(0, ROWS, 1, 8).select(key.cast("long").alias("k"), F.col("id").alias("v"))


@pytest.fixture()
def sides(spark):
    return spark.range(0, 1500).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))


@pytest.fixture()
def no_adaptive(spark):
    """Keep every shuffle partition as hashed, so that its size can be seen."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": "64"}
    old = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


def largest_share(df) -> float:
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def content(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(hot, sides, how):
    missing_key = hot.withColumn("k", F.when(F.col("v") % 50 != 0, F.col("k")))
    plain = missing_key.join(sides, "k", how)
    spread = joins.spread_join(missing_key, sides, ["k"], how, rows_per_task=1000)
    assert spread.columns == plain.columns
    assert content(spread) == content(plain)


def test_spread_join_divides_the_hot_key(no_adaptive, hot, sides):
    plain = hot.join(sides, "k", "left")
    spread = joins.spread_join(hot, sides, ["k"], "left", rows_per_task=1000)
    assert largest_share(plain) > 0.33
    assert largest_share(spread) < 0.12


def test_hot_copies_are_divided_too(no_adaptive, spark, sides):
    copies = spark.range(0, ROWS, 1, 8).select(F.lit(5).cast("long").alias("k"), F.lit("same").alias("v"))
    spread = joins.spread_join(copies, sides, ["k"], "inner", rows_per_task=1000)
    assert spread.count() == ROWS
    assert largest_share(spread) < 0.5


def test_rows_without_a_key_are_divided(no_adaptive, spark, sides):
    keyless = spark.range(0, ROWS, 1, 8).select(F.when(F.col("id") % 2 == 0, F.col("id") % 900).alias("k"), "id")
    plain = keyless.join(sides, "k", "left")
    spread = joins.spread_join(keyless, sides, ["k"], "left")
    assert largest_share(plain) > 0.5
    assert largest_share(spread) < 0.2
    assert content(spread) == content(plain)


def test_members_and_counts_with_a_hot_key(hot, sides):
    options = {"rows_per_task": 1000}
    doubled = sides.select("k").unionAll(sides.select("k"))  # repeated members do not repeat rows
    kept, left = joins.members(hot, doubled, ["k"], **options), joins.non_members(hot, doubled, ["k"], **options)
    assert kept.count() + left.count() == ROWS
    assert left.where("k < 1500").count() == 0
    counted = joins.with_key_count(hot, ["k"], **options)
    assert counted.where("k = 0").agg(F.min("total_sales"), F.count("*")).first() == (ROWS // 3, ROWS // 3)


def test_hot_key_list_is_bounded(hot):
    assert [tuple(r) for r in joins.hot_keys(hot, ["k"], 1000).collect()] == [(0, ROWS // 3)]


def test_input_that_lies_by_the_hot_key_is_divided(no_adaptive, hot, sides):
    """All rows of the hot key in one input partition: no task gets more than twice its fair share of them."""
    together = hot.repartition(8, "k")
    joined = joins.spread_join(together, sides, ["k"], "left", rows_per_task=ROWS // 3 // 32).where("k = 0")
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == ROWS // 3 and max(sizes) < 0.2 * sum(sizes)  # 32 shares hashed to 64 tasks


def test_shares_follow_the_rows_of_a_key(no_adaptive, spark):
    """A key four times as large gets four times the shares, and so lands in more tasks."""
    key = F.when(F.col("id") < 16_000, 1).when(F.col("id") < 20_000, 2).otherwise(F.col("id"))
    rows = spark.range(0, 21_000, 1, 4).select(key.cast("long").alias("k"), "id")
    names = spark.range(0, 30_000).select(F.col("id").alias("k"), (F.col("id") + 1).alias("w"))
    joined = joins.spread_join(rows, names, ["k"], "inner", rows_per_task=1000).where("k < 3")
    tasks = joined.groupBy("k", F.spark_partition_id().alias("task")).count()
    tasks = {r["k"]: r["count"] for r in tasks.groupBy("k").count().collect()}
    assert 2 <= tasks[2] <= 4 and 10 <= tasks[1] <= 16


def test_top_one_is_cut_before_the_shuffle(hot):
    dated = hot.withColumn("d", F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("v") % 900).cast("int")))
    for picked in (
        dedup.latest_per_key(dated, ["k"], "d", ["v"]),
        dedup.last_per_period(dated, ["k"], "d", "year", ["v"]),
        dedup.first_per_key_date(dated, ["k"], "d", ["v"]),
    ):
        plan = plan_of(picked).split("Physical Plan")[1]
        exchange, partial = plan.index("Exchange hashpartitioning"), plan.index("row_number(), 1, Partial")
        assert exchange < partial  # the plan prints the last step first
    latest = dedup.latest_per_key(dated, ["k"], "d", ["v"]).where("k = 0").first()
    best = dated.where("k = 0").orderBy(F.desc("d"), F.desc("v")).first()
    assert latest["v"] == best["v"]


def test_position_of_one_large_group(no_adaptive, hot):
    placed = with_position(hot.withColumn("g", F.lit(0)), ["g"], ["k", "v"], "place")
    assert largest_share(placed) < 0.1
    assert placed.agg(F.countDistinct("place"), F.min("place"), F.max("place")).first() == (ROWS, 0, ROWS - 1)
    in_order = [(r["k"], r["v"]) for r in placed.orderBy("place").collect()]
    assert in_order == sorted(in_order)


def test_backfill_of_a_hot_key_builds_no_pairs(spark):
    day = dt.date(2000, 1, 1)
    starts = spark.range(3000).select(
        F.lit("hot").alias("k"), F.col("id"), F.date_add(F.lit(day), (F.col("id") % 700).cast("int")).alias("start"),
        F.lit(None).cast("date").alias("actual"), F.lit(None).cast("double").alias("price"),
    )
    events = spark.range(3000).select(
        F.lit("hot").alias("k"), F.date_add(F.lit(day), (F.col("id") * 7 % 650).cast("int")).alias("d"),
        (F.col("id") * 1.0).alias("p"),
    )
    filled = backfill.backfill_actuals(
        starts, events, ["k"], "start", "d", "p", {"actual": "d", "price": "p"}, ["actual", "price"], ["p"]
    )
    first = {}
    for r in events.collect():
        first[r["d"]] = min(first.get(r["d"], float("inf")), r["p"])
    days = sorted(first)
    expected = {}
    for r in starts.collect():
        later = [d for d in days if d >= r["start"]]
        if later:
            expected[r["id"]] = (later[0], first[later[0]])
    assert {r["id"]: (r["actual"], r["price"]) for r in filled.collect()} == expected
    plan = plan_of(filled).split("Physical Plan")[1]
    assert ">= " not in plan.split("SortMergeJoin")[0]  # no range condition in a join
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_layout_lines_are_dealt_out_over_tasks(spark):
    """One read task of short rows, and adaptive execution that would merge by bytes, still give tasks of a bounded number of rows."""
    keys = spark.range(0, 2 * ROWS_PER_TASK + 1, 1, 1).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("c_custkey"))  # a third without a key
    lines = formats._lines(keys)
    sizes = [r["count"] for r in lines.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2 * ROWS_PER_TASK + 1 and len(sizes) == 3 and max(sizes) <= ROWS_PER_TASK
    few = spark.createDataFrame([(7,), (7,), (None,)], "c_custkey long")
    blocks = [hashlib.md5(f"7:{i}".encode()).hexdigest().translate(str.maketrans("abcdef", "123456")) for i in range(formats.BLOCKS)]
    assert sorted(r["line"] for r in formats._lines(few).collect()) == ["", "".join(blocks), "".join(blocks)]


def test_a_layout_query_does_not_read_and_cut_in_one_task(spark, tmp_path):
    spark.range(0, ROWS_PER_TASK + 1, 1, 1).withColumnRenamed("id", "c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    cut = QUERIES["layout_dwelling_clermont"](spark, str(tmp_path))
    sizes = [r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == ROWS_PER_TASK + 1 and len(sizes) == 2
