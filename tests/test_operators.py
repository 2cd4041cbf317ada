"""Operators on small hand-made tables and their properties."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from parcelflow.calendars import run_calendar
from parcelflow.operators import aggregates, backfill, dedup, encode, enrich, history, joins, panel, positions
from parcelflow.operators import snapshot, splits, upsert

D = dt.date


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_latest_prefers_a_known_date(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", D(2020, 1, 1), 2), ("b", None, 3)], "k string, d date, v int")
    assert rows(dedup.latest_per_key(df, ["k"], "d"), "k", "v") == [("a", 2), ("b", 3)]


def test_one_row_per_period(spark):
    df = spark.createDataFrame(
        [("a", D(2020, 1, 1), 1), ("a", D(2020, 12, 31), 2), ("a", D(2021, 1, 1), 3), ("a", D(2020, 12, 31), 4)],
        "k string, d date, v int",
    )
    assert rows(dedup.last_per_period(df, ["k"], "d", "year", ["v"]), "v") == [(3,), (4,)]
    assert rows(dedup.first_per_key_date(df, ["k"], "d", ["v"]), "v") == [(1,), (2,), (3,)]


def test_synthetic_history_priority(spark):
    df = spark.createDataFrame(
        [("a", D(2005, 5, 1), 10.0, 2005, D(2005, 3, 1), 7.0, "x"), ("b", D(2010, 5, 1), 20.0, 2001, D(2004, 3, 1), -1.0, "y"),
         ("b", D(2011, 5, 1), 21.0, 2001, D(2004, 3, 1), -1.0, "z"), ("c", D(2011, 5, 1), 5.0, None, None, None, "w")],
        "k string, sold date, price double, built int, assessed date, amount double, owner string",
    )
    from parcelflow.functions.dates import january_first
    from parcelflow.functions.numbers import positive_or_null

    full = history.synthetic_history(
        df, ["k"], "sold", "price",
        [history.Branch(january_first("built"), F.lit(None)),
         history.Branch(F.col("assessed"), positive_or_null("amount"))],
        ["owner", "assessed", "amount"],
    )
    result = {(r["k"], r["sold"]): (r["price"], r["owner"], r["source_priority"]) for r in full.collect()}
    assert result == {
        ("a", D(2005, 5, 1)): (10.0, "x", 2),  # the actual sale beats both derived rows of its year
        ("b", D(2001, 1, 1)): (None, None, 0),
        ("b", D(2004, 3, 1)): (None, None, 1),  # a non-positive amount is no price
        ("b", D(2010, 5, 1)): (20.0, "y", 2),
        ("b", D(2011, 5, 1)): (21.0, "z", 2),
        ("c", D(2011, 5, 1)): (5.0, "w", 2),
    }


def test_sale_chain(spark):
    df = spark.createDataFrame(
        [("a", D(2000, 1, 1), "Al Fox", 10.0), ("a", D(2001, 1, 1), "Bo Lee LLC", None), ("a", D(2002, 1, 1), "Bo Lee", 30.0),
         ("b", D(2001, 1, 1), None, 5.0), (None, D(2001, 1, 1), "x", 5.0), (None, D(2002, 1, 1), "x", 5.0)],
        "k string, d date, owner string, price double",
    )
    linked = {(r["k"], r["d"].year): r for r in history.sale_chain(df, ["k"], "d", "owner", "price").collect()}
    assert set(linked) == {("a", 2000), ("a", 2001), ("a", 2002), ("b", 2001)}
    first, second, third = (linked["a", y] for y in (2000, 2001, 2002))
    assert (first["same_owner"], first["good_sale"], first["next_good_sale"]) == (0, 1, 1)
    assert (second["business_owner"], second["same_owner"], second["next_same_owner"]) == (1, 0, 1)
    assert (third["same_owner"], third["good_sale"], third["next_sale_date"]) == (1, 0, None)
    assert (first["next_sale_date"], second["next_sale_price"]) == (D(2001, 1, 1), 30.0)


def test_history_filters(spark):
    df = spark.createDataFrame(
        [(None, D(2000, 1, 1), 1999, "x", 1.0, 25000.0, 1.0), (0.0, D(2000, 1, 1), 1999, "x", 1.0, 25000.0, 1.0),
         (1.0, None, 1999, "x", 1.0, 25000.0, 1.0), (2.0, D(2000, 1, 1), 2001, "x", 1.0, 25000.0, 1.0),
         (3.0, D(2000, 1, 1), 1999, None, 1.0, 25000.0, 1.0), (4.0, D(2000, 1, 1), 1999, "x", 9.0, 0.0, 1.0),
         (5.0, D(2000, 1, 1), 2000, "x", 9.0, 25000.0, None), (6.0, D(2000, 1, 1), 2000, "x", 9.0, 25000.0, 2.0)],
        "p double, d date, y int, a string, v double, r double, baths double",
    )
    sane = df.where(history.history_is_sane("p", "d", "y", "a", "v", "r"))
    assert sorted(str(r["p"]) for r in sane.collect()) == ["5.0", "6.0", "None"]
    assert sorted(str(r["p"]) for r in sane.where(history.all_positive(["baths"])).collect()) == ["6.0", "None"]


def test_panel_labels(spark):
    df = spark.createDataFrame(
        [("a", D(2020, 1, 15), D(2020, 6, 3)), ("b", D(2020, 1, 15), None), ("c", D(2020, 2, 29), D(2020, 2, 29))],
        "k string, d date, n date",
    )
    months = panel.month_panel(df, "d", "n", D(2020, 4, 20))
    a = {r["date"].month: r for r in months.collect() if r["k"] == "a"}
    assert sorted(a) == [1, 2, 3, 4, 5]
    assert [a[m]["sale_in_3_months"] for m in range(1, 6)] == [0, 0, 1, 1, 1]
    assert [a[m]["sale_in_6_months"] for m in range(1, 6)] == [1] * 5
    b = [r for r in months.collect() if r["k"] == "b"]
    assert [r["date"].month for r in b] == [1, 2, 3]
    assert not any(r["sale_in_12_months"] for r in b)
    assert not [r for r in months.collect() if r["k"] == "c"]


def test_bounded_panel_is_the_filtered_panel(spark):
    sales = [(k, D(1990 + 3 * k, 1 + k, 1 + 3 * k), D(1996 + 3 * k, 12 - k, 5) if k % 2 else None) for k in range(9)]
    df = spark.createDataFrame(sales, "k int, d date, n date")
    start, end, as_of = D(1999, 4, 1), D(2012, 7, 31), D(2015, 2, 1)
    naive = panel.month_panel(df, "d", "n", as_of).where(
        (F.col("date") >= start) & (F.col("date") <= end) & F.col("tenure_years").between(2, 8)
    )
    bounded = panel.month_panel(df, "d", "n", as_of, start, end, 2, 8)
    columns = naive.columns
    assert bounded.count() == naive.count() > 0
    assert bounded.select(columns).exceptAll(naive).count() == 0


def test_panel_start_inside_a_month(spark):
    df = spark.createDataFrame([("a", D(2020, 1, 15), None)], "k string, d date, n date")
    months = panel.month_panel(df, "d", "n", D(2020, 6, 1), start=D(2020, 2, 2))
    assert rows(months, "date") == [(D(2020, 3, 1),), (D(2020, 4, 1),), (D(2020, 5, 1),)]


@pytest.mark.parametrize(
    "run, expected",
    [
        ("2022-03-01", ("2022-03-01", "2022-04-01", "2022-06-30", "2020-09-01", "2021-09-30")),
        ("2026-12-15", ("2026-12-01", "2027-01-01", "2027-03-31", "2025-06-01", "2026-06-30")),
    ],
)
def test_run_calendar(run, expected):
    c = run_calendar(run)
    dates = (c.test_date, c.prediction_start, c.prediction_end, c.train_start, c.train_end)
    assert tuple(str(d) for d in dates) == expected
    assert c.train_end < c.test_date


SALES = "Parid string, last_sale_date date, next_sale_date date, next_sale_price double, next_good_sale int, total_sales int"


def test_leak_guard(spark):
    calendar = run_calendar("2022-03-01", "2022-12-01")
    sales = spark.createDataFrame(
        [("leak", D(2010, 1, 1), D(2022, 5, 1), 9.0, 1, 1), ("open", D(2010, 1, 1), None, None, None, 1),
         ("sold", D(2009, 1, 1), D(2021, 9, 1), 7.0, 1, 1), ("bad", D(2009, 1, 1), D(2021, 9, 1), 7.0, 0, 1)],
        SALES,
    )
    # "leak" also sold once inside the training year, which must not show either
    sales = sales.unionByName(spark.createDataFrame([("leak", D(2000, 1, 1), D(2021, 8, 1), 8.0, 1, 1)], SALES))
    parts = splits.split_panel(sales, calendar, ["Parid"])
    assert rows(parts.test, "Parid", "sale_in_3_months") == [("leak", 1), ("open", 0)]
    train = parts.train
    assert {r["Parid"] for r in train.collect()} == {"leak", "open", "sold"}
    assert train.where("Parid = 'leak' and (sale_in_3_months = 1 or next_sale_price is not null)").count() == 0
    assert train.where("Parid = 'sold' and sale_in_3_months = 1").count() == 3
    assert {r["Parid"] for r in parts.train_price.collect()} == {"sold"}
    assert train.where("sale_in_3_months > sale_in_6_months or sale_in_6_months > sale_in_12_months").count() == 0
    kept = splits.modelling_rows(train, splits.LABEL, ["total_sales"], date="date")
    assert kept.count() == train.select(*splits.LABELS, "total_sales").distinct().count()


def test_encode_orders_text_and_decodes(spark):
    values = ["10", "9", "a", "b", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    dictionary = encode.fit_ordinal(df, ["c"])
    coded = encode.encode(df, dictionary, ["c"])
    assert rows(coded, "i", "c") == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4)]
    assert {(r["i"], r["c"]) for r in encode.decode(coded, dictionary, ["c"]).collect()} == set(enumerate(values))


def test_unseen_value_is_an_error(spark):
    known = spark.createDataFrame([("a",)], "c string")
    new = spark.createDataFrame([("z",)], "c string")
    with pytest.raises(Exception, match="not in the dictionary"):
        encode.encode(new, encode.fit_ordinal(known, ["c"]), ["c"]).collect()


def test_large_dictionary_uses_the_shuffled_join(spark, monkeypatch):
    df = spark.range(500).select(F.concat(F.lit("v"), (F.col("id") % 90).cast("string")).alias("c"), "id")
    dictionary = encode.fit_ordinal(df, ["c"])
    small = rows(encode.encode(df, dictionary, ["c"]), "id", "c")
    monkeypatch.setattr(encode, "BROADCAST_BYTES", 0)
    assert rows(encode.encode(df, dictionary, ["c"]), "id", "c") == small


def test_positions_and_quantiles(spark):
    df = spark.range(1000).select((F.col("id") % 2).cast("int").alias("g"), ((F.col("id") * 7919) % 1009).alias("v"))
    placed = positions.with_position(df, ["g"], ["v"])
    for group in (0, 1):
        values = [r["v"] for r in placed.where(f"g = {group}").orderBy("position").collect()]
        assert values == sorted(values) and len(values) == 500
        assert rows(placed.where(f"g = {group}"), "position") == [(i,) for i in range(500)]
    for size in (1, 2, 3, 5, 6, 102, 103):
        table = spark.range(size).select((F.col("id") * F.col("id")).cast("double").alias("v"))
        exact = table.selectExpr("percentile(v, 0.25) a", "percentile(v, 0.5) b", "percentile(v, 0.75) c").first()
        found = aggregates.profile_numeric(table, ["v"]).select("q25", "q50", "q75").first()
        assert tuple(found) == pytest.approx(tuple(exact))
    skewed = spark.range(3000).select(F.when(F.col("id") < 1200, 5.0).otherwise(F.col("id") * 1.5).alias("v"))
    profile = aggregates.profile_numeric(skewed, ["v"]).first()
    exact = skewed.selectExpr("percentile(v, 0.25) a", "percentile(v, 0.5) b", "percentile(v, 0.75) c").first()
    assert (profile["q25"], profile["q50"], profile["q75"]) == tuple(exact)


@pytest.mark.parametrize("at_once", [aggregates.SUMMED_AT_ONCE, 0])
def test_quartiles_of_many_values(spark, monkeypatch, at_once):
    monkeypatch.setattr(aggregates, "SUMMED_AT_ONCE", at_once)
    table = spark.range(40_000).select(
        ((F.col("id") * 7919) % 40_009 * 0.25).alias("even"), F.when(F.col("id") % 3 > 0, F.pow(F.col("id"), 2)).alias("gaps"),
        F.when(F.col("id") < 15_000, 7.0).otherwise(F.col("id") % 11 - 5).alias("ties"), F.lit(1).alias("one"), F.lit(None).cast("int").alias("none"),
    )
    columns = ["even", "gaps", "ties", "one", "none"]
    found = {r["column"]: r for r in aggregates.profile_numeric(table, columns).collect()}
    for c in columns:
        exact = table.selectExpr(f"count({c})", f"percentile({c}, 0.25)", f"percentile({c}, 0.5)", f"percentile({c}, 0.75)", f"min({c})", f"max({c})").first()
        assert tuple(found[c][n] for n in ("count", "q25", "q50", "q75", "min", "max")) == pytest.approx(tuple(exact))


def test_profile_reads_its_rows_twice(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)
    table = spark.range(1000, numPartitions=4).select("id")

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    aggregates.profile_numeric(table.mapInArrow(counted, "id long"), ["id"]).collect()
    assert reads.value == 2000


def test_profile_of_missing_and_text(spark):
    df = spark.createDataFrame([("x", None), ("y", None), ("x", None), (None, None)], "t string, n double")
    top = aggregates.profile_text(df, ["t"]).first()
    assert (top["count"], top["unique"], top["top"], top["freq"]) == (3, 2, "x", 2)
    empty = aggregates.profile_numeric(df, ["n"]).first()
    assert (empty["count"], empty["mean"], empty["q50"]) == (0, None, None)


def test_first_event_from(spark):
    predictions = spark.createDataFrame(
        [(1, "a", D(2020, 1, 2), None, None), (2, "a", D(2020, 1, 5), None, None), (3, "a", D(2020, 1, 2), D(2020, 1, 3), 1.0),
         (4, "b", D(2020, 1, 1), None, None), (5, "a", D(2020, 1, 3), None, None)],
        "id int, k string, start date, actual date, price double",
    )
    events = spark.createDataFrame(
        [("a", D(2020, 1, 1), 1.0), ("a", D(2020, 1, 3), 3.0), ("a", D(2020, 1, 4), None), ("c", D(2020, 1, 9), 9.0)],
        "k string, sold date, amount double",
    )
    filled = backfill.backfill_actuals(
        predictions, events, ["k"], "start", "sold", "amount", {"actual": "sold", "price": "amount"}, ["actual", "price"]
    )
    assert rows(filled, "id", "actual", "price") == [(1, D(2020, 1, 3), 3.0), (5, D(2020, 1, 3), 3.0)]


def test_upsert_keeps_nulls_and_is_idempotent(spark):
    target = spark.createDataFrame([("p", "x", 1, "old"), ("q", "x", 2, "old")], "parcel string, county string, v int, s string")
    updates = spark.createDataFrame([("p", "x", None, "new"), ("p", "y", 7, "new")], target.schema)
    result = upsert.upsert_with_action(target, updates, ["parcel", "county"])
    expected = {("p", "x", None, "new", "updated"), ("q", "x", 2, "old", "kept"), ("p", "y", 7, "new", "inserted")}
    assert {tuple(r) for r in result.collect()} == expected
    again = upsert.upsert(result.drop("action"), updates, ["parcel", "county"])
    assert {tuple(r) for r in again.collect()} == {e[:4] for e in expected}
    assert rows(upsert.action_counts(result), "action", "n") == [("inserted", 1), ("kept", 1), ("updated", 1)]
    partial = upsert.upsert(target, updates, ["parcel", "county"], ["v"])
    assert ("p", "x", None, "old") in {tuple(r) for r in partial.collect()}


def test_snapshot(spark):
    sales = spark.createDataFrame(
        [("a", D(2000, 1, 1), 1900, 1), ("a", D(2008, 6, 1), 1900, 2), ("a", D(2022, 4, 1), 1900, 3),
         ("b", D(2015, 1, 1), None, 4), ("c", D(1980, 1, 1), 1700, 5)],
        "Parid string, last_sale_date date, YearBuilt int, v int",
    )
    now = snapshot.current_snapshot(
        sales, ["Parid"], "last_sale_date", run_calendar("2022-03-15"), year_built="YearBuilt"
    )
    result = {r["Parid"]: (r["v"], r["total_sales"], r["tenure_years"], r["tenure_capped"], r["age_years"], r["month"]) for r in now.collect()}
    assert result == {"a": (2, 2, 13, 13, 122, 3), "c": (5, 1, 42, 25, None, 3)}


def test_attach_by_normalized_id(spark):
    sales = spark.createDataFrame([("1-2.3", 1), ("124", 2), (None, 3)], "Parid string, v int")
    sides = spark.createDataFrame([("12-3", 1, "old"), ("1.23", 2, "new"), (None, 3, "none")], "raw string, day int, a string")
    joined = enrich.attach_by_normalized_id(sales, sides, "Parid", "raw", ["day"])
    assert {(r["Parid"], r["v"], r["a"]) for r in joined.collect()} == {("1-2.3", 1, "new"), ("124", 2, None), (None, 3, None)}


def test_key_counts_drop_missing_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    assert rows(joins.with_key_count(df, ["k"]), "v", "total_sales") == [(1, 2), (2, 2)]
    assert rows(joins.with_key_count_window(df, ["k"]), "v", "total_sales") == [(1, 2), (2, 2)]


def test_positive_turns_the_outer_join_into_an_inner_one(spark, tmp_path):
    spark.range(5).withColumn("price", F.col("id") * 1.0).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    joined = joins.positive(joins.join_with_suffixes(table, table, ["id"], ("_a", "_b")), "price_b")
    assert joined.columns == ["id", "price_a", "price_b"]
    optimized = plan_of(joined).split("Optimized Logical Plan")[1]
    assert "Join Inner" in optimized and "LeftOuter" not in optimized
