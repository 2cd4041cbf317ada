"""Metrics against their definitions, folds, permutation and scoring."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from parcelflow.ml import importance, metrics, score, train


@pytest.fixture(scope="module")
def outcomes():
    random.seed(3)
    return [(random.random() < 0.3, random.random() < 0.4) for _ in range(400)]


def average_precision(pairs) -> float:
    """Sum of precision over recall steps, thresholds from high to low, for 0/1 scores."""
    positives = sum(a for a, _ in pairs)
    total, previous = 0.0, 0.0
    for cut in (1, 0):
        chosen = [a for a, p in pairs if p >= cut]
        recall = sum(chosen) / positives
        total += (recall - previous) * (sum(chosen) / len(chosen) if chosen else 0.0)
        previous = recall
    return total


def roc_area(pairs) -> float:
    """Share of (positive, negative) pairs in the right order, ties counted half."""
    ups, downs = [p for a, p in pairs if a], [p for a, p in pairs if not a]
    return sum((u > d) + 0.5 * (u == d) for u in ups for d in downs) / (len(ups) * len(downs))


def table(spark, pairs):
    return spark.createDataFrame([(int(a), int(p)) for a, p in pairs], "actual int, predicted int")


def test_hard_metrics_match_their_definitions(spark, outcomes):
    found = metrics.classification_metrics(table(spark, outcomes), "actual", "predicted").first()
    assert found["average_precision_hard"] == pytest.approx(average_precision(outcomes))
    assert found["roc_auc_hard"] == pytest.approx(roc_area(outcomes))
    tp, fp, fn = found["tp"], found["fp"], found["fn"]
    assert found["precision"] == pytest.approx(tp / (tp + fp))
    assert found["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn))


def test_nothing_predicted(spark, outcomes):
    silent = [(a, False) for a, _ in outcomes]
    found = metrics.classification_metrics(table(spark, silent), "actual", "predicted").first()
    prevalence = sum(a for a, _ in outcomes) / len(outcomes)
    assert (found["precision"], found["f1"]) == (0.0, 0.0)
    assert found["average_precision_hard"] == pytest.approx(prevalence)


def test_report_and_crosstab(spark, outcomes):
    df = table(spark, outcomes)
    report = {r["label"]: r for r in metrics.class_report(df, "actual", "predicted").collect()}
    assert set(report) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    right = sum(a == p for a, p in outcomes) / len(outcomes)
    assert report["accuracy"]["f1"] == report["weighted avg"]["recall"] == pytest.approx(right)
    assert report["macro avg"]["precision"] == pytest.approx((report["0"]["precision"] + report["1"]["precision"]) / 2)
    cells = {(r["actual"], r["predicted"]): r["n"] for r in metrics.crosstab(df, "actual", "predicted").collect()}
    assert cells["All", "All"] == 400 and cells["1", "All"] == cells["1", "0"] + cells["1", "1"]


def test_thresholds_are_strict(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "actual int, score double")
    swept = {r["threshold"]: r for r in metrics.threshold_sweep(df, "actual", "score").collect()}
    assert (swept[0.5]["predicted"], swept[0.4]["predicted"], swept[0.9]["predicted"]) == (1, 3, 0)
    counted = {r["threshold"]: r["predicted"] for r in metrics.threshold_counts(df, "score").collect()}
    assert counted == {t: r["predicted"] for t, r in swept.items()}


def test_regression_metrics(spark):
    pairs = [(3.0, 2.5), (-0.5, 0.0), (2.0, 2.0), (7.0, 8.0), (None, 1.0)]
    found = metrics.regression_metrics(spark.createDataFrame(pairs, "y double, p double"), "y", "p").first()
    assert (found["n"], found["mae"]) == (4, pytest.approx(0.5))
    assert found["r2"] == pytest.approx(0.9486081370449679)
    assert found["mape"] == pytest.approx((0.5 / 3 + 1.0 + 0.0 + 1.0 / 7) / 4)


def test_folds_are_equal_blocks_in_date_order(spark):
    day = F.date_add(F.lit(dt.date(2020, 1, 1)), (F.sqrt(F.col("id")) / 4).cast("int"))
    folded = train.with_fold(spark.range(3000).select("id", day.alias("d")), "d", 5)
    blocks = folded.groupBy("fold").agg(F.count("*").alias("n"), F.min("d").alias("a"), F.max("d").alias("z"))
    blocks = blocks.orderBy("fold").collect()
    assert [b["fold"] for b in blocks] == list(range(5))
    assert all(500 < b["n"] < 700 for b in blocks)
    assert all(x["z"] <= y["a"] for x, y in zip(blocks, blocks[1:]))


@pytest.fixture(scope="module")
def scored_world(spark):
    """``good`` decides the label, ``noise`` does not, ``gap`` is sometimes missing."""
    df = spark.range(600).select(
        "id",
        (F.col("id") * 7919 % 100).cast("double").alias("good"),
        (F.col("id") * 104729 % 97).cast("double").alias("noise"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("gap"),
    )
    df = df.withColumns({"label": (F.col("good") > 40).cast("int"), "price": F.col("good") * 1000 + 50_000})
    features = ["good", "noise", "gap"]
    grid = [{"maxDepth": 2}]
    sale = train.train(df, features, "label", "classifier", folds=2, grid=grid, max_iter=2)
    price = train.train(df, features, "price", "regressor", folds=2, grid=grid, max_iter=2)
    return df, features, sale, price


def test_cascade(scored_world):
    df, features, sale, price = scored_world
    result = score.cascade_score(df, sale, price, features, features, threshold=0.5)
    assert set(result.columns) == {*df.columns, score.SCORE, score.PRICE, f"{score.PRICE}_lower", f"{score.PRICE}_upper"}
    assert result.where(F.col(score.SCORE) <= 0.5).count() == 0
    assert 0 < result.count() < 600
    assert result.where("gap is null").count() > 0  # features keep their missing values
    assert result.where(F.col(score.PRICE) % 10000 != 0).count() == 0
    assert result.where(f"{score.PRICE}_lower > {score.PRICE} or {score.PRICE}_upper < {score.PRICE}").count() == 0


def test_model_survives_saving(scored_world, tmp_path):
    df, features, sale, _ = scored_world
    train.save_model(sale, str(tmp_path / "model"))
    loaded = train.load_model(str(tmp_path / "model"))
    sums = [score.score_sales(df, m, features).agg(F.sum(score.SCORE)).first()[0] for m in (sale, loaded)]
    assert sums[0] == pytest.approx(sums[1])


def test_model_is_refused_with_other_features_or_codes(spark, scored_world, tmp_path):
    _, features, sale, _ = scored_world
    codes = spark.createDataFrame([("a", "x", 0), ("a", "y", 1)], "column string, value string, code int")
    path = str(tmp_path / "model")
    train.save_model(sale, path, features, codes)
    assert train.load_model(path, features, codes.orderBy(F.desc("code"))).stages
    with pytest.raises(ValueError, match="was trained on"):
        train.load_model(path, features[:2], codes)
    for other in (codes.where("code = 0"), codes.withColumn("code", F.col("code") + 1), codes.limit(0)):
        with pytest.raises(ValueError, match="another dictionary"):
            train.load_model(path, features, other)
    train.save_model(sale, path, features)
    with pytest.raises(ValueError, match="another dictionary"):
        train.load_model(path, features, codes)
    train.save_model(sale, str(tmp_path / "bare"))
    with pytest.raises(ValueError, match="was trained on None"):
        train.load_model(str(tmp_path / "bare"), features)
    assert train.load_model(str(tmp_path / "bare")).stages


def test_importance_finds_the_feature_that_matters(scored_world):
    df, features, sale, _ = scored_world
    ranked = importance.permutation_importance(sale, df, features, "label").collect()
    assert ranked[0]["feature"] == "good" and ranked[0]["importance"] > 0.2
    assert all(abs(r["importance"]) < 0.1 for r in ranked[1:])


def test_shuffled_copy_is_a_permutation(spark):
    df = spark.range(0, 500, 1, 4).select(F.col("id").alias("v"))
    pairs = [(r["v"], r["_other_v"]) for r in importance.shuffled_copy(df, ["v"], 7).collect()]
    assert sorted(a for a, _ in pairs) == sorted(b for _, b in pairs) == list(range(500))
    assert sum(a == b for a, b in pairs) < 20


def _rows(spark, counts):
    """Rows of (x, label), each as often as ``counts`` says."""
    return spark.createDataFrame([(float(x), y) for (x, y), n in counts.items() for _ in range(n)], "x double, y int")


def test_rows_that_agree_are_one_with_their_number(spark):
    df = _rows(spark, {(1, 0): 3, (1, 1): 2, (2, 1): 5}).unionByName(spark.createDataFrame([(None, 1), (None, 1), (4.0, None)], "x double, y int"))
    found = {tuple(r) for r in train.modelled(df, ["x"], "y").collect()}
    assert found == {(1.0, 0.0, 3.0), (1.0, 1.0, 2.0), (2.0, 1.0, 5.0), (train.MISSING_VALUE, 1.0, 2.0)}


@pytest.mark.parametrize("kind", ["classifier", "regressor"])
def test_weighted_rows_fit_like_all_rows(spark, kind):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    df = _rows(spark, {(x, y): 1 + (x * 7 + y * 5) % 11 for x in range(12) for y in (0, 1)})
    weighted = train.fit_once(df, ["x"], "y", kind, max_iter=5, max_depth=2)
    vectors = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    plain = (GBTClassifier if kind == "classifier" else GBTRegressor)(labelCol="y", featuresCol="features", maxIter=5, maxDepth=2, seed=42).fit(vectors)
    cells = df.select("x").distinct()
    one = {r["x"]: r["prediction"] for r in weighted.transform(cells).collect()}
    two = {r["x"]: r["prediction"] for r in plain.transform(VectorAssembler(inputCols=["x"], outputCol="features").transform(cells)).collect()}
    assert all(one[x] == pytest.approx(two[x], abs=1e-6) for x in two)


def test_more_rows_of_a_cell_change_the_fit(spark):
    counts = {(1, 0): 12, (1, 1): 10, (2, 1): 20, (3, 0): 20}
    fits = [train.fit_once(_rows(spark, c), ["x"], "y", "classifier", max_iter=3, max_depth=2) for c in (counts, counts | {(1, 1): 20})]
    cell = spark.createDataFrame([(1.0,)], "x double")
    assert [m.transform(cell).first()["prediction"] for m in fits] == [0.0, 1.0]


def test_search_drops_the_worse_half(spark):
    df = spark.range(800).select((F.col("id") % 16).cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 5).cast("int").alias("fold"))
    grid = [{"maxDepth": d, "stepSize": s} for d in (1, 2, 8) for s in (0.1, 0.3)]
    found = train.search(df, ["x"], "y", "classifier", fold_column="fold", grid=grid, max_iter=8)
    rungs = {r: [t for t in found.trials if t.rung == r] for r in (1, 2, 3)}
    assert [(len(ts), {t.rounds for t in ts}) for ts in rungs.values()] == [(6, {1}), (3, {2}), (2, {4})]
    for rung in (1, 2):
        kept = [t for t in rungs[rung] if t.kept]
        assert [t.setting for t in kept] == [t.setting for t in rungs[rung + 1]]
        assert min(t.score for t in kept) >= max(t.score for t in rungs[rung] if not t.kept)
    tree = found.model.stages[-1]
    assert (tree.getMaxDepth(), tree.getNumTrees) == (8, 8)


@pytest.mark.parametrize(("settings", "rounds"), [(1, []), (2, [10]), (3, [5, 10]), (8, [2, 5, 10]), (9, [1, 2, 5, 10])])
def test_rounds_double_from_rung_to_rung(settings, rounds):
    assert train.rounds_of(settings, 20) == rounds


def _many_rows(spark):
    """Rows of 20 cells and 3 folds that all differ by their price; one feature has a single value."""
    i = F.col("id")
    features = [(i % 4).cast("double").alias("a"), (i * 7919 % 5).cast("double").alias("b"), F.lit(None).cast("double").alias("c")]
    labels = [((i * 31 % 7) < i % 4 + 1).cast("int").alias("sold"), (F.pow(i % 4, 2) * 1000.0 + F.pow(i * 7919 % 5, 3) * 70 + i * 0.01).alias("price")]  # no two splits are equally good
    return spark.range(6000).select(*features, *labels, (i % 3).cast("int").alias("fold"))


def test_fits_are_as_large_as_their_cells(spark, monkeypatch):
    monkeypatch.setattr(train, "ROWS_PER_TASK", 1000)
    rows = train.modelled(_many_rows(spark), ["a", "b", "c"], "price", ["fold"])
    read = train.in_folds(rows, ["a", "b", "c"], "price", "regressor", "fold")
    weigh = lambda df: (df.count(), df.agg(F.sum(train.WEIGHT)).first()[0])
    assert rows.count() == 6000 and weigh(read.whole) == (20, 6000)
    assert {out: (weigh(a), weigh(b)) for out, (a, b) in read.parts.items()} == {out: ((20, 4000), (20, 2000)) for out in range(3)}
    assert read.whole.agg(F.sum(F.col(train.WEIGHT) * F.col("price"))).first()[0] == pytest.approx(rows.agg(F.sum("price")).first()[0])


def test_rows_that_no_bins_make_fewer_stay_as_they_are(spark, monkeypatch):
    monkeypatch.setattr(train, "ROWS_PER_TASK", 500)
    df = spark.range(600).select((F.col("id") % 30).alias("x"), F.floor(F.col("id") / 30).alias("z"), F.col("id").alias("y"), F.lit(0).alias("fold"))
    read = train.in_folds(train.modelled(df, ["x", "z"], "y", ["fold"]), ["x", "z"], "y", "regressor", "fold")
    assert read.bins is None and read.inputs == ["x", "z"] and read.whole.count() == 600


def test_features_of_many_values_are_cut_into_even_bins(spark, monkeypatch):
    monkeypatch.setattr(train, "ROWS_PER_TASK", 1000)
    df = spark.range(6400).select((F.col("id") * 7 % 6400).alias("x"), F.col("id").alias("y"), (F.col("id") % 2).cast("int").alias("fold"))
    read = train.in_folds(train.modelled(df, ["x"], "y", ["fold"]), ["x"], "y", "regressor", "fold")
    sizes = [r[train.WEIGHT] for r in read.whole.collect()]
    assert len(sizes) == train.BINS and sum(sizes) == 6400 and max(sizes) < 1.1 * min(sizes)


@pytest.mark.parametrize(("kind", "label"), [("classifier", "sold"), ("regressor", "price")])
def test_cells_are_searched_and_fitted_like_their_rows(spark, monkeypatch, kind, label):
    df, features = _many_rows(spark), ["a", "b", "c"]
    grid = [{"maxDepth": 1}, {"maxDepth": 3}]
    found = {}
    for limit in (10**6, 30):
        monkeypatch.setattr(train, "ROWS_PER_TASK", limit)
        found[limit] = train.search(df, features, label, kind, fold_column="fold", grid=grid, max_iter=4)
    rows, cells = found.values()
    assert (len(rows.model.stages), len(cells.model.stages)) == (2, 3)
    assert [(t.rung, t.setting, t.kept) for t in cells.trials] == [(t.rung, t.setting, t.kept) for t in rows.trials]
    assert [t.score for t in cells.trials] == pytest.approx([t.score for t in rows.trials], abs=1e-9)
    scored = [score.score_prices(df, s.model, features) if kind == "regressor" else score.score_sales(df, s.model, features) for s in (rows, cells)]
    assert scored[0].columns == scored[1].columns
    column = score.PRICE if kind == "regressor" else score.SCORE
    told = [{(r["a"], r["b"]): r[column] for r in one.select("a", "b", column).distinct().collect()} for one in scored]
    assert all(told[1][cell] == pytest.approx(value) for cell, value in told[0].items())


def test_search_scores_missing_classes_as_nothing(spark):
    scored = spark.createDataFrame([(0.0, 0.0, 3.0)], f"y double, prediction double, {train.WEIGHT} double")
    assert train._f1(scored, "y") == 0.0 and train._f1(scored.where("false"), "y") == 0.0
    half = spark.createDataFrame([(1.0, 1.0, 3.0), (1.0, 0.0, 1.0), (0.0, 1.0, 2.0)], f"y double, prediction double, {train.WEIGHT} double")
    assert train._f1(half, "y") == pytest.approx(2 * 3 / (2 * 3 + 1 + 2))


def test_unknown_kind(spark):
    with pytest.raises(ValueError, match="kind"):
        train.train(spark.range(1), ["id"], "id", "cluster")
