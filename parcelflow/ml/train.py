"""Gradient-boosted models, tuned over folds that follow the calendar."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow import stages
from parcelflow.checkpoints import checkpointed

FOLDS = 15
MISSING_VALUE = -1.0  # no feature is negative, so trees can split missing values off


def feature_rows(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features as doubles without gaps."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(MISSING_VALUE)) for c in features})


def with_fold(df: DataFrame, date: str, folds: int = FOLDS, name: str = "fold") -> DataFrame:
    """Cut the rows into ``folds`` equal blocks in date order, without sorting them.

    Rows of one date are spread evenly over the share of blocks that the date covers. The table of dates has
    one row per day of the training window, so it may be broadcast and its running total is small.
    """
    dated = df.where(F.col(date).isNotNull())
    days = dated.groupBy(date).agg(F.count(F.lit(1)).alias("_n"))
    running = W.orderBy(date).rowsBetween(W.unboundedPreceding, W.currentRow)
    days = days.withColumns({"_end": F.sum("_n").over(running), "_total": F.sum("_n").over(W.partitionBy())})
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(1_000_003)) / F.lit(1_000_003.0)
    place = (F.col("_end") - F.col("_n") + spread * F.col("_n")) / F.col("_total")
    fold = F.least(F.floor(place * folds), F.lit(folds - 1)).cast("int")
    return dated.join(F.broadcast(days), date).withColumn(name, fold).drop("_n", "_end", "_total")


ROWS_PER_TASK = 50_000
WEIGHT = "_weight"  # rows of the same features, label and fold are one row with their number as its weight
BINS = 32  # of a feature, between which trees of Spark look for a threshold (``maxBins``)
SPREAD = "_spread"  # squared distances of the labels of a cell's rows from their mean

#: Settings that a search starts from, shallow trees first: of equally good ones the first is kept.
GRID = tuple({"maxDepth": depth, "stepSize": step} for depth in (2, 3, 4, 5) for step in (0.1, 0.3))


@dataclass(frozen=True)
class Trial:
    """What a setting scored in a rung of a search, and whether it went on."""

    rung: int
    rounds: int
    setting: dict
    score: float
    kept: bool


@dataclass(frozen=True)
class Search:
    model: PipelineModel
    trials: list[Trial]


def _learner(kind: str, label: str, max_iter: int, seed: int):
    columns = {"labelCol": label, "featuresCol": "features", "weightCol": WEIGHT}
    if kind == "classifier":
        return GBTClassifier(maxIter=max_iter, seed=seed, **columns)
    if kind == "regressor":
        return GBTRegressor(maxIter=max_iter, seed=seed, **columns)
    raise ValueError(f"kind must be classifier or regressor, not {kind}")


def modelled(df: DataFrame, features: Sequence[str], label: str, more: Sequence[str] = ()) -> DataFrame:
    """Features and label as a model reads them, one row for all that agree, with their number.

    Every row counts, and a fit is as large as its different rows. They are kept because boosting reads its rows once
    per tree level.
    """
    kept = [*features, F.col(label).cast("double").alias(label), *more]
    known = feature_rows(df.where(F.col(label).isNotNull()), features).select(*kept)
    return _kept(known.groupBy(*known.columns).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT)))


def _kept(df: DataFrame) -> DataFrame:
    """``df`` computed once. A fit is a chain of short jobs over its rows: no more tasks than the rows are worth."""
    rows = checkpointed(df)
    return rows.coalesce(max(1, -(-rows.count() // ROWS_PER_TASK)))


def bin_name(feature: str) -> str:
    return f"_bin_{feature}"


def _bounds(rows: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """Where the bins of each feature meet: between its values if these are few, else at quantiles of the rows."""
    numbers = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in features]).first()
    few = [c for c in features if numbers[c] <= 2 * BINS]
    values = rows.agg(F.lit(0), *[F.sort_array(F.collect_set(c)).alias(c) for c in few]).first()
    quantiles = rows.approxQuantile(list(features), [i / BINS for i in range(1, BINS)], 0.001)
    bounds = []
    for c, points in zip(features, quantiles):
        if c in few and len(values[c]) <= BINS:
            points = [(a + b) / 2 for a, b in zip(values[c], values[c][1:])]
        bounds.append(sorted({p for p in points if math.isfinite(p)}))
    return bounds


def _cells(rows: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Rows that agree in ``keys`` as one row: their number and, of a label that is no key, its mean and spread."""
    number, total = F.sum(WEIGHT), F.sum(F.col(WEIGHT) * F.col(label))
    squares = F.sum(F.col(WEIGHT) * F.col(label) * F.col(label) + F.col(SPREAD))
    labels = [] if label in keys else [(total / number).alias(label), F.greatest(squares - total * total / number, F.lit(0.0)).alias(SPREAD)]
    return rows.groupBy(*keys).agg(number.alias(WEIGHT), *labels)


@dataclass(frozen=True)
class Folds:
    """What a search reads: all rows and, for each fold, the rows to fit and those to score. ``bins`` cuts features before."""

    inputs: list[str]
    whole: DataFrame
    parts: dict[int, tuple[DataFrame, DataFrame]]
    bins: Bucketizer | None = None


def in_folds(rows: DataFrame, features: Sequence[str], label: str, kind: str, fold: str) -> Folds:
    """The rows of ``modelled`` as they are, or as cells if there are more than a task takes and cells are fewer.

    A tree sees of a feature in which bin it lies, and of the labels (regression) or classes (classification) of the
    rows in the same bins nothing but their sums. So these rows are one weighted row, a cell, without loss, and fits
    that each read their rows hundreds of times are as large as the bins that occur, however many rows there are. The
    spread keeps R2 that of the rows.
    """
    held = sorted(r[0] for r in rows.select(fold).distinct().collect())  # as many as there are folds
    number = rows.count()
    if number > ROWS_PER_TASK:
        inputs = [bin_name(c) for c in features]
        splits = [[-math.inf, *points, math.inf] for points in _bounds(rows, features)]
        # A Bucketizer wants two bins at least; those of a constant feature meet where no value is.
        splits = [s if len(s) > 2 else [-math.inf, MISSING_VALUE - 1, math.inf] for s in splits]
        bins = Bucketizer(splitsArray=splits, inputCols=list(features), outputCols=inputs)
        keys = [*inputs, *([label] if kind == "classifier" else [])]
        cut = bins.transform(rows).withColumn(SPREAD, F.lit(0.0))
        for c in inputs:  # numbers in order to a tree, not the names that a Bucketizer calls them
            cut = cut.withMetadata(c, {})
        cells = checkpointed(_cells(cut, [*keys, fold], label).withColumns({} if kind == "regressor" else {SPREAD: F.lit(0.0)}))
        whole = _kept(_cells(cells, keys, label))
        if 2 * whole.count() <= number:
            parts = {out: (_kept(_cells(cells.where(F.col(fold) != out), keys, label)), _kept(cells.where(F.col(fold) == out))) for out in held}
            return Folds(inputs, whole, parts, bins)
    return Folds(list(features), rows, {out: (rows.where(F.col(fold) != out), rows.where(F.col(fold) == out)) for out in held})


def _pipeline(features: Sequence[str], learner) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), learner])


def fit_once(
    df: DataFrame, features: Sequence[str], label: str, kind: str, max_iter: int = 20, max_depth: int = 5, seed: int = 42
) -> PipelineModel:
    """One model with given settings: no folds and no search."""
    learner = _learner(kind, label, max_iter, seed).setMaxDepth(max_depth)
    return _pipeline(features, learner).fit(modelled(df, features, label))


def _f1(scored: DataFrame, label: str) -> float:
    """F1 of class 1. A block of dates without a positive row counts 0 instead of ending the search."""
    actual, predicted = F.col(label) == 1, F.col("prediction") == 1
    hits = [F.sum(F.when(c, F.col(WEIGHT)).otherwise(0.0)) for c in (actual & predicted, actual | predicted)]
    tp, union = scored.agg(*hits).first()
    return 2 * tp / (tp + union) if union else 0.0


def _r2(scored: DataFrame, label: str) -> float:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="r2", weightCol=WEIGHT).evaluate(scored)


def _r2_of_cells(scored: DataFrame, label: str) -> float:
    """R2 of the rows of the cells."""
    number, actual = F.col(WEIGHT), F.col(label)
    mean = scored.agg(F.sum(number * actual) / F.sum(number)).first()[0]
    missed, total = (F.sum(number * F.pow(actual - other, 2) + F.col(SPREAD)) for other in (F.col("prediction"), F.lit(mean)))
    missed, total = scored.agg(missed, total).first()
    return 1 - missed / total if total else float(not missed)


def rounds_of(settings: int, max_iter: int) -> list[int]:
    """Boosting rounds of each rung: the last has half of ``max_iter``, each one before half of that, until one setting is left."""
    rungs = max(0, settings - 1).bit_length()
    return [max(1, max_iter >> (rungs - i)) for i in range(rungs)]


def search(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    kind: str,
    folds: int = FOLDS,
    fold_column: str | None = None,
    grid: Sequence[dict] | None = None,
    max_iter: int = 20,
    seed: int = 42,
    parallelism: int = 8,
) -> Search:
    """Best model of a parameter grid by successive halving over cross-validated F1 (``classifier``) or R2 (``regressor``).

    ``grid`` lists settings such as ``{"maxDepth": 5, "stepSize": 0.1}``. A rung scores every setting that is left over
    all folds and drops the worse half; the next has twice the boosting rounds. What is left is fitted to all rows with
    ``max_iter`` rounds. Without a ``fold_column`` the content of a row decides its fold.
    """
    learner = _learner(kind, label, max_iter, seed)
    fold = fold_column or "_fold"
    placed = df if fold_column else df.withColumn(fold, F.pmod(F.xxhash64(*features, label), F.lit(folds)).cast("int"))
    read = in_folds(modelled(placed, features, label, [fold]), features, label, kind, fold)
    held = list(read.parts)
    measure = _f1 if kind == "classifier" else _r2_of_cells if read.bins else _r2
    left, trials = list(GRID if grid is None else grid), []

    def score(job: tuple[dict, int, int]) -> float:
        setting, rounds, out = job
        tuned = learner.copy({learner.getParam(n): v for n, v in setting.items()} | {learner.maxIter: rounds})
        fitted, scored = read.parts[out]
        return measure(_pipeline(read.inputs, tuned).fit(fitted).transform(scored), label)

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        for rung, rounds in enumerate(rounds_of(len(left), max_iter) if len(held) > 1 else [], 1):
            scores = list(pool.map(score, [(setting, rounds, out) for setting in left for out in held]))
            means = [math.fsum(scores[i * len(held) : (i + 1) * len(held)]) / len(held) for i in range(len(left))]
            best = sorted(range(len(left)), key=lambda i: (-means[i], i))[: -(-len(left) // 2)]
            trials += [Trial(rung, rounds, left[i], means[i], i in best) for i in range(len(left))]
            left = [left[i] for i in sorted(best)]
    tuned = learner.copy({learner.getParam(n): v for n, v in left[0].items()})
    model = _pipeline(read.inputs, tuned).fit(read.whole)
    return Search(PipelineModel([read.bins, *model.stages]) if read.bins else model, trials)


def train(*args, **settings) -> PipelineModel:
    """The model of a ``search``."""
    return search(*args, **settings).model


def dictionary_digest(dictionary: DataFrame) -> str:
    """A digest of a dictionary's rows, whatever their order."""
    row = F.xxhash64(*sorted(dictionary.columns))
    number, sums, bits = dictionary.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.bit_xor(row)).first()
    return f"{number}:{sums or 0}:{bits or 0}"


def _card(path: str) -> str:
    return f"{path}/features.json"


def save_model(model: PipelineModel, path: str, features: Sequence[str] | None = None, dictionary: DataFrame | None = None) -> None:
    """The model, and with it what it was trained on: its features in order and the dictionary that coded them."""
    model.write().overwrite().save(path)
    if features is not None:
        digest = None if dictionary is None else dictionary_digest(dictionary)
        spark = SparkSession.active()
        stages.write_text(spark, _card(path), json.dumps({"features": list(features), "dictionary": digest}), overwrite=True)


def load_model(path: str, features: Sequence[str] | None = None, dictionary: DataFrame | None = None) -> PipelineModel:
    """A saved model. Given ``features`` or a ``dictionary``, it is refused if it was saved with others or with none."""
    if features is not None or dictionary is not None:
        spark = SparkSession.active()
        card, files = stages.file_system(spark, _card(path))
        saved = json.loads(stages.read_text(spark, _card(path))) if files.exists(card) else {"features": None, "dictionary": None}
        if features is not None and saved["features"] != list(features):
            raise ValueError(f"the model of {path} was trained on {saved['features']}, not on {list(features)}")
        if dictionary is not None and saved["dictionary"] != dictionary_digest(dictionary):
            raise ValueError(f"the model of {path} was trained with another dictionary")
    return PipelineModel.load(path)
