"""Evaluation of hard 0/1 predictions, scores and regressions, each in one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLICES = 4096  # ranges of equal width that scores between 0 and 1 are counted in
THRESHOLDS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)


def _ratio(part: Column, whole: Column) -> Column:
    """0 when there is nothing to divide by."""
    return F.when(whole != 0, part / whole).otherwise(F.lit(0.0))


def _hits(actual: Column, predicted: Column) -> dict[str, Column]:
    return {
        "tn": F.count_if((actual == 0) & (predicted == 0)),
        "fp": F.count_if((actual == 0) & (predicted == 1)),
        "fn": F.count_if((actual == 1) & (predicted == 0)),
        "tp": F.count_if((actual == 1) & (predicted == 1)),
    }


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in _hits(F.col(actual), F.col(predicted)).items()])


def precision(tp: str, fp: str) -> Column:
    return _ratio(F.col(tp), F.col(tp) + F.col(fp))


def recall(tp: str, fn: str) -> Column:
    return _ratio(F.col(tp), F.col(tp) + F.col(fn))


def average_precision_hard(tn: str, fp: str, fn: str, tp: str) -> Column:
    """Average precision when the scores are only 0 and 1: two steps of the precision-recall curve."""
    total = F.col(tn) + F.col(fp) + F.col(fn) + F.col(tp)
    prevalence = _ratio(F.col(tp) + F.col(fn), total)
    return recall(tp, fn) * precision(tp, fp) + (1 - recall(tp, fn)) * prevalence


def classification_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Confusion counts with precision, recall, F1 and the hard average precision and ROC area."""
    cells = ("tn", "fp", "fn", "tp")
    specificity = _ratio(F.col("tn"), F.col("tn") + F.col("fp"))
    return confusion(df, actual, predicted).select(
        *cells,
        precision("tp", "fp").alias("precision"),
        recall("tp", "fn").alias("recall"),
        _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
        average_precision_hard(*cells).alias("average_precision_hard"),
        ((recall("tp", "fn") + specificity) / 2).alias("roc_auc_hard"),
    )


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""

    def scores(tp: str, fp: str, fn: str) -> list[Column]:
        f1 = _ratio(2 * F.col(tp), 2 * F.col(tp) + F.col(fp) + F.col(fn))
        return [precision(tp, fp), recall(tp, fn), f1]

    names = ("precision", "recall", "f1")
    one, zero = scores("tp", "fp", "fn"), scores("tn", "fn", "fp")
    n1, n0 = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    total = n0 + n1
    accuracy = _ratio(F.col("tp") + F.col("tn"), total)
    rows = {
        "0": (zero, n0),
        "1": (one, n1),
        "accuracy": ([accuracy] * 3, total),
        "macro avg": ([(a + b) / 2 for a, b in zip(zero, one)], total),
        "weighted avg": ([_ratio(a * n0 + b * n1, total) for a, b in zip(zero, one)], total),
    }
    report = [
        F.struct(
            F.lit(label).alias("label"), *[v.alias(n) for n, v in zip(names, values)], support.alias("support")
        )
        for label, (values, support) in rows.items()
    ]
    counts = confusion(df, actual, predicted)
    return counts.select(F.explode(F.array(*report)).alias("_row")).select("_row.*")


def crosstab(df: DataFrame, actual: str, predicted: str, margin: str = "All") -> DataFrame:
    """Counts per pair of values, with the margins."""
    counted = df.cube(actual, predicted).agg(
        F.count(F.lit(1)).alias("n"),
        F.grouping(actual).alias("_all_actual"),
        F.grouping(predicted).alias("_all_predicted"),
    )

    def shown(c: str, flag: str) -> Column:
        return F.when(F.col(flag) == 1, F.lit(margin)).otherwise(F.col(c).cast("string"))

    return counted.select(
        shown(actual, "_all_actual").alias("actual"), shown(predicted, "_all_predicted").alias("predicted"), "n"
    )


def threshold_sweep(
    df: DataFrame, actual: str, score: str, thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """Confusion counts, precision and hard average precision at every threshold (a score must exceed it).

    All thresholds are counted side by side, so the rows are read once and never multiplied.
    """
    cells = ("tn", "fp", "fn", "tp")
    counts, rows = [], []
    for i, t in enumerate(thresholds):
        hits = _hits(F.col(actual), (F.col(score) > F.lit(t)).cast("int"))
        counts += [hits[c].alias(f"{c}{i}") for c in cells]
        rows.append(F.struct(F.lit(t).alias("threshold"), *[F.col(f"{c}{i}").alias(c) for c in cells]))
    swept = df.agg(*counts).select(F.explode(F.array(*rows)).alias("_row")).select("_row.*")
    return swept.select(
        "threshold",
        *cells,
        (F.col("tp") + F.col("fp")).alias("predicted"),
        precision("tp", "fp").alias("precision"),
        average_precision_hard(*cells).alias("average_precision_hard"),
    )


def threshold_counts(df: DataFrame, score: str, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """How many scores exceed each threshold."""
    rows = [
        F.struct(F.lit(t).alias("threshold"), F.count_if(F.col(score) > F.lit(t)).alias("predicted"))
        for t in thresholds
    ]
    return df.agg(F.array(*rows).alias("_rows")).select(F.explode("_rows").alias("_row")).select("_row.*")


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """R2, mean absolute error and mean absolute percentage error over rows where both are known.

    R2 is missing for fewer than two rows. If all actual values are equal it is 1 without any error, otherwise 0.
    """
    y, p = F.col(actual), F.col(predicted)
    error = F.abs(y - p)
    tiny = F.lit(2.220446049250313e-16)  # keeps the percentage finite at an actual value of 0
    known = df.where(y.isNotNull() & p.isNotNull())
    sums = known.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("_squared"),
        F.var_pop(y).alias("_spread"),
        F.avg(error).alias("mae"),
        F.avg(error / F.greatest(F.abs(y), tiny)).alias("mape"),
    )
    explained = 1 - F.try_divide("_squared", "_spread")
    even = F.when(F.col("_squared") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    r2 = F.when(F.col("n") > 1, F.when(F.col("_spread") > 0, explained).otherwise(even))
    return sums.select("n", r2.alias("r2"), "mae", "mape")


def score_metrics(df: DataFrame, actual: str, score: str) -> DataFrame:
    """Exact average precision and ROC area of scores, from the counts of each distinct score.

    Rows with equal scores are one step of either curve. Steps are counted in slices of the score range, so no task
    orders all scores: a slice knows the hits above it from the sums of the slices. Both are 0 without a positive row,
    and the ROC area without a negative one too.
    """
    known = df.where(F.col(actual).isNotNull() & F.col(score).isNotNull())
    hit = F.count_if(F.col(actual) == 1).alias("hits")
    steps = known.groupBy(F.col(score).cast("double").alias("score")).agg(hit, F.count(F.lit(1)).alias("rows"))
    slices = steps.withColumn("_slice", F.floor(F.col("score") * SLICES))
    inside = slices.groupBy("_slice").agg(F.sum("hits").alias("_hits"), F.sum("rows").alias("_rows"))
    above = W.orderBy(F.desc("_slice")).rowsBetween(W.unboundedPreceding, -1)  # one row a slice
    everything = W.partitionBy()
    inside = inside.select(
        "_slice", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("_hits", "_rows")],
        F.sum("_hits").over(everything).alias("_all_hits"), F.sum("_rows").over(everything).alias("_all_rows"),
    )
    order = W.partitionBy("_slice").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = slices.join(inside, "_slice").withColumns(
        {
            "_tp": F.col("_hits_above") + F.sum("hits").over(order),
            "_n": F.col("_rows_above") + F.sum("rows").over(order),
        }
    )
    misses = F.col("rows") - F.col("hits")
    sums = placed.agg(
        F.sum(F.col("hits") * F.col("_tp") / F.col("_n")).alias("_precision"),
        # Pairs of a hit above a miss, ties counted half.
        F.sum(misses * (F.col("_tp") - F.col("hits") / 2)).alias("_pairs"),
        F.max("_all_hits").alias("_p"),
        F.max(F.col("_all_rows") - F.col("_all_hits")).alias("_n"),
        F.sum("rows").alias("n"),
    )
    ratio = [F.coalesce(F.try_divide(F.col(a), b), F.lit(0.0)) for a, b in (("_precision", F.col("_p")), ("_pairs", F.col("_p") * F.col("_n")))]
    return sums.select(F.coalesce("n", F.lit(0)).alias("n"), ratio[0].alias("average_precision"), ratio[1].alias("roc_auc"))
