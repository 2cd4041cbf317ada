"""Profiles, correlations and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.ml import metrics
from parcelflow.operators import aggregates
from parcelflow.queries.registry import Tables, query

DIGITS = 4


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


@query(
    "label_balance",
    """
    SELECT count(*) AS total, CAST(sum(quality) AS BIGINT) AS positive, round(avg(quality) * 100, 4) AS percent
    FROM labels WHERE quality IS NOT NULL
    """,
)
def label_balance(t: Tables) -> DataFrame:
    return rounded(aggregates.label_balance(t.labels, "quality"), "percent")


NUMERIC = ("l_extendedprice", "l_quantity", "l_discount", "l_linenumber")


def _profile_sql(column: str) -> str:
    return f"""
        SELECT '{column}' AS "column", count({column}) AS count, round(avg({column}), 4) AS mean,
               round(stddev_samp({column}), 4) AS std, CAST(min({column}) AS DOUBLE) AS min,
               round(quantile_cont({column}, 0.25), 4) AS q25, round(quantile_cont({column}, 0.5), 4) AS q50,
               round(quantile_cont({column}, 0.75), 4) AS q75, CAST(max({column}) AS DOUBLE) AS max
        FROM lineitem
    """


@query("profile_numeric", " UNION ALL ".join(_profile_sql(c) for c in NUMERIC))
def profile_numeric(t: Tables) -> DataFrame:
    return rounded(aggregates.profile_numeric(t.lineitem, NUMERIC), "mean", "std", "q25", "q50", "q75")


DATED = ("o_orderdate", "l_shipdate")


def _dates_sql(table: str, column: str) -> str:
    day = f"date_diff('day', DATE '1970-01-01', CAST({column} AS DATE))"
    cells = {"min": f"min({day})", "q25": f"quantile_cont({day}, 0.25)", "q50": f"quantile_cont({day}, 0.5)",
             "q75": f"quantile_cont({day}, 0.75)", "max": f"max({day})"}
    shown = ", ".join(f"CAST(DATE '1970-01-01' + CAST(floor({v}) AS INTEGER) AS VARCHAR) AS {c}" for c, v in cells.items())
    return f"SELECT '{column}' AS \"column\", count({column}) AS count, {shown} FROM {table}"


@query("profile_dates", " UNION ALL ".join(_dates_sql(t, c) for t, c in zip(("orders", "lineitem"), DATED)))
def profile_dates(t: Tables) -> DataFrame:
    orders = aggregates.profile_dates(t.orders, ["o_orderdate"])
    return orders.unionByName(aggregates.profile_dates(t.lineitem, ["l_shipdate"]))


def _text_sql(table: str, column: str) -> str:
    return f"""
        SELECT '{column}' AS "column", (SELECT count({column}) FROM {table}) AS count,
               (SELECT count(DISTINCT {column}) FROM {table}) AS "unique", value AS top, n AS freq
        FROM (SELECT {column} AS value, count(*) AS n FROM {table} GROUP BY {column} ORDER BY n DESC, value LIMIT 1)
    """


@query("profile_text", " UNION ALL ".join(f"({_text_sql('orders', c)})" for c in ("o_orderpriority", "o_orderstatus")))
def profile_text(t: Tables) -> DataFrame:
    return aggregates.profile_text(t.orders, ["o_orderpriority", "o_orderstatus"])


def _corr_sql(a: str, b: str) -> str:
    value = "max(1.0)" if a == b else f"round(corr({a}, {b}), 4)"
    keep = "" if a == "l_extendedprice" else f"HAVING abs(corr({a}, l_extendedprice)) > 0.001"
    return f"SELECT '{a}' AS \"column\", '{b}' AS other, CAST({value} AS DOUBLE) AS correlation FROM lineitem {keep}"


CORRELATED = ("l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_linenumber")


@query("corr_label", " UNION ALL ".join(_corr_sql(a, b) for a in CORRELATED for b in CORRELATED))
def corr_label(t: Tables) -> DataFrame:
    return rounded(aggregates.correlate(t.lineitem, CORRELATED, "l_extendedprice", 0.001), "correlation")


def _constant_sql(a: str, b: str) -> str:
    fixed = "l_fixed" in (a, b)
    value = "max(1.0)" if a == b else "max(CAST(NULL AS DOUBLE))" if fixed else f"round(corr({a}, {b}), 4)"
    keep = "" if a == "l_extendedprice" else f"HAVING abs(corr({a}, l_extendedprice)) > 0.001"
    return f"SELECT '{a}' AS \"column\", '{b}' AS other, CAST({value} AS DOUBLE) AS correlation FROM lineitem {keep}"


WITH_CONSTANT = ("l_extendedprice", "l_quantity", "l_fixed")


@query(
    "corr_constant",
    " UNION ALL ".join(_constant_sql(a, b) for a in WITH_CONSTANT if a != "l_fixed" for b in WITH_CONSTANT),
)
def corr_constant(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("l_fixed", F.lit(7))
    return rounded(aggregates.correlate(rows, WITH_CONSTANT, "l_extendedprice", 0.001), "correlation")


CELLS_SQL = """
    WITH predicted AS (SELECT quality AS actual, 1 - toxic AS predicted FROM labels),
    cells AS (
        SELECT count(*) FILTER (actual = 0 AND predicted = 0) AS tn, count(*) FILTER (actual = 0 AND predicted = 1) AS fp,
               count(*) FILTER (actual = 1 AND predicted = 0) AS fn, count(*) FILTER (actual = 1 AND predicted = 1) AS tp
        FROM predicted)
"""


def _predicted(t: Tables) -> DataFrame:
    return t.labels.select(F.col("quality").alias("actual"), (1 - F.col("toxic")).alias("predicted"))


@query("confusion", CELLS_SQL + "SELECT tn, fp, fn, tp FROM cells")
def confusion(t: Tables) -> DataFrame:
    return metrics.confusion(_predicted(t), "actual", "predicted")


@query(
    "hard_metrics",
    CELLS_SQL
    + """
    SELECT tn, fp, fn, tp, round(tp / (tp + fp), 4) AS precision, round(tp / (tp + fn), 4) AS recall,
           round(2 * tp / (2 * tp + fp + fn), 4) AS f1,
           round(tp / (tp + fn) * tp / (tp + fp) + fn / (tp + fn) * (tp + fn) / (tn + fp + fn + tp), 4)
               AS average_precision_hard,
           round((tp / (tp + fn) + tn / (tn + fp)) / 2, 4) AS roc_auc_hard
    FROM cells
    """,
)
def hard_metrics(t: Tables) -> DataFrame:
    result = metrics.classification_metrics(_predicted(t), "actual", "predicted")
    return rounded(result, "precision", "recall", "f1", "average_precision_hard", "roc_auc_hard")


@query(
    "class_report",
    CELLS_SQL
    + """
    , scores AS (
        SELECT *, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fn + fp) AS f0, tn + fp AS n0,
               tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fp + fn) AS f1, tp + fn AS n1,
               tn + fp + fn + tp AS n
        FROM cells)
    SELECT '0' AS label, round(p0, 4) AS precision, round(r0, 4) AS recall, round(f0, 4) AS f1, n0 AS support FROM scores
    UNION ALL SELECT '1', round(p1, 4), round(r1, 4), round(f1, 4), n1 FROM scores
    UNION ALL SELECT 'accuracy', round((tp + tn) / n, 4), round((tp + tn) / n, 4), round((tp + tn) / n, 4), n FROM scores
    UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 4), round((r0 + r1) / 2, 4), round((f0 + f1) / 2, 4), n FROM scores
    UNION ALL SELECT 'weighted avg', round((p0 * n0 + p1 * n1) / n, 4), round((r0 * n0 + r1 * n1) / n, 4),
                     round((f0 * n0 + f1 * n1) / n, 4), n FROM scores
    """,
)
def class_report(t: Tables) -> DataFrame:
    return rounded(metrics.class_report(_predicted(t), "actual", "predicted"), "precision", "recall", "f1")


@query(
    "crosstab_margins",
    """
    SELECT CASE WHEN grouping(quality) = 1 THEN 'All' ELSE CAST(quality AS VARCHAR) END AS actual,
           CASE WHEN grouping(predicted) = 1 THEN 'All' ELSE CAST(predicted AS VARCHAR) END AS predicted, count(*) AS n
    FROM (SELECT quality, 1 - toxic AS predicted FROM labels) GROUP BY CUBE (quality, predicted)
    """,
)
def crosstab_margins(t: Tables) -> DataFrame:
    return metrics.crosstab(_predicted(t), "actual", "predicted")


@query(
    "threshold_sweep",
    """
    WITH scored AS (SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS actual,
                           o_totalprice / 500000 AS score FROM orders),
    thresholds AS (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])::DOUBLE AS threshold),
    swept AS (
        SELECT threshold, count(*) FILTER (actual = 0 AND NOT score > threshold) AS tn,
               count(*) FILTER (actual = 0 AND score > threshold) AS fp,
               count(*) FILTER (actual = 1 AND NOT score > threshold) AS fn,
               count(*) FILTER (actual = 1 AND score > threshold) AS tp
        FROM scored CROSS JOIN thresholds GROUP BY threshold)
    SELECT threshold, tn, fp, fn, tp, tp + fp AS predicted,
           round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 4) AS precision,
           round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fn) * tp / (tp + fp) END
                 + fn / (tp + fn) * (tp + fn) / (tn + fp + fn + tp), 4) AS average_precision_hard
    FROM swept
    """,
)
def threshold_sweep(t: Tables) -> DataFrame:
    actual = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int")
    scored = t.orders.select(actual.alias("actual"), (F.col("o_totalprice") / 500000).alias("score"))
    return rounded(metrics.threshold_sweep(scored, "actual", "score"), "precision", "average_precision_hard")


@query(
    "threshold_counts",
    " UNION ALL ".join(
        f"SELECT CAST(0.{i} AS DOUBLE) AS threshold, count(*) FILTER (l_discount * 10 > 0.{i}) AS predicted FROM lineitem"
        for i in range(1, 10)
    ),
)
def threshold_counts(t: Tables) -> DataFrame:
    return metrics.threshold_counts(t.lineitem.select((F.col("l_discount") * 10).alias("score")), "score")


@query(
    "regression_metrics",
    """
    WITH priced AS (SELECT l_extendedprice AS actual, l_quantity * p_retailprice AS predicted
                    FROM lineitem JOIN part ON p_partkey = l_partkey)
    SELECT count(*) AS n,
           round(1 - avg((actual - predicted) * (actual - predicted)) / var_pop(actual), 4) AS r2,
           round(avg(abs(actual - predicted)), 4) AS mae, round(avg(abs(actual - predicted) / abs(actual)), 4) AS mape
    FROM priced
    """,
)
def regression_metrics(t: Tables) -> DataFrame:
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    priced = t.lineitem.select("l_partkey", "l_quantity", "l_extendedprice").join(parts, "l_partkey")
    rows = priced.select(
        F.col("l_extendedprice").alias("actual"), (F.col("l_quantity") * F.col("p_retailprice")).alias("predicted")
    )
    return rounded(metrics.regression_metrics(rows, "actual", "predicted"), "r2", "mae", "mape")


@query(
    "regression_one_row",
    """
    SELECT 1 AS n, CAST(NULL AS DOUBLE) AS r2, round(abs(max(l_extendedprice) - min(l_extendedprice)), 4) AS mae,
           round(abs(max(l_extendedprice) - min(l_extendedprice)) / abs(max(l_extendedprice)), 4) AS mape
    FROM lineitem
    """,
)
def regression_one_row(t: Tables) -> DataFrame:
    ends = t.lineitem.agg(F.max("l_extendedprice").alias("actual"), F.min("l_extendedprice").alias("predicted"))
    return rounded(metrics.regression_metrics(ends, "actual", "predicted"), "r2", "mae", "mape")


@query(
    "score_metrics",
    """
    WITH scored AS (SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS actual,
                           round(o_totalprice / 500000, 3) AS score FROM orders),
    steps AS (SELECT score, sum(actual) AS hits, count(*) AS n FROM scored GROUP BY score),
    placed AS (SELECT hits, n, sum(hits) OVER w AS tp, sum(n) OVER w AS seen, sum(hits) OVER () AS p,
                      sum(n - hits) OVER () AS q
               FROM steps WINDOW w AS (ORDER BY score DESC))
    SELECT CAST(sum(n) AS BIGINT) AS n, round(sum(hits * tp / seen) / max(p), 4) AS average_precision,
           round(sum((n - hits) * (tp - hits / 2)) / (max(p) * max(q)), 4) AS roc_auc
    FROM placed
    """,
)
def score_metrics(t: Tables) -> DataFrame:
    actual = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int")
    scored = t.orders.select(actual.alias("actual"), F.round(F.col("o_totalprice") / 500000, 3).alias("score"))
    return rounded(metrics.score_metrics(scored, "actual", "score"), "average_precision", "roc_auc")
