"""Training, scoring and importance.

The queries with SQL learn a step of one feature with few values, so that the right class, price, kept rows and most
important feature can be stated. Those on the panel of orders learn what no SQL can restate. Cross-validated models use
the default folds, grid and rounds; where a query is about scoring or importance, one model is fitted without a search.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow.checkpoints import checkpointed, scratch_folder
from parcelflow.ml import score
from parcelflow.ml.importance import permutation_importance
from parcelflow.ml.train import fit_once, load_model, save_model, search, train, with_fold
from parcelflow.operators import splits
from parcelflow.operators.encode import encode, fit_ordinal
from parcelflow.plans import etl, forecast
from parcelflow.plans.etl import CATEGORIES
from parcelflow.queries.panels import CALENDAR, KEYS, TENURE, linked_orders
from parcelflow.queries.registry import Tables, query

STEP_FEATURES = ["month", "priority"]
STEP_SQL = """
    SELECT DISTINCT month(o_orderdate) AS month, CAST(left(o_orderpriority, 1) AS INTEGER) AS priority FROM orders
"""


def _steps(t: Tables) -> DataFrame:
    """Every order: sold from July on, at a price that depends on the half year."""
    month = F.month("o_orderdate")
    return t.orders.select(
        "o_orderdate", month.alias("month"), F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        (month >= 7).cast("int").alias("sold"), F.when(month >= 7, 250_000.0).otherwise(120_000.0).alias("price"),
    )


def _cells(steps: DataFrame) -> DataFrame:
    return steps.select(*STEP_FEATURES).distinct()


def _searched(rows: DataFrame, features: list[str], label: str, kind: str, date: str):
    return train(with_fold(rows, date), features, label, kind, fold_column="fold")


@query("train_classifier", f"SELECT month, priority, CASE WHEN month >= 7 THEN 1 ELSE 0 END AS sold FROM ({STEP_SQL})")
def train_classifier(t: Tables) -> DataFrame:
    """Predicted class of each month and priority."""
    steps = checkpointed(_steps(t))
    model = _searched(steps, STEP_FEATURES, "sold", "classifier", "o_orderdate")
    scored = score.score_sales(_cells(steps), model, STEP_FEATURES)
    return scored.select(*STEP_FEATURES, (F.col(score.SCORE) > 0.5).cast("int").alias("sold"))


@query(
    "train_regressor",
    f"""
    SELECT month, priority, CASE WHEN month >= 7 THEN 250000.0 ELSE 120000.0 END AS price FROM ({STEP_SQL})
    """,
)
def train_regressor(t: Tables) -> DataFrame:
    """Predicted price of each month and priority, rounded to ten thousands."""
    steps = checkpointed(_steps(t))
    model = _searched(steps, STEP_FEATURES, "price", "regressor", "o_orderdate")
    priced = score.score_prices(_cells(steps), model, STEP_FEATURES)
    return priced.select(*STEP_FEATURES, F.col(score.PRICE).alias("price"))


@query(
    "train_search",
    f"""
    SELECT month, priority, (month + priority) % 2 AS sold, '8, 4, 2' AS settings, '2, 5, 10' AS rounds, 6 AS depth FROM ({STEP_SQL})
    """,
)
def train_search(t: Tables) -> DataFrame:
    """Predicted class of each month and priority where neighbours always differ, which shallow trees cannot tell.

    With it come the settings and boosting rounds of each rung of the search, and the depth that won.
    """
    steps = _steps(t).withColumn("sold", (F.col("month") + F.col("priority")) % 2)
    grid = [{"maxDepth": depth, "stepSize": step} for depth in (1, 2, 3, 6) for step in (0.1, 0.3)]
    found = search(with_fold(steps, "o_orderdate"), STEP_FEATURES, "sold", "classifier", fold_column="fold", grid=grid)
    rungs = sorted({(trial.rung, trial.rounds) for trial in found.trials})
    sizes = [sum(trial.rung == rung for trial in found.trials) for rung, _ in rungs]
    winner = next(trial for trial in found.trials if trial.kept and trial.rung == len(rungs))
    facts = {"settings": ", ".join(map(str, sizes)), "rounds": ", ".join(str(n) for _, n in rungs), "depth": winner.setting["maxDepth"]}
    scored = score.score_sales(_cells(steps), found.model, STEP_FEATURES)
    told = scored.select(*STEP_FEATURES, (F.col(score.SCORE) > 0.5).cast("int").alias("sold"))
    return told.withColumns({name: F.lit(value) for name, value in facts.items()})


@query(
    "cascade_score",
    f"""
    SELECT month, priority, 250000.0 AS price, round(250000 * 0.875, -4) AS lower, round(250000 * 1.125, -4) AS upper
    FROM ({STEP_SQL}) WHERE month >= 7
    """,
)
def cascade_score(t: Tables) -> DataFrame:
    """Prices of the months that the sale model finds likely."""
    steps = checkpointed(_steps(t))
    sale = fit_once(steps, STEP_FEATURES, "sold", "classifier")
    price = fit_once(steps, STEP_FEATURES, "price", "regressor")
    scored = score.cascade_score(_cells(steps), sale, price, STEP_FEATURES, STEP_FEATURES)
    prices = [F.col(f"{score.PRICE}{end}").alias(name) for end, name in (("", "price"), ("_lower", "lower"), ("_upper", "upper"))]
    return scored.select(*STEP_FEATURES, *prices)


@query("perm_importance", "SELECT 1 AS rank, 'month' AS feature, true AS counts UNION ALL SELECT 2, 'priority', false")
def perm_importance(t: Tables) -> DataFrame:
    """Features by importance: the month decides alone, so shuffling the priority changes nothing."""
    steps = checkpointed(_steps(t))
    model = fit_once(steps, STEP_FEATURES, "sold", "classifier")
    ranked = permutation_importance(model, steps, STEP_FEATURES, "sold")
    order = W.orderBy(F.desc("importance"), "feature")  # one row a feature
    return ranked.select(F.row_number().over(order).alias("rank"), "feature", (F.col("importance") > 0.1).alias("counts"))


@query(
    "saved_model_scores",
    """
    SELECT DISTINCT month(o_orderdate) AS month, o_orderpriority AS priority, CASE WHEN o_orderpriority >= '3' THEN 1 ELSE 0 END AS sold,
           'features, dictionary' AS refused
    FROM orders
    """,
)
def saved_model_scores(t: Tables) -> DataFrame:
    """Classes by a model that was saved and loaded again with its dictionary; other features and other codes are refused."""
    orders = t.orders.select(F.month("o_orderdate").alias("month"), F.col("o_orderpriority").alias("priority"))
    dictionary = checkpointed(fit_ordinal(orders, ["priority"]))
    coded = encode(orders.withColumn("sold", (F.col("priority") >= "3").cast("int")), dictionary, ["priority"], suffix="_code")
    features, path = ["month", "priority_code"], scratch_folder(t.spark, "model")
    save_model(fit_once(coded, features, "sold", "classifier"), path, features, dictionary)
    refused = []
    for what, names, codes in (("features", features[::-1], dictionary), ("dictionary", features, dictionary.where("code > 0"))):
        try:
            load_model(path, names, codes)
        except ValueError:
            refused.append(what)
    scored = score.score_sales(coded.select("month", "priority", "priority_code").distinct(), load_model(path, features, dictionary), features)
    return scored.select("month", "priority", (F.col(score.SCORE) > 0.5).cast("int").alias("sold"), F.lit(", ".join(refused)).alias("refused"))


_EVALUATION_SQL = """
WITH cells AS (
    SELECT DISTINCT year(o_orderdate) >= 2000 AS late, month(o_orderdate) AS month, CAST(left(o_orderpriority, 1) AS INTEGER) AS digit FROM orders),
rows AS (
    SELECT 'train' AS part, month, digit, month >= 7 AS actual, CASE WHEN month >= 7 THEN 250000.0 ELSE 120000.0 END AS price FROM cells WHERE NOT late
    UNION ALL
    SELECT 'test', month, digit, month >= 7 OR digit = 1, CASE WHEN month >= 7 THEN 250000.0 ELSE 120000.0 END + 10000 * digit FROM cells WHERE late),
c AS (
    SELECT part, CAST(count_if(NOT actual AND month < 7) AS DOUBLE) AS tn, CAST(count_if(NOT actual AND month >= 7) AS DOUBLE) AS fp,
           CAST(count_if(actual AND month < 7) AS DOUBLE) AS fn, CAST(count_if(actual AND month >= 7) AS DOUBLE) AS tp
    FROM rows GROUP BY part),
m AS (
    SELECT *, tn + fp + fn + tp AS total, coalesce(tp / nullif(tp + fp, 0), 0) AS precision1, coalesce(tp / nullif(tp + fn, 0), 0) AS recall1,
           coalesce(tn / nullif(tn + fn, 0), 0) AS precision0, coalesce(tn / nullif(tn + fp, 0), 0) AS recall0,
           2 * tp / (2 * tp + fp + fn) AS f1, 2 * tn / (2 * tn + fp + fn) AS f0 FROM c),
a AS (SELECT *, recall1 * precision1 + (1 - recall1) * (tp + fn) / total AS ap, (recall1 + recall0) / 2 AS roc FROM m),
r AS (
    SELECT part, count(*) AS n, avg(abs(price - guess)) AS mae, avg(abs(price - guess) / price) AS mape,
           1 - avg((price - guess) * (price - guess)) / nullif(var_pop(price), 0) AS r2
    FROM (SELECT part, price, CASE WHEN month >= 7 THEN 250000.0 ELSE 120000.0 END AS guess FROM rows WHERE actual) GROUP BY part),
told AS (
    SELECT part, 'balance' AS name, 'total' AS metric, total AS value FROM a UNION ALL SELECT part, 'balance', 'positive', tp + fn FROM a
    UNION ALL SELECT part, 'balance', 'percent', 100 * (tp + fn) / total FROM a
    UNION ALL SELECT part, 'classification', 'tn', tn FROM a UNION ALL SELECT part, 'classification', 'fp', fp FROM a
    UNION ALL SELECT part, 'classification', 'fn', fn FROM a UNION ALL SELECT part, 'classification', 'tp', tp FROM a
    UNION ALL SELECT part, 'classification', 'precision', precision1 FROM a UNION ALL SELECT part, 'classification', 'recall', recall1 FROM a
    UNION ALL SELECT part, 'classification', 'f1', f1 FROM a UNION ALL SELECT part, 'classification', 'average_precision_hard', ap FROM a
    UNION ALL SELECT part, 'classification', 'roc_auc_hard', roc FROM a
    UNION ALL SELECT part, 'report 0', 'precision', precision0 FROM a UNION ALL SELECT part, 'report 0', 'recall', recall0 FROM a
    UNION ALL SELECT part, 'report 0', 'f1', f0 FROM a UNION ALL SELECT part, 'report 0', 'support', tn + fp FROM a
    UNION ALL SELECT part, 'report 1', 'f1', f1 FROM a UNION ALL SELECT part, 'report 1', 'support', tp + fn FROM a
    UNION ALL SELECT part, 'report macro avg', 'f1', (f0 + f1) / 2 FROM a
    UNION ALL SELECT part, 'report weighted avg', 'f1', (f0 * (tn + fp) + f1 * (tp + fn)) / total FROM a
    UNION ALL SELECT part, 'report accuracy', 'f1', (tn + tp) / total FROM a
    UNION ALL SELECT part, 'threshold 0.5', 'predicted', tp + fp FROM a UNION ALL SELECT part, 'threshold 0.7', 'fn', fn FROM a
    UNION ALL SELECT part, 'scores', 'n', total FROM a UNION ALL SELECT part, 'scores', 'average_precision', ap FROM a
    UNION ALL SELECT part, 'scores', 'roc_auc', roc FROM a
    UNION ALL SELECT part, 'regression', 'n', n FROM r UNION ALL SELECT part, 'regression', 'mae', mae FROM r
    UNION ALL SELECT part, 'regression', 'mape', mape FROM r UNION ALL SELECT part, 'regression', 'r2', coalesce(r2, 1) FROM r)
SELECT part, name, metric, round(value, 6) AS value FROM told
"""


@query("evaluation_tables", _EVALUATION_SQL)
def evaluation_tables(t: Tables) -> DataFrame:
    """The job's whole evaluation of two models that learnt steps of the month, on test rows that also depend on the priority."""
    month, digit = F.month("o_orderdate"), F.substring("o_orderpriority", 1, 1).cast("int")
    late = F.year("o_orderdate") >= 2000
    step = F.when(month >= 7, 250_000.0).otherwise(120_000.0)
    # Columns of the panel that the models read: the month decides, the priority stands in the total, all others are constant.
    constant = {c: F.lit("x") for c in CATEGORIES} | {c: F.lit(1.0) for c in (*forecast.SALE_FEATURES, *forecast.PRICE_FEATURES) if c not in CATEGORIES}
    features = constant | {"total_sales": month, "YearBuiltRounded": month.cast("double"), "TaxMarketValueTotalRounded": digit * 25_000.0}
    labels = {
        splits.LABEL: ((month >= 7) | (late & (digit == 1))).cast("int"), splits.PRICE_LABEL: F.when(late, step + 10_000 * digit).otherwise(step),
        "sale_in_6_months": F.lit(1), "sale_in_12_months": F.lit(1), "next_good_sale": F.lit(1), "date": F.trunc("o_orderdate", "MM"),
    }
    panel = checkpointed(t.orders.select(*[v.alias(c) for c, v in (features | labels).items()], late.alias("late")))
    panels = splits.Splits(test=panel.where("late"), train=panel.where("not late"))
    dictionary = fit_ordinal(panel, CATEGORIES)
    models = {}
    for label, names, kind in ((splits.LABEL, forecast.SALE_FEATURES, "classifier"), (splits.PRICE_LABEL, forecast.PRICE_FEATURES, "regressor")):
        coded = forecast.coded(names)
        rows = splits.modelling_rows(forecast.encoded_categories(panels.train, dictionary), label, coded)
        models[label] = fit_once(rows, coded, label, kind)
    tables = forecast.evaluate(panels, dictionary, models, forecast.ForecastConfig(etl.EtlConfig("", "", None, None)))
    told: list[DataFrame] = []

    def tell(part: str, name: str, df: DataFrame, columns: list[str]) -> None:
        pairs = F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(c).cast("double") for c in columns]))).alias("metric", "value")
        told.append(df.select(F.lit(part).alias("part"), F.lit(name).alias("name"), pairs))

    for part in ("train", "test"):
        for name, columns in (
            ("balance", ["total", "positive", "percent"]), ("scores", ["n", "average_precision", "roc_auc"]), ("regression", ["n", "r2", "mae", "mape"]),
            ("classification", ["tn", "fp", "fn", "tp", "precision", "recall", "f1", "average_precision_hard", "roc_auc_hard"]),
        ):
            tell(part, name, tables[f"{part}_{name}"], columns)
        report, swept = tables[f"{part}_report"], tables[f"{part}_thresholds"]
        for label, columns in (("0", ["precision", "recall", "f1", "support"]), ("1", ["f1", "support"]), ("macro avg", ["f1"]), ("weighted avg", ["f1"]), ("accuracy", ["f1"])):
            tell(part, f"report {label}", report.where(F.col("label") == label), columns)
        for threshold, columns in ((0.5, ["predicted"]), (0.7, ["fn"])):
            tell(part, f"threshold {threshold}", swept.where(F.abs(F.col("threshold") - threshold) < 1e-9), columns)
    stacked = told[0]
    for one in told[1:]:
        stacked = stacked.unionByName(one)
    return stacked.select("part", "name", "metric", F.round("value", 6).alias("value"))


SALE_FEATURES = ["total_sales", "tenure_months", "month", "owner_code", "business_owner"]
PRICE_FEATURES = ["total_sales", "tenure_months", "last_sale_price", "owner_code"]


def _panels(t: Tables) -> splits.Splits:
    sales = checkpointed(linked_orders(t))  # plays the history stage, which the job reads several times
    dictionary = fit_ordinal(sales, ["owner"])
    return splits.split_panel(encode(sales, dictionary, ["owner"], suffix="_code"), CALENDAR, KEYS, TENURE)


def _panel_rows(panel: DataFrame, features: list[str], label: str) -> DataFrame:
    return checkpointed(splits.modelling_rows(panel, label, features, date="date"))


@query("panel_classifier")
def panel_classifier(t: Tables) -> DataFrame:
    """Test rows with the probability of a sale."""
    panels = _panels(t)
    rows = _panel_rows(panels.train, SALE_FEATURES, splits.LABEL)
    model = _searched(rows, SALE_FEATURES, splits.LABEL, "classifier", "date")
    return score.score_sales(panels.test, model, SALE_FEATURES).select("customer", "date", splits.LABEL, score.SCORE)


@query("panel_regressor")
def panel_regressor(t: Tables) -> DataFrame:
    """Test rows with the predicted price and its interval."""
    panels = _panels(t)
    rows = _panel_rows(panels.train_price, PRICE_FEATURES, splits.PRICE_LABEL)
    model = _searched(rows, PRICE_FEATURES, splits.PRICE_LABEL, "regressor", "date")
    priced = score.score_prices(panels.test, model, PRICE_FEATURES)
    return priced.select("customer", "date", score.PRICE, f"{score.PRICE}_lower", f"{score.PRICE}_upper")


@query("panel_cascade")
def panel_cascade(t: Tables) -> DataFrame:
    """Prices for the test rows that the sale model finds likely."""
    panels = _panels(t)
    jobs = (
        (panels.train, SALE_FEATURES, splits.LABEL, "classifier"),
        (panels.train_price, PRICE_FEATURES, splits.PRICE_LABEL, "regressor"),
    )
    with ThreadPoolExecutor(max_workers=2) as pool:  # both models train side by side
        sale, price = pool.map(lambda j: fit_once(_panel_rows(j[0], j[1], j[2]), j[1], j[2], j[3]), jobs)
    scored = score.cascade_score(panels.test, sale, price, SALE_FEATURES, PRICE_FEATURES, threshold=0.2)
    return scored.select("customer", "date", score.SCORE, score.PRICE)


@query("panel_importance")
def panel_importance(t: Tables) -> DataFrame:
    panels = _panels(t)
    model = fit_once(_panel_rows(panels.train, SALE_FEATURES, splits.LABEL), SALE_FEATURES, splits.LABEL, "classifier")
    return permutation_importance(model, panels.test, SALE_FEATURES, splits.LABEL)
