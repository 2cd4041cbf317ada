"""Forecast job: history to trained models, current predictions and the updated prediction table."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import stages
from parcelflow.calendars import RunCalendar, run_calendar
from parcelflow.checkpoints import checkpointed
from parcelflow.ml import metrics, score
from parcelflow.ml.train import FOLDS, load_model, save_model, train, with_fold
from parcelflow.operators.aggregates import label_balance
from parcelflow.operators.encode import encode
from parcelflow.operators.snapshot import current_snapshot
from parcelflow.operators.splits import LABEL, PRICE_LABEL, TENURE_YEARS, Splits, modelling_rows, split_panel
from parcelflow.periods import Merge
from parcelflow.plans.etl import CATEGORIES, KEY, PREDICTION_KEYS, SALE_NUMBER, EtlConfig

log = logging.getLogger(__name__)

CODE = "_code"

# Features of the two models.
SALE_FEATURES = (
    "total_sales", "CompanyFlag", "OwnerTypeDescription1", "PropertyUseGroup", "BathPartialCount", "StoriesCount",
    "ConfidenceScore", "TaxMarketValueTotalRounded", "business_owner",
)
PRICE_FEATURES = (
    "PropertyUseGroup", "YearBuiltRounded", "AreaBuildingRounded", "TaxMarketValueLandRounded",
    "TaxMarketValueImprovementsRounded", "TaxMarketValueTotalRounded", "EstimatedValueRounded",
    "last_sale_priceRounded", "ConfidenceScore",
)

# Published name of every published column, in output order.
PUBLISHED = {
    "Parid": "parcel",
    "YearBuilt": "yearBuilt",
    "PropertyAddressFull": "address",
    "PropertyAddressCity": "city",
    "PropertyAddressZIP": "zipCode",
    "SitusCounty": "county",
    "SitusStateCode": "state",
    "PropertyLatitude": "latitude",
    "PropertyLongitude": "longitude",
    "PropertyUseGroup": "propertyUse",
    "business_owner": "businessOwner",
    "AreaBuilding": "areaBuildingSqft",
    "AreaLotSF": "areaLotSqft",
    "StoriesCount": "stories",
    "TaxMarketValueLand": "taxMarketValueLand",
    "TaxMarketValueImprovements": "taxMarketValueImprovements",
    "TaxMarketValueTotal": "taxMarketValueTotal",
    "EstimatedValue": "estimatedValue",
    "ConfidenceScore": "estimatedValueConfidenceScore",
    "last_sale_date": "lastSaleDate",
    "last_sale_price": "lastSalePrice",
    "next_sale_date": "actualSaleDate",
    "next_sale_price": "actualSalePrice",
    "next_good_sale": "goodSale",
    "pred_next_sale_price": "predictedSalePrice",
    "prediction_period_start": "predictionPeriodStart",
    "prediction_period_end": "predictionPeriodEnd",
    "updated_at": "updatedAt",
}


@dataclass(frozen=True)
class ForecastConfig:
    etl: EtlConfig
    tenure: tuple[int, int] = TENURE_YEARS
    threshold: float = score.THRESHOLD
    interval: float = score.INTERVAL
    folds: int = FOLDS
    max_iter: int = 20
    grid: list[dict] | None = None  # settings that the search starts from, those of ``train.GRID`` if there are none

    @property
    def calendar(self) -> RunCalendar:
        return run_calendar(self.etl.run_date, self.etl.as_of)

    def prepared(self, panel: str) -> str:
        """Folder of a prepared panel, which the tenure bounds decide."""
        low, high = self.tenure
        return self.etl.path(f"3-prepared/tenure={low}-{high}/{panel}")

    def model_path(self, label: str) -> str:
        low, high = self.tenure
        run = f"{self.etl.run_date}/{self.etl.state}/as_of={self.etl.as_of}/tenure={low}-{high}"
        return f"{self.etl.root}/models/{run}/{label}"


def coded(features: tuple[str, ...]) -> list[str]:
    """Feature columns with categories replaced by their code columns."""
    return [f + CODE if f in CATEGORIES else f for f in features]


def encoded_categories(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    used = [c for c in CATEGORIES if c in (*SALE_FEATURES, *PRICE_FEATURES)]
    return encode(df, dictionary, used, suffix=CODE)


def prepare(raw: DataFrame, config: ForecastConfig) -> Splits:
    """Test and training panels. The history carries its sale numbers, so this shuffles only to mark keys."""
    numbered = raw.withColumnRenamed(SALE_NUMBER, "total_sales")
    return split_panel(numbered, config.calendar, KEY, config.tenure, year_built="YearBuilt")


def train_models(splits: Splits, dictionary: DataFrame, config: ForecastConfig) -> dict[str, object]:
    """Both models, trained side by side and saved by label."""
    jobs = {
        LABEL: (splits.train, SALE_FEATURES, "classifier"),
        PRICE_LABEL: (splits.train_price, PRICE_FEATURES, "regressor"),
    }

    def fit(label: str):
        panel, features, kind = jobs[label]
        columns = coded(features)
        rows = modelling_rows(encoded_categories(panel, dictionary), label, columns, date="date")
        folded = with_fold(rows, "date", config.folds)
        model = train(
            folded, columns, label, kind, config.folds, "fold", config.grid, config.max_iter
        )
        save_model(model, config.model_path(label), columns, dictionary)
        return model

    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return dict(zip(jobs, pool.map(fit, jobs)))


def evaluate(splits: Splits, dictionary: DataFrame, models: dict, config: ForecastConfig) -> dict[str, DataFrame]:
    """Metric tables of both models, on the training and the test rows."""
    result = {}
    sale_columns, price_columns = coded(SALE_FEATURES), coded(PRICE_FEATURES)
    both = [*sale_columns, *price_columns]  # test rows are distinct over the features of both models
    panels = {
        "train": (splits.train, sale_columns, splits.train_price, price_columns),
        "test": (splits.test, both, splits.test, both),
    }
    for name, (sale_panel, sale_kept, price_panel, price_kept) in panels.items():
        rows = modelling_rows(encoded_categories(sale_panel, dictionary), LABEL, sale_kept)
        scored = score.score_sales(rows, models[LABEL], sale_columns)
        scored = checkpointed(scored.select(LABEL, score.SCORE))  # scored once for all tables below
        hard = scored.withColumn("predicted", (F.col(score.SCORE) > config.threshold).cast("int"))
        result[f"{name}_balance"] = label_balance(scored, LABEL)
        result[f"{name}_classification"] = metrics.classification_metrics(hard, LABEL, "predicted")
        result[f"{name}_report"] = metrics.class_report(hard, LABEL, "predicted")
        result[f"{name}_crosstab"] = metrics.crosstab(hard, LABEL, "predicted")
        result[f"{name}_thresholds"] = metrics.threshold_sweep(scored, LABEL, score.SCORE)
        result[f"{name}_scores"] = metrics.score_metrics(scored, LABEL, score.SCORE)
        sold = modelling_rows(encoded_categories(price_panel, dictionary), PRICE_LABEL, price_kept)
        priced = score.score_prices(sold.where(F.col(LABEL) == 1), models[PRICE_LABEL], price_columns)
        result[f"{name}_regression"] = metrics.regression_metrics(priced, PRICE_LABEL, score.PRICE)
    return result


def publish(df: DataFrame, calendar: RunCalendar, updated_at: Column | None = None) -> DataFrame:
    """Predictions under their published names, with the predicted period."""
    dated = df.withColumns(
        {
            "prediction_period_start": F.lit(calendar.prediction_start),
            "prediction_period_end": F.lit(calendar.prediction_end),
            "updated_at": F.current_timestamp() if updated_at is None else updated_at,
        }
    )
    return dated.select(*[F.col(c).alias(name) for c, name in PUBLISHED.items()])


def scored_parcels(raw: DataFrame, dictionary: DataFrame, classifier, config: ForecastConfig) -> DataFrame:
    """Current state of every parcel that is held long enough, with its sale probability."""
    snapshot = current_snapshot(
        raw.drop(SALE_NUMBER),
        KEY,
        "last_sale_date",
        config.calendar,
        year_built="YearBuilt",
        min_tenure_years=config.tenure[0],
    )
    return score.score_sales(encoded_categories(snapshot, dictionary), classifier, coded(SALE_FEATURES))


def predict(scored: DataFrame, regressor, config: ForecastConfig) -> DataFrame:
    """Published predictions for the parcels that are likely to sell."""
    likely = score.likely(scored, config.threshold)
    return publish(score.score_prices(likely, regressor, coded(PRICE_FEATURES), config.interval), config.calendar)


def save_predictions(spark: SparkSession, predictions: DataFrame, config: ForecastConfig) -> Merge | None:
    """Run output as Parquet and JSON, then into the prediction table, of which only the predicted period is touched."""
    output = config.etl.path("4-predictions")
    stages.write_stage(predictions, output)
    saved = spark.read.parquet(output)
    stages.write_json(saved, config.etl.path("4-predictions-json"))
    merge = config.etl.predictions.merge(saved.select(*PUBLISHED.values()), PREDICTION_KEYS)
    log.info("predictions: %s", merge.counts if merge else {})
    return merge


def run(spark: SparkSession, config: ForecastConfig) -> DataFrame:
    """Train, evaluate, predict and save; returns the prediction table."""
    raw = spark.read.parquet(config.etl.path("1-raw"))
    dictionary = spark.read.parquet(config.etl.path("2-dictionary"))
    fresh = prepare(raw, config)
    splits = Splits(
        test=stages.stage(spark, config.prepared("test"), lambda: fresh.test),
        train=stages.stage(spark, config.prepared("train"), lambda: fresh.train),
    )
    train_models(splits, dictionary, config)
    columns = {LABEL: coded(SALE_FEATURES), PRICE_LABEL: coded(PRICE_FEATURES)}
    models = {label: load_model(config.model_path(label), columns[label], dictionary) for label in columns}
    for name, table in evaluate(splits, dictionary, models, config).items():
        log.info("%s: %s", name, [r.asDict() for r in table.collect()])
    scored = checkpointed(scored_parcels(raw, dictionary, models[LABEL], config))
    counts = metrics.threshold_counts(scored, score.SCORE)
    log.info("likely parcels: %s", [r.asDict() for r in counts.collect()])
    save_predictions(spark, predict(scored, models[PRICE_LABEL], config), config)
    table = config.etl.predictions.read(spark)
    return spark.read.parquet(config.etl.path("4-predictions")) if table is None else table

