"""Both jobs from landed files to the prediction table."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from landing import sample_parcels, write_landing
from pyspark.sql import functions as F

from parcelflow import stages
from parcelflow.__main__ import parse
from parcelflow.checkpoints import checkpointed
from parcelflow.ml import score
from parcelflow.operators.splits import LABEL
from parcelflow.plans import etl, explore, forecast

D = dt.date
RUN, AS_OF = D(2022, 3, 1), D(2022, 12, 1)


@pytest.fixture(scope="module")
def config(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    config = etl.EtlConfig(str(root), "ohio", RUN, AS_OF)
    write_landing(Path(config.landing), sample_parcels())
    return config


@pytest.fixture(scope="module")
def raw(spark, config):
    return etl.run(spark, config)


@pytest.fixture(scope="module")
def published(spark, config, raw):
    settings = forecast.ForecastConfig(config, threshold=0.0, folds=2, max_iter=2, grid=[{"maxDepth": 2}])
    return checkpointed(forecast.run(spark, settings))


def test_history(spark, config, raw):
    assert raw.columns == [*etl.RAW_COLUMNS, etl.SALE_NUMBER]
    parcels = {p.key: p for p in sample_parcels()}
    one = next(p for p in parcels.values() if p.number == 1 and p.county == "ohio-butler")
    rows = raw.where(F.col("Parid") == one.key).orderBy("last_sale_date").collect()
    assert [r["last_sale_date"] for r in rows] == [D(one.built, 1, 1), one.assessed, one.sales[0][0]]
    assert [r["last_sale_price"] for r in rows] == [None, 90_000.0, one.sales[0][1]]
    assert [r["PartyOwner1NameFull"] for r in rows] == [None, None, "Owner Number1 Llc"]
    assert [r["same_owner"] for r in rows] == [0, 0, 0] and [r["next_good_sale"] for r in rows] == [1, 1, None]
    assert [r["sale_number"] for r in rows] == [1, 2, 3]
    assert rows[0]["PropertyAddressFull"] == "1 O'Neil St" and rows[0]["AreaBuildingRounded"] == 1500.0
    assert rows[2]["EstimatedValue"] == 210_001.0
    per_year = raw.groupBy("Parid", F.year("last_sale_date")).count()
    assert per_year.where("count > 1").count() == 0
    assert raw.select("Parid").distinct().count() == len(parcels)


def test_stages_are_reused(spark, config, raw):
    marker = Path(config.path("1-raw")) / "_SUCCESS"
    before = marker.stat().st_mtime_ns
    etl.raw_stage(spark, config)
    assert marker.stat().st_mtime_ns == before
    assert stages.is_complete(spark, config.path("2-dictionary"))


def test_another_as_of_builds_the_stage_again(spark, config, raw):
    later = etl.EtlConfig(config.root, config.state, config.run_date, D(2022, 12, 2))
    assert later.landing == config.landing and not stages.is_complete(spark, later.path("1-raw"))
    assert etl.raw_stage(spark, later).count() == raw.count()
    assert stages.is_complete(spark, later.path("1-raw"))
    wide, narrow = (forecast.ForecastConfig(config, tenure=t) for t in ((10, 20), (5, 20)))
    assert wide.prepared("test") != narrow.prepared("test") and wide.model_path("x") != narrow.model_path("x")


def test_predictions(spark, config, published):
    assert published.columns == list(forecast.PUBLISHED.values())
    assert published.count() == published.select(*etl.PREDICTION_KEYS).distinct().count() > 0
    first = published.first()
    assert (first["predictionPeriodStart"], first["predictionPeriodEnd"]) == (D(2022, 4, 1), D(2022, 6, 30))
    assert published.where("predictedSalePrice % 10000 <> 0 or lastSaleDate >= '2022-04-01'").count() == 0
    lines = spark.read.json(config.path("4-predictions-json"))
    assert lines.count() == published.count()


def test_saved_models_and_metrics(spark, config, published):
    settings = forecast.ForecastConfig(config)
    model = forecast.load_model(settings.model_path(LABEL))
    raw = spark.read.parquet(config.path("1-raw"))
    dictionary = spark.read.parquet(config.path("2-dictionary"))
    splits = forecast.prepare(raw, settings)
    price_model = forecast.load_model(settings.model_path("next_sale_price"))
    tables = forecast.evaluate(splits, dictionary, {LABEL: model, "next_sale_price": price_model}, settings)
    counts = tables["train_classification"].first()
    balance = tables["train_balance"].first()
    assert counts["tn"] + counts["fp"] + counts["fn"] + counts["tp"] == balance["total"] > 0
    assert tables["train_thresholds"].count() == 9
    assert tables["train_regression"].first()["n"] > 0
    assert score.THRESHOLD == 0.7


def test_rerun_replaces_the_period(spark, config, published):
    same = checkpointed(spark.read.parquet(config.path("4-predictions")))
    again = forecast.save_predictions(spark, same, forecast.ForecastConfig(config))
    assert again.counts == {"inserted": 0, "updated": same.count(), "kept": 0}
    assert config.predictions.read(spark).count() == published.count()


def test_later_sales_fill_open_predictions(spark, config, published):
    late = etl.EtlConfig(config.root, "ohio", D(2022, 9, 1), D(2022, 12, 1))
    parcels = sample_parcels()
    sold = next(p for p in parcels if p.number == 2 and p.county == "ohio-clermont")
    sold.sales.append((D(2022, 5, 17), 333_000.0))
    write_landing(Path(late.landing), parcels)
    before = late.predictions.manifest(spark)
    raw = etl.run(spark, late)
    current = late.predictions.read(spark)
    assert late.predictions.manifest(spark).version == before.version + 1
    assert etl.backfill(spark, late, raw) is None  # nothing has happened since, so nothing is written
    assert current.count() == published.count()
    filled = current.where("actualSaleDate is not null and parcel = '%s'" % sold.key).collect()
    assert [(r["actualSaleDate"], r["actualSalePrice"]) for r in filled] == [(D(2022, 5, 17), 333_000.0)]
    others = current.where(F.col("parcel") != sold.key)
    assert others.where("actualSaleDate is not null").count() == published.where(
        (F.col("parcel") != sold.key) & F.col("actualSaleDate").isNotNull()
    ).count()


def test_exploration(spark, config, published):
    train = spark.read.parquet(forecast.ForecastConfig(config).prepared("train"))
    profiles = explore.describe(train.select("total_sales", "AreaBuilding", "PropertyUseGroup"))
    assert {r["column"] for r in profiles["numeric"].collect()} == {"total_sales", "AreaBuilding"}
    assert profiles["text"].first()["top"] in ("Condo", "Residential")
    rows = explore.label_correlations(train.select(LABEL, "sale_in_6_months", "AreaBuilding", "month")).collect()
    with_self = {r["column"]: r["correlation"] for r in rows if r["other"] == LABEL}
    assert with_self[LABEL] == 1.0 and with_self["sale_in_6_months"] > 0.3
    model = forecast.load_model(forecast.ForecastConfig(config).model_path(LABEL))
    dictionary = spark.read.parquet(config.path("2-dictionary"))
    ranked = explore.sale_importance(train, dictionary, model).collect()
    assert [r["feature"] for r in ranked] and len(ranked) == len(forecast.SALE_FEATURES)


def test_command_line():
    options = parse(["etl", "--root", "/x", "--run-date", "2022-03-01"])
    assert (options.job, options.state, options.run_date, options.as_of) == ("etl", "ohio", RUN, None)
