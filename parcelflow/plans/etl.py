"""History job: landed files to the linked history of every parcel, its dictionary, and filled predictions."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import stages
from parcelflow.functions.dates import january_first
from parcelflow.functions.numbers import positive_or_null
from parcelflow.functions.text import title_case
from parcelflow.operators import enrich, history
from parcelflow.operators.aggregates import stage_counts
from parcelflow.operators.backfill import backfill_actuals, is_open
from parcelflow.operators.dedup import last_per_period
from parcelflow.operators.encode import fit_ordinal
from parcelflow.operators.joins import positive
from parcelflow.periods import Merge, PeriodTable
from parcelflow.sources import counties

log = logging.getLogger(__name__)

KEY = ("Parid",)

# Text columns shown in title case.
TITLE_COLUMNS = (
    "PropertyAddressFull", "PropertyAddressCity", "CompanyFlag", "OwnerTypeDescription1", "PartyOwner1NameFull",
    "PropertyUseGroup",
)

# Rounding base per column.
ROUNDING = {
    "YearBuilt": 10,
    "AreaBuilding": 500,
    "AreaLotSF": 5000,
    "last_sale_price": 25000,
    "TaxMarketValueLand": 25000,
    "TaxMarketValueImprovements": 25000,
    "TaxMarketValueTotal": 25000,
    "EstimatedValue": 25000,
}

# Columns that are unknown for a derived earlier sale.
BLANK_COLUMNS = (
    "AssessorLastSaleDate", "AssessorLastSaleAmount", "CompanyFlag", "OwnerTypeDescription1", "PartyOwner1NameFull",
    "ValuationDate", "last_sale_priceRounded",
)

# Columns that must be positive in the finished history.
POSITIVE_COLUMNS = ("BathCount", "BedroomsCount", "AreaBuilding", "AreaLotSF", "StoriesCount")

# Columns of the finished history.
RAW_COLUMNS = (
    "Parid", "YearBuilt", "PropertyAddressFull", "PropertyAddressCity", "PropertyAddressZIP", "SitusCounty",
    "SitusStateCode", "NeighborhoodCode", "PropertyLatitude", "PropertyLongitude", "PartyOwner1NameFull",
    "CompanyFlag", "OwnerTypeDescription1", "PropertyUseGroup", "BathCount", "BathPartialCount", "BedroomsCount",
    "AreaBuilding", "AreaLotSF", "StoriesCount", "TaxMarketValueLand", "TaxMarketValueImprovements",
    "TaxMarketValueTotal", "ValuationDate", "EstimatedValue", "ConfidenceScore", "YearBuiltRounded",
    "AreaBuildingRounded", "AreaLotSFRounded", "TaxMarketValueLandRounded", "TaxMarketValueImprovementsRounded",
    "TaxMarketValueTotalRounded", "EstimatedValueRounded", "last_sale_priceRounded", "business_owner",
    "next_business_owner", "same_owner", "next_same_owner", "good_sale", "next_good_sale", "last_sale_date",
    "last_sale_price", "next_sale_date", "next_sale_price",
)

# Running number of the sale in its parcel, added because the history is already grouped by parcel there.
SALE_NUMBER = "sale_number"

CATEGORIES = (
    "PropertyAddressCity", "SitusCounty", "SitusStateCode", "NeighborhoodCode", "CompanyFlag",
    "OwnerTypeDescription1", "PropertyUseGroup",
)


OPEN_COLUMNS = ("actualSaleDate", "actualSalePrice")
PERIOD = "predictionPeriodStart"


@dataclass(frozen=True)
class EtlConfig:
    root: str  # folder of all stages, on storage that the whole cluster sees
    state: str
    run_date: dt.date
    as_of: dt.date

    def path(self, stage_name: str) -> str:
        """Folder of a computed stage. It names ``as_of``, so a stage is reused only under the same one."""
        return f"{self.root}/etl/{self.run_date}/{self.state}/as_of={self.as_of}/{stage_name}"

    @property
    def landing(self) -> str:
        return f"{self.root}/etl/{self.run_date}/{self.state}/0-landing"

    @property
    def predictions(self) -> PeriodTable:
        return PeriodTable(f"{self.root}/predictions/{self.state}", PERIOD, is_open(OPEN_COLUMNS))


def build_history(sales: DataFrame, assessor: DataFrame, valuations: DataFrame) -> DataFrame:
    """Linked history from county sales, latest assessor rows and latest valuations.

    Sales are reduced to the last one per parcel and year before anything is joined to them. This also
    removes exact copies, and bounds every later group of a parcel by the number of years.
    """
    priced = positive(sales, "last_sale_price").where(F.col("Parid").isNotNull())
    yearly = last_per_period(priced, KEY, "last_sale_date", "year", ["last_sale_price"])
    yearly = yearly.select("Parid", "last_sale_date", "last_sale_price")
    attributes = enrich.assessor_with_valuation(assessor, valuations)
    order = ["AssrLastUpdated", "AssessorLastSaleDate", "source_id"]
    joined = enrich.attach_by_normalized_id(yearly, attributes, "Parid", "ParcelNumberRaw", order)
    titled = joined.withColumns({c: title_case(c) for c in TITLE_COLUMNS})
    rounded = enrich.round_columns(titled, ROUNDING)
    full = history.synthetic_history(
        rounded,
        KEY,
        "last_sale_date",
        "last_sale_price",
        [
            history.Branch(january_first("YearBuilt"), F.lit(None)),
            history.Branch(F.col("AssessorLastSaleDate"), positive_or_null("AssessorLastSaleAmount")),
        ],
        BLANK_COLUMNS,
    )
    sane = full.where(
        history.history_is_sane(
            "last_sale_price", "last_sale_date", "YearBuilt", "PropertyAddressFull", "TaxMarketValueTotal",
            "TaxMarketValueTotalRounded",
        )
    )
    linked = history.sale_chain(sane, KEY, "last_sale_date", "PartyOwner1NameFull", "last_sale_price")
    homes = linked.where(history.all_positive(POSITIVE_COLUMNS))
    numbered = history.with_sale_number(homes, KEY, "last_sale_date", name=SALE_NUMBER)
    return numbered.select(*RAW_COLUMNS, SALE_NUMBER)


def raw_stage(spark: SparkSession, config: EtlConfig) -> DataFrame:
    def build() -> DataFrame:
        sales = counties.stacked_sales(spark, config.state, config.landing, config.as_of)
        assessor = counties.read_assessor(spark, config.landing)
        return build_history(sales, assessor, counties.read_valuations(spark, config.landing))

    return stages.stage(spark, config.path("1-raw"), build)


def dictionary_stage(spark: SparkSession, config: EtlConfig, raw: DataFrame) -> DataFrame:
    return stages.stage(spark, config.path("2-dictionary"), lambda: fit_ordinal(raw, CATEGORIES))


PREDICTION_KEYS = ("predictionPeriodStart", "predictionPeriodEnd", "parcel", "county", "state")
ACTUALS = {"actualSaleDate": "last_sale_date", "actualSalePrice": "last_sale_price", "goodSale": "good_sale"}


def filled_predictions(predictions: DataFrame, raw: DataFrame) -> DataFrame:
    """Open predictions whose sale has happened since, with the actual values."""
    events = raw.withColumnsRenamed({"Parid": "parcel", "SitusCounty": "county", "SitusStateCode": "state"})
    return backfill_actuals(
        predictions,
        events,
        ["parcel", "county", "state"],
        "predictionPeriodStart",
        "last_sale_date",
        "last_sale_price",
        ACTUALS,
        open_columns=OPEN_COLUMNS,
        tiebreak=["last_sale_price"],
        stamp=("updatedAt", F.current_timestamp()),
    )


def backfill(spark: SparkSession, config: EtlConfig, raw: DataFrame) -> Merge | None:
    """Fill known outcomes into the prediction table.

    Only periods that hold open predictions are read, and only those with a new outcome are written again.
    """
    pending = config.predictions.read(spark, open_only=True)
    if pending is None:
        return None
    merge = config.predictions.merge(filled_predictions(pending, raw), PREDICTION_KEYS, [*ACTUALS, "updatedAt"])
    log.info("open predictions: %s", merge.counts if merge else {})
    return merge


def run(spark: SparkSession, config: EtlConfig) -> DataFrame:
    """Raw history stage, dictionary stage and backfill; returns the raw history."""
    raw = raw_stage(spark, config)
    log.info("history: %s", stage_counts(raw, "Parid").first().asDict())
    dictionary_stage(spark, config, raw)
    backfill(spark, config, raw)
    return raw
