"""County sale files, brought to common columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.functions import dates, numbers, text
from parcelflow.operators.dedup import first_by, first_per_key_date, latest_per_key
from parcelflow.operators.joins import members, positive
from parcelflow.sources import layouts
from parcelflow.sources.delimited import read_headerless, read_with_header, stack_formats, without_repeated_headers
from parcelflow.sources.fixed_width import read_fixed_width

# The columns of the two transfer file formats, by position.
TRANSFER_COLUMNS_NEW = (
    "Book", "Plat", "Parcel", "ParcelID", "Tax District", "Owner Name 1", "Owner Name 2", "Land Value",
    "Building Value", "Property Class", "House #", "Street Name", "Street Suffix", "Zip Code", "Month of Sale",
    "Day of Sale", "Year of Sale", "# of Parcels Sold", "Sale Price", "ValidSale", "Conveyance #", "DeedType",
    "Appraisal Area", "PriorOwner", "PropertyNumber",
)
TRANSFER_COLUMNS_OLD = (
    "Book", "Plat", "Parcel", "ParcelID", "Tax District", "Owner Name 1", "Owner Name 2", "Land Value",
    "Building Value", "Property Class", "House #", "Street Name", "Street Suffix", "Month of Sale",
    "Day of Sale", "Year of Sale", "# of Parcels Sold", "Sale Price", "ValidSale", "Conveyance #", "DeedType",
)

# Columns of the rows that every county loader returns.
SALE_COLUMNS = (
    "Parid", "Year of Sale", "Month of Sale", "Day of Sale", "last_sale_price", "last_sale_date", "Owner Name 1",
    "DeedType", "ValidSale", "Sale Price", "Building Value", "Land Value", "Property Class",
)
ADDRESS_COLUMNS = ("House #", "Street Name", "Street Suffix", "Tax District")

_NUMBERS = {c: "double" for c in ("Sale Price", "Building Value", "Land Value")}
_DATE_PARTS = {c: "int" for c in ("Year of Sale", "Month of Sale", "Day of Sale")}


def cama_sales(sales: DataFrame, as_of: dt.date) -> DataFrame:
    """Sales with a positive price, their date read and their sale type coded."""
    return positive(sales, "Price").withColumns(
        {
            "last_sale_price": F.col("Price"),
            "last_sale_date": dates.parse_day_month_year("Saledt", F.lit(as_of)),
            "Saletype": numbers.sale_type_code("Saletype"),
        }
    )


def known_sales(parcels: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales of known parcels. A parcel without a sale has no price and would be dropped next."""
    return members(sales, parcels, ["Parid"])


def cama_rows(parcels: DataFrame, assessments: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales of known parcels, each beside every assessment of its parcel; the assessed columns may be missing."""
    assessed = assessments.select("Parid", "Aprland", "Aprbldg", F.col("Class").alias("Class_asmt"))
    rows = known_sales(parcels, sales).join(assessed, "Parid", "left")
    renamed = rows.withColumnsRenamed(
        {
            "Own1": "Owner Name 1",
            "Saletype": "DeedType",
            "Saleval": "ValidSale",
            "Price": "Sale Price",
            "Aprbldg": "Building Value",
            "Aprland": "Land Value",
            "Class_asmt": "Property Class",
        }
    )
    parts = {
        "Year of Sale": F.year("last_sale_date"),
        "Month of Sale": F.month("last_sale_date"),
        "Day of Sale": F.dayofmonth("last_sale_date"),
    }
    return renamed.withColumns(parts).select(*SALE_COLUMNS)


def _cama_sales_files(spark: SparkSession, directory: str, as_of: dt.date) -> tuple[DataFrame, DataFrame]:
    parcels = read_fixed_width(spark, f"{directory}/PARDAT.DAT", layouts.PARCEL, columns=["Parid"])
    return parcels, cama_sales(read_fixed_width(spark, f"{directory}/SALES.DAT", layouts.SALES), as_of)


def read_cama(spark: SparkSession, directory: str, as_of: dt.date) -> DataFrame:
    """Sales and assessments of a county that publishes fixed-width tax files."""
    parcels, sales = _cama_sales_files(spark, directory, as_of)
    return cama_rows(parcels, read_fixed_width(spark, f"{directory}/ASMT.DAT", layouts.ASSESSMENT), sales)


def read_cama_sales(spark: SparkSession, directory: str, as_of: dt.date) -> DataFrame:
    """Parcel, date and price of the sales of such a county, each sale once; the assessment file is not needed."""
    return known_sales(*_cama_sales_files(spark, directory, as_of)).select("Parid", "last_sale_date", "last_sale_price")


def read_dwellings(spark: SparkSession, directory: str, county: str) -> DataFrame:
    """Stories, year built and living area per dwelling; the layout depends on the county."""
    rows = read_fixed_width(spark, f"{directory}/DWELL.DAT", layouts.DWELLING[county])
    return rows.select("Parid", "Stories", F.col("Yrblt").alias("Year Built"), "Sfla")


def read_legal(spark: SparkSession, directory: str) -> DataFrame:
    return read_fixed_width(spark, f"{directory}/LEGDAT.DAT", layouts.LEGAL)


def transfer_rows(transfers: DataFrame) -> DataFrame:
    """Transfers with a parcel key, a date and a price."""
    rows = without_repeated_headers(transfers, "Book", "book")
    key = text.build_key([("Book", 3), ("Plat", 4), ("Parcel", 4), ("ParcelID", 2)])
    year = dates.four_digit_year("Year of Sale")
    return rows.withColumns(
        {
            "Parid": key,
            "Year of Sale": year,
            "last_sale_price": F.col("Sale Price"),
            "last_sale_date": dates.date_from_parts(year, "Month of Sale", "Day of Sale"),
        }
    ).select(*SALE_COLUMNS, *ADDRESS_COLUMNS)


def historic_rows(sheet: DataFrame) -> DataFrame:
    """The sheet of historic sales under the common column names; columns it lacks are missing."""
    missing_number, missing_int = F.lit(None).cast("double"), F.lit(None).cast("int")
    return sheet.select(
        F.col("parcel_number").alias("Parid"),
        missing_int.alias("Year of Sale"),
        missing_int.alias("Month of Sale"),
        missing_int.alias("Day of Sale"),
        F.col("sale_price").alias("last_sale_price"),
        F.col("date_of_sale").alias("last_sale_date"),
        F.col("owner_name_1").alias("Owner Name 1"),
        text.first_token("instrument_type").alias("DeedType"),
        F.lit("Y").alias("ValidSale"),
        F.col("sale_price").alias("Sale Price"),
        missing_number.alias("Building Value"),
        missing_number.alias("Land Value"),
        F.col("use_code").alias("Property Class"),
        F.col("house_number").alias("House #"),
        F.col("street_name").alias("Street Name"),
        F.col("street_suffix").alias("Street Suffix"),
        F.lit(None).cast("string").alias("Tax District"),
    )


def building_rows(sheet: DataFrame) -> DataFrame:
    """Living area (missing if any floor is), stories and year built, one row per parcel."""
    rows = sheet.select(
        F.col("PARCELID").alias("Parid"),
        numbers.sum_parts("SQFT_FLR1", "SQFT_FLR2", "SQFT_FLRH").alias("Livable Sqft"),
        F.col("STORYHT").alias("Stories"),
        F.col("YEARBUILT").alias("Year Built"),
    )
    return first_by(rows, ["Parid"], [F.desc_nulls_last(c) for c in ("Livable Sqft", "Stories", "Year Built")])


def sales_with_buildings(sales: DataFrame, buildings: DataFrame) -> DataFrame:
    """First priced sale per parcel and day, for every parcel of the building sheet.

    After the reduction a parcel has at most one row per day, so the outer join meets no large group.
    """
    tiebreak = ["last_sale_price", "Owner Name 1", "DeedType", "ValidSale", "Building Value", "Land Value"]
    daily = first_per_key_date(positive(sales, "last_sale_price"), ["Parid"], "last_sale_date", tiebreak)
    return daily.join(buildings, "Parid", "right")


HISTORIC_TYPES = {
    "parcel_number": "string", "owner_name_1": "string", "house_number": "string", "street_name": "string",
    "street_suffix": "string", "instrument_type": "string", "use_code": "string", "sale_price": "double",
    "date_of_sale": "date",
}
BUILDING_TYPES = {
    "PARCELID": "string", "SQFT_FLR1": "double", "SQFT_FLR2": "double", "SQFT_FLRH": "double", "STORYHT": "double",
    "YEARBUILT": "int",
}


def read_transfers(spark: SparkSession, directory: str) -> DataFrame:
    """Sales of a county that publishes yearly transfer files and two sheets (landed as CSV)."""
    types = {**_NUMBERS, **_DATE_PARTS}
    formats = [
        read_headerless(spark, f"{directory}/{folder}/*.csv", columns, types)
        for folder, columns in (("new-format", TRANSFER_COLUMNS_NEW), ("old-format", TRANSFER_COLUMNS_OLD))
    ]
    historic = read_with_header(spark, f"{directory}/HistoricSalesExport.csv", HISTORIC_TYPES, separator=",")
    buildings = read_with_header(spark, f"{directory}/bldginfo.csv", BUILDING_TYPES, separator=",")
    sales = stack_formats([transfer_rows(stack_formats(formats)), historic_rows(historic)])
    return sales_with_buildings(sales, building_rows(buildings))


# Supported counties per state.
STATE_COUNTIES = {"ohio": ("ohio-butler", "ohio-clermont", "ohio-hamilton")}

Loader = Callable[[SparkSession, str, dt.date], DataFrame]

LOADERS: Mapping[str, Loader] = {
    "ohio-butler": read_cama,
    "ohio-clermont": read_cama,
    "ohio-hamilton": lambda spark, directory, as_of: read_transfers(spark, directory),
}
SALE_LOADERS: Mapping[str, Loader] = {**LOADERS, "ohio-butler": read_cama_sales, "ohio-clermont": read_cama_sales}


def tag_county(df: DataFrame, county: str) -> DataFrame:
    """State and county names from the parts of the county id."""
    identifier = F.lit(county)
    return df.withColumns(
        {
            "State": text.title_case(text.id_part(identifier, 1)),
            "County": text.title_case(text.id_part(identifier, 2)),
        }
    )


def load_county(
    spark: SparkSession, county: str, directory: str, as_of: dt.date, loaders: Mapping[str, Loader] = LOADERS
) -> DataFrame:
    if county not in loaders:
        raise ValueError(f"unknown county {county}")
    return tag_county(loaders[county](spark, directory, as_of), county)


def stacked_counties(
    spark: SparkSession, state: str, landing: str, as_of: dt.date, loaders: Mapping[str, Loader] = LOADERS
) -> DataFrame:
    """All rows of all counties of a state."""
    return stack_formats([load_county(spark, c, f"{landing}/{c}", as_of, loaders) for c in STATE_COUNTIES[state]])


def stacked_sales(spark: SparkSession, state: str, landing: str, as_of: dt.date) -> DataFrame:
    """Parcel, date and price of the sales of all counties: what the history is built from."""
    rows = stacked_counties(spark, state, landing, as_of, SALE_LOADERS)
    return rows.select("Parid", "last_sale_date", "last_sale_price", "State", "County")


def load_state(spark: SparkSession, state: str, landing: str, as_of: dt.date) -> DataFrame:
    """Distinct priced rows of all counties of a state."""
    return positive(stacked_counties(spark, state, landing, as_of).distinct(), "last_sale_price")


# Our choice of types for the assessor and valuation files, which declare none.
ASSESSOR_TYPES = {
    "source_id": "string", "ParcelNumberRaw": "string", "AssrLastUpdated": "date", "AssessorLastSaleDate": "date",
    "AssessorLastSaleAmount": "double", "YearBuilt": "int", "PropertyAddressFull": "string",
    "PropertyAddressCity": "string", "PropertyAddressZIP": "string", "SitusCounty": "string",
    "SitusStateCode": "string", "NeighborhoodCode": "string", "PropertyLatitude": "double",
    "PropertyLongitude": "double", "CompanyFlag": "string", "OwnerTypeDescription1": "string",
    "PartyOwner1NameFull": "string", "PropertyUseGroup": "string", "BathCount": "double",
    "BathPartialCount": "double", "BedroomsCount": "double", "AreaBuilding": "double", "AreaLotSF": "double",
    "StoriesCount": "double", "TaxMarketValueLand": "double", "TaxMarketValueImprovements": "double",
    "TaxMarketValueTotal": "double",
}
VALUATION_TYPES = {
    "source_id": "string", "LastUpdateDate": "date", "ValuationDate": "date", "EstimatedValue": "double",
    "ConfidenceScore": "double",
}


def read_assessor(spark: SparkSession, landing: str) -> DataFrame:
    """Latest assessor row per source id."""
    rows = read_with_header(spark, f"{landing}/source", ASSESSOR_TYPES, "*ASSESSOR*.txt")
    return latest_per_key(rows, ["source_id"], "AssrLastUpdated", [c for c in ASSESSOR_TYPES if c != "source_id"])


def read_valuations(spark: SparkSession, landing: str) -> DataFrame:
    """Latest valuation per source id."""
    rows = read_with_header(spark, f"{landing}/source", VALUATION_TYPES, "*AVM*.txt")
    return latest_per_key(rows, ["source_id"], "LastUpdateDate", ["ValuationDate", "EstimatedValue", "ConfidenceScore"])
