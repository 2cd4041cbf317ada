"""Landed-file formats, written from the tables and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.queries.registry import Tables, query
from parcelflow.sources import counties, delimited, fixed_width
from parcelflow.sources.layouts import Field, layout

LINE_LAYOUT = layout(
    "l_orderkey 12 l_partkey 10 unused 0 l_linenumber 3 l_extendedprice 14 l_quantity 6 l_returnflag 2 l_shipdate 10",
    types={"l_orderkey": "long", "l_partkey": "long", "l_linenumber": "int", "l_extendedprice": "double",
           "l_quantity": "double"},
)


def written_line(fields: list[Field]):
    """Columns padded to their widths, one text per row."""
    return F.concat(*[F.rpad(F.coalesce(F.col(f.name).cast("string"), F.lit("")), f.width, " ") for f in fields if f.width])


@query(
    "fixed_width_parse",
    """
    SELECT l_orderkey, l_partkey, CAST(NULL AS VARCHAR) AS unused, l_linenumber, l_extendedprice, l_quantity,
           nullif(l_returnflag, 'N') AS l_returnflag, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate
    FROM lineitem
    """,
)
def fixed_width_parse(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("N")))
    written = lines.select(written_line(LINE_LAYOUT).alias("line"))
    return fixed_width.cut_fields(written, "line", LINE_LAYOUT)


@query(
    "delimited_parse",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
           o_orderpriority
    FROM orders
    """,
)
def delimited_parse(t: Tables) -> DataFrame:
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    rows = t.orders.select(F.concat_ws("\t", *names).alias("line"))
    header = t.orders.agg(F.lit("\t".join(names)).alias("line"))  # a header line among the data
    cut = delimited.cut_columns(header.unionByName(rows), "line", names, "\t")
    kept = delimited.without_repeated_headers(cut, "o_orderkey", "ORDERKEY")
    types = {"o_orderkey": "long", "o_custkey": "long", "o_orderstatus": "string", "o_totalprice": "double",
             "o_orderdate": "date", "o_orderpriority": "string"}
    return delimited.with_types(kept, types)


@query(
    "transfer_sales",
    """
    SELECT lpad(CAST(l_suppkey AS VARCHAR), 3, '0') ||
           CASE WHEN length(CAST(l_partkey AS VARCHAR)) < 4 THEN lpad(CAST(l_partkey AS VARCHAR), 4, '0')
                ELSE CAST(l_partkey AS VARCHAR) END ||
           lpad(CAST(l_linenumber AS VARCHAR), 4, '0') || '00' AS parid,
           l_orderkey AS conveyance, l_extendedprice AS price, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS sold,
           year(l_shipdate) AS sale_year, l_returnflag AS valid
    FROM lineitem
    """,
)
def transfer_sales(t: Tables) -> DataFrame:
    year = F.year("l_shipdate")
    short_year = F.when(year.isin(1998, 1999), year - 1900).otherwise(year)
    transfers = t.lineitem.select(
        F.col("l_suppkey").cast("string").alias("Book"),
        F.col("l_partkey").cast("string").alias("Plat"),
        F.col("l_linenumber").cast("string").alias("Parcel"),
        F.lit("0").alias("ParcelID"),
        F.col("l_extendedprice").alias("Sale Price"),
        short_year.alias("Year of Sale"),
        F.month("l_shipdate").alias("Month of Sale"),
        F.day("l_shipdate").alias("Day of Sale"),
        F.col("l_returnflag").alias("ValidSale"),
        F.col("l_orderkey").cast("string").alias("Owner Name 1"),
        *[F.lit(None).cast("string").alias(c) for c in ("DeedType", "Property Class", *counties.ADDRESS_COLUMNS)],
        *[F.lit(None).cast("double").alias(c) for c in ("Building Value", "Land Value")],
    )
    return counties.transfer_rows(transfers).select(
        F.col("Parid").alias("parid"),
        F.col("Owner Name 1").cast("long").alias("conveyance"),
        F.col("last_sale_price").alias("price"),
        F.col("last_sale_date").alias("sold"),
        F.col("Year of Sale").alias("sale_year"),
        F.col("ValidSale").alias("valid"),
    )


@query(
    "historic_sheet",
    """
    SELECT 'P' || CAST(o_custkey AS VARCHAR) AS parid, o_totalprice AS price,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS sold, split_part(o_orderpriority, ' ', 1) AS deed, 'Y' AS valid
    FROM orders
    """,
)
def historic_sheet(t: Tables) -> DataFrame:
    sheet = t.orders.select(
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("parcel_number"),
        F.col("o_totalprice").alias("sale_price"),
        F.col("o_orderdate").alias("date_of_sale"),
        F.col("o_orderpriority").alias("instrument_type"),
        *[
            F.col("o_orderstatus").alias(c)
            for c in ("owner_name_1", "use_code", "house_number", "street_name", "street_suffix")
        ],
    )
    return counties.historic_rows(sheet).select(
        F.col("Parid").alias("parid"),
        F.col("last_sale_price").alias("price"),
        F.col("last_sale_date").alias("sold"),
        F.col("DeedType").alias("deed"),
        F.col("ValidSale").alias("valid"),
    )


@query(
    "building_info",
    """
    WITH sheet AS (
        SELECT p_brand, p_size + p_retailprice + nullif(p_size, 1) AS sqft, p_size AS stories, 1900 + p_size AS built
        FROM part),
    best AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY sqft DESC NULLS LAST, stories DESC, built DESC) AS rn
             FROM sheet)
    SELECT p_brand AS parid, sqft, CAST(stories AS DOUBLE) AS stories, built FROM best WHERE rn = 1
    """,
)
def building_info(t: Tables) -> DataFrame:
    sheet = t.part.select(
        F.col("p_brand").alias("PARCELID"),
        F.col("p_size").cast("double").alias("SQFT_FLR1"),
        F.col("p_retailprice").alias("SQFT_FLR2"),
        F.nullif("p_size", F.lit(1)).cast("double").alias("SQFT_FLRH"),
        F.col("p_size").cast("double").alias("STORYHT"),
        (F.col("p_size") + 1900).alias("YEARBUILT"),
    )
    return counties.building_rows(sheet).select(
        F.col("Parid").alias("parid"),
        F.col("Livable Sqft").alias("sqft"),
        F.col("Stories").alias("stories"),
        F.col("Year Built").alias("built"),
    )


@query(
    "cama_sales",
    """
    WITH assessed AS (
        SELECT l_partkey, max(l_extendedprice) AS l_extendedprice, max(l_quantity) AS l_quantity,
               max(l_returnflag) AS l_returnflag
        FROM lineitem GROUP BY l_partkey, year(l_shipdate))
    SELECT CAST(s.l_partkey AS VARCHAR) AS parid, s.l_orderkey AS owner, s.l_extendedprice AS price,
           CAST(CAST(s.l_shipdate AS DATE) AS VARCHAR) AS sold, year(s.l_shipdate) AS sale_year,
           CASE s.l_linestatus WHEN 'O' THEN '0' ELSE s.l_linestatus END AS deed,
           a.l_extendedprice AS building_value, a.l_quantity AS land_value, a.l_returnflag AS class
    FROM lineitem s JOIN part ON p_partkey = s.l_partkey LEFT JOIN assessed a ON a.l_partkey = s.l_partkey
    WHERE s.l_extendedprice > 0
    """,
)
def cama_sales(t: Tables) -> DataFrame:
    parid = F.col("l_partkey").cast("string").alias("Parid")
    parcels = t.part.select(F.col("p_partkey").cast("string").alias("Parid"))
    assessments = t.lineitem.groupBy(parid, F.year("l_shipdate").alias("Taxyr")).agg(
        F.max("l_extendedprice").alias("Aprbldg"),
        F.max("l_quantity").alias("Aprland"),
        F.max("l_returnflag").alias("Class"),
    )
    sales = t.lineitem.select(
        parid,
        F.col("l_orderkey").alias("Own1"),
        F.col("l_extendedprice").alias("Price"),
        F.date_format("l_shipdate", "dd-MMM-yy").alias("Saledt"),
        F.nullif("l_linestatus", F.lit("O")).alias("Saletype"),
        F.col("l_returnflag").alias("Saleval"),
    )
    rows = counties.cama_rows(parcels, assessments, counties.cama_sales(sales, dt.date(2002, 1, 1)))
    return rows.select(
        F.col("Parid").alias("parid"),
        F.col("Owner Name 1").alias("owner"),
        F.col("Sale Price").alias("price"),
        F.col("last_sale_date").alias("sold"),
        F.col("Year of Sale").alias("sale_year"),
        F.col("DeedType").alias("deed"),
        F.col("Building Value").alias("building_value"),
        F.col("Land Value").alias("land_value"),
        F.col("Property Class").alias("class"),
    )


@query(
    "tagged_counties",
    """
    SELECT DISTINCT 'Ohio' AS "State", 'Butler' AS "County", c_nationkey AS nation FROM customer
    UNION ALL
    SELECT DISTINCT 'Ohio', 'Clermont', s_nationkey FROM supplier
    """,
)
def tagged_counties(t: Tables) -> DataFrame:
    first = counties.tag_county(t.customer.select(F.col("c_nationkey").alias("nation")), "ohio-butler")
    second = counties.tag_county(t.supplier.select(F.col("s_nationkey").alias("nation")), "ohio-clermont")
    return delimited.stack_formats([first, second]).distinct()
