"""Files as they land: written from the tables to the shared folder, then read by the loaders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow import stages
from parcelflow.checkpoints import scratch_folder
from parcelflow.queries.files import written_line
from parcelflow.queries.registry import Tables, query
from parcelflow.sources import counties, delimited, layouts
from parcelflow.sources.layouts import Field

AS_OF = dt.date(2002, 1, 1)


def _csv(df: DataFrame, path: str, by: str | None = None, **options) -> None:
    """Quoted where needed, missing values empty, as the counties write them; a folder for each value of ``by``."""
    df.write.options(quote='"', escape='"', emptyValue="", nullValue="", **options).partitionBy(*[by] if by else []).csv(path)


@query(
    "headerless_files",
    """
    SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
           CASE WHEN year(o_orderdate) < 1998 THEN NULL ELSE o_totalprice END AS o_totalprice,
           o_orderpriority || ', "' || o_orderstatus || '"' AS note, year(o_orderdate) AS o_year
    FROM orders
    """,
)
def headerless_files(t: Tables) -> DataFrame:
    """Yearly files without a header in two formats, the older without a price; all years of a format are read at once."""
    orders = t.orders.select(
        "o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), "o_totalprice",
        F.concat("o_orderpriority", F.lit(', "'), "o_orderstatus", F.lit('"')).alias("note"), F.year("o_orderdate").alias("o_year"),
    )
    folder = scratch_folder(t.spark, "landing")
    new, old = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "note", "o_year"], ["o_year", "note", "o_orderkey", "o_custkey", "o_orderstatus"]
    types = {"o_orderkey": "long", "o_custkey": "long", "o_totalprice": "double", "o_year": "int"}
    frames = []
    for name, columns, rows in (("new", new, orders.where("o_year >= 1998")), ("old", old, orders.where("o_year < 1998"))):
        _csv(rows.select(*columns, F.col("o_year").alias("folder")), f"{folder}/{name}-format", by="folder")
        kept = {c: kind for c, kind in types.items() if c in columns}
        frames.append(delimited.read_headerless(t.spark, [f"{folder}/{name}-format/*"], columns, kept))
    return delimited.stack_formats(frames)


@query(
    "stacked_headers",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END AS l_extendedprice,
           CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate
    FROM lineitem
    """,
)
def stacked_headers(t: Tables) -> DataFrame:
    """Files with a header, columns in another order in each folder; one lacks the price and has a column nobody asks for."""
    folder = scratch_folder(t.spark, "landing")
    names = {
        "A": ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate"],
        "N": ["l_shipdate", "l_extendedprice", "l_partkey", "l_orderkey", "l_linenumber"],
        "R": ["l_comment", "l_partkey", "l_shipdate", "l_linenumber", "l_orderkey"],
    }
    lines = t.lineitem.withColumn("l_comment", F.lit('tab\tand "quotes"'))
    for flag, columns in names.items():
        _csv(lines.where(F.col("l_returnflag") == flag).select(columns), f"{folder}/source/{flag}", header=True, sep="\t")
    types = {"l_orderkey": "long", "l_linenumber": "int", "l_partkey": "long", "l_extendedprice": "double", "l_shipdate": "date"}
    return delimited.read_with_header(t.spark, f"{folder}/source", types, "*.csv")


@query(
    "json_lines",
    """
    SELECT event_id, user_id, event_type, nullif(value, 0) AS value, props, CAST(CAST(ts AS DATE) AS VARCHAR) AS day
    FROM events
    """,
)
def json_lines(t: Tables) -> DataFrame:
    """Events as a stage, then as JSON lines, read back."""
    folder = scratch_folder(t.spark, "stages")
    events = t.events.select("event_id", "user_id", "event_type", F.nullif("value", F.lit(0.0)).alias("value"), "props", F.to_date("ts").alias("day"))
    kept = stages.stage(t.spark, f"{folder}/1-events", lambda: events)
    stages.write_json(kept, f"{folder}/2-json")
    return t.spark.read.schema(kept.schema).json(f"{folder}/2-json")


#: Lines of a landed file. A compressed file is read by one task, so it is kept short: at most 64 MB of the longest lines.
LINES_PER_FILE = 40_000


def _landed(df: DataFrame, fields: list[Field], path: str) -> None:
    """Rows as fixed-width files; fields that ``df`` lacks are blank. Lines are mostly blanks, hence compressed."""
    blank = {f.name: F.lit(None).cast("string") for f in fields if f.name not in df.columns}
    lines = df.withColumns(blank).select(written_line(fields))
    lines.write.options(encoding=layouts.ENCODING, compression="gzip", maxRecordsPerFile=LINES_PER_FILE).text(path)


@query(
    "county_files",
    """
    WITH assessed AS (
        SELECT o_custkey, max(o_totalprice) AS building, count(*) AS land, max(o_orderstatus) AS class FROM orders GROUP BY o_custkey, year(o_orderdate))
    SELECT CAST(s.o_custkey AS VARCHAR) AS parid, 'Order ' || s.o_orderkey AS owner, s.o_totalprice AS price,
           CAST(CAST(s.o_orderdate AS DATE) AS VARCHAR) AS sold, building AS building_value, CAST(land AS DOUBLE) AS land_value, class,
           'Ohio' AS state, 'Butler' AS county
    FROM orders s JOIN customer ON c_custkey = s.o_custkey LEFT JOIN assessed a ON a.o_custkey = s.o_custkey
    WHERE s.o_totalprice > 0
    """,
)
def county_files(t: Tables) -> DataFrame:
    """A county's parcel, sales and assessment files, loaded as the history job does."""
    folder = scratch_folder(t.spark, "landing")
    parid = F.col("o_custkey").cast("string").alias("Parid")
    _landed(t.customer.select(F.col("c_custkey").cast("string").alias("Parid")), layouts.PARCEL, f"{folder}/PARDAT.DAT")
    sales = t.orders.select(
        parid, F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("Own1"), F.col("o_totalprice").alias("Price"),
        F.date_format("o_orderdate", "dd-MMM-yy").alias("Saledt"), F.col("o_orderpriority").alias("Note1"),
    )
    _landed(sales, layouts.SALES, f"{folder}/SALES.DAT")
    assessments = t.orders.groupBy(parid, F.year("o_orderdate").alias("Taxyr")).agg(
        F.max("o_totalprice").alias("Aprbldg"), F.count("*").alias("Aprland"), F.max("o_orderstatus").alias("Class")
    )
    _landed(assessments, layouts.ASSESSMENT, f"{folder}/ASMT.DAT")
    rows = counties.load_county(t.spark, "ohio-butler", folder, AS_OF)
    shown = {
        "Parid": "parid", "Owner Name 1": "owner", "Sale Price": "price", "last_sale_date": "sold", "Building Value": "building_value",
        "Land Value": "land_value", "Property Class": "class", "State": "state", "County": "county",
    }
    return rows.select(*[F.col(c).alias(n) for c, n in shown.items()])
