"""Scalar functions over whole columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import dates, numbers, owners, text
from parcelflow.operators import encode as ordinal
from parcelflow.operators.enrich import round_columns
from parcelflow.queries.registry import Tables, query

AS_OF = dt.date(2002, 1, 1)


@query(
    "business_flag",
    """
    WITH named AS (
        SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN p_name || ' LLC' WHEN 'SMALL' THEN p_name || ' Incline'
                                      WHEN 'LARGE' THEN NULL ELSE p_name END AS owner FROM part)
    SELECT p_partkey, owner,
           CASE WHEN contains(lower(owner), ' inc') OR contains(lower(owner), ' llc') OR contains(lower(owner), ' ltd')
                THEN 1 ELSE 0 END AS business_owner
    FROM named
    """,
)
def business_flag(t: Tables) -> DataFrame:
    owner = (
        F.when(F.col("p_type") == "ECONOMY", F.concat("p_name", F.lit(" LLC")))
        .when(F.col("p_type") == "SMALL", F.concat("p_name", F.lit(" Incline")))
        .when(F.col("p_type") != "LARGE", F.col("p_name"))
    )
    named = t.part.select("p_partkey", owner.alias("owner"))
    return named.withColumn("business_owner", owners.is_business("owner"))


@query(
    "dd_mon_yy",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%d-%b-%y') AS written, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS parsed
    FROM orders
    """,
)
def dd_mon_yy(t: Tables) -> DataFrame:
    written = t.orders.select("o_orderkey", F.date_format("o_orderdate", "dd-MMM-yy").alias("written"))
    return written.withColumn("parsed", dates.parse_day_month_year("written", F.lit(AS_OF)))


@query(
    "date_parts",
    """
    SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d,
           CASE WHEN year(o_orderdate) % 100 IN (98, 99) THEN year(o_orderdate) ELSE year(o_orderdate) % 100 END AS y4,
           CAST(make_date(year(o_orderdate), 1, 1) AS VARCHAR) AS jan_first,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS rebuilt,
           CAST(TRY_CAST(CAST(year(o_orderdate) AS VARCHAR) || '-02-' || CAST(day(o_orderdate) AS VARCHAR) AS DATE)
                AS VARCHAR) AS in_february,
           CAST(CASE WHEN month(o_orderdate) = 2 AND day(o_orderdate) = 29 THEN make_date(year(o_orderdate), 3, 1)
                     ELSE date_trunc('month', o_orderdate) END AS DATE) ::VARCHAR AS sale_month
    FROM orders
    """,
)
def date_parts(t: Tables) -> DataFrame:
    day = "o_orderdate"
    parts = t.orders.select("o_orderkey", day, F.year(day).alias("y"), F.month(day).alias("m"), F.day(day).alias("d"))
    return parts.select(
        "o_orderkey",
        "y",
        "m",
        "d",
        dates.four_digit_year(F.col("y") % 100).alias("y4"),
        dates.january_first("y").alias("jan_first"),
        dates.date_from_parts("y", "m", "d").alias("rebuilt"),
        dates.date_from_parts(F.col("y"), F.lit(2), F.col("d")).alias("in_february"),
        dates.sale_month(day).alias("sale_month"),
    )


@query(
    "month_sequence",
    """
    WITH opened AS (
        SELECT o_orderkey,
               CASE WHEN month(o_orderdate) = 2 AND day(o_orderdate) = 29 THEN make_date(year(o_orderdate), 3, 1)
                    ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS first
        FROM orders),
    shipped AS (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS last FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey, CAST(CAST(unnest(generate_series(first, date_trunc('month', last), INTERVAL 1 MONTH)) AS DATE)
                            AS VARCHAR) AS month
    FROM opened JOIN shipped ON o_orderkey = l_orderkey
    """,
)
def month_sequence(t: Tables) -> DataFrame:
    shipped = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("last"))
    orders = t.orders.select("o_orderkey", "o_orderdate").join(shipped, "o_orderkey")
    return orders.select("o_orderkey", F.explode(dates.month_sequence("o_orderdate", "last")).alias("month"))


@query(
    "tenure_age",
    """
    WITH months AS (
        SELECT o_orderkey, (2002 - year(o_orderdate)) * 12 + 1 - month(o_orderdate) AS n,
               CAST(floor(o_totalprice / 200) AS INTEGER) AS built FROM orders)
    SELECT o_orderkey, CAST(floor(n / 12) AS INTEGER) AS tenure_years, CAST(least(floor(n / 12), 3) AS INTEGER) AS capped,
           CAST(floor((-n) / 12) AS INTEGER) AS floored,
           CAST(CASE WHEN built >= 1800 THEN 2002 - built END AS INTEGER) AS age
    FROM months
    """,
)
def tenure_age(t: Tables) -> DataFrame:
    today = F.lit(AS_OF)
    tenure = dates.whole_years_between("o_orderdate", today)
    built = F.floor(F.col("o_totalprice") / 200).cast("int")
    return t.orders.select(
        "o_orderkey",
        tenure.alias("tenure_years"),
        dates.capped(tenure, 3).alias("capped"),
        dates.whole_years_between(today, "o_orderdate").alias("floored"),
        dates.age_since_year(built, today).alias("age"),
    )


@query(
    "key_build",
    """
    SELECT c_custkey,
           CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 3 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0')
                ELSE CAST(c_custkey AS VARCHAR) END
           || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS parcel,
           replace(replace(c_name, '#', ''), ' ', '') AS name,
           'Customer' AS prefix,
           split_part(c_mktsegment, 'E', 1) AS first_part
    FROM customer
    """,
)
def key_build(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        text.build_key([("c_custkey", 3), ("c_nationkey", 4)]).alias("parcel"),
        text.drop_spaces(F.translate("c_name", "#", " ")).alias("name"),
        text.first_token(F.translate("c_name", "#", " ")).alias("prefix"),
        text.id_part("c_mktsegment", 1, "E").alias("first_part"),
    )


@query(
    "title_case",
    """
    SELECT doc_id, array_to_string(list_transform(regexp_extract_all(lower(text), '([\\p{L}]+|[^\\p{L}]+)'),
           lambda x: CASE x[1] WHEN 'ß' THEN 'Ss' ELSE upper(x[1]) END || x[2:]), '') AS title
    FROM documents
    """,
)
def title_case(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.title_case("text").alias("title"))


@query(
    "normalized_ids",
    """
    SELECT page_id, replace(replace(url, '-', ''), '.', '') AS id,
           CASE WHEN contains(lower(html), 'href') THEN 1 ELSE 0 END AS has_link
    FROM pages
    """,
)
def normalized_ids(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id", text.normalize_id("url").alias("id"), text.mentions("html", "HREF").cast("int").alias("has_link")
    )


@query(
    "round_base",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice, round_even(l_extendedprice / 500, 0) * 500 AS by_500,
           round_even(l_extendedprice / 5000, 0) * 5000 AS by_5000, round_even(l_extendedprice / 25000, 0) * 25000 AS by_25000,
           round_even(l_quantity / 10, 0) * 10 AS "l_quantityRounded"
    FROM lineitem
    """,
)
def round_base(t: Tables) -> DataFrame:
    rounded = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        "l_quantity",
        *[numbers.round_base("l_extendedprice", b).alias(f"by_{b}") for b in (500, 5000, 25000)],
    )
    return round_columns(rounded, {"l_quantity": 10}).drop("l_quantity")


@query(
    "round_interval",
    """
    WITH priced AS (SELECT o_orderkey, round_even(o_totalprice / 10000, 0) * 10000 AS price FROM orders)
    SELECT o_orderkey, price, round_even((price - price * 0.125) / 10000, 0) * 10000 AS lower_price,
           round_even((price + price * 0.125) / 10000, 0) * 10000 AS upper_price
    FROM priced
    """,
)
def round_interval(t: Tables) -> DataFrame:
    priced = t.orders.select("o_orderkey", numbers.round_ten_thousands("o_totalprice").alias("price"))
    lower, upper = numbers.price_interval("price")
    return priced.select("o_orderkey", "price", lower.alias("lower_price"), upper.alias("upper_price"))


@query(
    "coerce_clean",
    """
    WITH mixed AS (
        SELECT c_custkey, c_acctbal, c_mktsegment,
               CASE c_mktsegment WHEN 'BUILDING' THEN ' ' || CAST(c_nationkey AS VARCHAR) || ' '
                    WHEN 'MACHINERY' THEN 'nan' WHEN 'FURNITURE' THEN '' WHEN 'HOUSEHOLD' THEN '1,234'
                    ELSE CAST(c_nationkey AS VARCHAR) || 'e2' END AS written
        FROM customer)
    SELECT c_custkey,
           CASE c_mktsegment WHEN 'MACHINERY' THEN NULL ELSE try_cast(trim(written) AS DOUBLE) END AS number,
           CASE WHEN c_acctbal > 0 THEN c_acctbal END AS positive,
           CASE WHEN lower(written) NOT IN ('nan', 'nat', 'none') THEN written END AS cleaned,
           CASE WHEN nullif(substr(c_mktsegment, 1, 1), 'H') IS NULL THEN '0' WHEN c_mktsegment[2:2] = 'I' THEN '1'
                ELSE substr(c_mktsegment, 1, 1) END AS sale_type
    FROM mixed
    """,
)
def coerce_clean(t: Tables) -> DataFrame:
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey").cast("string")
    written = (
        F.when(segment == "BUILDING", F.concat(F.lit(" "), nation, F.lit(" ")))
        .when(segment == "MACHINERY", "nan")
        .when(segment == "FURNITURE", "")
        .when(segment == "HOUSEHOLD", "1,234")
        .otherwise(F.concat(nation, F.lit("e2")))
    )
    letter = F.when(F.substring(segment, 2, 1) == "I", "I").otherwise(F.substring(segment, 1, 1))
    mixed = t.customer.select(
        "c_custkey", "c_acctbal", written.alias("written"), F.nullif(letter, F.lit("H")).alias("type")
    )
    return mixed.select(
        "c_custkey",
        numbers.to_number("written").alias("number"),
        numbers.positive_or_null("c_acctbal").alias("positive"),
        text.clean_missing("written").alias("cleaned"),
        numbers.sale_type_code("type").alias("sale_type"),
    )


CODES_SQL = """
    segments AS (SELECT coalesce(nullif(c_mktsegment, 'BUILDING'), 'nan') AS segment, c_custkey, c_nationkey
                 FROM customer),
    coded AS (SELECT c_custkey, segment, CAST(dense_rank() OVER (ORDER BY segment) - 1 AS INTEGER) AS segment_code,
                     CAST(dense_rank() OVER (ORDER BY CAST(c_nationkey AS VARCHAR)) - 1 AS INTEGER) AS nation_code,
                     c_nationkey
              FROM segments)
"""


def _categories(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.col("c_nationkey").cast("string").alias("nation"),
    )


@query("ordinal_encode", f"WITH {CODES_SQL} SELECT c_custkey, segment_code, nation_code FROM coded")
def ordinal_encode(t: Tables) -> DataFrame:
    rows = _categories(t)
    dictionary = ordinal.fit_ordinal(rows, ["segment", "nation"])
    coded = ordinal.encode(rows, dictionary, ["segment", "nation"], suffix="_code")
    return coded.select("c_custkey", "segment_code", "nation_code")


@query(
    "ordinal_dictionary",
    f"""
    WITH {CODES_SQL}
    SELECT DISTINCT 'segment' AS "column", segment AS value, segment_code AS code FROM coded
    UNION ALL
    SELECT DISTINCT 'nation', CAST(c_nationkey AS VARCHAR), nation_code FROM coded
    """,
)
def ordinal_dictionary(t: Tables) -> DataFrame:
    return ordinal.fit_ordinal(_categories(t), ["segment", "nation"])


@query(
    "ordinal_roundtrip",
    """
    SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, o_orderstatus AS status FROM orders
    """,
)
def ordinal_roundtrip(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )
    columns = ["priority", "status"]
    dictionary = ordinal.fit_ordinal(rows, columns)
    return ordinal.decode(ordinal.encode(rows, dictionary, columns), dictionary, columns)
