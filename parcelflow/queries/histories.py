"""Rebuilt histories and their owner chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.dates import january_first
from parcelflow.functions.text import normalize_id
from parcelflow.operators import dedup, enrich, history, joins
from parcelflow.plans import etl
from parcelflow.queries.keys import LINE_TIES, YEARLY_SQL, yearly_orders
from parcelflow.queries.registry import Tables, query


def words_sql(name: str) -> str:
    return f"list_filter(string_split_regex(lower({name}), '\\s+'), lambda w: length(w) >= 4)"


def same_owner_sql(owner: str, prev: str, prev2: str) -> str:
    return f"""
        CASE WHEN {owner} IS NOT NULL AND {prev} IS NOT NULL AND (
            contains(lower({prev}), lower({owner})) OR contains(lower({owner}), lower({prev}))
            OR coalesce(contains(lower({owner}), lower({prev2})), false)
            OR list_has_any({words_sql(owner)}, {words_sql(prev)})
            OR coalesce(list_has_any({words_sql(owner)}, {words_sql(prev2)}), false)) THEN 1 ELSE 0 END
    """


def chain_sql(source: str, key: str, date: str, owner: str, price: str) -> str:
    """Linked rows of ``source``, which has one row per key and date."""
    over = f"(PARTITION BY {key} ORDER BY {date})"
    return f"""
        SELECT *, lead(business_owner) OVER {over} AS next_business_owner,
               lead(same_owner) OVER {over} AS next_same_owner, lead(good_sale) OVER {over} AS next_good_sale,
               lead({date}) OVER {over} AS next_sale_date, lead({price}) OVER {over} AS next_sale_price
        FROM (SELECT *, CASE WHEN same_owner = 0 AND ({price} IS NULL OR {price} > 0) THEN 1 ELSE 0 END AS good_sale
              FROM (SELECT *, {same_owner_sql(owner, "prev_owner", "prev2_owner")} AS same_owner,
                           CASE WHEN contains(lower({owner}), ' inc') OR contains(lower({owner}), ' llc')
                                     OR contains(lower({owner}), ' ltd') THEN 1 ELSE 0 END AS business_owner
                    FROM (SELECT *, lag({owner}, 1) OVER {over} AS prev_owner, lag({owner}, 2) OVER {over} AS prev2_owner
                          FROM {source})))
    """


@query(
    "synthetic_history",
    f"""
    WITH yearly AS ({YEARLY_SQL}),
    shipped AS (SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS first_ship, max(l_extendedprice) AS amount
                FROM lineitem GROUP BY l_orderkey),
    actual AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderpriority, first_ship, amount
               FROM yearly LEFT JOIN shipped ON l_orderkey = o_orderkey),
    stacked AS (
        SELECT o_custkey, o_orderkey, DATE '1995-01-01' AS sold, NULL AS price, NULL AS o_orderpriority,
               0 AS source_priority, o_orderdate AS origin FROM actual
        UNION ALL
        SELECT o_custkey, o_orderkey, first_ship, amount, NULL, 1, o_orderdate FROM actual WHERE first_ship IS NOT NULL
        UNION ALL
        SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderpriority, 2, o_orderdate FROM actual),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, year(sold)
                                            ORDER BY source_priority DESC, origin DESC, o_orderkey DESC) AS rn
               FROM stacked)
    SELECT o_custkey, o_orderkey, CAST(sold AS VARCHAR) AS sold, price, o_orderpriority, source_priority
    FROM ranked WHERE rn = 1
    """,
)
def synthetic_history(t: Tables) -> DataFrame:
    shipped = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_extendedprice").alias("amount")
    )
    actual = yearly_orders(t).join(shipped, "o_orderkey", "left")
    sales = actual.select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").alias("sold"), F.col("o_totalprice").alias("price"),
        "o_orderpriority", "first_ship", "amount",
    )
    full = history.synthetic_history(
        sales,
        ["o_custkey"],
        "sold",
        "price",
        [
            history.Branch(january_first(F.lit(1995)), F.lit(None)),
            history.Branch(F.col("first_ship"), F.col("amount")),
        ],
        ["o_orderpriority", "first_ship", "amount"],
        tiebreak=["o_orderkey"],
    )
    return full.drop("first_ship", "amount")


OWNED_SQL = """
    SELECT l_suppkey, sold, p_name || CASE p_type WHEN 'ECONOMY' THEN ' llc' ELSE '' END AS owner, price
    FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS sold, l_partkey, l_extendedprice AS price,
                 row_number() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
                                    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                                             l_quantity, l_discount) AS rn
          FROM lineitem)
    LEFT JOIN part ON p_partkey = l_partkey WHERE rn = 1
"""


@query(
    "owner_chain",
    f"""
    WITH owned AS ({OWNED_SQL}), linked AS ({chain_sql("owned", "l_suppkey", "sold", "owner", "price")})
    SELECT l_suppkey, CAST(sold AS VARCHAR) AS sold, owner, price, business_owner, same_owner, good_sale,
           next_business_owner, next_same_owner, next_good_sale, CAST(next_sale_date AS VARCHAR) AS next_sale_date,
           next_sale_price
    FROM linked
    """,
)
def owner_chain(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_shipdate", *LINE_TIES)
    daily = dedup.first_per_key_date(lines, ["l_suppkey"], "l_shipdate", LINE_TIES)
    suffix = F.when(F.col("p_type") == "ECONOMY", " llc").otherwise("")
    names = t.part.select(F.col("p_partkey").alias("l_partkey"), F.concat("p_name", suffix).alias("owner"))
    hot = joins.hot_keys(t.lineitem, ["l_partkey"])
    owned = joins.spread_join(daily, names, ["l_partkey"], "left", hot=hot).select(
        "l_suppkey", F.col("l_shipdate").alias("sold"), "owner", F.col("l_extendedprice").alias("price")
    )
    return history.sale_chain(owned, ["l_suppkey"], "sold", "owner", "price")


ASSESSOR_SQL = """
    shipped AS (
        SELECT o_custkey, CAST(min(l_shipdate) AS DATE) AS assr_date, CAST(max(l_shipdate) AS DATE) AS updated,
               max(l_extendedprice) AS amount
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey),
    valued AS (
        SELECT user_id, CAST(ts AS DATE) AS valued_on, value * 1000 AS estimated
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, value DESC) AS rn
              FROM events)
        WHERE rn = 1),
    assessor AS (
        SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS parid, assr_date,
               CASE WHEN amount > 0 THEN amount END AS amount, 1983 + c_nationkey AS built, c_name,
               c_mktsegment || CASE c_nationkey WHEN 3 THEN ' llc' ELSE '' END AS owner, c_acctbal * 100 AS market,
               c_nationkey AS baths, estimated
        FROM customer LEFT JOIN shipped ON o_custkey = c_custkey LEFT JOIN valued ON user_id = c_custkey
        WHERE assr_date IS NOT NULL AND year(assr_date) >= 1983 + c_nationkey)
"""

PARCEL_HISTORY_SQL = f"""
    WITH yearly AS (
        SELECT lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS parid, CAST(o_orderdate AS DATE) AS sold, o_totalprice AS price
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                                           ORDER BY o_orderdate DESC, o_totalprice DESC) AS rn
              FROM orders WHERE o_totalprice > 0)
        WHERE rn = 1),
    {ASSESSOR_SQL},
    joined AS (
        SELECT y.parid, y.sold, y.price, assr_date, amount, built, c_name, owner, market, baths, estimated,
               round_even(market / 25000, 0) * 25000 AS market_rounded
        FROM yearly y LEFT JOIN assessor a ON a.parid = y.parid),
    stacked AS (
        SELECT parid, make_date(built, 1, 1) AS sold, CAST(NULL AS DOUBLE) AS price, NULL AS owner, built, c_name, market,
               market_rounded, baths, estimated, 0 AS priority, sold AS origin
        FROM joined WHERE built IS NOT NULL
        UNION ALL
        SELECT parid, assr_date, amount, NULL, built, c_name, market, market_rounded, baths, estimated, 1, sold
        FROM joined WHERE assr_date IS NOT NULL
        UNION ALL
        SELECT parid, sold, price, owner, built, c_name, market, market_rounded, baths, estimated, 2, sold FROM joined),
    sane AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY parid, year(sold)
                                                    ORDER BY priority DESC, origin DESC) AS rn FROM stacked)
        WHERE rn = 1 AND (price IS NULL OR price > 0) AND year(sold) >= built AND c_name IS NOT NULL AND market > 0
              AND market_rounded > 0),
    linked AS ({chain_sql("sane", "parid", "sold", "owner", "price")}),
    homes AS (SELECT * FROM linked WHERE baths > 0)
    SELECT parid, built, CAST(sold AS VARCHAR) AS sold, price, market_rounded, estimated, business_owner, same_owner,
           good_sale, next_business_owner, next_same_owner, next_good_sale,
           CAST(next_sale_date AS VARCHAR) AS next_sold, next_sale_price AS next_price,
           row_number() OVER (PARTITION BY parid ORDER BY sold) AS sale_number
    FROM homes
"""


def parcel_sources(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sales, assessor rows and valuations in the shape of the landed files."""
    parid = F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("Parid")
    sales = t.orders.select(
        parid, F.col("o_orderdate").alias("last_sale_date"), F.col("o_totalprice").alias("last_sale_price")
    )
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_extendedprice")
    shipped = t.orders.select("o_orderkey", "o_custkey").join(lines, "o_orderkey")
    shipped = shipped.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("l_shipdate").alias("AssessorLastSaleDate"),
        F.max("l_shipdate").alias("AssrLastUpdated"),
        F.max("l_extendedprice").alias("AssessorLastSaleAmount"),
    )
    digits, nation = F.lpad(F.col("c_custkey").cast("string"), 9, "0"), F.col("c_nationkey")
    first, second, third = (F.substring(digits, i, 3) for i in (1, 4, 7))
    written = F.concat(first, F.lit("-"), second, F.lit("."), third)
    suffix = F.when(nation == 3, " llc").otherwise("")
    text_columns = ("PropertyAddressCity", "PropertyAddressZIP", "SitusCounty", "SitusStateCode", "NeighborhoodCode",
                    "CompanyFlag", "OwnerTypeDescription1", "PropertyUseGroup")
    counts = ("BathCount", "BathPartialCount", "BedroomsCount", "AreaBuilding", "AreaLotSF", "StoriesCount")
    places = ("PropertyLatitude", "PropertyLongitude", "TaxMarketValueLand", "TaxMarketValueImprovements")
    assessor = t.customer.join(shipped, "c_custkey", "left").select(
        F.col("c_custkey").cast("string").alias("source_id"),
        written.alias("ParcelNumberRaw"),
        "AssrLastUpdated",
        "AssessorLastSaleDate",
        "AssessorLastSaleAmount",
        (nation + 1983).alias("YearBuilt"),
        F.col("c_name").alias("PropertyAddressFull"),
        F.concat("c_mktsegment", suffix).alias("PartyOwner1NameFull"),
        *[F.col("c_mktsegment").alias(c) for c in text_columns],
        *[nation.cast("double").alias(c) for c in counts],
        *[F.col("c_acctbal").alias(c) for c in places],
        (F.col("c_acctbal") * 100).alias("TaxMarketValueTotal"),
    )
    day = F.to_date("ts")
    valuations = t.events.select(
        F.col("user_id").cast("string").alias("source_id"),
        day.alias("LastUpdateDate"),
        day.alias("ValuationDate"),
        (F.col("value") * 1000).alias("EstimatedValue"),
        F.col("value").alias("ConfidenceScore"),
    )
    latest = dedup.latest_per_key(valuations, ["source_id"], "LastUpdateDate", ["EstimatedValue"])
    return sales, assessor, latest


@query(
    "assessor_valuation",
    f"""
    WITH {ASSESSOR_SQL}
    SELECT parid, CAST(assr_date AS VARCHAR) AS assr_date, amount, built, owner, market, estimated FROM assessor
    """,
)
def assessor_valuation(t: Tables) -> DataFrame:
    _, assessor, valuations = parcel_sources(t)
    return enrich.assessor_with_valuation(assessor, valuations).select(
        normalize_id("ParcelNumberRaw").alias("parid"),
        F.col("AssessorLastSaleDate").alias("assr_date"),
        F.col("AssessorLastSaleAmount").alias("amount"),
        F.col("YearBuilt").alias("built"),
        F.col("PartyOwner1NameFull").alias("owner"),
        F.col("TaxMarketValueTotal").alias("market"),
        F.col("EstimatedValue").alias("estimated"),
    )


@query("parcel_history", PARCEL_HISTORY_SQL)
def parcel_history(t: Tables) -> DataFrame:
    full = etl.build_history(*parcel_sources(t))
    return full.select(
        F.col("Parid").alias("parid"),
        F.col("YearBuilt").alias("built"),
        F.col("last_sale_date").alias("sold"),
        F.col("last_sale_price").alias("price"),
        F.col("TaxMarketValueTotalRounded").alias("market_rounded"),
        F.col("EstimatedValue").alias("estimated"),
        "business_owner",
        "same_owner",
        "good_sale",
        "next_business_owner",
        "next_same_owner",
        "next_good_sale",
        F.col("next_sale_date").alias("next_sold"),
        F.col("next_sale_price").alias("next_price"),
        F.col(etl.SALE_NUMBER).alias("sale_number"),
    )
