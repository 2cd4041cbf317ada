"""One row per key, joins, set operations, upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.text import pad_left
from parcelflow.operators import aggregates, backfill, dedup, enrich, joins, upsert
from parcelflow.queries.registry import Tables, query
from parcelflow.sources.delimited import stack_formats

LINE_TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount"]


@query(
    "latest_per_key",
    """
    SELECT event_id, ts, user_id, event_type, value, props
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def latest_per_key(t: Tables) -> DataFrame:
    return dedup.latest_per_key(t.events, ["user_id"], "ts", ["event_id"])


YEARLY_SQL = """
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice, o_orderstatus,
           o_orderpriority
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                                       ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    WHERE rn = 1
"""


def yearly_orders(t: Tables) -> DataFrame:
    """Last order per customer and year."""
    return dedup.last_per_period(t.orders, ["o_custkey"], "o_orderdate", "year", ["o_orderkey"])


@query(
    "last_per_key_year",
    f"""
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_totalprice, o_orderstatus,
           o_orderpriority
    FROM ({YEARLY_SQL})
    """,
)
def last_per_key_year(t: Tables) -> DataFrame:
    return yearly_orders(t).select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )


@query(
    "first_per_key_date",
    """
    SELECT l_partkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, l_orderkey, l_linenumber, l_suppkey,
           l_extendedprice, l_quantity, l_discount
    FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
                 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount) AS rn
          FROM lineitem)
    WHERE rn = 1
    """,
)
def first_per_key_date(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_shipdate", *LINE_TIES)
    return dedup.first_per_key_date(lines, ["l_partkey"], "l_shipdate", LINE_TIES)


@query(
    "left_then_positive",
    """
    SELECT o_orderkey AS order_id, o_totalprice AS price_order, l_extendedprice AS price_line, l_partkey, l_linenumber
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    WHERE l_extendedprice > 0
    """,
)
def left_then_positive(t: Tables) -> DataFrame:
    headers = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").alias("price"), "l_partkey", "l_linenumber"
    )
    joined = joins.join_with_suffixes(headers, lines, ["order_id"], ("_order", "_line"))
    return joins.positive(joined, "price_line")


@query(
    "left_join_unmatched",
    """
    SELECT doc_id, source, lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def left_join_unmatched(t: Tables) -> DataFrame:
    documents = t.documents.select("doc_id", "source", "lang", "n_chars")
    return joins.spread_join(documents, t.labels, ["doc_id"], "left")


@query(
    "right_join_info",
    """
    WITH daily AS (
        SELECT l_orderkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, l_extendedprice
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, CAST(l_shipdate AS DATE)
                     ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
                              l_discount) AS rn
              FROM lineitem)
        WHERE rn = 1)
    SELECT o_orderkey AS l_orderkey, l_shipdate, l_extendedprice, o_orderstatus, o_totalprice
    FROM daily RIGHT JOIN orders ON l_orderkey = o_orderkey
    """,
)
def right_join_info(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_shipdate", *LINE_TIES)
    daily = dedup.first_per_key_date(lines, ["l_orderkey"], "l_shipdate", LINE_TIES)
    info = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_totalprice")
    return daily.select("l_orderkey", "l_shipdate", "l_extendedprice").join(info, "l_orderkey", "right")


@query(
    "enrich_latest",
    f"""
    WITH latest AS (
        SELECT lpad(CAST(user_id AS VARCHAR), 6, '0') AS id, event_type, value
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1)
    SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS parcel, o_orderkey,
           CAST(o_orderdate AS VARCHAR) AS o_orderdate, event_type, value
    FROM ({YEARLY_SQL}) LEFT JOIN latest ON id = lpad(CAST(o_custkey AS VARCHAR), 6, '0')
    """,
)
def enrich_latest(t: Tables) -> DataFrame:
    sales = yearly_orders(t).select(pad_left("o_custkey", 6).alias("parcel"), "o_orderkey", "o_orderdate")
    digits = pad_left("user_id", 6)
    first, second, third = F.substring(digits, 1, 3), F.substring(digits, 4, 2), F.substring(digits, 6, 1)
    written = F.concat(first, F.lit("-"), second, F.lit("."), third)
    attributes = t.events.select(written.alias("raw_id"), "ts", "event_id", "event_type", "value")
    joined = enrich.attach_by_normalized_id(sales, attributes, "parcel", "raw_id", ["ts", "event_id"])
    return joined.drop("ts", "event_id")


@query(
    "semi_members",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE EXISTS (SELECT 1 FROM events WHERE user_id = o_custkey)
    """,
)
def semi_members(t: Tables) -> DataFrame:
    users = t.events.select(F.col("user_id").alias("o_custkey"))
    return joins.members(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), users, ["o_custkey"])


@query(
    "anti_members",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = o_custkey)
    """,
)
def anti_members(t: Tables) -> DataFrame:
    users = t.events.select(F.col("user_id").alias("o_custkey"))
    return joins.non_members(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), users, ["o_custkey"])


@query(
    "key_count_join",
    """
    SELECT o_orderkey, o_custkey, total_sales
    FROM orders JOIN (SELECT o_custkey, count(*) AS total_sales FROM orders GROUP BY o_custkey) USING (o_custkey)
    """,
)
def key_count_join(t: Tables) -> DataFrame:
    return joins.with_key_count(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"])


@query(
    "key_count_window",
    f"""
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
           count(*) OVER (PARTITION BY o_custkey) AS total_sales
    FROM ({YEARLY_SQL})
    """,
)
def key_count_window(t: Tables) -> DataFrame:
    return joins.with_key_count_window(
        yearly_orders(t).select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"]
    )


@query("key_list", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def key_list(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@query("key_counts", "SELECT l_suppkey, count(*) AS total_sales FROM lineitem GROUP BY l_suppkey")
def key_counts(t: Tables) -> DataFrame:
    return joins.key_counts(t.lineitem, ["l_suppkey"])


@query(
    "union_formats",
    """
    SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment
    FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier
    """,
)
def union_formats(t: Tables) -> DataFrame:
    def common(df: DataFrame, prefix: str, key: str) -> DataFrame:
        return df.withColumnsRenamed(
            {key: "id", f"{prefix}_name": "name", f"{prefix}_nationkey": "nation", f"{prefix}_acctbal": "balance"}
        )

    customers = common(t.customer, "c", "c_custkey").withColumnRenamed("c_mktsegment", "segment")
    return stack_formats([customers, common(t.supplier, "s", "s_suppkey")])


@query(
    "union_distinct",
    """
    SELECT 'Customer' AS source, c_nationkey AS nation, c_mktsegment AS kind FROM customer
    UNION
    SELECT 'Supplier', s_nationkey, CASE WHEN s_acctbal > 0 THEN 'CREDIT' ELSE 'DEBIT' END FROM supplier
    """,
)
def union_distinct(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.lit("Customer").alias("source"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("kind")
    )
    standing = F.when(F.col("s_acctbal") > 0, "CREDIT").otherwise("DEBIT")
    suppliers = t.supplier.select(
        F.lit("Supplier").alias("source"), F.col("s_nationkey").alias("nation"), standing.alias("kind")
    )
    return stack_formats([customers, suppliers]).distinct()


@query(
    "event_backfill",
    """
    WITH predictions AS (
        SELECT o_orderkey AS id, o_custkey AS parcel,
               CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS period_start
        FROM orders WHERE o_orderstatus <> 'F'),
    daily AS (
        SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, o_totalprice, o_orderpriority
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) AS rn
              FROM orders)
        WHERE rn = 1),
    matched AS (
        SELECT id, parcel, period_start, d, o_totalprice, o_orderpriority,
               row_number() OVER (PARTITION BY id ORDER BY d) AS rn
        FROM predictions JOIN daily ON o_custkey = parcel AND d >= period_start)
    SELECT id, parcel, CAST(period_start AS VARCHAR) AS period_start, CAST(d AS VARCHAR) AS actual_date,
           o_totalprice AS actual_price, o_orderpriority AS actual_priority
    FROM matched WHERE rn = 1
    """,
)
def event_backfill(t: Tables) -> DataFrame:
    closed = F.col("o_orderstatus") == "F"
    predictions = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("parcel"),
        F.add_months(F.trunc("o_orderdate", "MM"), 1).alias("period_start"),
        F.when(closed, F.col("o_orderdate")).alias("actual_date"),
        F.when(closed, F.col("o_totalprice")).alias("actual_price"),
        F.when(closed, F.col("o_orderpriority")).alias("actual_priority"),
    )
    return backfill.backfill_actuals(
        predictions,
        t.orders.withColumnRenamed("o_custkey", "parcel"),
        ["parcel"],
        "period_start",
        "o_orderdate",
        "o_totalprice",
        {"actual_date": "o_orderdate", "actual_price": "o_totalprice", "actual_priority": "o_orderpriority"},
        open_columns=["actual_date", "actual_price"],
        tiebreak=["o_orderkey"],
    )


UPSERT_SQL = """
    WITH target AS (
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate < DATE '1999-01-01'),
    updates AS (
        SELECT o_orderkey, o_custkey, -o_totalprice AS o_totalprice, nullif(o_orderpriority, '5-LOW') AS o_orderpriority
        FROM orders WHERE o_orderdate >= DATE '1998-06-01'),
    merged AS (
        SELECT coalesce(target.o_orderkey, updates.o_orderkey) AS o_orderkey,
               CASE WHEN updates.o_orderkey IS NULL THEN target.o_custkey ELSE updates.o_custkey END AS o_custkey,
               CASE WHEN updates.o_orderkey IS NULL THEN target.o_totalprice ELSE updates.o_totalprice END
                   AS o_totalprice,
               CASE WHEN updates.o_orderkey IS NULL THEN target.o_orderpriority ELSE updates.o_orderpriority END
                   AS o_orderpriority,
               CASE WHEN target.o_orderkey IS NULL THEN 'inserted' WHEN updates.o_orderkey IS NULL THEN 'kept'
                    ELSE 'updated' END AS action
        FROM target FULL JOIN updates ON target.o_orderkey = updates.o_orderkey)
"""


def _upserted(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    target = orders.where(F.col("o_orderdate") < "1999-01-01").drop("o_orderdate")
    updates = orders.where(F.col("o_orderdate") >= "1998-06-01").withColumns(
        {"o_totalprice": -F.col("o_totalprice"), "o_orderpriority": F.nullif("o_orderpriority", F.lit("5-LOW"))}
    )
    return upsert.upsert_with_action(target, updates, ["o_orderkey"])


@query("upsert_rows", UPSERT_SQL + "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, action FROM merged")
def upsert_rows(t: Tables) -> DataFrame:
    return _upserted(t)


@query("upsert_counts", UPSERT_SQL + "SELECT action, count(*) AS n FROM merged GROUP BY action")
def upsert_counts(t: Tables) -> DataFrame:
    return upsert.action_counts(_upserted(t))


@query(
    "upsert_null_key",
    """
    WITH keyed AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS kind, o_totalprice,
                          CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT o_orderkey, kind, CASE WHEN d >= DATE '1998-06-01' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice
    FROM keyed
    """,
)
def upsert_null_key(t: Tables) -> DataFrame:
    """The same update twice, under keys with missing parts: no row is doubled."""
    keyed = t.orders.select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("kind"), "o_totalprice", "o_orderdate"
    )
    target = keyed.where(F.col("o_orderdate") < "1999-01-01").drop("o_orderdate")
    updates = keyed.where(F.col("o_orderdate") >= "1998-06-01").drop("o_orderdate")
    updates = updates.withColumn("o_totalprice", -F.col("o_totalprice"))
    once = upsert.upsert(target, updates, ["o_orderkey", "kind"])
    return upsert.upsert(once, updates, ["o_orderkey", "kind"])


@query(
    "hot_key_join",
    """
    SELECT l_orderkey, l_linenumber, l_shipdate_year, p_retailprice FROM
        (SELECT l_orderkey, l_linenumber, year(l_shipdate) AS l_shipdate_year,
                CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_orderkey % 7 > 0 THEN l_partkey END AS k FROM lineitem)
        LEFT JOIN part ON p_partkey = k
    """,
)
def hot_key_join(t: Tables) -> DataFrame:
    """A third of the rows on one key, some without a key."""
    key = F.when(F.col("l_orderkey") % 3 == 0, 1).when(F.col("l_orderkey") % 7 > 0, F.col("l_partkey"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.year("l_shipdate").alias("l_shipdate_year"), key.alias("k"))
    parts = t.part.select(F.col("p_partkey").alias("k"), "p_retailprice")
    return joins.spread_join(rows, parts, ["k"], "left", rows_per_task=1000).drop("k")


@query(
    "open_predictions",
    """
    SELECT o_orderkey, o_custkey, l_shipdate FROM
        (SELECT o_orderkey, o_custkey FROM orders)
        LEFT JOIN (SELECT l_orderkey, CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR) AS l_shipdate FROM lineitem
                   GROUP BY l_orderkey) ON o_orderkey = l_orderkey
    WHERE l_shipdate IS NULL
    """,
)
def open_predictions(t: Tables) -> DataFrame:
    shipped = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("l_shipdate"))
    orders = t.orders.select("o_orderkey", "o_custkey").join(shipped, "o_orderkey", "left")
    return backfill.open_rows(orders, ["l_shipdate"])


@query(
    "stage_counts",
    "SELECT count(*) AS total_rows, count(DISTINCT o_custkey) AS total_keys FROM orders",
)
def stage_counts(t: Tables) -> DataFrame:
    return aggregates.stage_counts(t.orders, "o_custkey")
