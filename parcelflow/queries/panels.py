"""Month panels, their splits, the current snapshot and published rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.calendars import run_calendar
from parcelflow.operators import history, splits
from parcelflow.operators.panel import month_panel as expand_months
from parcelflow.operators.snapshot import current_snapshot as snapshot_of
from parcelflow.plans.forecast import PUBLISHED, publish
from parcelflow.queries.histories import chain_sql, parcel_sources
from parcelflow.queries.keys import YEARLY_SQL, yearly_orders
from parcelflow.queries.registry import Tables, query

AS_OF = dt.date(2002, 1, 1)
CALENDAR = run_calendar("2001-03-01", AS_OF)
TENURE = (1, 3)
KEYS = ["customer"]


def linked_orders(t: Tables) -> DataFrame:
    """Last order per customer and year, linked to the next one and numbered. The priority plays the owner."""
    sales = yearly_orders(t).select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderdate").alias("last_sale_date"),
        F.col("o_totalprice").alias("last_sale_price"),
        F.col("o_orderpriority").alias("owner"),
    )
    linked = history.sale_chain(sales, KEYS, "last_sale_date", "owner", "last_sale_price")
    return history.with_sale_number(linked, KEYS, "last_sale_date")


LINKED_SQL = f"""
    yearly AS ({YEARLY_SQL}),
    sales AS (SELECT o_custkey AS customer, o_orderdate AS last_sale_date, o_totalprice AS last_sale_price,
                     o_orderpriority AS owner FROM yearly),
    linked AS (SELECT *, row_number() OVER (PARTITION BY customer ORDER BY last_sale_date) AS total_sales
               FROM ({chain_sql("sales", "customer", "last_sale_date", "owner", "last_sale_price")})),
    months AS (
        SELECT *, CAST(unnest(generate_series(
                      CASE WHEN month(last_sale_date) = 2 AND day(last_sale_date) = 29
                           THEN make_date(year(last_sale_date), 3, 1)
                           ELSE CAST(date_trunc('month', last_sale_date) AS DATE) END,
                      CAST(date_trunc('month', coalesce(next_sale_date, DATE '2002-01-01')) AS DATE),
                      INTERVAL 1 MONTH)) AS DATE) AS date
        FROM linked),
    counted AS (
        SELECT *, row_number() OVER (PARTITION BY customer, last_sale_date ORDER BY date) - 1 AS tenure_months,
               count(*) OVER (PARTITION BY customer, last_sale_date) AS n_months
        FROM months),
    panel AS (
        SELECT *, CAST(floor(tenure_months / 12) AS INTEGER) AS tenure_years, month(date) AS month,
               CASE WHEN next_sale_date IS NOT NULL AND tenure_months >= n_months - 4 THEN 1 ELSE 0 END
                   AS sale_in_3_months,
               CASE WHEN next_sale_date IS NOT NULL AND tenure_months >= n_months - 7 THEN 1 ELSE 0 END
                   AS sale_in_6_months,
               CASE WHEN next_sale_date IS NOT NULL AND tenure_months >= n_months - 13 THEN 1 ELSE 0 END
                   AS sale_in_12_months
        FROM counted WHERE tenure_months < n_months - 1)
"""

PANEL_COLUMNS = ["customer", "last_sale_date", "date", "month", "tenure_months", "tenure_years", "tenure_capped",
                 "total_sales", "sale_in_3_months", "sale_in_6_months", "sale_in_12_months", "next_sale_date",
                 "next_sale_price"]
PANEL_SELECT = """
    SELECT customer, CAST(last_sale_date AS VARCHAR) AS last_sale_date, CAST(date AS VARCHAR) AS date, month,
           tenure_months, tenure_years, least(tenure_years, 25) AS tenure_capped, total_sales, sale_in_3_months,
           sale_in_6_months, sale_in_12_months, CAST(next_sale_date AS VARCHAR) AS next_sale_date, next_sale_price
"""


BUILT = "CAST(floor(1790 + last_sale_price / 3000) AS INTEGER)"


@query(
    "month_panel",
    f"""
    WITH {LINKED_SQL}
    {PANEL_SELECT}, CASE WHEN {BUILT} >= 1800 THEN 2001 - {BUILT} END AS age_years FROM panel
    """,
)
def month_panel(t: Tables) -> DataFrame:
    sales = linked_orders(t).withColumn("built", F.floor(1790 + F.col("last_sale_price") / 3000).cast("int"))
    panel = expand_months(
        sales, "last_sale_date", "next_sale_date", AS_OF, year_built="built", age_as_of=CALENDAR.test_date
    )
    return panel.select(*PANEL_COLUMNS, "age_years")


@query(
    "bounded_panel",
    f"WITH {LINKED_SQL} {PANEL_SELECT} FROM panel WHERE tenure_months >= 12 AND date >= DATE '1999-01-01'",
)
def bounded_panel(t: Tables) -> DataFrame:
    start = dt.date(1999, 1, 1)
    panel = expand_months(linked_orders(t), "last_sale_date", "next_sale_date", AS_OF, start, min_tenure_years=1)
    return panel.select(*PANEL_COLUMNS)


ELIGIBLE = "tenure_years BETWEEN 1 AND 3 AND (next_good_sale IS NULL OR next_good_sale = 1)"
TEST_WHERE = f"date = DATE '2001-03-01' AND {ELIGIBLE}"
TRAIN_WHERE = f"date BETWEEN DATE '1999-09-01' AND DATE '2000-09-30' AND {ELIGIBLE}"
GUARDED_SQL = f"""
    leaks AS (SELECT DISTINCT customer FROM panel WHERE {TEST_WHERE} AND sale_in_3_months = 1),
    guarded AS (
        SELECT * REPLACE (CASE WHEN customer IN (SELECT customer FROM leaks) THEN 0 ELSE sale_in_3_months END
                              AS sale_in_3_months,
                          CASE WHEN customer NOT IN (SELECT customer FROM leaks) THEN next_sale_price END
                              AS next_sale_price)
        FROM panel WHERE {TRAIN_WHERE})
"""


@query("test_split", f"WITH {LINKED_SQL} {PANEL_SELECT} FROM panel WHERE {TEST_WHERE}")
def test_split(t: Tables) -> DataFrame:
    return splits.test_panel(linked_orders(t), CALENDAR, TENURE).select(*PANEL_COLUMNS)


@query("train_split", f"WITH {LINKED_SQL} {PANEL_SELECT} FROM panel WHERE {TRAIN_WHERE}")
def train_split(t: Tables) -> DataFrame:
    return splits.train_panel(linked_orders(t), CALENDAR, TENURE).select(*PANEL_COLUMNS)


@query("leak_guard", f"WITH {LINKED_SQL}, {GUARDED_SQL} {PANEL_SELECT} FROM guarded")
def leak_guard(t: Tables) -> DataFrame:
    return splits.split_panel(linked_orders(t), CALENDAR, KEYS, TENURE).train.select(*PANEL_COLUMNS)


@query(
    "price_split", f"WITH {LINKED_SQL}, {GUARDED_SQL} {PANEL_SELECT} FROM guarded WHERE next_sale_price IS NOT NULL"
)
def price_split(t: Tables) -> DataFrame:
    return splits.split_panel(linked_orders(t), CALENDAR, KEYS, TENURE).train_price.select(*PANEL_COLUMNS)


@query(
    "modelling_rows",
    f"""
    WITH {LINKED_SQL}, {GUARDED_SQL}
    SELECT DISTINCT sale_in_3_months, next_sale_price, sale_in_6_months, sale_in_12_months, total_sales, owner
    FROM guarded
    """,
)
def modelling_rows(t: Tables) -> DataFrame:
    train = splits.split_panel(linked_orders(t), CALENDAR, KEYS, TENURE).train
    return splits.modelling_rows(train, splits.LABEL, ["total_sales", "owner"])


@query(
    "current_snapshot",
    """
    WITH known AS (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate < DATE '2000-07-01'),
    latest AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC, o_orderkey DESC) AS rn,
                      count(*) OVER (PARTITION BY o_custkey) AS total_sales FROM known),
    aged AS (SELECT *, CAST(floor(((2000 - year(d)) * 12 + 6 - month(d)) / 12) AS INTEGER) AS tenure_years,
                    CAST(1790 + o_totalprice / 3000 AS INTEGER) AS built
             FROM latest WHERE rn = 1)
    SELECT o_custkey, o_orderkey, o_totalprice, CAST(d AS VARCHAR) AS o_orderdate, total_sales, 6 AS month,
           tenure_years, least(tenure_years, 2) AS tenure_capped
    FROM aged WHERE tenure_years >= 1
    """,
)
def current_snapshot(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    calendar = run_calendar("2000-06-15", AS_OF)
    return snapshot_of(
        orders, ["o_custkey"], "o_orderdate", calendar, ["o_orderkey"], min_tenure_years=1, cap_years=2
    )


# Published name -> SQL over the customers that play the parcels; all other published columns are unknown.
_PUBLISHED_SQL = {
    "parcel": "lpad(CAST(c_custkey AS VARCHAR), 9, '0')", "address": "c_name", "yearBuilt": "1983 + c_nationkey",
    "taxMarketValueTotal": "c_acctbal * 100", "predictionPeriodStart": "'2001-04-01'",
    "predictionPeriodEnd": "'2001-06-30'", "updatedAt": "'2002-01-01'",
    **dict.fromkeys(("city", "zipCode", "county", "state", "propertyUse"), "c_mktsegment"),
    **dict.fromkeys(("areaBuildingSqft", "areaLotSqft", "stories"), "CAST(c_nationkey AS DOUBLE)"),
    **dict.fromkeys(("latitude", "longitude", "taxMarketValueLand", "taxMarketValueImprovements"), "c_acctbal"),
}


@query(
    "publish_projection",
    "SELECT "
    + ", ".join(f'{_PUBLISHED_SQL.get(c, "CAST(NULL AS VARCHAR)")} AS "{c}"' for c in PUBLISHED.values())
    + " FROM customer",
)
def publish_projection(t: Tables) -> DataFrame:
    """All published columns."""
    _, assessor, _ = parcel_sources(t)
    parcels = assessor.withColumn("Parid", F.translate("ParcelNumberRaw", "-.", ""))
    empty = [c for c in PUBLISHED if c not in parcels.columns and c not in _PERIOD]
    rows = parcels.withColumns({c: F.lit(None).cast("string") for c in empty})
    return publish(rows, CALENDAR, F.lit(AS_OF))


_PERIOD = ("prediction_period_start", "prediction_period_end", "updated_at")
