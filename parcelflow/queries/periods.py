"""The prediction table as it is kept: orders stand for predictions, months for periods.

Every query writes a table of its own in the shared folder, merges into it and reads it back. ``rewritten`` says whether
the files of a row's period are those of the merge or still those of the first write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.checkpoints import scratch_folder
from parcelflow.operators.backfill import backfill_actuals, is_open
from parcelflow.periods import PeriodTable
from parcelflow.queries.keys import UPSERT_SQL
from parcelflow.queries.registry import Tables, query


def _with_rewritten(t: Tables, table: PeriodTable, period: str) -> DataFrame:
    """The table with the periods that its second version does not share with its first."""
    first, second = (table.manifest(t.spark, version).periods for version in (1, None))
    fresh = [name for name, entry in second.items() if first.get(name) != entry]
    return table.read(t.spark).withColumn("rewritten", F.col(period).cast("string").isin(fresh))


@query(
    "period_upsert",
    UPSERT_SQL
    + """
    SELECT merged.o_orderkey, merged.o_custkey, merged.o_totalprice, merged.o_orderpriority,
           CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS period, o_orderdate >= DATE '1998-06-01' AS rewritten
    FROM merged JOIN orders ON merged.o_orderkey = orders.o_orderkey
    """,
)
def period_upsert(t: Tables) -> DataFrame:
    """Orders to 1998 as the table, those from June 1998 on as updates."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    dated = orders.withColumn("period", F.trunc("o_orderdate", "MM").cast("date"))
    target = dated.where(F.col("o_orderdate") < "1999-01-01").drop("o_orderdate")
    updates = dated.where(F.col("o_orderdate") >= "1998-06-01").drop("o_orderdate").withColumns(
        {"o_totalprice": -F.col("o_totalprice"), "o_orderpriority": F.nullif("o_orderpriority", F.lit("5-LOW"))}
    )
    table = PeriodTable(scratch_folder(t.spark, "periods"), "period")
    for rows in (target, updates):
        table.merge(rows, ["period", "o_orderkey"])
    return _with_rewritten(t, table, "period")


@query(
    "period_merge_counts",
    UPSERT_SQL
    + """
    , touched AS (
        SELECT action FROM merged JOIN orders ON merged.o_orderkey = orders.o_orderkey WHERE o_orderdate >= DATE '1998-06-01')
    SELECT action, count(*) AS n FROM touched GROUP BY action
    UNION ALL SELECT 'kept', 0 WHERE NOT EXISTS (SELECT 1 FROM touched WHERE action = 'kept')
    """,
)
def period_merge_counts(t: Tables) -> DataFrame:
    """What the merge of ``period_upsert`` did, from row counts that the manifests hold."""
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    dated = orders.withColumn("period", F.trunc("o_orderdate", "MM").cast("date"))
    table = PeriodTable(scratch_folder(t.spark, "periods"), "period")
    table.merge(dated.where(F.col("o_orderdate") < "1999-01-01"), ["period", "o_orderkey"])
    merge = table.merge(dated.where(F.col("o_orderdate") >= "1998-06-01"), ["period", "o_orderkey"])
    return t.spark.createDataFrame(list(merge.counts.items()), "action string, n long")


_OPEN = ("actual_date", "actual_price")


@query(
    "period_backfill",
    """
    WITH predictions AS (
        SELECT o_orderkey AS id, o_custkey AS parcel, o_orderstatus = 'F' AS closed, CAST(o_orderdate AS DATE) AS d, o_totalprice AS price,
               CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS period_start
        FROM orders),
    daily AS (
        SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, arg_min(o_totalprice, o_orderkey) AS price FROM orders GROUP BY ALL),
    matched AS (
        SELECT id, arg_min(daily.d, daily.d) AS d, arg_min(daily.price, daily.d) AS price
        FROM predictions JOIN daily ON o_custkey = parcel AND daily.d >= period_start WHERE NOT closed GROUP BY id),
    filled AS (
        SELECT p.id, parcel, period_start, CASE WHEN closed THEN p.d ELSE m.d END AS actual_date,
               CASE WHEN closed THEN p.price ELSE m.price END AS actual_price, m.id IS NOT NULL AS found
        FROM predictions AS p LEFT JOIN matched AS m ON p.id = m.id)
    SELECT id, parcel, CAST(period_start AS VARCHAR) AS period_start, CAST(actual_date AS VARCHAR) AS actual_date, actual_price,
           bool_or(found) OVER (PARTITION BY period_start) AS rewritten
    FROM filled
    """,
)
def period_backfill(t: Tables) -> DataFrame:
    """Open predictions filled with the next order of their customer; months without one keep their files."""
    closed = F.col("o_orderstatus") == "F"
    predictions = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("parcel"), F.add_months(F.trunc("o_orderdate", "MM"), 1).alias("period_start"),
        F.when(closed, F.col("o_orderdate")).alias("actual_date"), F.when(closed, F.col("o_totalprice")).alias("actual_price"),
    )
    table = PeriodTable(scratch_folder(t.spark, "periods"), "period_start", is_open(_OPEN))
    table.merge(predictions, ["period_start", "id"])
    events = t.orders.withColumnRenamed("o_custkey", "parcel")
    changes = {"actual_date": "o_orderdate", "actual_price": "o_totalprice"}
    pending = table.read(t.spark, open_only=True)
    filled = backfill_actuals(
        pending, events, ["parcel"], "period_start", "o_orderdate", "o_totalprice", changes, open_columns=_OPEN, tiebreak=["o_orderkey"]
    )
    table.merge(filled, ["period_start", "id"], _OPEN)
    return _with_rewritten(t, table, "period_start")
