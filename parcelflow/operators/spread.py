"""Rows dealt out over tasks by their number."""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS_PER_TASK = 25_000


def spread_rows(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` in tasks of at most about ``rows_per_task`` rows, for rows that are small as read and grow large in the next step.

    Readers and adaptive execution cut by bytes, so a table of short rows may come as one task however many it has. The
    number of tasks is stated, hence not merged again. Rows are dealt out in turn, whatever their keys.
    """
    tasks = -(-df.count() // rows_per_task)
    return df.repartition(tasks) if tasks > 1 else df
