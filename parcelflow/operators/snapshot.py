"""The state of every key at a run date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import dates
from parcelflow.calendars import RunCalendar


def current_snapshot(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    calendar: RunCalendar,
    tiebreak: Sequence[str] = (),
    year_built: str | None = None,
    min_tenure_years: int = 10,
    cap_years: int = 25,
) -> DataFrame:
    """Latest event per key before the end of the run month, with tenure, age and number of events.

    One aggregate gives the latest row and the count, so each map task sends one row per key.
    """
    known = df.where(F.col(date) < F.lit(calendar.prediction_start))
    for key in keys:
        known = known.where(F.col(key).isNotNull())
    rest = [c for c in df.columns if c not in keys]
    latest = F.max_by(F.struct(*rest), F.struct(date, *tiebreak))
    grouped = known.groupBy(*keys).agg(latest.alias("_latest"), F.count(F.lit(1)).alias("total_sales"))
    today = F.lit(calendar.test_date)
    snapshot = grouped.select(*keys, "_latest.*", "total_sales")
    tenure = dates.whole_years_between(date, today)
    added = {
        "month": F.lit(calendar.test_date.month),
        "tenure_years": tenure,
        "tenure_capped": dates.capped(tenure, cap_years),
    }
    if year_built is not None:
        added["age_years"] = dates.age_since_year(year_built, today)
    return snapshot.withColumns(added).where(F.col("tenure_years") >= min_tenure_years)
