"""One row per event and calendar month until the next event."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import dates

HORIZONS = (3, 6, 12)


def horizon_label(months_to_go: Column | str, has_next: Column, months: int) -> Column:
    """1 if the next event comes within ``months`` months."""
    remaining = F.col(months_to_go) if isinstance(months_to_go, str) else months_to_go
    return F.when(has_next & (remaining <= months), 1).otherwise(0)


def month_panel(
    df: DataFrame,
    date: str,
    next_date: str,
    as_of: dt.date,
    start: dt.date | None = None,
    end: dt.date | None = None,
    min_tenure_years: int = 0,
    max_tenure_years: int | None = None,
    horizons: Sequence[int] = HORIZONS,
    cap_years: int = 25,
    year_built: str | None = None,
    age_as_of: dt.date | None = None,
) -> DataFrame:
    """Expand events to months, from the event's month up to the month before the next event (or ``as_of``).

    The date and tenure bounds set where the month sequence starts and stops, so months outside of them are
    never generated. No shuffle: each row is expanded on its own. With ``year_built``, ``age_years`` is the age at
    ``age_as_of`` (or ``as_of``), the same for all months of an event.
    """
    opened = dates.sale_month(date)
    closed = F.trunc(F.coalesce(F.col(next_date), F.lit(as_of)), "MM")
    first, last = F.col("_opened"), F.add_months(F.col("_closed"), -1)
    if min_tenure_years:
        first = F.add_months(first, 12 * min_tenure_years)
    if start is not None:
        first = F.greatest(first, F.lit(start.replace(day=1) if start.day == 1 else _next_month(start)))
    if max_tenure_years is not None:
        last = F.least(last, F.add_months(F.col("_opened"), 12 * max_tenure_years + 11))
    if end is not None:
        last = F.least(last, F.lit(end.replace(day=1)))

    bounded = df.withColumns({"_opened": opened, "_closed": closed})
    expanded = bounded.withColumn("date", F.explode(dates.month_range(first, last)))
    expanded = expanded.withColumns(
        {
            "tenure_months": dates.months_between_months("_opened", "date"),
            "_to_go": dates.months_between_months("date", "_closed"),
        }
    )
    has_next = F.col(next_date).isNotNull()
    tenure = F.floor(F.col("tenure_months") / 12).cast("int")
    features = {
        **{f"sale_in_{n}_months": horizon_label("_to_go", has_next, n) for n in horizons},
        "month": F.month("date"),
        "tenure_years": tenure,
        "tenure_capped": dates.capped(tenure, cap_years),
    }
    if year_built is not None:
        features["age_years"] = dates.age_since_year(year_built, F.lit(age_as_of or as_of))
    return expanded.withColumns(features).drop("_opened", "_closed", "_to_go")


def _next_month(day: dt.date) -> dt.date:
    return dt.date(day.year + day.month // 12, day.month % 12 + 1, 1)
