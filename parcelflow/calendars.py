"""Dates that a run is built around."""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass


def _shift(day: dt.date, months: int) -> dt.date:
    """First of the month that lies ``months`` months after ``day``."""
    index = day.year * 12 + day.month - 1 + months
    return dt.date(index // 12, index % 12 + 1, 1)


def _month_end(day: dt.date) -> dt.date:
    return day.replace(day=calendar.monthrange(day.year, day.month)[1])


@dataclass(frozen=True)
class RunCalendar:
    run_date: dt.date
    as_of: dt.date  # last day the data is known for; later than run_date when back-testing
    test_date: dt.date
    train_start: dt.date
    train_end: dt.date
    prediction_start: dt.date
    prediction_end: dt.date


def run_calendar(run_date: dt.date | str, as_of: dt.date | str | None = None) -> RunCalendar:
    """Test month, training year (ending half a year before it) and the quarter to predict."""
    if isinstance(run_date, str):
        run_date = dt.date.fromisoformat(run_date)
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    test = run_date.replace(day=1)
    train_end = _month_end(_shift(test, -6))
    prediction_start = _shift(test, 1)
    return RunCalendar(
        run_date=run_date,
        as_of=as_of or run_date,
        test_date=test,
        train_start=_shift(train_end, -12),
        train_end=train_end,
        prediction_start=prediction_start,
        prediction_end=_month_end(_shift(prediction_start, 2)),
    )
