"""Training and test rows of a month panel, split by date without label leakage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow.calendars import RunCalendar
from parcelflow.functions import dates
from parcelflow.operators.panel import HORIZONS, month_panel

TENURE_YEARS = (10, 20)
LABEL = "sale_in_3_months"
PRICE_LABEL = "next_sale_price"
LABELS = (LABEL, PRICE_LABEL, "sale_in_6_months", "sale_in_12_months")


def null_or_equal(c: str, value: int) -> Column:
    return F.col(c).isNull() | (F.col(c) == value)


def in_window(start, end, tenure: tuple[int, int] = TENURE_YEARS) -> Column:
    """Panel months between two dates whose tenure is inside the bounds, all inclusive."""
    return F.col("date").between(F.lit(start), F.lit(end)) & F.col("tenure_years").between(*tenure)


def test_panel(
    sales: DataFrame, calendar: RunCalendar, tenure: tuple[int, int] = TENURE_YEARS, horizons: Sequence[int] = HORIZONS
) -> DataFrame:
    """Rows of the test month: at most one per sale."""
    eligible = sales.where(null_or_equal("next_good_sale", 1))
    day = calendar.test_date
    panel = month_panel(
        eligible, "last_sale_date", "next_sale_date", calendar.as_of, day, day, *tenure, horizons
    )
    return panel.where(in_window(day, day, tenure))


def train_panel(
    sales: DataFrame, calendar: RunCalendar, tenure: tuple[int, int] = TENURE_YEARS, horizons: Sequence[int] = HORIZONS
) -> DataFrame:
    """Rows of the training year."""
    eligible = sales.where(null_or_equal("next_good_sale", 1))
    start, end = calendar.train_start, calendar.train_end
    panel = month_panel(
        eligible, "last_sale_date", "next_sale_date", calendar.as_of, start, end, *tenure, horizons
    )
    return panel.where(in_window(start, end, tenure))


def sells_in_test(
    calendar: RunCalendar, tenure: tuple[int, int] = TENURE_YEARS, months: int = HORIZONS[0]
) -> Column:
    """Whether a sale has a positive row in the test panel, read off the sale itself."""
    day = F.lit(calendar.test_date)
    opened = dates.sale_month("last_sale_date")
    closed = F.trunc("next_sale_date", "MM")
    years = F.floor(dates.months_between_months(opened, day) / 12)
    held = (opened <= day) & (closed > day) & years.between(*tenure)
    soon = dates.months_between_months(day, closed) <= months
    return held & soon & null_or_equal("next_good_sale", 1)


def guard_labels(train: DataFrame, is_leak: Column) -> DataFrame:
    """Hide the outcome of keys whose sale is what the test month asks about."""
    return train.withColumns(
        {
            LABEL: F.when(is_leak, 0).otherwise(F.col(LABEL)),
            PRICE_LABEL: F.when(~is_leak, F.col(PRICE_LABEL)),
        }
    )


@dataclass(frozen=True)
class Splits:
    test: DataFrame
    train: DataFrame

    @property
    def train_price(self) -> DataFrame:
        """Training rows of the price model: those with a price that was paid in a good sale."""
        return self.train.where(F.col(PRICE_LABEL).isNotNull() & null_or_equal("next_good_sale", 1))


def split_panel(
    sales: DataFrame,
    calendar: RunCalendar,
    keys: Sequence[str],
    tenure: tuple[int, int] = TENURE_YEARS,
    year_built: str | None = None,
) -> Splits:
    """Test and guarded training panels of linked sales (output of ``sale_chain`` with a sale number).

    The keys that sell in the test months are marked on the sales, before these are expanded to months. Sales
    hold one row per key and year, so the mark is a window over a bounded group, on the partitioning that the
    chain already has; no join is needed. With ``year_built``, both panels have the age at the test date.
    """
    if year_built is not None:
        sales = sales.withColumn("age_years", dates.age_since_year(year_built, F.lit(calendar.test_date)))
    sold = F.max(F.coalesce(sells_in_test(calendar, tenure), F.lit(False))).over(W.partitionBy(*keys))
    marked = sales.withColumn("_leak", sold)
    guarded = guard_labels(train_panel(marked, calendar, tenure), F.col("_leak")).drop("_leak")
    return Splits(test_panel(sales, calendar, tenure), guarded)


def modelling_rows(
    panel: DataFrame, label: str, features: Sequence[str], date: str | None = None, labels: Sequence[str] = LABELS
) -> DataFrame:
    """Distinct label and feature rows with a known label; with ``date``, also the first date of each."""
    columns = list(dict.fromkeys([*labels, *features]))
    known = panel.where(F.col(label).isNotNull())
    if date is None:
        return known.select(*columns).distinct()
    return known.groupBy(*columns).agg(F.min(date).alias(date))
