"""Joins that stay spread out when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROWS_PER_TASK = 2_000_000  # a key with more rows is dealt out in shares of about this many

_ROWS, _SHARES, _SALT = "_rows", "_shares", "_salt"


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows, with their ``_rows``: at most rows / rows_per_task of them."""
    counts = df.where(_known(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS))
    return counts.where(F.col(_ROWS) > rows_per_task)


def _known(keys: Sequence[str]):
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return known


def spread_join(
    big: DataFrame,
    unique: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join ``big`` to a side with one row per key (``inner``, ``left``, ``left_semi`` or ``left_anti``).

    A hot key is dealt out in as many shares as its rows need, by a hash of the row and of the partition it comes
    from, so a task that is run again deals the same way; the single row that the key matches is copied to each share.
    All other keys join as usual. Rows without a key match nothing and are dealt out by the same hash, without copies.
    The list of hot keys is broadcast: its length is bounded (see ``hot_keys``). Where ``big`` is reduced before, or
    costly to compute, pass ``hot``, the hot keys of a table that it was reduced from.
    """
    if hot is None:
        hot = hot_keys(big, keys, rows_per_task)
    shares = F.ceil(F.col(_ROWS) / F.lit(rows_per_task)).cast("long")
    hot = F.broadcast(hot.select(*keys, shares.alias(_SHARES)))
    place = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in big.columns])
    share = F.when(~_known(keys), place).when(F.col(_SHARES).isNotNull(), F.pmod(place, F.col(_SHARES))).otherwise(0)
    copies = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(_SHARES), F.lit(1)) - 1)

    dealt = big.join(hot, list(keys), "left").withColumn(_SALT, share).drop(_SHARES)
    copied = unique.join(hot, list(keys), "left").withColumn(_SALT, F.explode(copies)).drop(_SHARES)
    joined = dealt.join(copied, [*keys, _SALT], how).drop(_SALT)
    added = [] if how in ("left_semi", "left_anti") else [c for c in unique.columns if c not in keys]
    return joined.select(*big.columns, *added)


def members(df: DataFrame, others: DataFrame, keys: Sequence[str], **spread) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``others``."""
    return spread_join(df, others.select(*keys).distinct(), keys, "left_semi", **spread)


def non_members(df: DataFrame, others: DataFrame, keys: Sequence[str], **spread) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``others``; a missing key never occurs."""
    return spread_join(df, others.select(*keys).distinct(), keys, "left_anti", **spread)


def suffix_overlap(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_suffix: str, right_suffix: str
) -> tuple[DataFrame, DataFrame]:
    """Both sides with the columns they share, other than the keys, renamed apart."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    return (
        left.withColumnsRenamed({c: c + left_suffix for c in shared}),
        right.withColumnsRenamed({c: c + right_suffix for c in shared}),
    )


def join_with_suffixes(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    suffixes: tuple[str, str],
    how: str = "left",
) -> DataFrame:
    left, right = suffix_overlap(left, right, keys, *suffixes)
    return left.join(right, list(keys), how)


def positive(df: DataFrame, price: str) -> DataFrame:
    """Rows with a known positive price. After an outer join this lets Spark run an inner join."""
    return df.where(F.col(price) > 0)


def key_counts(df: DataFrame, keys: Sequence[str], name: str = "total_sales") -> DataFrame:
    """Rows per known key."""
    return df.where(_known(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def with_key_count(
    df: DataFrame, keys: Sequence[str], name: str = "total_sales", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Every row with the number of rows of its key. Rows without a key are dropped.

    The counts also tell which keys are hot, so they are computed once for both.
    """
    counts = key_counts(df, keys, name)
    hot = counts.where(F.col(name) > rows_per_task).select(*keys, F.col(name).alias(_ROWS))
    return spread_join(df, counts, keys, "inner", rows_per_task, hot)


def with_key_count_window(df: DataFrame, keys: Sequence[str], name: str = "total_sales") -> DataFrame:
    """As ``with_key_count``, for rows already reduced to one per key and period, whose groups are bounded."""
    return df.where(_known(keys)).withColumn(name, F.count(F.lit(1)).over(W.partitionBy(*keys)))
