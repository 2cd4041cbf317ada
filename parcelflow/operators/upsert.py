"""Update rows that match on a key, insert the others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ACTION = "action"


def upsert_with_action(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], update_columns: Sequence[str] | None = None
) -> DataFrame:
    """Target after the upsert plus ``action``: ``kept``, ``updated`` or ``inserted``.

    Keys match by null-safe equality, so a missing part of a key matches a missing one and a second run changes
    nothing. Both sides hold one row per key, so the full outer join has no large group; a key that ``updates`` holds
    twice is an error. The choice between old and new is made per row: a new NULL replaces an old value.
    """
    values = [c for c in target.columns if c not in keys]
    changed = set(values if update_columns is None else update_columns)
    old = target.withColumn("_old", F.lit(True)).withColumnsRenamed({c: f"_old_{c}" for c in values})
    new = updates.select(*keys, *[c for c in values if c in updates.columns])
    twice = F.raise_error(F.concat_ws(" ", F.lit("more than one update of"), *[F.col(k).cast("string") for k in keys]))
    times = F.count(F.lit(1)).over(W.partitionBy(*keys))
    new = new.withColumn("_new", F.when(times > 1, twice.cast("boolean")).otherwise(F.lit(True)))
    new = new.withColumnsRenamed({c: f"_new_{c}" for c in [*keys, *values]})
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_new_{key}"))
    joined = old.join(new, same, "full_outer")
    is_new = F.col("_new").isNotNull()
    inserted = F.col("_old").isNull()
    chosen = []
    for c in values:
        fresh = F.col(f"_new_{c}") if c in updates.columns else F.lit(None).cast(target.schema[c].dataType)
        take = inserted | is_new if c in changed and c in updates.columns else inserted
        chosen.append(F.when(take, fresh).otherwise(F.col(f"_old_{c}")).alias(c))
    action = F.when(inserted, "inserted").when(is_new, "updated").otherwise("kept")
    known = [F.when(inserted, F.col(f"_new_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    return joined.select(*known, *chosen, action.alias(ACTION)).select(*target.columns, ACTION)


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], update_columns: Sequence[str] | None = None
) -> DataFrame:
    return upsert_with_action(target, updates, keys, update_columns).drop(ACTION)


def action_counts(result: DataFrame) -> DataFrame:
    return result.groupBy(ACTION).agg(F.count(F.lit(1)).alias("n"))
