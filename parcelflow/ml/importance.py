"""Permutation importance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow.checkpoints import checkpointed
from parcelflow.ml.score import SCORE, score_sales
from parcelflow.operators.positions import with_position

_UNCHANGED = ""


def shuffled_copy(df: DataFrame, columns: Sequence[str], seed: int) -> DataFrame:
    """Each row plus the values that ``columns`` have in another row, as ``_other_<column>``.

    A true permutation: rows are numbered in two orders of their content, one of which depends on the seed, and matched
    by number. So it is the same however the rows lie; rows equal in all columns are the same row to it.
    """
    def placed(salt: int) -> DataFrame:
        mixed = df.withColumn("_mix", F.xxhash64(F.lit(salt), *df.columns))
        return with_position(mixed, [], ["_mix", *df.columns], "_place").drop("_mix")

    own = placed(0)
    others = [F.col(c).alias(f"_other_{c}") for c in columns]
    return own.join(placed(seed + 1).select("_place", *others), "_place").drop("_place")


def permutation_importance(
    model, df: DataFrame, features: Sequence[str], label: str, cut: float = 0.5, seed: int = 42
) -> DataFrame:
    """Loss of accuracy of a classifier when one feature is permuted: columns ``feature``, ``importance``.

    Every feature uses the same permutation. The unchanged rows and all changed versions are scored in one pass.
    """
    known = df.select(*features, label).where(F.col(label).isNotNull())
    pairs = checkpointed(shuffled_copy(known, features, seed))
    versions = [
        F.struct(
            F.lit(changed).alias("feature"),
            *[F.col(f"_other_{c}" if c == changed else c).alias(c) for c in features],
        )
        for changed in [_UNCHANGED, *features]
    ]
    stacked = pairs.select(label, F.explode(F.array(*versions)).alias("_v")).select(label, "_v.*")
    hit = ((F.col(SCORE) > cut).cast("int") == F.col(label)).cast("double")
    accuracy = score_sales(stacked, model, features).groupBy("feature").agg(F.avg(hit).alias("_accuracy"))
    # One row per feature from here on.
    base = F.max(F.when(F.col("feature") == _UNCHANGED, F.col("_accuracy"))).over(W.partitionBy())
    compared = accuracy.withColumn("importance", base - F.col("_accuracy"))
    changed = compared.where(F.col("feature") != _UNCHANGED).select("feature", "importance")
    return changed.orderBy(F.desc("importance"), "feature")
