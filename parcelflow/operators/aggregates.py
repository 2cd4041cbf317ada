"""Counts, profiles and correlations. Every aggregate is combined on the map side."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow.checkpoints import checkpointed
from parcelflow.operators.positions import values_at


def stage_counts(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.countDistinct(key).alias("total_keys"))


def label_balance(df: DataFrame, label: str) -> DataFrame:
    known = df.where(F.col(label).isNotNull())
    return known.agg(
        F.count(F.lit(1)).alias("total"), F.sum(label).alias("positive"), (F.avg(label) * 100).alias("percent")
    )


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    known = df.select(F.explode(F.array(*cells)).alias("_cell")).select("_cell.*").where(F.col("value").isNotNull())
    return known.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


QUARTILES = (0.25, 0.5, 0.75)
SKETCH = 16_384  # size of a quantile sketch, which misplaces a value by about 2 of 10,000 rows, and rarely by more
MARGINS = (0.001, 0.004, 0.02, 0.2)  # around a quartile, as a share of the rows; a wider one is taken if the last was missed
SUMMED_AT_ONCE = 1_000_000  # values near the quartiles that one window may hold


def _intervals(sketch: Sequence[float], margin: int, least: float, largest: float) -> list[list[float]]:
    """Ranges of values around the quartiles, sorted and apart from each other; all values behind the last margin.

    ``sketch`` has two values around each quartile for each of ``MARGINS``.
    """
    if margin == len(MARGINS):
        return [[least, largest]]
    low = 2 * margin * len(QUARTILES)
    out: list[list[float]] = []
    for start, end in sorted(zip(sketch[low : low + 2 * len(QUARTILES) : 2], sketch[low + 1 : low + 2 * len(QUARTILES) : 2])):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _quartiles(df: DataFrame, intervals: dict[str, list[list[float]]]) -> dict[str, list[float]]:
    """Exact quartiles in one pass: rows inside of an interval are counted by value, those between them all together.

    A column whose intervals miss one of its quartiles is left out.
    """
    cells = []
    for i, (c, ranges) in enumerate(intervals.items()):
        value = F.col(c).cast("double")
        # 0 before the first interval, 1 inside of it, 2 behind it and so on.
        code = F.when(value.isNull(), F.lit(None))
        for j in range(len(ranges), 0, -1):
            code = code.when(value > ranges[j - 1][1], 2 * j).when(value >= ranges[j - 1][0], 2 * j - 1)
        cells.append(F.struct(F.lit(i).alias("of"), code.otherwise(0).alias("code"), value.alias("value")))
    cell = df.select(F.explode(F.array(*cells)).alias("_cell")).select("_cell.of", "_cell.code", F.expr("if(_cell.code % 2 = 1, _cell.value, null)").alias("value"))
    names = F.array(*[F.lit(c) for c in intervals])
    cell = cell.where("code is not null")
    counted = cell.groupBy("of", "code", "value").agg(F.count(F.lit(1)).alias("n"))
    counted = checkpointed(counted.select(F.element_at(names, F.col("of") + 1).alias("column"), "code", "value", "n"))
    sums = {(r["column"], r["code"]): r for r in counted.groupBy("column", "code").agg(F.sum("n").alias("rows"), F.count("*").alias("values")).collect()}
    targets, near = [], 0
    for c in intervals:
        codes = sorted(code for column, code in sums if column == c)
        rows = sum(sums[c, code]["rows"] for code in codes)
        found = []
        for i, point in enumerate(QUARTILES):
            before, place = 0, point * (rows - 1)
            for code in codes:
                if place < before + sums[c, code]["rows"]:
                    break
                before += sums[c, code]["rows"]
            if code % 2 and math.ceil(place) < before + sums[c, code]["rows"]:
                found.append((c, i, code, place - before))
        if len(found) == len(QUARTILES):
            targets += found
            near += sum(sums[c, code]["values"] for _, _, code, _ in found)
    if not targets:
        return {}
    wanted = df.sparkSession.createDataFrame(targets, "column string, point int, code int, place double")
    values = counted.join(F.broadcast(wanted), ["column", "code"]).select("column", "point", "value", "n", "place")
    if near <= SUMMED_AT_ONCE:
        end = F.sum("n").over(W.partitionBy("column", "point").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow))
        at = lambda rank: F.max(F.when((rank < F.col("end")) & (rank >= F.col("end") - F.col("n")), F.col("value")))
        low, high = at(F.floor("place")), at(F.ceil("place"))
        part = F.max(F.col("place") - F.floor("place"))
        found = values.withColumn("end", end).groupBy("column", "point").agg((low + (high - low) * part).alias("value"))
    else:
        found = values_at(values.drop("place"), ["column", "point"], "value", "n", wanted.drop("code"), "place")
    out = {c: [None] * len(QUARTILES) for c, *_ in targets}
    for r in found.collect():  # three rows a column
        out[r["column"]][r["point"]] = r["value"]
    return out


def profile_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column.

    Two passes over ``df``: one for counts, moments and a mergeable sketch, and one that counts the values which the
    sketch finds close to a quartile. Should the sketch be further off than expected, the second pass is done again
    with wider margins.
    """
    around = F.array(*[F.lit(min(max(p + side * m, 0.0), 1.0)) for m in MARGINS for p in QUARTILES for side in (-1, 1)])
    summaries: list[Column] = []
    for c in columns:
        value = F.col(c).cast("double")
        moments = [F.count(value), F.avg(value), F.stddev_samp(value), F.min(value), F.max(value)]
        named = [m.alias(n) for m, n in zip(moments, ("count", "mean", "std", "min", "max"))]
        summaries.append(F.struct(*named, F.kll_sketch_agg_double(value, SKETCH).alias("sketch")).alias(c))
    shown = [c for i, name in enumerate(columns) for c in (F.col(f"`{name}`").dropFields("sketch").alias(name), F.when(F.col(f"`{name}`.count") > 0, F.kll_sketch_get_quantile_double(F.col(f"`{name}`.sketch"), around)).alias(f"_around_{i}"))]
    found = df.agg(*summaries).select(*shown).first()
    margins = {c: next((i for i, m in enumerate(MARGINS) if m >= 2.0 / found[c]["count"]), len(MARGINS)) for c in columns if found[c]["count"]}
    quartiles: dict[str, list[float]] = {}
    while open_ := [c for c in margins if c not in quartiles]:
        around_ = {c: found[f"_around_{columns.index(c)}"] for c in open_}
        quartiles |= _quartiles(df, {c: _intervals(around_[c], margins[c], found[c]["min"], found[c]["max"]) for c in open_})
        margins = {c: min(m + 1, len(MARGINS)) for c, m in margins.items()}
    rows = [
        (c, *(found[c][n] for n in ("count", "mean", "std", "min")), *quartiles.get(c, (None,) * len(QUARTILES)), found[c]["max"]) for c in columns
    ]
    numbers = ", ".join(f"{n} double" for n in ("mean", "std", "min", "q25", "q50", "q75", "max"))
    return df.sparkSession.createDataFrame(rows, f"column string, count long, {numbers}")


def profile_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, extremes and exact quartiles of dates, one row per column. A quartile between two days is the earlier."""
    days = df.select(*[F.unix_date(F.to_date(c)).alias(c) for c in columns])
    found = profile_numeric(days, columns)
    shown = [F.date_from_unix_date(F.floor(c).cast("int")).alias(c) for c in ("min", "q25", "q50", "q75", "max")]
    return found.select("column", "count", *shown)


def profile_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency, one row per column.

    Equally frequent values are settled by taking the smallest text.
    """
    counted = _value_counts(df, columns)
    top = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value")))
    grouped = counted.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), top.alias("_top")
    )
    return grouped.select(
        "column", "count", "unique", F.col("_top.value").alias("top"), (-F.col("_top.rank")).alias("freq")
    )


def correlate(df: DataFrame, columns: Sequence[str], label: str, min_abs: float = 0.005) -> DataFrame:
    """Rows of the correlation matrix whose correlation with the label is larger than ``min_abs``.

    One output row per cell: ``column``, ``other``, ``correlation``. Every pair is taken over the rows where
    both are known, and all pairs come from one pass. A column that is constant there has no correlation.
    """
    columns = list(dict.fromkeys([label, *columns]))
    name = {frozenset(pair): f"c{i}" for i, pair in enumerate(combinations(columns, 2))}

    def correlation(a: str, b: str) -> Column:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        both = x.isNotNull() & y.isNotNull()
        deviation = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
        return F.try_divide(F.covar_pop(x, y), deviation)

    matrix = df.agg(*[correlation(a, b).alias(name[frozenset((a, b))]) for a, b in combinations(columns, 2)])

    def cell(a: str, b: str) -> Column:
        return F.lit(1.0) if a == b else F.col(name[frozenset((a, b))])

    cells = [
        F.struct(
            F.lit(a).alias("column"),
            F.lit(b).alias("other"),
            cell(a, b).alias("correlation"),
            cell(a, label).alias("_with_label"),
        )
        for a in columns
        for b in columns
    ]
    rows = matrix.select(F.explode(F.array(*cells)).alias("_cell")).select("_cell.*")
    return rows.where(F.abs("_with_label") > min_abs).drop("_with_label")
