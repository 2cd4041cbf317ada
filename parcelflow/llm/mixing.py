"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, followed by the same documents again as often as repeats are
allowed. A document's virtual finish time is the number of tokens its source has sent, itself included, over the weight
of the source. All queues are merged by that time and the mix ends where the token budget is used up. A source that
runs out leaves its share to the others, which is what sharing the excess again by weight comes to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow.llm.shared import LAST_ID, running, slices_for, written


def shared_out(sizes: DataFrame, budget: float, repeats: int) -> float:
    """Tokens for each unit of weight, when no source of ``sizes`` gets more than ``repeats`` times its source_size.

    What a source cannot take is shared again by weight among the others, until none is above its limit. Every round
    finds another source that is above, and each is one small sum over the sources.
    """
    limit, level = F.col("source_size") * repeats, 0.0
    while True:
        full = limit <= F.lit(level) * F.col("weight")
        spent, left = sizes.agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))).first()
        if not left:
            return float("inf")
        reached = (budget - float(spent or 0)) / float(left)
        if reached <= level:
            return level
        level = reached


def weighed(docs: DataFrame, weights: DataFrame, share: float, repeats: int, seed: int, carry: list[str]) -> tuple[DataFrame, int]:
    """Documents with the size and target of their source and the finish time of their first copy; the token budget."""
    named = [F.col("source").isNull().alias("missing"), F.coalesce("source", F.lit("")).alias("name")]
    turn = F.xxhash64(F.lit(seed), "doc_id", "source", "size")
    rows = written(docs.select("doc_id", "source", "size", *carry, *named, turn.alias("turn")))
    totals = rows.groupBy("missing", "name").agg(F.sum("size").alias("source_size"))
    sizes = written(totals.join(weights.select(*named, "weight"), ["missing", "name"]))
    budget = share * (sizes.agg(F.sum("source_size")).first()[0] or 0)
    level = shared_out(sizes, budget, repeats)
    limit = (F.col("source_size") * repeats).cast("double")
    sizes = sizes.withColumn("target", F.least(limit, F.lit(level) * F.col("weight")))
    queued = running(rows, ["missing", "name"], F.col("turn"), ["turn", "doc_id", *carry], F.col("size"), "sent")
    queued = queued.join(written(sizes), ["missing", "name"])
    place = F.struct(
        ((F.col("sent") + F.col("size")) / F.col("weight")).alias("finish"),
        "turn", F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"),
    )
    return written(queued.withColumn("place", place)), int(budget)


def _copy(number: int) -> Column:
    """Place of a document's copy in the merged queues: its source has been sent ``number`` times before."""
    later = F.col("place.finish") + F.lit(number) * F.col("source_size") / F.col("weight")
    return F.struct(later.alias("finish"), F.col("place.turn").alias("turn"), F.col("place.id").alias("id"))


def cut(queued: DataFrame, budget: int, repeats: int):
    """The place of the last copy that the budget still holds, or None.

    Finish times are cut into even ranges and the tokens of each are summed; only the copies of the range in which the
    budget ends are put in order one by one.
    """
    copies = queued.where("size > 0").select("size", F.explode(F.array(*[_copy(i) for i in range(repeats)])).alias("at"))
    last, number = copies.agg(F.max("at.finish"), F.count("*")).first()
    if not number:
        return None
    slices = slices_for(number)
    copies = copies.withColumn("range", F.least(F.floor(F.col("at.finish") / F.lit(last) * slices), F.lit(slices - 1)))
    sums = copies.groupBy("range").agg(F.sum("size").alias("tokens")).orderBy("range").collect()  # one row a range
    spent, ending = 0, None
    for row in sums:
        if spent + row["tokens"] > budget:
            ending = row["range"]
            break
        spent += row["tokens"]
    inside = copies.where(F.col("range") == F.lit(ending)) if ending is not None else copies
    if ending is not None:
        total = F.sum("size").over(W.orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow))
        found = inside.withColumn("total", total).where(F.col("total") <= budget - spent).agg(F.max("at")).first()[0]
        if found is not None:
            return found
        inside = copies.where(F.col("range") < F.lit(ending))
    return inside.agg(F.max("at")).first()[0]


def mixed(
    docs: DataFrame, weights: DataFrame, share: float = 1.5, repeats: int = 2, seed: int = 0, carry: tuple[str, ...] | list[str] = ()
) -> DataFrame:
    """How many tokens the mix takes of each document.

    ``docs`` has doc_id, source, size (tokens) and the columns to ``carry``; ``weights`` has source and weight (above 0) for every source. The mix
    holds ``share`` times all tokens, short by less than one document, and no document more than ``repeats`` times. The
    result has the rows of ``docs`` with source_size, target (of the source), copies and taken (copies times size).

    An empty table gives none. A null source is a source like any other. Documents of size 0 are never taken. Ties are settled by a hash of the
    row; rows that are equal in all columns cannot be told apart, so it doesn't matter which one comes first.
    """
    queued, budget = weighed(docs, weights, share, repeats, seed, list(carry))
    end = cut(queued, budget, repeats)
    copies = F.lit(0)
    if end is not None:
        last = F.struct(F.lit(end["finish"]).alias("finish"), F.lit(end["turn"]).alias("turn"), F.lit(end["id"]).alias("id"))
        copies = sum((F.when(_copy(i) <= last, 1).otherwise(0) for i in range(repeats)), F.lit(0))
        copies = F.when(F.col("size") > 0, copies).otherwise(0)
    return queued.select("doc_id", "source", "size", "source_size", "weight", "target", "place", *carry, copies.alias("copies")).withColumn(
        "taken", F.col("copies") * F.col("size")
    )


def in_order(mix: DataFrame, repeats: int = 2) -> DataFrame:
    """The documents of a mix, each copy a row, range-sorted by finish time: what a training run would read."""
    each = mix.select("*", F.posexplode(F.array(*[_copy(i) for i in range(repeats)])).alias("pass", "at"))
    return each.where(F.col("pass") < F.col("copies")).repartitionByRange("at").sortWithinPartitions("at")


def repeated(docs: DataFrame, size: Column, weights: DataFrame, share: float = 1.5, repeats: int = 2, seed: int = 0) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its columns. ``docs`` has doc_id and source.

    Rows that agree in every column are taken together and the copies dealt out among them.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key = F.xxhash64(*columns)
    sized = docs.select("doc_id", "source", size.cast("long").alias("size"), key.alias("key"))
    taken = mixed(sized, weights, share, repeats, seed, ["key"]).where("copies > 0")
    taken = taken.groupBy(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "key").agg(F.sum("copies").alias("copies"))
    rows = docs.select(F.struct(*columns).alias("row"), F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), key.alias("key"))
    same = F.row_number().over(W.partitionBy("id", "key").orderBy("key"))
    own = F.least(F.lit(repeats).cast("long"), F.col("copies") - F.lit(repeats) * (same - 1))
    joined = rows.join(written(taken), ["id", "key"]).withColumn("own", own).where("own > 0")
    return joined.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("own")))).select("row.*")
