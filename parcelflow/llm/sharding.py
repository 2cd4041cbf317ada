"""Shards of near equal bytes by Karmarkar-Karp differencing over indivisible groups.

A partial partition is a sum for each shard. The two with the largest spread between their heaviest and lightest shard
are combined again and again, the heaviest of one with the lightest of the other, until one is left. A task differences
the groups of one batch to a partial partition; the partial partitions of all batches are differenced the same way, in
as many levels as it takes. No level sees more than a batch at a time.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.shared import running, written

#: Groups that are differenced at a time, at most and on average, and partial partitions.
BATCH, LEVEL = 10_000, 8192
#: Bytes that a document takes in a shard besides its text.
OVERHEAD = 16


def differenced(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combines the rows of ``sums`` (each a partial partition) into one.

    Returns the shard of the result that each part of each row goes to, and the sums of the result. Ties are settled by
    the order of the rows.
    """
    rows, shards = sums.shape
    # Each part list is kept heaviest first; the first order brings it there.
    order = [np.argsort(-row, kind="stable") for row in sums]
    parts = [row[by] for row, by in zip(sums, order, strict=True)]
    heap = [(int(p[-1] - p[0]), i) for i, p in enumerate(parts)]
    heapq.heapify(heap)
    joined: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        (_, left), (_, right) = heapq.heappop(heap), heapq.heappop(heap)
        total = parts[left] + parts[right][::-1]
        by = np.argsort(-total, kind="stable")
        parts[left] = parts[right] = None
        parts.append(total[by])
        joined.append((left, right, by))
        heapq.heappush(heap, (int(total[by[-1]] - total[by[0]]), len(parts) - 1))
    # From the last combination down: which shard each part of the two combined lists ends in.
    shard_of: list[np.ndarray | None] = [None] * len(parts)
    shard_of[-1] = np.arange(shards)
    for i in range(len(joined) - 1, -1, -1):
        left, right, by = joined[i]
        to = shard_of[rows + i]
        here = np.empty(shards, np.int64)
        here[by] = to
        shard_of[left], shard_of[right], shard_of[rows + i] = here, here[::-1], None
    out = np.empty((rows, shards), np.int64)
    for row, by in enumerate(order):
        out[row, by] = shard_of[row]
    return out, parts[-1]


def _groups(shards: int):
    def over(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("digest")
        sums = np.zeros((rows.num_rows, shards), np.int64)
        sums[:, 0] = rows["bytes"].to_numpy()
        to, _ = differenced(sums)
        return pa.table([rows["digest"], rows["bytes"], rows["part"], pa.array(to[:, 0].astype(np.int32))], ["digest", "bytes", "part", "shard"])

    return over


def _parts(shards: int):
    def over(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part")
        number = rows.num_rows
        to, total = differenced(np.array(rows["sums"].combine_chunks().flatten(), np.int64).reshape(-1, shards))
        each = pa.ListArray.from_arrays(pa.array(np.arange(0, number * shards + 1, shards), pa.int32()), pa.array(to.ravel().astype(np.int32)))
        whole = pa.array([total.tolist()] * number, pa.list_(pa.int64()))
        return pa.table([rows["part"], each, rows["whole"], whole], ["part", "to", "whole", "sums"])

    return over


def group_shards(groups: DataFrame, shards: int) -> DataFrame:
    """``groups`` (digest, bytes; one row for each) with the shard of each: digest, shard.

    A hash of the digest says which batch a group is in, and batches are sorted, so the same groups always end in the
    same shards, however they lie.
    """
    bits = max(0, math.ceil(math.log2(max(1, groups.count()) / BATCH)))
    part = F.shiftrightunsigned(F.xxhash64("digest"), 64 - bits) if bits else F.lit(0).cast("long")
    dealt = groups.select("digest", "bytes", part.alias("part")).groupBy("part")
    dealt = written(dealt.applyInArrow(_groups(shards), "digest binary, bytes long, part long, shard int"))
    sums = dealt.groupBy("part", "shard").agg(F.sum("bytes").alias("bytes")).groupBy("part")
    held = F.map_from_entries(F.collect_list(F.struct("shard", "bytes")))
    zero = F.lit(0).cast("long")
    full = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.coalesce(F.try_element_at(F.col("held"), s), zero))
    parts = sums.agg(held.alias("held")).select("part", full.alias("sums"))
    placed = dealt.select("digest", "part", "shard")
    while True:
        parts = written(parts)
        if parts.count() <= 1:
            return placed.select("digest", "shard")
        # Neighbouring parts are one part of the next level, which has LEVEL times fewer.
        level = parts.withColumn("whole", F.floor(F.col("part") / LEVEL)).groupBy("whole")
        level = written(level.applyInArrow(_parts(shards), "part long, to array<int>, whole long, sums array<long>"))
        to = level.select("part", "to", "whole")
        placed = written(placed.join(to, "part").select("digest", F.col("whole").alias("part"), F.element_at("to", F.col("shard") + 1).alias("shard")))
        parts = level.select(F.col("whole").alias("part"), "sums").dropDuplicates(["part"])


def sharded(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with its shard and its slot there: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the text's UTF-8 bytes and ``OVERHEAD``; shards are near equal in bytes (``law`` is "bytes") and documents
    with equal texts are in one shard. Null texts are one group with no bytes, as are empty ones. Slots of a shard count
    from 0 without gaps; rows with equal doc_id each have their own. The result does not depend on how the rows lie; rows
    that agree in doc_id and text take neighbouring slots. Other columns are left out. An empty table has no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"), F.xxhash64("doc_id", text).alias("turn"),
    )
    rows = written(rows)
    groups = written(rows.groupBy("digest").agg(F.sum("size").alias("bytes")))
    placed = written(rows.join(written(group_shards(groups, shards)), "digest"))
    numbered = running(placed, ["shard"], F.col("turn"), ["turn", "doc_id", "digest"], F.lit(1), "slot")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
