"""Approximate nearest neighbours by cross-polytope hashing.

A table rotates unit vectors by fast pseudo-rotations, three times random signs and a Hadamard transform, and assigns
each to the signed axis it is nearest to. Larger indexes take several rotations for a key, the last over as many axes as
bring a bucket to about ``BUCKET`` vectors. A query is looked up under several keys of each table, those with the least
distance to the axes, and what shares a bucket is ranked by the inner product of the original vectors.

Tables are added, a few at a time, until the recall of a bounded sample of the queries, measured against all vectors, is
``RECALL``. A query that has met fewer vectors than it asks for is compared with all of them, in blocks.

The largest inner product is the smallest angle where all norms are equal. Otherwise vectors get one more component that
brings them to the largest norm, which queries do not have; that leaves inner products as they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow.llm.shared import LAST_ID, mapped, row_id, written
from parcelflow.llm.words import paired

#: Vectors that a bucket holds on average.
BUCKET = 256
#: Tables that a round adds, and the keys a query is looked up under in each.
TABLES, PROBES = 4, 8
#: Queries whose true neighbours are sought among all vectors, and the share of these that has to be found.
SAMPLE, RECALL = 256, 0.95
#: Vectors or queries of a bucket that one group holds; larger buckets are met in blocks of this size.
BLOCK = 4096
#: Products that are summed at a time.
_PAIRS = 1 << 15

_POINT = "key long, row long, id long, vector binary"
_FOUND = "query_row long, query_id long, row long, id long, score double"


@dataclass(frozen=True)
class Space:
    """What hashing has to know of all vectors of one length."""

    length: int
    rows: int
    least: float
    largest: float

    @property
    def padded(self) -> bool:
        return self.least < self.largest * (1 - 1e-6)

    @property
    def width(self) -> int:
        """Components after the one that evens out norms, as a power of two, since Hadamard transforms want one."""
        return 1 << math.ceil(math.log2(self.length + self.padded))

    def axes(self) -> list[int]:
        """Axes of each rotation of a key; both signs of each are told apart."""
        wanted, out = self.rows / BUCKET, []
        while wanted > 1:
            axes = min(self.width, 1 << max(0, math.ceil(math.log2(wanted / 2))))
            out.append(axes)
            wanted /= 2 * axes
        return out


def rotated(points: np.ndarray, seed: list[int]) -> np.ndarray:
    """Three times random signs and a Hadamard transform; lengths stay as they are."""
    dice, (rows, width) = np.random.default_rng(seed), points.shape
    for _ in range(3):
        points = points * dice.choice([-1.0, 1.0], width)
        step = 1
        while step < width:
            halves = points.reshape(rows, -1, 2, step)
            points = np.stack([halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]], 2).reshape(rows, width)
            step *= 2
        points = points / math.sqrt(width)
    return points


def keys(points: np.ndarray, space: Space, table: int, probes: int) -> np.ndarray:
    """The ``probes`` keys (or all, if there are fewer) of each point in a table, nearest axes first."""
    codes, cost = np.zeros((len(points), 1), np.int64), np.zeros((len(points), 1))
    for turn, axes in enumerate(space.axes()):
        near = rotated(points, [space.length, table, turn])[:, :axes]
        near = np.concatenate([near, -near], 1)
        best = np.argsort(-near, axis=1, kind="stable")[:, :probes]
        less = near.max(1, keepdims=True) - np.take_along_axis(near, best, 1)
        codes = (codes[:, :, None] * (2 * axes) + best[:, None, :]).reshape(len(points), -1)
        cost = (cost[:, :, None] + (less * less)[:, None, :]).reshape(len(points), -1)
        first = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        codes, cost = np.take_along_axis(codes, first, 1), np.take_along_axis(cost, first, 1)
    name = paired(np.full(1, space.length, np.uint64), np.full(1, table, np.uint64))
    return paired(np.broadcast_to(name, codes.size), codes.ravel().view(np.uint64)).view(np.int64).reshape(codes.shape)


def _matrix(vectors: pa.Array, kind: str) -> np.ndarray:
    """Binary vectors of one length as rows of doubles."""
    return np.stack([np.frombuffer(v.as_buffer(), kind) for v in vectors]).astype(np.float64)


def _unit(points: np.ndarray, space: Space, query: bool) -> np.ndarray:
    scaled = points / np.abs(points).max(1, keepdims=True)
    norms = np.linalg.norm(scaled, axis=1, keepdims=True)
    out = np.zeros((len(points), space.width))
    out[:, : space.length] = scaled / norms
    if space.padded and not query:
        share = np.minimum(1.0, norms[:, 0] * np.abs(points).max(1) / space.largest)
        out[:, : space.length] *= share[:, None]
        out[:, space.length] = np.sqrt(1 - share * share)
    return out


def _checked(kind: str):
    """Vectors that take part, as bytes, with their length and norm."""

    def over(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vectors = batch["vector"]
        values = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind)
        size = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(size)))
        good, total = np.isfinite(values), np.concatenate(([0], np.cumsum(~np.isfinite(values))))
        nonzero = np.concatenate(([0], np.cumsum(good & (values != 0))))
        fit = (total[ends[1:]] == total[ends[:-1]]) & (nonzero[ends[1:]] > nonzero[ends[:-1]])
        which = np.flatnonzero(fit)
        parts = [values[ends[i] : ends[i + 1]] for i in which]
        largest = [float(np.abs(p).max()) for p in parts]
        norms = [m * float(np.linalg.norm(p.astype(np.float64) / m)) for p, m in zip(parts, largest, strict=True)]
        yield pa.record_batch(
            [
                pa.array(batch["row"].take(pa.array(which))), batch["id"].take(pa.array(which)), pa.array(size[which]), pa.array(norms, pa.float64()),
                pa.array([p.tobytes() for p in parts], pa.binary()),
            ],
            ["row", "id", "length", "norm", "vector"],
        )

    return over


def _hashed(kind: str, spaces: dict[int, Space], tables: range, query: bool, vectors: bool = True) -> Callable:
    """Each vector once for each of its keys, with or without the vector itself."""

    def over(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lengths = batch["length"].to_numpy()
        for length in np.unique(lengths):
            space, here = spaces[int(length)], batch.filter(pa.array(lengths == length))
            points = _unit(_matrix(here["vector"], kind), space, query)
            for table in tables:
                found = keys(points, space, table, PROBES if query else 1)
                if not vectors:
                    yield pa.record_batch([pa.array(found.ravel())], ["key"])
                    continue
                rows = pa.array(np.repeat(np.arange(len(points)), found.shape[1]))
                yield pa.record_batch([pa.array(found.ravel()), *(here[c].take(rows) for c in ("row", "id", "vector"))], ["key", "row", "id", "vector"])

    return over


def best(query: np.ndarray, other: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, count: int):
    """(query, other, score) indexes of the ``count`` largest inner products of each query, its own row left out.

    A fast product finds who can be among them, with room for its rounding; these are summed in one fixed order, so equal
    vectors have equal scores wherever they stand, and ties go to the smaller id.
    """
    fast = query @ other.T
    fast[own[:, None] == rows[None, :]] = -np.inf
    count = min(count, fast.shape[1])
    least = np.partition(fast, fast.shape[1] - count, axis=1)[:, fast.shape[1] - count]
    room = 1e-12 * np.linalg.norm(query, axis=1) * np.linalg.norm(other, axis=1).max(initial=0.0)
    q, o = np.nonzero((fast >= (least - room)[:, None]) & (fast > -np.inf))
    score = np.concatenate([np.zeros(0), *((query[q[i : i + _PAIRS]] * other[o[i : i + _PAIRS]]).sum(1) for i in range(0, len(q), _PAIRS))])
    by = np.lexsort((rows[o], ids[o], -score, q))
    q, o, score = q[by], o[by], score[by]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < count], o[place < count], score[place < count]


def _ranked(kind: str, count: int):
    """The best of a group's vectors for each of its queries."""
    names = [c.split(" ")[0] for c in _FOUND.split(", ")]

    def over(queries: pa.Table, others: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 4, [np.zeros(0)]
        parts = [tuple(zip(names, (*out[0], out[1][0]), strict=True))]
        if queries.num_rows and others.num_rows:
            other = _matrix(others["vector"].combine_chunks(), kind)
            rows, ids = others["row"].to_numpy(), others["id"].to_numpy()
            for low in range(0, queries.num_rows, 256):
                some = queries.slice(low, 256)
                own = some["row"].to_numpy()
                q, o, score = best(_matrix(some["vector"].combine_chunks(), kind), other, own, rows, ids, count)
                parts.append(tuple(zip(names, (own[q], some["id"].to_numpy()[q], rows[o], ids[o], score), strict=True)))
        return pa.table({n: np.concatenate([dict(p)[n] for p in parts]) for n in names})

    return over


def _in_blocks(queries: DataFrame, others: DataFrame, kind: str, count: int, many: DataFrame | None, many_queries: DataFrame | None) -> DataFrame:
    """What meets under equal keys, ranked. Keys with more than ``BLOCK`` rows (in ``many``: key, n) are met in blocks."""

    def dealt(df: DataFrame, own: DataFrame | None, across: DataFrame | None, mine: str, theirs: str) -> DataFrame:
        # A row goes to one block of its side, and meets every block of the other.
        blocks = lambda n: F.ceil(F.coalesce(F.col(n), F.lit(1)) / BLOCK).cast("int")
        for side, name in ((own, "own_n"), (across, "across_n")):
            df = df.withColumn(name, F.lit(1)) if side is None else df.join(side.select(F.col("key").alias("_key"), F.col("n").alias(name)), F.col("key") == F.col("_key"), "left").drop("_key")
        each = F.explode(F.sequence(F.lit(0), blocks("across_n") - 1)).alias(theirs)
        return df.select("key", "row", "id", "vector", F.pmod(F.xxhash64("row"), blocks("own_n")).cast("int").alias(mine), each)

    left = dealt(queries, many_queries, many, "query_block", "block").groupBy("key", "block", "query_block")
    right = dealt(others, many, many_queries, "block", "query_block").groupBy("key", "block", "query_block")
    return left.cogroup(right).applyInArrow(_ranked(kind, count), _FOUND)


def _nearest(found: DataFrame, count: int) -> DataFrame:
    """The best of all that was found for each query, with its rank from 1."""
    order = W.partitionBy("query_row").orderBy(F.desc("score"), "id", "row")
    once = found.groupBy("query_row", "query_id", "row", "id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


@dataclass(frozen=True)
class Search:
    """Neighbours found (query_row, query_id, row, id, score, rank), the recall measured on the sample and the tables used."""

    found: DataFrame
    recall: float
    tables: int


def _scanned(queries: DataFrame, index: DataFrame, kind: str, count: int, rows: int) -> DataFrame:
    """Queries against all vectors of their length, in blocks; keys are lengths."""
    point = lambda df: df.select(F.col("length").alias("key"), "row", "id", "vector")
    lengths = index.groupBy(F.col("length").alias("key")).agg(F.count("*").alias("n"))
    asked = queries.groupBy(F.col("length").alias("key")).agg(F.count("*").alias("n"))
    return _in_blocks(point(queries), point(index), kind, count, written(lengths), written(asked))


def neighbours(
    vectors: DataFrame, query: Column, count: int = 20, name: str = "vec_id", vector: str = "embedding", recall: float = RECALL, sample: int = SAMPLE
) -> Search:
    """The ``count`` vectors with the largest inner product for each row of ``vectors`` for which ``query`` is true.

    Vectors that are null, empty or zero, or hold null or non-finite components, take no part. A query meets vectors of its
    own length only, and never its own row; other rows with its id and its copies are met. Ties go to the smaller id, a
    missing id last. If fewer than ``count`` others are there, all are found. Of equal vectors, more than a query can
    take are not indexed: the ``count`` + 1 smallest ids hold all that any query can return. An empty table finds nothing.
    """
    element = dict(vectors.dtypes)[vector].removeprefix("array<").removesuffix(">")
    kind = "<f4" if element == "float" else "<f8"
    base = vectors.select(
        F.monotonically_increasing_id().alias("row"), row_id(name).alias("id"), F.col(f"`{vector}`").cast(f"array<{'float' if kind == '<f4' else 'double'}>").alias("vector"),
        F.coalesce(query, F.lit(False)).alias("asks"),
    )
    base = written(base)
    checked = written(mapped(base.select("row", "id", "vector"), _checked(kind), "row long, id long, length long, norm double, vector binary"))
    asking = base.where("asks").select(F.col("row").alias("asking"))
    queries = written(checked.join(asking, F.col("row") == F.col("asking")).drop("asking"))
    copies = F.row_number().over(W.partitionBy("vector").orderBy("id", "row"))
    index = written(checked.withColumn("copy", copies).where(F.col("copy") <= count + 1).drop("copy"))
    measures = index.groupBy("length").agg(F.count("*").alias("rows"), F.min("norm").alias("least"), F.max("norm").alias("largest"))
    spaces = {r["length"]: Space(r["length"], r["rows"], r["least"], r["largest"]) for r in measures.collect()}  # one for each length
    total = sum(s.rows for s in spaces.values())

    some = written(queries.orderBy(F.xxhash64("id", "vector"), "row").limit(sample))
    truth = written(_nearest(_scanned(some, index, kind, count, total), count).select("query_row", "row"))
    wanted = truth.count()
    found, used, share = None, 0, 0.0
    while True:
        tables = range(used, used + TABLES)
        used += TABLES
        hot = [
            written(mapped(df, _hashed(kind, spaces, tables, asks, vectors=False), "key long").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK))
            for df, asks in ((index, False), (queries, True))
        ]
        points = [mapped(df, _hashed(kind, spaces, tables, asks), _POINT) for df, asks in ((queries, True), (index, False))]
        new = _in_blocks(*points, kind, count, *hot)
        found = written(_nearest(new if found is None else new.unionByName(found.drop("rank")), count))
        share = found.join(truth, ["query_row", "row"], "left_semi").count() / wanted if wanted else 1.0
        if share >= recall or all(not s.axes() for s in spaces.values()):
            break
    held = found.groupBy(F.col("query_row").alias("held")).agg(F.count("*").alias("n"))
    sizes = checked.groupBy(F.col("length").alias("of")).agg((F.count("*") - 1).alias("others"))
    lacking = queries.join(held, F.col("row") == F.col("held"), "left").join(sizes, F.col("length") == F.col("of"))
    lacking = written(lacking.where(F.coalesce("n", F.lit(0)) < F.least("others", F.lit(count))).select(*queries.columns))
    if not lacking.isEmpty():
        found = written(_nearest(found.drop("rank").unionByName(_scanned(lacking, index, kind, count, total)), count))
    return Search(found, share, used)


def named(found: DataFrame) -> DataFrame:
    """query_id, rank, vec_id and score, a missing id as null."""
    out = [F.when(F.col(c) < LAST_ID, F.col(c)).alias(n) for c, n in (("query_id", "query_id"), ("id", "vec_id"))]
    return found.select(out[0], "rank", out[1], "score")
