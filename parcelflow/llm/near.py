"""Near duplicates by Order MinHash, which is sensitive to edit similarity.

A text is the sequence of its five-word shingles, each labelled with how often it has occurred in the text before. A
sketch takes the few shingles with the smallest hashes and keeps them in the order of the text; a text with repeated
shingles has sketches of their first occurrences as well. Texts that share a sketch are candidates, and a banded
alignment of their shingles verifies them: the longest run of shared shingles in the same order, no further apart than
an alignment of the wanted similarity allows, over all shingles of either.

Texts with the same words are compared once. In each bucket a leader is compared with the other members, and what it
resembles joins its class. Members that are then in different classes meet in groups that hold a bucket's texts, or blocks
of them: how many shingles a text shares with each of the others is counted for all of them at once, and what shares
enough is aligned. Pairs never become rows, only links do. Labels of classes travel along the links until nothing changes.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow.llm.shared import PIECE_BYTES, mapped, row_id, written
from parcelflow.llm.words import SPACED, Words, mixed, paired, pieces, windows

SHINGLE = 5
SIMILARITY = 0.8
#: Sketches of a text, and the shingles that each keeps. Texts that share one are aligned. Shingles are drawn without
#: replacement: of u shingles, i of them aligned, a sketch agrees with i over KEPT out of u over KEPT. At 4 of 5, the
#: worst case at 0.8, that is 0.4, and 3 of 10,000 pairs share none of the sketches.
SKETCHES, KEPT = 16, 3
#: Shingles of the members of a bucket that one group holds; buckets with more are met in blocks of this size.
BLOCK = 300_000
_SEEDS = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64))


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labelled shingles of all texts, where those of each text begin, and which are first occurrences.

    A text with fewer words than a shingle is one shingle of all its words.
    """
    hashes, counts = words.hashes(), words.counts
    sizes = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    first = np.concatenate(([0], np.cumsum(sizes)))
    owner = np.repeat(np.arange(len(counts)), sizes)
    at = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], sizes)
    long_ = windows(hashes, SHINGLE)
    out = np.zeros(first[-1], np.uint64)
    whole = counts[owner] >= SHINGLE
    out[whole] = long_[at[whole]]
    for place in np.flatnonzero(~whole):
        a, b = words.first[owner[place]], words.first[owner[place] + 1]
        value = np.uint64(b - a)
        for h in hashes[a:b]:
            value = paired(np.array([value]), np.array([h]))[0]
        out[place] = value
    # The n-th occurrence in a text: places with equal owner and hash, in order.
    by = np.lexsort((out, owner))
    new = np.ones(len(by), bool)
    new[1:] = (out[by][1:] != out[by][:-1]) | (owner[by][1:] != owner[by][:-1])
    start = np.flatnonzero(new)
    nth = np.arange(len(by)) - np.repeat(start, np.diff(np.append(start, len(by))))
    label = np.empty(len(by), np.uint64)
    label[by] = nth.astype(np.uint64)
    return paired(out, label), first, label == 0


def sketches(text: np.ndarray) -> np.ndarray:
    """The sketches of one text, each a hash of its kept shingles in order; none if it has no shingle."""
    if not len(text):
        return np.zeros(0, np.uint64)
    kept = min(KEPT, len(text))
    out = np.empty((SKETCHES, kept), np.uint64)
    step = max(1, 2_000_000 // len(text))
    for low in range(0, SKETCHES, step):
        order = mixed(text[None, :] ^ _SEEDS[low : low + step, None])
        places = np.argpartition(order, kept - 1, axis=1)[:, :kept] if kept < len(text) else np.tile(np.arange(kept), (len(order), 1))
        out[low : low + step] = text[np.sort(places, axis=1)]
    value = _SEEDS.copy()
    for k in range(kept):
        value = paired(value, out[:, k])
    return value


def aligned(left: np.ndarray, right: np.ndarray) -> int:
    """Most labelled shingles that both have in the same order, inside of the band; 0 if it cannot be enough."""
    both = len(left) + len(right)
    _, i, j = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    need = SIMILARITY / (1 + SIMILARITY) * both - 1e-9
    if len(i) < need:
        return 0
    # Off the diagonal by more than this, an alignment leaves too many shingles out.
    near = np.abs(i - j) <= (1 - SIMILARITY) / (1 + SIMILARITY) * both + 1e-9
    right_places = j[near][np.argsort(i[near])]
    if np.all(right_places[1:] > right_places[:-1]):
        return len(right_places)
    ends: list[int] = []
    for place in right_places.tolist():
        spot = bisect_left(ends, place)
        if spot == len(ends):
            ends.append(place)
        else:
            ends[spot] = place
    return len(ends)


def similarity(left: np.ndarray, right: np.ndarray) -> float:
    """Aligned shingles over all shingles of either text; 0 where it is below ``SIMILARITY`` for certain."""
    same = aligned(left, right)
    return same / (len(left) + len(right) - same) if same else 0.0


def alike(left: np.ndarray, right: np.ndarray, left_new: np.ndarray, right_new: np.ndarray) -> bool:
    """Whether two texts are similar enough, by all their shingles or by the first occurrences of each alone.

    The second keeps a line that is repeated many times from outweighing the rest of a text.
    """
    return similarity(left, right) >= SIMILARITY or similarity(left[left_new], right[right_new]) >= SIMILARITY


def buckets(text: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Sketches of a text, and of its first occurrences alone where some shingles are repeated, each once.

    Both kinds are looked up among each other, because texts are alike by either. First occurrences have the label 0,
    so a text without repeated shingles has the same sketches of both kinds.
    """
    return sketches(text) if new.all() else np.unique(np.concatenate((sketches(text), sketches(text[new]))))


def _describe(batch: pa.RecordBatch):
    for row, texts in pieces(batch, batch["text"], PIECE_BYTES):
        words = Words(texts, SPACED)
        labelled, first, new = shingles(words)
        each = [buckets(labelled[a:b], new[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
        digests = [
            hashlib.sha256(b" ".join(words.data[a:b].tobytes().split())).digest()
            for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)
        ]
        here, sizes = batch.slice(row, len(texts)), np.diff(first)
        news = np.diff(np.concatenate(([0], np.cumsum(new)))[first])
        ends = np.cumsum([0, *map(len, each)])
        keys = np.concatenate([*each, np.zeros(0, np.uint64)])
        yield pa.record_batch(
            [
                here["id"], here["key"], pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(news, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.view(np.int64))),
            ],
            ["id", "key", "digest", "size", "news", "sketch"],
        )


def _verify(batch: pa.RecordBatch):
    for row, texts in pieces(batch, batch["left_text"], PIECE_BYTES):
        here = batch.slice(row, len(texts))
        left, first, left_new = shingles(Words(texts, SPACED))
        right, second, right_new = shingles(Words(here["right_text"].cast(pa.large_string()).fill_null(""), SPACED))
        linked = []
        for i in range(len(texts)):
            a, b = slice(first[i], first[i + 1]), slice(second[i], second[i + 1])
            linked.append(alike(left[a], right[b], left_new[a], right_new[b]))
        yield pa.record_batch([here["leader"], here["node"]], ["leader", "node"]).filter(pa.array(linked, pa.bool_()))


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, label) for every end of a link: label is the smallest node that can be reached.

    Each round takes the smallest label among the neighbours and then the label of that label, so a path of n links
    needs about log n rounds. Tables of a round are written, so a lost executor costs one round's tasks.
    """
    ends = links.select(F.col(left).alias("a"), F.col(right).alias("b"))
    both = written(ends.union(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("low"))
        lower = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("was"), F.least("label", "low").alias("label"))
        onward = lower.select(F.col("node").alias("at"), F.col("label").alias("onward"))
        moved = written(lower.join(onward, F.col("label") == F.col("at")).select("node", "was", F.least("label", "onward").alias("label")))
        labels = moved.select("node", "label")
        if moved.where("was != label").isEmpty():
            return labels


def _near_in(one: str, other: str) -> Column:
    """Whether two numbers of shingles are near enough for texts with so many to be alike."""
    return F.least(one, other) >= F.lit(SIMILARITY) * F.greatest(one, other) - 1e-6


def _need(size, others):
    """Shared shingles that texts of so many shingles must have at least to be alike."""
    return SIMILARITY / (1 + SIMILARITY) * (size + others) - 1e-9


def _links_of(key: int, rows: dict, which: np.ndarray, ids: np.ndarray, first: np.ndarray, new: np.ndarray, mark: np.ndarray):
    """Pairs of nodes of one bucket (rows ``which``) that are alike and not connected yet.

    Rows that ask are met by all that answer at once: one look-up over the shingles of all of them says how many each
    shares with the one that asks, and only those that share enough are aligned. A pair is left to the smallest bucket that
    both are in.
    """
    answers = which[rows["answers"][which]]
    parts = [slice(first[r], first[r + 1]) for r in answers]
    cat, cat_new = np.concatenate([ids[p] for p in parts]), np.concatenate([new[p] for p in parts])
    sizes = np.array([p.stop - p.start for p in parts])
    starts = np.cumsum(sizes) - sizes
    news = np.add.reduceat(cat_new, starts, dtype=np.int64)
    plain = bool(cat_new.all())
    nodes, labels, outside = rows["node"], rows["label"], rows["outside"]
    parent: dict[int, int] = {}

    def find(label: int) -> int:
        while (up := parent.get(label, label)) != label:
            label = up
        return label

    smaller = {}

    def earlier(r: int) -> frozenset:
        if r not in smaller:
            smaller[r] = frozenset(k for k in rows["sketch"][r] if k < key)
        return smaller[r]

    for i in which[rows["asks"][which]]:
        own = slice(first[i], first[i + 1])
        mark[ids[own]] = True
        enough = np.add.reduceat(mark[cat], starts, dtype=np.int64) >= _need(own.stop - own.start, sizes)
        mark[ids[own]] = False
        if not (plain and new[own].all()):
            mine = ids[own][new[own]]
            mark[mine] = True
            enough |= np.add.reduceat(mark[cat] & cat_new, starts, dtype=np.int64) >= _need(len(mine), news)
            mark[mine] = False
        for j in answers[enough]:
            if nodes[i] == nodes[j] or (outside[j] and nodes[i] > nodes[j]):
                continue
            left, right = find(labels[i]), find(labels[j])
            if left == right or not earlier(i).isdisjoint(earlier(j)):
                continue
            theirs = slice(first[j], first[j + 1])
            if alike(ids[own], ids[theirs], new[own], new[theirs]):
                parent[left] = right
                yield int(nodes[i]), int(nodes[j])


def _met(group: pa.Table) -> pa.Table:
    """Links inside of the buckets of a group."""
    words = Words(group["text"].combine_chunks().cast(pa.large_string()).fill_null(""), SPACED)
    labelled, first, new = shingles(words)
    known, ids = np.unique(labelled, return_inverse=True)
    mark = np.zeros(len(known), bool)
    rows = {c: group[c].to_numpy() for c in ("key", "node", "label", "asks", "answers", "outside")} | {"sketch": group["sketch"].to_pylist()}
    links = []
    order = np.argsort(rows["key"], kind="stable")
    for which in np.split(order, np.flatnonzero(np.diff(rows["key"][order])) + 1):
        if rows["asks"][which].any() and rows["answers"][which].any():
            links += _links_of(int(rows["key"][which[0]]), rows, which, ids, first, new, mark)
    return pa.table({"leader": pa.array([a for a, _ in links], pa.int64()), "node": pa.array([b for _, b in links], pa.int64())})


def _led(members: DataFrame, leaders: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between the leader of each bucket and its other members."""
    met = members.join(leaders, "key").where("node != leader").where(_near_in("size", "leader_size") | _near_in("news", "leader_news"))
    pairs = written(met.select(F.least("leader", "node").alias("leader"), F.greatest("leader", "node").alias("node")).distinct())
    left = texts.select(F.col("node").alias("leader"), F.col("text").alias("left_text"))
    right = texts.select("node", F.col("text").alias("right_text"))
    return written(mapped(pairs.join(left, "leader").join(right, "node"), _verify, "leader long, node long"))


def _rest(open_: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between members of open buckets that are in different classes. ``open_``: key, node, label, size, main.

    Members of a bucket's largest class do not meet each other: those outside of it ask, and all answer. Small buckets
    share a group; a large one is met in blocks, each block of those who ask with each block of those who answer.
    """
    rows = open_.withColumn("outside", F.col("label") != F.col("main"))
    sums = written(rows.groupBy("key").agg(F.sum("size").alias("shingles"), F.sum(F.when(F.col("outside"), F.col("size")).otherwise(0)).alias("asked")))
    groups = max(1, -(-(sums.where(F.col("shingles") <= BLOCK).agg(F.sum("shingles")).first()[0] or 0) // BLOCK))
    rows = rows.join(sums, "key").join(texts, "node").select(
        "key", "node", "label", "outside", "sketch", "text", (F.col("shingles") > BLOCK).alias("large"),
        F.ceil(F.col("shingles") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("asked") / BLOCK).cast("int").alias("ask_blocks"),
    )
    own = ["key", "node", "label", "outside", "sketch", "text", "large"]
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    few, many = rows.where("not large"), rows.where("large")
    together = few.select(*own, F.pmod(F.xxhash64("key"), F.lit(groups)).alias("of"), F.lit(0).alias("a"), F.lit(0).alias("b"), F.col("outside").alias("asks"), F.lit(True).alias("answers"))
    asking = many.where("outside").select(*own, F.col("key").alias("of"), block("ask_blocks").alias("a"), every("blocks").alias("b"), F.lit(True).alias("asks"), F.lit(False).alias("answers"))
    answering = many.select(*own, F.col("key").alias("of"), every("ask_blocks").alias("a"), block("blocks").alias("b"), F.lit(False).alias("asks"), F.lit(True).alias("answers"))
    dealt = together.unionByName(asking).unionByName(answering)
    return written(dealt.groupBy("large", "of", "a", "b").applyInArrow(_met, "leader long, node long"))


def _labels(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, label) of what verified links inside of buckets connect. ``members``: key, node, weight, size, news.

    A leader meets all members of its bucket, which joins what is nearly equal, and leaves the bucket. What is then not in
    one class is met in groups that hold the texts of whole buckets, so every pair of a bucket is compared unless links
    already connect it or the shingles they share are too few.
    """
    heaviest = F.max(F.struct("weight", (-F.col("node")).alias("less"), "node", "size", "news")).alias("l")
    leaders = members.groupBy("key").agg(heaviest).select("key", F.col("l.node").alias("leader"), F.col("l.size").alias("leader_size"), F.col("l.news").alias("leader_news"))
    leaders = written(leaders)
    links = _led(members, leaders, texts)
    labels = components(links, "leader", "node").select(F.col("node").alias("of"), F.col("label").alias("found"))
    left = members.join(leaders.select("key", "leader"), "key").where("node != leader")
    labelled = left.join(labels, F.col("node") == F.col("of"), "left").select("key", "node", "size", F.coalesce("found", "node").alias("label"))
    labelled = written(labelled)
    # Of equally large classes the one with the smallest label; buckets of one class are done.
    each = labelled.groupBy("key", "label").agg(F.count("*").alias("n"))
    main = each.groupBy("key").agg(F.count("*").alias("n_classes"), F.max(F.struct("n", (-F.col("label")).alias("less"), "label")).alias("l"))
    open_ = written(labelled.join(main.where("n_classes > 1").select("key", F.col("l.label").alias("main")), "key"))
    return components(links.union(_rest(open_, texts)), "leader", "node")


def classes(docs: DataFrame) -> DataFrame:
    """The class of near duplicates of each row of ``docs`` (doc_id, text; ``key`` hashes all columns of a row).

    Columns: id (doc_id, a missing one last), key, row, size (shingles), class_id (smallest doc_id of the class) and
    kept, true for one row of each class: the one with the smallest doc_id. Texts with the same words are one class;
    different texts are linked if their aligned shingles are ``SIMILARITY`` of all of theirs, and links are followed.
    A null text and one without words is a class of its own. Repeated rows are copies of each other.
    """
    source = docs.select(row_id().alias("id"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("key"), "text")
    described = mapped(source, _describe, "id long, key long, digest binary, size long, news long, sketch array<long>")
    described = written(described.withColumn("row", F.monotonically_increasing_id()))
    first = F.min(F.struct("id", "row"))
    nodes = written(
        described.where("size > 0").groupBy("digest").agg(first.alias("f"))
        .select("digest", F.col("f.row").alias("node"), F.col("f.id").alias("first_id"))
    )
    sketch = described.join(nodes.select("node"), F.col("row") == F.col("node")).select("node", "id", "key", "size", "news", "sketch")
    sketch = written(sketch)
    entries = sketch.select("node", F.explode("sketch").alias("bucket"))
    shared = written(entries.groupBy(F.col("bucket").alias("key")).agg(F.count("*").alias("n")).where("n > 1"))
    entries = written(entries.join(shared, F.col("bucket") == F.col("key")).select("key", "node", "n"))
    weights = written(entries.groupBy("node").agg(F.sum("n").alias("weight")))
    sizes = sketch.select("node", "size", "news")
    members = written(entries.join(weights, "node").join(sizes, "node").select("key", "node", "weight", "size", "news"))
    met = sketch.join(weights.select("node"), "node")
    texts = source.join(met.select("node", "id", "key", "sketch"), ["id", "key"]).select("node", "text", "sketch")
    labels = _labels(members, written(texts))
    joined = nodes.join(labels, "node", "left").select("digest", "node", "first_id", F.coalesce("label", "node").alias("label"))
    joined = written(joined)
    # The member of a class that stays: smallest doc_id, then smallest row.
    heads = joined.groupBy("label").agg(F.min(F.struct("first_id", "node")).alias("h"))
    heads = written(heads.select("label", F.col("h.first_id").alias("class_id"), F.col("h.node").alias("head")))
    of = written(joined.join(heads, "label").select("digest", "class_id", "head"))
    out = described.where("size > 0").join(of, "digest").select("id", "key", "row", "size", "class_id", (F.col("row") == F.col("head")).alias("kept"))
    empty = described.where("size = 0").select("id", "key", "row", "size", F.col("id").alias("class_id"), F.lit(True).alias("kept"))
    return out.unionByName(empty)


def without_copies(docs: DataFrame) -> DataFrame:
    """One document of each class, with its columns; documents without words all stay."""
    found = classes(docs)
    key = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    wanted = written(found.where("kept").groupBy("id", "key").agg(F.count("*").alias("times"), F.max("size").alias("size")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_id().alias("id"), key.alias("key"))
    joined = rows.join(wanted, ["id", "key"])
    # Rows that agree in every column share a key: all but one of them go, unless they have no words.
    again = F.row_number().over(W.partitionBy("id", "key").orderBy("key"))
    return joined.withColumn("again", again).where("size = 0 or again = 1").select("row.*")
