"""Benchmark contamination by suffix arrays over shards of the training texts.

A shard is a run of neighbouring documents inside a task. Its words are numbered by the words of the benchmark, its
suffixes are sorted, and every suffix of a benchmark item is binary-searched in them. The range of suffixes that begin
with the item's window gives all places of that window, and the two neighbours of the item's suffix give the longest
verbatim match. Words that no item has end every match, so suffixes are sorted only inside runs of known words that are
long enough to hold a window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.llm.shared import PIECE_BYTES, mapped
from parcelflow.llm.words import PLAIN, Words, pieces, spans_of

#: Text of benchmark items that is sent to the executors at a time; a larger benchmark is searched block by block.
BLOCK_BYTES = 32 << 20

_MATCH = "struct<item_id: string, item_start: int, doc_start: int, words: int, longest: int>"
_MATCHES = pa.struct(
    [("item_id", pa.string()), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("words", pa.int32()), ("longest", pa.int32())]
)


class Items:
    """A block of benchmark items: their words as numbers from 1, one after the other, and their suffixes.

    ``need`` is the number of words a suffix must match: ``size``, or all words of an item that has fewer.
    """

    def __init__(self, ids: list[str], texts: list[str | None], size: int):
        words = Words(pa.array(texts, pa.large_string()).fill_null(""), PLAIN, lower=True)
        self.ids, self.first = ids, words.first
        self.vocabulary, codes = np.unique(words.hashes(), return_inverse=True)
        self.codes = np.concatenate((codes.astype(np.int64) + 1, [0]))
        owner, left = words.owners(), words.left()
        length = words.counts[owner]
        at = np.flatnonzero((left >= size) | ((left == length) & (length < size)))
        self.at, self.left, self.owner = at, left[at], owner[at]
        self.need = np.minimum(self.left, size)
        self.shortest = int(self.need.min()) if len(at) else 0
        self.longest = int(self.left.max()) if len(at) else 0


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``codes`` in the order of the suffixes that begin there, by their first ``depth`` numbers at least."""
    rank, known = codes, 1
    while True:
        after = np.zeros_like(rank)
        after[:-known or None] = rank[known:] + 1 if known < len(rank) else 0
        key = rank * (int(rank.max()) + 2) + after if known < len(rank) else rank
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        step = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = np.empty_like(rank)
        rank[order] = step
        known *= 2
        if known >= depth or step[-1] == len(rank) - 1:
            return order


def _first_at_least(shard: np.ndarray, order: np.ndarray, query: np.ndarray, at: np.ndarray, depth: np.ndarray, after: bool) -> np.ndarray:
    """First place in ``order`` whose suffix is not below the query (above it with ``after``), by ``depth`` numbers.

    All queries are searched at once; each round compares the middles number by number until they differ.
    """
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(order), np.int64)
    padded = np.concatenate((shard, np.zeros(int(depth.max()) + 1, np.int64)))
    while (active := np.flatnonzero(low < high)).size:
        middle = (low[active] + high[active]) // 2
        place = order[middle]
        sign = np.zeros(len(active), np.int8)
        open_, k = np.arange(len(active)), 0
        while open_.size:
            open_ = open_[depth[active[open_]] > k]
            difference = padded[place[open_] + k] - query[at[active[open_]] + k]
            sign[open_] = np.sign(difference)
            open_ = open_[difference == 0]
            k += 1
        below = (sign <= 0) if after else (sign < 0)
        low[active[below]] = middle[below] + 1
        high[active[~below]] = middle[~below]
    return low


def _common(shard: np.ndarray, place: np.ndarray, query: np.ndarray, at: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many numbers agree from ``place`` of the shard and ``at`` of the query on, ``most`` at most."""
    padded = np.concatenate((shard, np.zeros(int(most.max(initial=0)) + 1, np.int64)))
    out = np.zeros(len(at), np.int64)
    open_, k = np.arange(len(at)), 0
    while open_.size:
        open_ = open_[most[open_] > k]
        open_ = open_[padded[place[open_] + k] == query[at[open_] + k]]
        k += 1
        out[open_] = k
    return out


def find(words: Words, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All places of windows in a shard: (word of the shard, suffix of ``items``, longest match from there)."""
    nothing = np.zeros(0, np.int64)
    if not items.shortest or not len(words):
        return nothing, nothing, nothing
    hashes = words.hashes()
    codes = np.searchsorted(items.vocabulary, hashes)
    codes[codes == len(items.vocabulary)] = 0
    codes = np.where(items.vocabulary[codes] == hashes, codes + 1, 0)
    # A text's end ends a run as well: runs are looked for with a gap after each text.
    gapped = np.zeros(len(codes) + len(words.first), np.int64)
    home = np.arange(len(codes)) + words.owners()
    gapped[home] = codes
    begin, end = spans_of(gapped > 0)
    long_ = end - begin >= items.shortest
    begin, end = begin[long_], end[long_]
    if not len(begin):
        return nothing, nothing, nothing
    sizes = end - begin + 1
    offset = np.concatenate(([0], np.cumsum(sizes)))
    source = np.arange(offset[-1]) + np.repeat(begin - offset[:-1], sizes)
    shard = gapped[source]
    shard[offset[1:] - 1] = 0
    order = suffix_array(shard, items.longest)
    low = _first_at_least(shard, order, items.codes, items.at, items.need, False)
    high = _first_at_least(shard, order, items.codes, items.at, items.need, True)
    met = np.flatnonzero(low < high)
    if not len(met):
        return nothing, nothing, nothing
    times = (high - low)[met]
    suffix = np.repeat(met, times)
    ahead = np.arange(len(suffix)) - np.repeat(np.cumsum(times) - times, times)
    place = order[np.repeat(low[met], times) + ahead]
    longest = _common(shard, place, items.codes, items.at[suffix], items.left[suffix])
    back = np.searchsorted(home, source[place])
    return back, suffix, longest


def _scan(items, more: bool, kept: list[str]):
    """Adds the matches of one block of items to those that earlier blocks left in ``matches``; ``kept`` goes on."""

    def run(batch: pa.RecordBatch):
        block = items.value
        for row, texts in pieces(batch, batch["row"].field("text"), PIECE_BYTES):
            here = batch.slice(row, len(texts))
            words = Words(texts, PLAIN, lower=True)
            word, suffix, longest = find(words, block)
            owner = words.owners()
            by = np.lexsort((suffix, word))
            word, suffix, longest = word[by], suffix[by], longest[by]
            text = owner[word] if len(word) else word
            item = block.owner[suffix]
            values = pa.StructArray.from_arrays(
                [
                    pa.array([block.ids[i] for i in item], pa.string()),
                    pa.array((block.at[suffix] - block.first[item]).astype(np.int32)),
                    pa.array((word - words.first[text]).astype(np.int32)),
                    pa.array(block.need[suffix].astype(np.int32)),
                    pa.array(longest.astype(np.int32)),
                ],
                fields=list(_MATCHES),
            )
            found = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32()), values)
            if more:
                found = pa.array([a + b for a, b in zip(here["matches"].to_pylist(), found.to_pylist(), strict=True)], pa.list_(_MATCHES))
            rows = pa.StructArray.from_arrays([here["row"].field(c) for c in kept], kept)
            yield pa.record_batch([rows, pa.array(words.counts, pa.int64()), found], ["row", "n_words", "matches"])

    return run


def _blocks(items: DataFrame, item_id: str, text: str) -> list[DataFrame]:
    """The benchmark in parts of about ``BLOCK_BYTES`` of text."""
    total = items.agg(F.sum(F.length(F.encode(text, "UTF-8")))).first()[0] or 0
    parts = 1 + total // BLOCK_BYTES
    chosen = items.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text"))
    return [chosen.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == k) for k in range(parts)]


def matches(docs: DataFrame, items: DataFrame, size: int = 13, keep: list[str] | None = None) -> DataFrame:
    """Places in each document where a window of a benchmark item occurs, with the longest match from there.

    ``docs`` has ``text``, ``items`` has ``item_id`` and ``text``. A window is ``size`` consecutive words of an item,
    or all words of an item that has fewer. The result has a row for each document: ``row`` (a struct of its columns,
    or those of ``keep``), n_words and matches, an array of (item_id, item_start, doc_start, words, longest). A null
    text has no words and an item without words no window. A null item_id is left out. Texts are read whole. Repeated
    rows have a result each; of items with one id all windows count. Columns of ``docs`` may have any names, as they
    stand in ``row``. An empty table of documents has no rows, and without items nothing is hit.
    """
    keep, spark = keep or docs.columns, docs.sparkSession
    wanted = [*keep] if "text" in keep else [*keep, "text"]
    blocks = _blocks(items.where("item_id is not null"), "item_id", "text")
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in wanted]).alias("row"))
    for place, block in enumerate(blocks):
        got = block.orderBy("id", "text").collect()
        sent = spark.sparkContext.broadcast(Items([r["id"] for r in got], [r["text"] for r in got], size))
        columns = keep if place + 1 == len(blocks) else wanted
        kind = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in columns])
        schema = T.StructType().add("row", kind).add("n_words", "long").add("matches", T.DataType.fromDDL(f"array<{_MATCH}>"))
        out = mapped(out.select("row", *["matches"] * (place > 0)), _scan(sent, place > 0, columns), schema)
    return out


def counted(found: DataFrame) -> DataFrame:
    """``matches()`` with n_hit (words inside a window), n_items, items_sha256 and contaminated beside them."""
    # Places in order, folded into (words covered so far, end of the last window).
    places = F.sort_array(F.transform("matches", lambda m: F.struct(m.doc_start.alias("at"), m.words.alias("words"))))
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("end"))
    covered = F.aggregate(
        places, start,
        lambda acc, m: F.struct(
            (acc.hit + F.greatest(F.lit(0), m["at"] + m.words - F.greatest(acc.end, m["at"]))).cast("long").alias("hit"),
            F.greatest(acc.end, m["at"] + m.words).alias("end"),
        ),
    )
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m.item_id)))
    counts = found.withColumn("n_hit", covered.hit).withColumn("items", items)
    return counts.select(
        "row", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "matches",
    )


def longest_matches(docs: DataFrame, items: DataFrame, size: int = 13) -> DataFrame:
    """For each window of an item that occurs in a document: the longest verbatim match from there and where it is.

    One row per (item_id, item_start): longest (words), doc_id and doc_start of the first such place, n_places.
    """
    each = matches(docs, items, size, ["doc_id"]).select("row.doc_id", F.explode("matches").alias("m"))
    # struct order: the longest first, then the smallest id and place
    best = F.min(F.struct((-F.col("m.longest")).alias("less"), F.col("doc_id"), F.col("m.doc_start")))
    found = each.groupBy("m.item_id", "m.item_start").agg(best.alias("b"), F.count("*").alias("n_places"))
    return found.select("item_id", "item_start", (-F.col("b.less")).alias("longest"), "b.doc_id", "b.doc_start", "n_places")


def clean(docs: DataFrame, items: DataFrame, size: int = 13) -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    return counted(matches(docs, items, size)).where(~F.col("contaminated")).select("row.*")
