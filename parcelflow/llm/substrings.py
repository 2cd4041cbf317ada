"""Repeated passages by level-wise doubling of windows.

A passage counts as repeated if a window of ``length`` consecutive words also starts in a document with a smaller id.
Windows of half the length are looked at first. Only some of them have to be: of the half-length windows inside of
any full window, the one with the smallest hash is taken, so two equal full windows agree on the one they take. Full
windows whose taken half occurs in one document only cannot be repeated; the others alone are extended to the full
length and compared. Longer repeats consist of repeated full windows, so the doubling ends there.

Documents with the same word sequence are compared once: all but the one with the smallest id are removed whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.shared import LAST_ID, PIECE_BYTES, mapped, row_id, written
from parcelflow.llm.words import SPACED, Words, pieces, spans_of, windows

_KEY = ["id", "key"]


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values; short by ``width - 1`` at the end."""
    length = 1
    while length < width:
        step = min(length, width - length)
        values = pick(values[:-step], values[step:])
        length += step
    return values


def _smallest(words: Words, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the half-length windows, and the smallest of them inside of each full window (0 if it leaves the text)."""
    half = (length + 1) // 2
    halves = windows(hashes, half)
    least = _sliding(halves, length - half + 1, np.minimum)
    return halves, np.where(words.left()[: len(least)] >= length, least, np.uint64(0))


def _taken(halves: np.ndarray, least: np.ndarray, width: int) -> np.ndarray:
    """Half-length windows that some full window around them takes."""
    around = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
    return np.flatnonzero((_sliding(around, width, np.maximum) == halves) & (halves != 0))


def _lists(values: pa.Array, at: np.ndarray, first: np.ndarray) -> pa.Array:
    """``values``, which lie at words ``at``, as one list for each text."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(at, first), pa.int32()), values)


def _inside(at: np.ndarray, first: np.ndarray) -> pa.Array:
    """Words ``at`` counted from the first word of their text."""
    return pa.array((at - np.repeat(first[:-1], np.diff(np.searchsorted(at, first)))).astype(np.int32))


def _describe(length: int):
    def run(batch: pa.RecordBatch):
        for row, texts in pieces(batch, batch["text"], PIECE_BYTES):
            words = Words(texts, SPACED)
            hashes = words.hashes()
            at, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)
            if len(words) >= length:
                halves, least = _smallest(words, hashes, length)
                at = _taken(halves, least, length - (length + 1) // 2 + 1)
                values = halves[at]
            digests = [
                hashlib.sha256(b" ".join(words.data[a:b].tobytes().split())).hexdigest()
                for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)
            ]
            here = batch.slice(row, len(texts))
            yield pa.record_batch(
                [
                    here["id"], here["key"], pa.array(words.counts, pa.int64()), pa.array(digests),
                    _lists(pa.array(values.view(np.int64)), at, words.first),
                    _lists(_inside(at, words.first), at, words.first),
                ],
                ["id", "key", "n_words", "words_sha256", "halves", "places"],
            )

    return run


def _marked(words: Words, batch: pa.RecordBatch, places: str) -> np.ndarray:
    """Words at the places that the rows of the batch list."""
    lists = batch[places]
    sizes = np.diff(lists.offsets.to_numpy())
    at = lists.flatten().to_numpy(zero_copy_only=False) + np.repeat(words.first[:-1], sizes)
    mark = np.zeros(len(words), bool)
    mark[at] = True
    return mark


def _extend(length: int):
    def run(batch: pa.RecordBatch):
        for row, texts in pieces(batch, batch["text"], PIECE_BYTES):
            here = batch.slice(row, len(texts))
            words = Words(texts, SPACED)
            hashes = words.hashes()
            halves, least = _smallest(words, hashes, length)
            mark = _marked(words, here, "places")[: len(halves)]
            repeated = _sliding(np.where(mark, halves, ~np.uint64(0)), length - (length + 1) // 2 + 1, np.minimum)
            at = np.flatnonzero((repeated == least) & (least != 0))
            values = windows(hashes, length)[at]
            yield pa.record_batch(
                [
                    here["id"], here["key"], here["text"],
                    _lists(pa.array(values.view(np.int64)), at, words.first),
                    _lists(_inside(at, words.first), at, words.first),
                ],
                ["id", "key", "text", "fulls", "places"],
            )

    return run


def _cut(length: int):
    def run(batch: pa.RecordBatch):
        for row, texts in pieces(batch, batch["text"], PIECE_BYTES):
            here = batch.slice(row, len(texts))
            words = Words(texts, SPACED)
            starts = np.flatnonzero(_marked(words, here, "removed"))
            change = np.zeros(len(words) + 1, np.int64)
            change[starts] += 1
            np.subtract.at(change, starts + length, 1)
            gone = np.cumsum(change[:-1]) > 0
            kept, spans = [], []
            for i in range(len(texts)):
                a, b = words.first[i], words.first[i + 1]
                begin, end = spans_of(gone[a:b])
                spans.append([{"start": int(s), "end": int(e)} for s, e in zip(begin, end, strict=True)])
                left = np.flatnonzero(~gone[a:b]) + a
                parts = [words.data[s:e].tobytes() for s, e in zip(words.start[left], words.end[left], strict=True)]
                kept.append(b" ".join(parts).decode())
            removed = np.diff(np.concatenate(([0], np.cumsum(gone)))[words.first])
            yield pa.record_batch(
                [
                    here["id"], here["key"], pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ],
                ["id", "key", "n_removed", "kept", "spans"],
            )

    return run


def repeated_passages(docs: DataFrame, length: int = 50) -> DataFrame:
    """What is left of each document without the passages that documents with smaller ids have too.

    ``docs`` has ``doc_id`` and ``text``; other columns are not looked at. The result has one row for each row:
    doc_id, n_words, n_removed, spans (word places of the removed runs, end excluded), kept (the words left, one
    space between; null if nothing was removed) and words_sha256 (of all words, one space between).

    A null text has no words. A null doc_id counts as larger than all others. Repeated rows of one doc_id are one
    document and don't remove each other; texts with fewer words than ``length`` are left as they are.
    """
    source = docs.select(row_id().alias("id"), F.xxhash64("doc_id", "text").alias("key"), F.col("text"))
    described = written(
        mapped(
            source, _describe(length),
            "id long, key long, n_words long, words_sha256 string, halves array<long>, places array<int>",
        )
    )
    firsts = written(described.groupBy("words_sha256").agg(F.min("id").alias("first_id")))
    own = described.select(*_KEY, "n_words", "words_sha256")
    own = own.join(firsts, "words_sha256").withColumn("copy", F.col("first_id") < F.col("id"))
    # One row for each word sequence and id: equal rows have equal places.
    alone = described.where(F.size("halves") > 0).join(firsts, "words_sha256")
    alone = alone.where(F.col("first_id") == F.col("id")).select(*_KEY, "halves", "places")
    takes = alone.select(*_KEY, F.explode(F.arrays_zip("halves", "places")).alias("x"))
    takes = takes.select(*_KEY, F.col("x.halves").alias("half"), F.col("x.places").alias("place"))
    halves = alone.select("id", F.explode("halves").alias("half")).groupBy("half")
    repeated = written(halves.agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("half"))
    places = takes.join(repeated, "half").groupBy(*_KEY).agg(F.collect_set("place").alias("places"))
    candidates = written(
        mapped(
            source.where(F.length("text") >= 2 * length - 1).join(places, _KEY), _extend(length),
            "id long, key long, text string, fulls array<long>, places array<int>",
        ).where(F.size("fulls") > 0)
    )
    fulls = candidates.select("id", F.explode("fulls").alias("full")).groupBy("full")
    earliest = written(fulls.agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("full", "low"))
    starts = candidates.select(*_KEY, F.explode(F.arrays_zip("fulls", "places")).alias("x"))
    starts = starts.select(*_KEY, F.col("x.fulls").alias("full"), F.col("x.places").alias("place"))
    removed = starts.join(earliest, "full").where(F.col("low") < F.col("id"))
    removed = removed.groupBy(*_KEY).agg(F.collect_set("place").alias("removed"))
    cut = mapped(
        candidates.select(*_KEY, "text").dropDuplicates(_KEY).join(removed, _KEY), _cut(length),
        "id long, key long, n_removed long, kept string, spans array<struct<start: int, end: int>>",
    )
    whole = F.col("copy") & (F.col("n_words") >= length)
    all_of_it = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    none = F.array().cast("array<struct<start: int, end: int>>")
    return own.join(cut, _KEY, "left").select(
        F.when(F.col("id") < F.lit(LAST_ID), F.col("id")).alias("doc_id"),
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, all_of_it).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept"),
        "words_sha256",
    )
