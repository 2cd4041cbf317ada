"""Token counts of texts, from the number of pieces of each distinct pre-token.

A byte-level BPE tokenizer first cuts a text into pre-tokens and then each of them into pieces, whatever stands around
it. So the pieces of a pre-token are counted once, over the table of all distinct ones, and a text's count is the sum
over its pre-token frequencies. The frequencies of the commonest pre-tokens, which hold nearly all occurrences, are
joined to a dictionary of bounded size that every task has; all others are joined by a shuffle. No ids are made.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.shared import mapped, written

#: Entries of the dictionary that every task has.
COMMONEST = 400_000
#: Distinct pre-tokens that a task holds before it hands its counts on.
HELD = 200_000
#: The split of the byte-level pre-tokenizer (fixed values of its public definition).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts of these characters alone are cut by ``_PLAIN_PATTERN``, where they are classed the same way, in less time.
_PLAIN_TEXT = re.compile("[\\x00-\\x7F\u00C0-\u02AF\u2010-\u2027\u2030-\u205E]*")
_LETTERS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u02AF"
_PLAIN_PATTERN = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?(?:[{_LETTERS}]+|[0-9]+|[^\s0-9{_LETTERS}]+)|\s+(?!\S)|\s+", re.ASCII
)
#: Classes of common counts: eighths of a power of two.
_CLASS = "floor(8 * log2(total))"


@functools.lru_cache(maxsize=4)
def _library(definition: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _checked(definition: str) -> list[str]:
    """Special strings of a tokenizer file, if its texts can be cut the way this module does."""
    parts = json.loads(definition)
    cut = parts["pre_tokenizer"] or {}
    if parts["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        raise ValueError("only byte-level tokenizers without a normalizer or prefix space are supported")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in parts["added_tokens"]):
        raise ValueError("added tokens that look at their neighbours are not supported")
    return [t["content"] for t in parts["added_tokens"]]


@functools.lru_cache(maxsize=1 << 17)
def is_odd(definition: str, character: str) -> bool:
    """Whether the library's split and ``PATTERN`` class a character differently, as they know different Unicode versions."""
    c = character
    text = f"a{c}a 1{c}1 .{c}. {c}{c}"
    split = _library(definition).pre_tokenizer.pre_tokenize_str(text)
    return [span for _, span in split] != [m.span() for m in _pattern().finditer(text)]


@functools.lru_cache(maxsize=1)
def _pattern() -> regex.Pattern:
    return regex.compile(PATTERN)


class Splitter:
    """Cuts texts into pre-tokens as the library does. Sent to tasks as its definition; characters are classed as they are met."""

    def __init__(self, definition: str):
        self.definition, self.specials = definition, _checked(definition)
        self._ready = False

    def __getstate__(self):
        return {"definition": self.definition, "specials": self.specials, "_ready": False}

    def _prepare(self) -> None:
        self._even, self._odd = set(), set()
        self._special = regex.compile("|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True)) or r"(?!)")
        self._ready = True

    def __call__(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text and how many special strings it has."""
        if not self._ready:
            self._prepare()
        parts = self._special.split(text) if any(s in text for s in self.specials) else (text,)
        if text.isascii() or _PLAIN_TEXT.fullmatch(text):
            cut = _PLAIN_PATTERN.findall
        elif self._all_even(text):
            cut = _pattern().findall
        else:
            cut = self._by_library
        if len(parts) == 1:
            return cut(text), 0
        return [t for part in parts for t in cut(part)], len(parts) - 1

    def _all_even(self, text: str) -> bool:
        for c in set(text) - self._even - self._odd:
            (self._odd if is_odd(self.definition, c) else self._even).add(c)
        return self._odd.isdisjoint(text)

    def _by_library(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in _library(self.definition).pre_tokenizer.pre_tokenize_str(text)]


def _occurrences(splitter: Splitter):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["piece", "n"])

        for batch in batches:
            for text in batch["text"]:
                counts.update(splitter(text.as_py() or "")[0])
                if len(counts) > HELD:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return over


def _pieces(definition: str):
    def run(batch: pa.RecordBatch):
        # Special strings have been cut away before, so none of these holds one.
        encoded = _library(definition).encode_batch_fast(batch["piece"].to_pylist(), add_special_tokens=False)
        yield pa.record_batch([batch["piece"], batch["total"], pa.array([len(e) for e in encoded], pa.int32())], ["piece", "total", "pieces"])

    return run


def piece_table(docs: DataFrame, definition: str) -> DataFrame:
    """Every distinct pre-token of the texts: piece (its text), total (occurrences), pieces (how many it is cut into)."""
    splitter = Splitter(definition)
    counts = docs.select("text").mapInArrow(_occurrences(splitter), "piece string, n long")
    totals = counts.groupBy("piece").agg(F.sum("n").alias("total"))
    return mapped(totals, _pieces(definition), "piece string, total long, pieces int")


def _sums(splitter: Splitter, dictionary):
    state: dict = {}

    def run(batch: pa.RecordBatch):
        if "known" not in state:
            state["known"] = known = {}
            for entries in pa.ipc.open_stream(dictionary.value):
                known.update(zip(entries["piece"].to_pylist(), entries["pieces"].to_pylist(), strict=True))
        get = state["known"].get
        for first in range(0, batch.num_rows, 512):
            here = batch.slice(first, 512)
            sizes, sums, rest = [], [], []
            for value in here["text"]:
                text = value.as_py() or ""
                found, specials = splitter(text)
                each = list(map(get, found))
                if None in each:
                    unknown = Counter(t for t, n in zip(found, each, strict=True) if n is None)
                    rest.append([{"piece": t, "n": n} for t, n in unknown.items()])
                    each = [n for n in each if n is not None]
                else:
                    rest.append([])
                sizes.append(len(text.encode()))
                sums.append(sum(each) + specials)
            kind = pa.list_(pa.struct([("piece", pa.string()), ("n", pa.int32())]))
            yield pa.record_batch([here["doc_id"], pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(rest, kind)], ["doc_id", "n_bytes", "known", "rest"])

    return run


def token_counts(docs: DataFrame, definition: str, commonest: int = COMMONEST) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of each row of ``docs`` (doc_id, text), without begin or end tokens.

    ``definition`` is the content of a tokenizer file. A null text counts as empty: no bytes, no tokens. Special
    strings inside texts are one token each, as the library has it by default. Rows may repeat; each is counted. Texts
    are counted whole. Other columns are left out. An empty table has no rows.
    """
    spark = docs.sparkSession
    splitter = Splitter(definition)
    pieces = written(piece_table(docs, definition))
    classes = pieces.groupBy(F.expr(_CLASS).alias("class")).agg(F.count("*").alias("n")).orderBy(F.desc("class")).collect()
    lowest, held = None, 0
    for row in classes:  # at most 8 * 64 classes
        held += row["n"]
        if held > commonest:
            break
        lowest = row["class"]
    common = pieces.where(F.expr(_CLASS) >= lowest) if lowest is not None else pieces.limit(0)
    sink = pa.BufferOutputStream()
    entries = common.select("piece", "pieces").toArrow()
    with pa.ipc.new_stream(sink, entries.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(entries, max_chunksize=20_000)
    dictionary = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())
    sums = mapped(
        docs.select("doc_id", "text"), _sums(splitter, dictionary),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, known long, rest array<struct<piece: string, n: int>>",
    )
    sums = written(sums.withColumn("row", F.monotonically_increasing_id()))
    rest = sums.select("row", F.explode("rest").alias("r")).select("row", "r.piece", "r.n")
    rest = rest.join(pieces.select("piece", "pieces"), "piece").groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("more"))
    return sums.select("row", "doc_id", "n_bytes", "known").join(rest, "row", "left").select(
        "doc_id", "n_bytes", (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_tokens")
    )
