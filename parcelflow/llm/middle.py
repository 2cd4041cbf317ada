"""Fill-in-the-middle texts by secondary-sort assembly.

A text is cut into prefix, middle and suffix at ends of lines, and each part into chunks of whole lines. Chunks are rows
keyed by document and place in the output: they are dealt out by document and sorted inside of partitions, so a task
reads the output of one document after another as a stream, chunk by chunk, and holds no more than one chunk of it. This
is ``repartitionAndSortWithinPartitions`` on DataFrames. The stream goes into an incremental digest and, at the same
time, through a parser that knows the form only and finds the parts again by their marks. What it finds is sorted by the
place in the original, inside of the same partition, and read as a stream once more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.shared import mapped

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Marks of a form, in the order of the output, and the place that the part behind each has in the original.
FORMS = {"plain": [], "psm": [(PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)], "spm": [(SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)]}
#: Bytes of a chunk; only a longer line is cut inside.
CHUNK = 64 << 10
#: Bytes and rows that a task hands on at a time.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 4096

_FACTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
CHUNKS = f"uid long, place long, data binary, {_FACTS}"
_FOUND = f"uid long, part int, place long, data binary, {_FACTS}, output_sha256 string"
DIGESTS = f"{_FACTS}, output_sha256 string, restored_sha256 string"


@dataclass(frozen=True)
class Rule:
    """What decides the cuts and the form: a seed, the share of texts that are cut, the share of these that begin with the suffix."""

    seed: str = "7"
    percent: int = 100
    suffix_first: int = 50


def _rows(schema: str, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size."""
    fields = [pa.field(*_field(part)) for part in schema.split(", ")]
    data = [f.name for f in fields].index("data") if "data" in schema else None
    held: list[tuple] = []
    size = 0

    def batch():
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), fields, strict=True)], schema=pa.schema(fields))

    for row in rows:
        held.append(row)
        size += len(row[data]) if data is not None else 0
        if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _field(part: str) -> tuple[str, pa.DataType]:
    name, kind = part.split(" ")
    return name, {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[kind]


def _cut(doc_id: int | None, data: bytes, rule: Rule) -> tuple[int, str, list[bytes]]:
    """Number of lines, form and the parts of a text in their original order."""
    hashed = hashlib.sha256(f"{rule.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hashed[i : i + 8], 16) for i in (0, 8, 16, 24))
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    if data and not data.endswith(b"\n"):
        ends = np.append(ends, len(data))
    n = len(ends)
    if not data or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rule.percent:
        return n, "plain", [data]
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (low, high))
    return n, "spm" if h4 % 100 < rule.suffix_first else "psm", [data[:a], data[a:b], data[b:]]


def _chunks(part: bytes) -> Iterator[bytes]:
    """Runs of whole lines up to ``CHUNK`` bytes; a longer line is cut."""
    at = 0
    while len(part) - at > CHUNK:
        end = part.rfind(b"\n", at, at + CHUNK) + 1
        end = end if end > at else at + CHUNK
        yield part[at:end]
        at = end
    yield part[at:]


def _emitted(rule: Rule) -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for uid, doc_id, text in zip(batch["uid"].to_pylist(), batch["doc_id"].to_pylist(), batch["data"], strict=True):
            n, form, parts = _cut(doc_id, text.as_buffer().to_pybytes(), rule)
            chars = [None, None] if form == "plain" else [len(p.decode()) for p in parts[:2]]
            facts, place = (doc_id, n, form, *chars), 0
            for mark, part in FORMS[form] or [(b"", 0)]:
                for chunk in _chunks(parts[part]):
                    yield (uid, place, mark + chunk, *(facts if place == 0 else (None,) * 5))
                    mark, place = b"", place + 1

    return lambda batch: _rows(CHUNKS, rows(batch))


def chunks(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The output of each row of ``docs`` (doc_id, text) as chunks: uid (one for each row), place, data, and with place 0 the facts.

    Facts are doc_id, n (lines), form and the code points of prefix and middle, which are null for the form plain. A
    null text is an empty one, which is plain, with one empty chunk. A null doc_id counts as an empty string in the
    digest that decides the cuts. Repeated rows have a uid each. Other columns are left out. An empty table has no chunks.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"))
    return mapped(rows, _emitted(rule), CHUNKS)


def in_output_order(parts: DataFrame) -> DataFrame:
    """All chunks of a document in one partition, in the order of its output."""
    return parts.repartition("uid").sortWithinPartitions("uid", "place")


class _Parser:
    """Finds the parts in an output that comes in chunks cut anywhere: (place in the original, number, bytes)."""

    def __init__(self, form: str):
        self.marks, self.part, self.number, self.rest = list(FORMS[form]), 0, 0, b""

    def _found(self, data: bytes) -> Iterator[tuple[int, int, bytes]]:
        if data:
            yield self.part, self.number, data
            self.number += 1

    def fed(self, data: bytes) -> Iterator[tuple[int, int, bytes]]:
        data = self.rest + data
        while self.marks and (at := data.find(self.marks[0][0])) >= 0:
            yield from self._found(data[:at])
            data = data[at + len(self.marks[0][0]) :]
            self.part = self.marks.pop(0)[1]
        # What could be the beginning of a mark waits for the next chunk.
        keep = min(len(data), len(PREFIX) - 1) if self.marks else 0
        yield from self._found(data[: len(data) - keep])
        self.rest = data[len(data) - keep :]

    def ended(self) -> None:
        if self.marks:
            raise ValueError("an output lacks a mark of its form")


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for low in range(0, batch.num_rows, BATCH_ROWS):
            yield from batch.slice(low, BATCH_ROWS).to_pylist()


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        head = digest = parser = None

        def last():
            parser.ended()
            return (head["uid"], -1, 0, b"", *(head[c] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars")), digest.hexdigest())

        for row in _streams(batches):
            if head is None or row["uid"] != head["uid"]:
                if head is not None:
                    yield last()
                head, digest, parser = row, hashlib.sha256(), _Parser(row["form"])
            digest.update(row["data"])
            for part, number, data in parser.fed(row["data"]):
                yield (row["uid"], part, number, data, *(None,) * 6)
        if head is not None:
            yield last()

    return _rows(_FOUND, rows())


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split(" ")[0] for f in DIGESTS.split(", ")][:-1]

    def rows() -> Iterator[tuple]:
        head = digest = None
        for row in _streams(batches):
            if row["part"] == -1:
                if head is not None:
                    yield (*(head[c] for c in names), digest.hexdigest())
                head, digest = row, hashlib.sha256()
            else:
                digest.update(row["data"])
        if head is not None:
            yield (*(head[c] for c in names), digest.hexdigest())

    return _rows(DIGESTS, rows())


def restored(parts: DataFrame) -> DataFrame:
    """The original text of each document, from its output and form alone, as sorted pieces: uid, part, place, data and facts.

    The row with part -1 comes first and holds the facts and the digest of the output. Pieces of a document lie in one
    partition, in their original order.
    """
    return in_output_order(parts).mapInArrow(_parsed, _FOUND).sortWithinPartitions("uid", "part", "place")


def digests(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Facts of each row of ``docs`` (see ``chunks``), the digest of its output and that of the text restored from it."""
    return restored(chunks(docs, rule)).mapInArrow(_restored, DIGESTS)


def texts(parts: DataFrame) -> DataFrame:
    """Whole outputs, for those who want a row for each document: doc_id, form, output. A row is as long as its text."""
    from_first = F.min_by(F.struct("doc_id", "form"), "place").alias("head")
    pieces = F.array_sort(F.collect_list(F.struct("place", F.hex("data").alias("data"))))
    whole = F.decode(F.unhex(F.array_join(F.transform(pieces, lambda p: p.data), "")), "UTF-8")
    return parts.groupBy("uid").agg(from_first, whole.alias("output")).select("head.doc_id", "head.form", "output")
