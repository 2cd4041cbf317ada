"""Repair of conversations by Hirschberg's divide and conquer over the states of a legal one.

A legal conversation is empty, or an optional system turn and then user and assistant turns in pairs. While its rows are
read it is in one of four states: nothing yet, after the system turn, after a user turn, after an assistant turn. Every
row is kept, given the other role or deleted, and turns may be inserted before it; the cheapest edits win, of equally
cheap ones those whose letters come first.

Cost vectors over the four states run forward to the middle of a run of rows and backward to it; the state with the least
sum is where the cheapest edits cross, and both halves are solved the same way. The forward vector also ranks its states
by the letters that lead there: letters up to a row all end with what is done to that row, so none continues another,
and the rank alone decides ties. No more than one vector is held at a time.

Rows are sorted by conversation and turn over the whole cluster and cut into blocks. A block of rows is summed up as the
costs and ranks from each state to each, which is just what one row is, so the crossings between the blocks of a long
conversation are found first, in the same way, and then each block is solved on its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.shared import LAST_ID, mapped, row_id, written

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Faults of a row; the first that holds counts. Blank and repeated rows have to go.
SOUND, TRUNCATED, BLANK, REPEATED = range(4)
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 2, 3, 2, 1
#: Rows of a block.
BLOCK = 1 << 13
#: A conversation's inserted last turns stand in a block of their own, behind all others.
_LAST_PART = (1 << 31) - 1

_BLANKS = " \t\n\x0b\x0c\r"
_NEVER = 1 << 40
#: From any state all others can be imitated for 3 more, and the one after an assistant turn is reached for 4 at most: a
#: state that costs over 7 more than the cheapest is on no cheapest way.
_HOPELESS = 7
_NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}

Matrix = tuple[tuple[tuple[int, ...], ...], tuple[tuple[int, ...], ...]]
Vector = tuple[tuple[int, ...], tuple[int, ...]]


def _ways(code: int) -> list[list[tuple[int, str]]]:
    """Cheapest cost and letters from each state to each over one row; ``code`` is fault * 4 + role (a state, 0 for others)."""
    out = [[(_NEVER, "")] * 4 for _ in range(4)]
    fault, role = divmod(code, 4)
    late = LEFT_TRUNCATED if fault == TRUNCATED else 0
    for start in range(4):
        state = start
        for inserted in range(3):
            ends = [(state, "D", DELETE)]
            if fault in (SOUND, TRUNCATED):
                ends.append((_NEXT[state], "R", REROLE + late))
                if role == _NEXT[state] or (role == SYSTEM and state == NOTHING):
                    ends.append((role, "K", late))
            for end, letter, cost in ends:
                out[start][end] = min(out[start][end], (cost + INSERT * inserted, "I" * inserted + letter))
            state = _NEXT[state]
    return out


#: The end of a conversation, as a row that can be passed with nothing or after an assistant turn.
END = 16
_END_WAYS = [[(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")][s : s + 1] + [(_NEVER, "")] * 3 for s in range(4)]
WAYS = [*map(_ways, range(END)), _END_WAYS]


def _matrix(ways: list[list[tuple[int, str]]]) -> Matrix:
    """Costs, and ranks of the letters to all states from each."""
    ranks = [[sorted(w[1] for w in row if w[0] < _NEVER).index(way[1]) if way[0] < _NEVER else 9 for way in row] for row in ways]
    return tuple(tuple(w[0] for w in row) for row in ways), tuple(map(tuple, ranks))


MATRICES = [_matrix(w) for w in WAYS]


def start_at(state: int) -> Vector:
    return tuple(0 if s == state else _NEVER for s in range(4)), tuple(0 if s == state else 9 for s in range(4))


def onward(vector: Vector, matrix: Matrix) -> Vector:
    """Least cost to each state, and the ranks of the letters that lead there."""
    (costs, ranks), (cost, rank) = vector, matrix
    best = [min((costs[s] + cost[s][t], ranks[s], rank[s][t]) for s in range(4)) for t in range(4)]
    least = min(b[0] for b in best)
    reached = [b[0] <= least + _HOPELESS for b in best]
    order = sorted(b[1:] for b, r in zip(best, reached, strict=True) if r)
    return tuple(b[0] if r else _NEVER for b, r in zip(best, reached, strict=True)), tuple(
        order.index(b[1:]) if r else 9 for b, r in zip(best, reached, strict=True)
    )


def backward(costs: tuple[int, ...], matrix: Matrix) -> tuple[int, ...]:
    """Least cost from each state to the end."""
    return tuple(min(_NEVER, *(matrix[0][s][t] + costs[t] for t in range(4))) for s in range(4))


@lru_cache(maxsize=1 << 16)
def _onward_row(vector: Vector, code: int) -> tuple[Vector, int]:
    """Over one row, with the least cost taken out, so that few different vectors occur."""
    costs, ranks = onward(vector, MATRICES[code])
    least = min(costs)
    return (tuple(c if c >= _NEVER else c - least for c in costs), ranks), least


@lru_cache(maxsize=1 << 16)
def _backward_row(costs: tuple[int, ...], code: int) -> tuple[int, ...]:
    costs = backward(costs, MATRICES[code])
    least = min(costs)
    return tuple(c if c >= _NEVER else c - least for c in costs)


def over_rows(codes: bytes, state: int) -> Vector:
    """The vector behind all rows of a block that is entered in ``state``."""
    vector, total = start_at(state), 0
    for code in codes:
        vector, least = _onward_row(vector, code)
        total += least
    return tuple(c if c >= _NEVER else c + total for c in vector[0]), vector[1]


def crossings(items: Sequence, enters: int, leaves: int, ahead: Callable, behind: Callable) -> list[int]:
    """The state before each of ``items`` and behind the last, on the way with the least cost and the first letters."""
    states = [enters, *[0] * (len(items) - 1), leaves]
    spans = [(0, len(items))]
    while spans:
        low, high = spans.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        vector = start_at(states[low])
        for i in range(low, middle):
            vector = ahead(vector, items[i])
        after = start_at(states[high])[0]
        for i in range(high - 1, middle - 1, -1):
            after = behind(after, items[i])
        states[middle] = min(range(4), key=lambda s: (vector[0][s] + after[s], vector[1][s]))
        spans += [(low, middle), (middle, high)]
    return states


def edits(codes: bytes, enters: int, leaves: int) -> tuple[list[str], list[int]]:
    """Letters for each row of a block, and the states between them."""
    states = crossings(codes, enters, leaves, lambda v, c: _onward_row(v, c)[0], _backward_row)
    return [WAYS[c][s][t][1] for c, s, t in zip(codes, states[:-1], states[1:], strict=True)], states


def _illegal(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether two neighbouring roles are none of system-user, user-assistant and assistant-user."""
    return ~(((right == USER) & ((left == SYSTEM) | (left == ASSISTANT))) | ((left == USER) & (right == ASSISTANT)))


_BLOCKS = "conv long, part int, number int, codes binary, uids binary, cost array<long>, rank array<int>, illegal long, first int, last int"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a task's sorted rows, each of one conversation."""
    part, number = TaskContext.get().partitionId(), 0
    conv, held, size = None, [], 0

    def block():
        codes = np.concatenate([c for c, _ in held])
        vectors = [over_rows(codes.tobytes(), s) for s in range(4)]
        roles = codes % 4
        row = {
            "conv": conv, "part": part, "number": number, "codes": codes.tobytes(), "uids": np.concatenate([u for _, u in held]).tobytes(),
            "cost": [c for v in vectors for c in v[0]], "rank": [r for v in vectors for r in v[1]],
            "illegal": int(_illegal(roles[:-1], roles[1:]).sum()), "first": int(roles[0]), "last": int(roles[-1]),
        }
        return row

    done: list[dict] = []
    for batch in batches:
        convs, codes, uids = (batch[c].to_numpy() for c in ("conv", "code", "uid"))
        codes = codes.astype(np.uint8)
        ends = np.append(np.flatnonzero(convs[1:] != convs[:-1]) + 1, len(convs)) if len(convs) else []
        low = 0
        for end in ends:
            while low < end:
                if held and (convs[low] != conv or size == BLOCK):
                    done.append(block())
                    held, size, number = [], 0, number + 1
                conv, high = int(convs[low]), min(int(end), low + BLOCK - size)
                held.append((codes[low:high], uids[low:high]))
                size, low = size + high - low, high
        if len(done) >= 1024:
            yield _batch(done, _BLOCKS)
            done = []
    if held:
        done.append(block())
    if done:
        yield _batch(done, _BLOCKS)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = []
    for name, kind in (part.split(" ") for part in schema.split(", ")):
        fields.append(pa.field(name, pa.list_(_KINDS[kind[6:-1]]) if kind.startswith("array<") else _KINDS[kind]))
    return pa.RecordBatch.from_pylist(rows, pa.schema(fields))


_CROSSED = "conv long, part int, number int, enters int, leaves int, total long, illegal long"


def _crossed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The states between the blocks of each conversation; its cost stands with the end."""
    out = []
    for conv, blocks in zip(batch["conv"].to_pylist(), batch["blocks"].to_pylist(), strict=True):
        square = lambda flat: tuple(tuple(flat[i : i + 4]) for i in range(0, 16, 4))
        items = [*((square(b["cost"]), square(b["rank"])) for b in blocks), MATRICES[END]]
        states = crossings(items, NOTHING, NOTHING, onward, backward)
        total = sum(item[0][s][t] for item, s, t in zip(items, states[:-1], states[1:], strict=True))
        first, last = (np.array([b[c] for b in blocks]) for c in ("first", "last"))
        illegal = sum(b["illegal"] for b in blocks) + int(_illegal(last[:-1], first[1:]).sum())
        for b, s, t in zip(blocks, states[:-1], states[1:], strict=False):
            out.append({"conv": conv, "part": b["part"], "number": b["number"], "enters": s, "leaves": t})
        out.append({"conv": conv, "part": _LAST_PART, "number": 0, "enters": states[-2], "leaves": NOTHING, "total": total, "illegal": illegal})
    yield _batch(out, _CROSSED)


_EDITED = "conv long, part int, number int, audit string, uid array<long>, letters array<string>, before array<int>, after array<int>"


def _edited(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    out = []
    for row in batch.to_pylist():
        codes = bytes([END]) if row["codes"] is None else row["codes"]
        letters, states = edits(codes, row["enters"], row["leaves"])
        uids = [None] if row["uids"] is None else np.frombuffer(row["uids"], np.int64).tolist()
        done = {"audit": "".join(letters), "uid": uids, "letters": letters, "before": states[:-1], "after": states[1:]}
        out.append({c: row[c] for c in ("conv", "part", "number")} | done)
        if len(letters) > 1024 or len(out) >= 1024:
            yield _batch(out, _EDITED)
            out = []
    if out:
        yield _batch(out, _EDITED)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each conversation from its sorted turns, as they stream by."""
    conv, digest, done = None, None, []
    for batch in batches:
        for key, said in zip(batch["conv"].to_pylist(), batch["said"], strict=True):
            if key != conv:
                if digest is not None:
                    done.append({"conv": conv, "sha256": digest.hexdigest()})
                conv, digest = key, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(said.as_buffer())
        if len(done) >= 1024:
            yield _batch(done, "conv long, sha256 string")
            done = []
    if digest is not None:
        done.append({"conv": conv, "sha256": digest.hexdigest()})
    if done:
        yield _batch(done, "conv long, sha256 string")


@dataclass(frozen=True)
class Repair:
    """What was found and done.

    ``turns``: the repaired turns (conv, role, text) with what orders them (part, number, place, turn_of). ``audits``:
    conv and audit. ``costs``: conv, cost and illegal. ``faults``: conv, gaps, blank, duplicate and truncated.
    Conversations without rows are in none of them. A missing conv_id is one conversation, ``LAST_ID``.
    """

    turns: DataFrame
    audits: DataFrame
    costs: DataFrame
    faults: DataFrame


def repaired(rows: DataFrame) -> Repair:
    """Cheapest repair of each conversation of ``rows`` (conv_id, turn, role, text); other columns are left out.

    Rows of a conversation are ordered by turn, missing ones first; of one turn by role, then by the text's digest, so the
    order of the input does not matter. Null roles and texts count as one blank. Rows that agree in role and text with an
    earlier one are repeated. Texts of any length are read whole. An empty table gives empty ones.
    """
    text = F.coalesce("text", F.lit(" "))
    told = rows.select(
        row_id("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("digest"), F.monotonically_increasing_id().alias("uid"),
    )
    told = written(told)
    first = told.groupBy("conv", "role", "digest").agg(F.min(F.struct("turn", "uid")).alias("f")).select(F.col("f.uid").alias("first_uid"))
    trimmed = F.rtrim("text", F.lit(_BLANKS))
    fault = (
        F.when(trimmed == "", BLANK).when(F.col("first_uid").isNull(), REPEATED)
        .when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    )
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(0)
    seen = told.join(first, F.col("uid") == F.col("first_uid"), "left")
    seen = written(seen.select("conv", "turn", "role", "digest", "uid", fault.alias("fault"), (fault * 4 + role).alias("code")))

    order = ["conv", "turn", "role", "digest", "uid"]
    sorted_ = seen.select(*order, "code").repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = written(sorted_.select("conv", "code", "uid").mapInArrow(_blocks, _BLOCKS))
    parts = F.sort_array(F.collect_list(F.struct("part", "number", "cost", "rank", "illegal", "first", "last"))).alias("blocks")
    crossed = written(mapped(blocks.groupBy("conv").agg(parts), _crossed, _CROSSED))
    solved = crossed.drop("total", "illegal").join(blocks.select("conv", "part", "number", "codes", "uids"), ["conv", "part", "number"], "left")
    edited = written(mapped(solved, _edited, _EDITED))

    each = edited.select("conv", "part", "number", F.posexplode(F.arrays_zip("uid", "letters", "before", "after")).alias("place", "e"))
    each = each.select("conv", "part", "number", "place", F.col("e.uid").alias("uid"), *(F.col(f"e.{c}") for c in ("letters", "before", "after")))
    found = each.join(told.select(F.col("uid").alias("told_uid"), "role", "text"), F.col("uid") == F.col("told_uid"), "left")
    inserted = F.length(F.regexp_extract("letters", "^(I*)", 1))
    # Inserted turns go on from the state they find; an own row has the role it is given or its own.
    turn = lambda i: F.struct(F.when((F.col("before") == USER) == (i % 2 == 0), "assistant").otherwise("user").alias("role"), F.lit("").alias("text"))
    given = F.when(F.col("after") == USER, "user").otherwise("assistant")
    own = F.struct(F.when(F.endswith("letters", F.lit("R")), given).otherwise(F.col("role")).alias("role"), F.col("text").alias("text"))
    here = F.when(F.endswith("letters", F.lit("K")) | F.endswith("letters", F.lit("R")), F.array(own)).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    before = F.when(inserted > 0, F.transform(F.sequence(F.lit(0), inserted - 1), turn)).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    turns = found.select("conv", "part", "number", "place", F.posexplode(F.concat(before, here)).alias("turn_of", "t"))
    turns = turns.select("conv", "part", "number", "place", "turn_of", "t.role", "t.text")

    letters = F.sort_array(F.collect_list(F.struct("part", "number", "audit")))
    audits = edited.groupBy("conv").agg(F.array_join(F.transform(letters, lambda b: b.audit), "").alias("audit"))
    counts = [F.count_if(F.col("fault") == f).alias(n) for f, n in ((BLANK, "blank"), (REPEATED, "duplicate"), (TRUNCATED, "truncated"))]
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    return Repair(turns, audits, crossed.where("total is not null").select("conv", F.col("total").alias("cost"), "illegal"), seen.groupBy("conv").agg(gaps, *counts))


def digests(turns: DataFrame) -> DataFrame:
    """sha256 of each conversation's ``role:text`` joined by newlines: its turns stream through one task in their order."""
    said = F.encode(F.concat("role", F.lit(":"), "text"), "UTF-8").alias("said")
    place = ["conv", "part", "number", "place", "turn_of"]
    return turns.select(*place, said).repartition("conv").sortWithinPartitions(*place).select("conv", "said").mapInArrow(_hashed, "conv long, sha256 string")


def reported(rows: DataFrame, names: DataFrame) -> DataFrame:
    """One row for each conv_id of ``names``: faults of its ``rows``, cost, audit and digest of the repair.

    A conversation without rows has zeros, an empty audit and the digest of an empty string.
    """
    repair = repaired(rows)
    conv = names.select(row_id("conv_id").alias("conv")).distinct()
    found = conv
    for part in (repair.faults, repair.costs, repair.audits, digests(repair.turns)):
        found = found.join(part, "conv", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    audit, digest = F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return found.select(F.when(F.col("conv") < LAST_ID, F.col("conv")).alias("conv_id"), *numbers, audit, digest)
