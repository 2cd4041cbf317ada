"""Repair of conversations."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tables import FOLDER, ordered

import __spark_entry__ as driver
from check_queries import compare, database
from parcelflow.llm import repair
from parcelflow.llm.queries import damaged
from parcelflow.llm.shared import table

QUERIES = driver.queries()
COLUMNS = "conv_id long, turn long, role string, text string, code string, part int, uid string"
WORDS = re.compile(r"[^\x20\x09-\x0D]")
LAST = (1 << 63) - 1


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def turns_first(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role, hashlib.sha256(text.encode()).digest())


def faults(rows):
    """Fault of each ordered (turn, role, text)."""
    seen, out = set(), []
    for _, role, text in rows:
        found = WORDS.findall(text)
        out.append("blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """(cost, audit, turns), by a search over (rows read, state) in the order of cost and letters."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, turns = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, turns
        follow = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        role = {"u": "user", "a": "assistant"}[follow]
        heapq.heappush(heap, (cost + 2, audit + "I", i, follow, (*turns, (role, ""))))
        if i < len(rows):
            own, text = rows[i][1:]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, turns))
            if kinds[i] not in ("blank", "duplicate"):
                late = kinds[i] == "truncated"
                heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, follow, (*turns, (role, text))))
                if own[:1] == follow or (own[:1] == "s" and state == ""):
                    heapq.heappush(heap, (cost + late, audit + "K", i + 1, own[:1], (*turns, (own, text))))
    raise AssertionError


def expected(rows, names):
    """One tuple for each conversation of ``names``, from its (conv_id, turn, role, text)."""
    of, out = defaultdict(list), []
    for conv, turn, role, text in rows:
        of[conv].append((turn, " " if role is None else role, " " if text is None else text))
    for conv in set(names):
        told = sorted(of[conv], key=turns_first)
        kinds = faults(told)
        cost, audit, turns = cheapest(told, kinds)
        numbered = [t for t, _, _ in told if t is not None]
        gaps = max(numbered) - min(numbered) + 1 - len(set(numbered)) if numbered else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(told))
        out.append((conv, gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in turns))))
    return ordered(out)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (fate != 0) * (1 + (fate == 3))
    return out


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "u") for r in rows], COLUMNS).repartition(3)


def strange(conversations=250, seed=5):
    dice = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "u", "tool", "", None, "User", "s"]
    texts = ["Hello.", "And?", "no end", "", " \t\n\x0b\x0c\r", None, "Ünd \U0001f600!", "x.\n", " ", "multi\nline.", "y." * 3000]
    rows = []
    for conv in range(conversations):
        for _ in range(int(dice.integers(0, 12))):
            turn = None if dice.random() < 0.1 else int(dice.integers(-3, 10))
            rows.append((None if conv == 3 else conv, turn, roles[dice.choice(9, p=[0.3, 0.3, 0.1, 0.05, 0.05, 0.05, 0.05, 0.05, 0.05])], texts[int(dice.integers(0, 11))]))
    return rows


def report(spark, rows, names=None):
    df = conversations(spark, rows)
    return ordered(map(tuple, repair.reported(df, df if names is None else names).collect()))


def test_query_over_its_table(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = ordered(map(tuple, QUERIES["op13_conversation_repair"](spark, FOLDER).collect()))
    assert got == expected(damage(rows), [r[0] for r in rows])


def test_same_rows_as_sql(spark):
    assert compare(spark, FOLDER, "op13_conversation_repair", database(FOLDER)) == ""


def test_damage(spark):
    rows = strange()
    got = damaged(conversations(spark, rows).select("conv_id", "turn", "role", "text")).collect()
    assert ordered(map(tuple, got)) == ordered(damage(rows))


def test_strange_conversations(spark):
    rows = strange()
    assert report(spark, rows) == expected(rows, [r[0] for r in rows])


@pytest.mark.parametrize("block", [1, 2, 5])
def test_conversations_cut_into_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = strange(40, 8) + [(7, t, r, f"{t}{e}") for t, r, e in zip(range(200), itertools.cycle(["user", "assistant", "assistant", "system", "user"]), itertools.cycle([".", "", "!"]))]
    assert report(spark, rows) == expected(rows, [r[0] for r in rows])


def test_one_conversation_with_most_rows(spark):
    rows = [(1, i // 3, ("user", "assistant")[i % 2], f"text {i % 1500}.") for i in range(6000)] + [(2, None, "user", "same.")] * 3000
    assert report(spark, rows) == expected(rows, [1, 2])


def test_conversation_without_rows_and_empty_table(spark):
    names = conversations(spark, [(5, 1, "user", "gone"), (None, 1, "user", "gone")])
    nothing = [(c, 0, 0, 0, 0, 0, 0, "", sha("")) for c in (5, None)]
    assert report(spark, [], names) == ordered(nothing)
    assert report(spark, []) == []


def test_same_repair_for_every_layout(spark):
    rows = strange()
    runs = [ordered(map(tuple, repair.reported(df := conversations(spark, rows).repartition(n), df).collect())) for n in (1, 5)]
    assert runs[0] == runs[1]


def test_repaired_turns_are_legal(spark):
    turns = repair.repaired(conversations(spark, strange())).turns.collect()
    of = defaultdict(list)
    for r in sorted(turns, key=lambda r: (r["conv"], r["part"], r["number"], r["place"], r["turn_of"])):
        of[r["conv"]].append(r["role"][:1])
    assert of and all(re.fullmatch("(s?(ua)+)?", "".join(roles)) for roles in of.values())


@pytest.mark.parametrize("length", range(1, 5))
def test_halves_meet_on_the_cheapest_first_way(length):
    """Every run of a few row kinds against a search over whole edit scripts."""
    kinds = {"": 0, "truncated": 1, "blank": 2, "duplicate": 3}
    rows = [(k, r) for k in kinds for r in ("system", "user", "assistant", "tool") if k != "duplicate" or r == "user"]
    for run in itertools.islice(itertools.product(rows, repeat=length), 0, None, 1 if length < 4 else 7):
        codes = bytes([*(kinds[k] * 4 + {"s": 1, "u": 2, "a": 3}.get(r[0], 0) for k, r in run), repair.END])
        letters, _ = repair.edits(codes, repair.NOTHING, repair.NOTHING)
        assert "".join(letters) == cheapest([(0, r, "x") for _, r in run], [k for k, _ in run])[1]
