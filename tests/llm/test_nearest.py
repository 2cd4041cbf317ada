"""Nearest neighbours by cross-polytope hashing."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tables import FOLDER, ordered

import __spark_entry__ as driver
from parcelflow.llm import nearest
from parcelflow.llm.shared import LAST_ID, table

QUERIES = driver.queries()
COLUMNS = "vec_id long, embedding array<{}>, row string, key string, id string, length string, n int"


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "r", "k", "i", "l", 1) for i, v in rows], COLUMNS.format(kind)).repartition(3)


def brute(rows, asks, count=20):
    """(query_id, rank, vec_id, score) over (vec_id, vector); rows are told apart by their place."""
    fit = [(i, d, v) for i, (d, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for i, d, v in fit:
        if not asks(d):
            continue
        met = [(-(np.array(v) * np.array(w)).sum(), LAST_ID if e is None else e, e) for j, e, w in fit if j != i and len(w) == len(v)]
        out += [(d, rank + 1, e, -score) for rank, (score, _, e) in enumerate(sorted(met, key=lambda m: m[:2])[:count])]
    return out


def searched(df, **more):
    search = nearest.neighbours(df, F.col("vec_id") % 20 == 0, **more)
    return search, [tuple(r) for r in nearest.named(search.found).select("query_id", "rank", "vec_id", "score").collect()]


def by_twenty(d):
    return d is not None and d % 20 == 0


def recall(got, want):
    found = {(q, v) for q, _, v, _ in got}
    return sum((q, v) in found for q, _, v, _ in want) / len(want)


def cloud(rows, width, seed=1, spread=None):
    dice = np.random.default_rng(seed)
    points = dice.normal(size=(rows, width)).astype(np.float32)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    return points * (1 if spread is None else dice.uniform(*spread, size=(rows, 1)))


def test_query_over_its_table(spark):
    got = [tuple(r) for r in QUERIES["op12_nearest_neighbours"](spark, FOLDER).collect()]
    rows = [tuple(r) for r in table(spark, FOLDER, "embeddings").select("vec_id", "embedding").collect()]
    want = brute(rows, by_twenty)
    assert len(got) == len(want) and recall(got, want) >= 0.9
    exact = {(q, v): s for q, _, v, s in brute(rows, by_twenty, len(rows))}
    assert all(exact[q, v] == pytest.approx(s, abs=1e-12) for q, _, v, s in got)
    assert [r for _, r, _, _ in sorted(got)] == list(range(1, 21)) * len({g[0] for g in got})


@pytest.mark.parametrize(("width", "spread"), [(64, None), (24, None), (20, (0.2, 3.0))])
def test_recall_on_hashed_buckets(spark, monkeypatch, width, spread):
    monkeypatch.setattr(nearest, "BUCKET", 16)
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(cloud(1500, width, spread=spread))]
    search, got = searched(vectors(spark, rows, "double"))
    want = brute(rows, by_twenty)
    measured = recall(got, want)
    assert measured >= 0.9 and abs(measured - search.recall) < 0.05
    assert len(got) == len(want)


def test_copies_ties_and_hot_buckets(spark, monkeypatch):
    """A third of the vectors are equal and another third nearly so; blocks are small, so they are met in many."""
    monkeypatch.setattr(nearest, "BUCKET", 16)
    monkeypatch.setattr(nearest, "BLOCK", 32)
    points = cloud(900, 16)
    points[:300] = points[0]
    points[300:600] = points[300] + 0.01 * points[300:600]
    dice = np.random.default_rng(3)
    rows = [(int(i), [float(np.float32(x)) for x in p]) for i, p in zip(dice.permutation(900), points, strict=True)]
    _, got = searched(vectors(spark, rows))
    want = brute(rows, by_twenty)
    assert recall(got, want) >= 0.9 and len(got) == len(want)
    copies = {i for i, v in rows if v == rows[0][1]}
    assert ordered(g for g in got if g[0] in copies) == ordered(w for w in want if w[0] in copies)


def test_nulls_and_strange_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, [1.0, 2.0, 0.5]), (40, None), (60, []), (80, [0.0, 0.0]), (100, [None, 1.0]), (120, [nan, 1.0]),
        (140, [inf, 1.0]), (160, [-3.0, 1.0]), (1, [5.0, 5.0]), (2, [5.0, 5.0]), (None, [5.0, 5.0]), (None, None), (-20, [0.25, -0.5]), (180, [7.0, 1.0, 1.0]),
        (200, [4.0]), (3, [1e30, 1e30]), (4, [1e-30, 0.0]),
    ]
    for kind in ("float", "double"):
        rounded = [(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
        _, got = searched(vectors(spark, rounded, kind))
        assert ordered(got) == ordered(brute(rounded, by_twenty))


def test_fewer_candidates_than_asked_for(spark, monkeypatch):
    """Buckets hold next to nothing, so most queries are compared with all vectors."""
    monkeypatch.setattr(nearest, "BUCKET", 0.05)
    monkeypatch.setattr(nearest, "PROBES", 1)
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(cloud(61, 8))]
    _, got = searched(vectors(spark, rows), recall=0.0)
    assert len(got) == 4 * 20


def test_empty_tables(spark):
    assert searched(vectors(spark, []))[1] == []
    assert searched(vectors(spark, [(0, None), (20, [0.0])]))[1] == []
    assert searched(vectors(spark, [(0, [1.0])]))[1] == []


def test_same_neighbours_for_every_layout(spark):
    df = table(spark, FOLDER, "embeddings")
    runs = [ordered(searched(df.repartition(n))[1]) for n in (1, 5)]
    assert runs[0] == runs[1]


def test_rotations_keep_lengths_and_keys_are_nearest_first():
    points = cloud(50, 32).astype(float)
    assert np.allclose(np.linalg.norm(nearest.rotated(points, [1, 2, 3]), axis=1), np.linalg.norm(points, axis=1))
    space = nearest.Space(32, 100_000, 1.0, 1.0)
    assert np.prod([2 * a for a in space.axes()]) * nearest.BUCKET >= space.rows
    found = nearest.keys(points, space, 0, 8)
    assert found.shape == (50, 8) and (found[:, :1] == nearest.keys(points, space, 0, 1)).all()
    assert all(len(set(f)) == 8 for f in found.tolist())
