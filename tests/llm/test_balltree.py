import math
import random

import pytest
from pyspark.sql import functions as F

from vicinity.llm import balltree


def brute(rows, is_query, k):
    ok = [
        (i, [math.floor(256 * x) for x in v])
        for i, v, *_ in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, qv in ok:
        if is_query(q):
            hits = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q and len(v) == len(qv))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(hits)]
    return sorted(out)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [-1.0, 0.25]), (4, None), (5, []), (6, [nan, 1.0])]
    rows += [(7, [inf, 0.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (50, [0.1, 0.2, 0.3]), (2, [1.0, 0.5]), (100, [0.0, 0.0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, rank string")
    got = sorted(tuple(r) for r in balltree.top_k(frame, F.col("vec_id") % 50 == 0, 5).collect())
    assert got == brute(rows, lambda i: i % 50 == 0, 5)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert balltree.top_k(frame, F.col("vec_id") % 50 == 0, 5).collect() == []


@pytest.mark.parametrize("same", [False, True])
def test_many_shards_and_parts(spark, monkeypatch, same):
    monkeypatch.setattr(balltree, "SHARD", 300)
    monkeypatch.setattr(balltree, "BLOCK", 8)
    rng = random.Random(4)
    rows = []
    for i in range(1500):
        c = rng.randrange(5)
        v = [0.5] * 6 if same and i % 3 == 0 else [rng.gauss(3 * (j == c), 0.4) for j in range(6)]
        rows.append((i, v))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in balltree.top_k(frame, F.col("vec_id") % 20 == 0, 7).collect())
    assert got == brute(rows, lambda i: i % 20 == 0, 7)


def test_trees_prune():
    import numpy as np

    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 8)) * 400
    v = np.floor(centres[rng.integers(0, 40, 8000)] + rng.normal(size=(8000, 8)) * 20).astype(float)
    tree = balltree.BallTree(np.arange(8000), v)
    ids = np.arange(0, 8000, 200)
    best = [[] for _ in ids]
    done = tree.search(ids, v[ids], best, 5, [None] * len(ids))
    assert done < 0.4 * len(ids) * 8000


def found(spark, rows, every, k=5):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(tuple(r) for r in balltree.top_k(frame, F.col("vec_id") % every == 0, k).collect())


@pytest.mark.parametrize("size", [(1 << 24) / 256 - 1, 1e6, 1e9, 3e14])
def test_scores_beyond_doubles_are_exact(spark, monkeypatch, size):
    monkeypatch.setattr(balltree, "SHARD", 25)
    rng = random.Random(6)
    near = [size + rng.randrange(-3, 4) / 256 for _ in range(768)]
    rows = [(i, [x + rng.randrange(-1, 2) / 256 for x in near]) for i in range(60)]
    rows += [(100 + i, [-x for x in near[:40]] + near[40:]) for i in range(5)]
    want = brute(rows, lambda i: i % 20 == 0, 5)
    most = (1 << 63) - 1
    assert found(spark, rows, 20) == [(q, r, i, max(-most - 1, min(most, s))) for q, r, i, s in want]


def test_components_of_any_finite_size(spark):
    rows = [(0, [1e300, 1.0]), (1, [1e308, -2.0]), (2, [-1.7e308, 0.5]), (3, [1e308, -1.0]), (4, [0.0, 9e307]), (5, [0.5, 0.25])]
    rows += [(10, [0.25, 1e-300]), (11, [1e17, 3.0]), (12, [1e17, 5.0])]
    want = brute_whole(rows, lambda i: i % 5 == 0, 4)
    most = (1 << 63) - 1
    assert found(spark, rows, 5, 4) == [(q, r, i, max(-most - 1, min(most, s))) for q, r, i, s in want]


def brute_whole(rows, is_query, k):
    from fractions import Fraction

    ok = [(i, [math.floor(256 * Fraction(x)) for x in v]) for i, v in rows]
    out = []
    for q, qv in ok:
        if is_query(q):
            hits = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(hits)]
    return sorted(out)


def test_keys_sort_as_scores():
    scores = [0, 1, -1, 9, 10, -10, 99, 1 << 63, -(1 << 63), 10**80, -(10**80), 12345]
    assert [balltree.score_of(balltree.order_key(s)) for s in scores] == scores
    assert sorted(scores, key=balltree.order_key) == sorted(scores, reverse=True)
