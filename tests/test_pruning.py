"""Pruned best scores against all pairs, and how many pairs met."""

from __future__ import annotations

import numpy as np
import pytest

from quipu.operators import blocks, pruning, similarity


@pytest.fixture(autouse=True)
def small_cells(monkeypatch):
    monkeypatch.setattr(pruning, "LEFT_CELL", 24)
    monkeypatch.setattr(pruning, "RIGHT_CELL", 12)
    monkeypatch.setattr(pruning, "CHUNK", 3)


def dense(spark, x, key):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], f"{key} long, val array<double>").repartition(3)


def sparse(spark, x, key):
    rows = [(i, np.flatnonzero(r).tolist(), [float(v) for v in r[np.flatnonzero(r)]]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, f"{key} long, idx array<int>, val array<double>").repartition(3)


def same(left, right, k, most, **more):
    count = {}
    got = blocks.block_topk(left, right, k, "l", "r", prune=True, count=count, **more).collect()
    want = blocks.block_topk(left, right, k, "l", "r", prune=False, **more).collect()
    assert sorted((r.l, r.r) for r in got) == sorted((r.l, r.r) for r in want)
    for field in ["score"] + (["low", "high"] if more.get("extremes") else []):
        a, b = ({(r.l, r.r): r[field] for r in rows} for rows in (got, want))
        assert all(abs(a[x] - b[x]) < 1e-9 for x in a)
    assert count["met"] <= most * count["all"], count
    return count


def clustered(rng, n, d, groups=12, spread=0.05):
    return rng.standard_normal((groups, d))[rng.integers(0, groups, n)] + spread * rng.standard_normal((n, d))


def test_dense_vectors_around_pivots(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 16))
    x = centres[rng.integers(0, 12, 700)] + 0.05 * rng.standard_normal((700, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[5:40] = x[4]  # ties
    same(dense(spark, x[:300], "l"), dense(spark, x[200:], "r"), 4, 0.4)


def test_factors_of_varied_norm_with_exclusions_and_extremes(spark):
    rng = np.random.default_rng(2)
    users = clustered(rng, 260, 5) * rng.exponential(1.0, (260, 1))
    items = clustered(rng, 600, 5) * rng.exponential(1.0, (600, 1)) ** 3
    gone = spark.createDataFrame([(int(u), int(i)) for u, i in rng.integers(0, 260, (500, 2))], "l long, r long").distinct()
    same(dense(spark, users, "l"), dense(spark, items, "r"), 3, 0.5, exclude=gone, extremes=True)


def test_sparse_unit_vectors(spark):
    rng = np.random.default_rng(3)
    x = np.zeros((600, 200))
    for i in range(600):  # ten subjects with words of their own, and a few common words
        own = 20 * (i % 10) + rng.integers(0, 18, 5)
        x[i, own] = rng.random(5) + 0.5
        x[i, 20 * rng.integers(0, 10) + 19] = 0.3
    x[7] = 0.0
    x /= np.maximum(np.linalg.norm(x, axis=1), 1e-12)[:, None]
    same(sparse(spark, x[:250], "l"), sparse(spark, x, "r"), 3, 0.5)


def test_sets_with_equal_ones(spark):
    rng = np.random.default_rng(4)
    x = np.zeros((500, 120))
    for i in range(500):
        group = i % 6
        x[i, 20 * group + rng.choice(20, rng.choice([2, 3, 9]), replace=False)] = 1.0
    x[30:60] = x[0]
    same(sparse(spark, x[:200], "l"), sparse(spark, x, "r"), 5, 0.6, measure="jaccard")


def test_vectors_that_nothing_separates_are_compared_as_before(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((200, 60))
    count = same(dense(spark, x[:60], "l"), dense(spark, x, "r"), 30, 1.0)
    assert count["met"] > 0.5 * count["all"]
    none = dense(spark, x[:0], "r")
    assert blocks.block_topk(dense(spark, x[:5], "l"), none, 3, "l", "r", prune=True).count() == 0


def test_text_keys(spark):
    rng = np.random.default_rng(6)
    x = clustered(rng, 200, 6)
    left = dense(spark, x[:80], "l").selectExpr("concat('u0', l) AS l", "val")
    right = dense(spark, x, "r").selectExpr("concat('0', r) AS r", "val")
    got = blocks.block_topk(left, right, 3, "l", "r", prune=True).collect()
    want = blocks.block_topk(left, right, 3, "l", "r", prune=False).collect()
    assert sorted((r.l, r.r) for r in got) == sorted((r.l, r.r) for r in want)


def test_neighbours_take_the_pruned_way(spark, monkeypatch):
    rng = np.random.default_rng(7)
    df = dense(spark, clustered(rng, 150, 6).round(1), "id")
    want = sorted(map(tuple, similarity.neighbours(df, "id", 4).select("id", "neighbour").collect()))
    monkeypatch.setattr(blocks, "PRUNE_PRODUCTS", 1)
    assert sorted(map(tuple, similarity.neighbours(df, "id", 4).select("id", "neighbour").collect())) == want
