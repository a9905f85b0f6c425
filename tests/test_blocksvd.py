"""The block solver against numpy, and the tiled matrix."""

from __future__ import annotations

import numpy as np
import pytest

from quipu.operators import blocksvd, factorize, reshape
from quipu.plans import fixtures as fx
from quipu.plans import queries_reco  # noqa: F401
from quipu.plans.registry import QUERIES
from quipu.session import settle


def dense(cells, shape):
    out = np.zeros(shape)
    for r in cells:
        out[r[0], r[1]] = r[2]
    return out


def test_tiles_hold_every_cell_and_split_a_heavy_row(spark, monkeypatch):
    monkeypatch.setattr(reshape, "TILE_ROWS", 4)
    monkeypatch.setattr(reshape, "TILE_COLUMNS", 8)
    rows = [(0, j, float(j)) for j in range(50)] + [(i, 3, 1.0) for i in range(1, 20)]
    tiles = reshape.matrix_tiles(spark.createDataFrame(rows, "u long, i long, v double"), "u", "i", "v").collect()
    back = sorted((t.rb * 4 + r, t.cb * 8 + c, v) for t in tiles for r, c, v in zip(t.r, t.c, t.v))
    assert back == sorted(rows)
    assert max(len(t.v) for t in tiles) <= 4 * 8
    assert sum(0 in [t.rb * 4 + r for r in t.r] for t in tiles) == 7  # the row of all columns


@pytest.mark.parametrize(("users", "items", "basis"), [(30, 7, 1024), (300, 161, 1024), (300, 161, 120)])
def test_vectors_against_numpy(spark, monkeypatch, users, items, basis):
    monkeypatch.setattr(blocksvd, "BASIS", basis)
    monkeypatch.setattr(blocksvd, "WIDTH", 24)
    for module in (reshape, blocksvd):
        monkeypatch.setattr(module, "TILE_ROWS", 64)
        monkeypatch.setattr(module, "TILE_COLUMNS", 32)
    rng = np.random.default_rng(users)
    cells = [(u, i, float(rng.integers(1, 6))) for u in range(users) for i in range(items) if rng.random() < 0.1]
    cells += [(0, i, 5.0) for i in range(items) if not any(c[:2] == (0, i) for c in cells)]
    # Tastes that some users and items share keep the leading values apart from the noise.
    cells = [(u, i, v + (20.0 if u % 5 == i % 7 else 0.0) + (9.0 if u % 4 == i % 3 else 0.0)) for u, i, v in cells]
    a = dense(cells, (users, items))
    k, count = 5, {}
    df = spark.createDataFrame(cells, "user_pos long, item_pos long, v double").repartition(3)
    leading, sigma = blocksvd.singular_vectors(df, items, k, count)
    v = np.array([r.val for r in sorted(leading.collect(), key=lambda r: r.item_pos)])
    _, s, vt = np.linalg.svd(a, full_matrices=False)
    assert v.shape == (items, k)
    assert np.allclose(sigma, s[:k], rtol=1e-9)
    assert np.allclose(v.T @ v, np.eye(k), atol=1e-9)
    assert np.abs(a @ v @ v.T - a @ vt[:k].T @ vt[:k]).max() < 1e-6
    assert count["passes"] <= 60


def test_a_matrix_of_small_rank(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 3, (40, 2)) @ rng.integers(0, 3, (2, 25))
    cells = [(i, j, float(a[i, j])) for i in range(40) for j in range(25) if a[i, j]]
    leading, sigma = blocksvd.singular_vectors(spark.createDataFrame(cells, "user_pos long, item_pos long, v double"), 25, 4)
    s = np.linalg.svd(a, compute_uv=False)
    assert np.allclose(sigma, s[:4], atol=1e-5 * s[0])


def test_recommendations_do_not_depend_on_the_solver(spark):
    d = "/root/testdata/sf0.01"
    ratings = settle(fx.ratings(spark, d), "ratings")
    done = settle(fx.completions(spark, d), "done")
    found = []
    for limit in (factorize.SOLVER_ITEMS, 0):
        factors, sigma = factorize.factorize(ratings, "score", solver_items=limit)
        best = factorize.recommend_all(ratings, "score", factors, len(sigma), done, 3).toPandas()
        found.append((sigma, best.sort_values(["user_id", "item_id"]).reset_index(drop=True)))
    (s1, best1), (s2, best2) = found
    assert np.allclose(s1, s2, rtol=1e-8)
    assert (best1[["user_id", "item_id"]] == best2[["user_id", "item_id"]]).all().all()
    assert np.abs(best1.score - best2.score).max() < 1e-6


def test_equal_values_are_no_gap():
    """Of four equal values two are wanted: what counts is how far the first other value lies below."""
    values, tail, rest = np.array([4.0, 4.0, 4.0, 4.0, 1.0]), np.full((1, 2), 1e-9), np.ones((1, 1))
    assert blocksvd._angle(values, tail, rest, 2) == pytest.approx(1e-9 / 3)
    assert blocksvd._angle(values[:4], tail, rest, 2) == pytest.approx(1e-9 / 4)
    assert blocksvd._angle(np.array([4.0, 2.0, 1.0]), tail, rest, 1) == pytest.approx(1e-9 / 2)


def test_a_task_gives_out_one_sum_per_range(spark, monkeypatch):
    """Cells spread thinly over 625 tiles, more ranges than a task holds together."""
    for module in (reshape, blocksvd):
        monkeypatch.setattr(module, "TILE_ROWS", 8)
        monkeypatch.setattr(module, "TILE_COLUMNS", 8)
    monkeypatch.setattr(blocksvd, "HELD_SUMS", 3)
    given, add = [], blocksvd._sum_blocks

    def counted(partial, keys):
        if keys == ["at"]:
            given.append(partial.count())
        return add(partial, keys)

    monkeypatch.setattr(blocksvd, "_sum_blocks", counted)
    monkeypatch.setattr(blocksvd, "PASSES", 1)
    rng = np.random.default_rng(3)
    cells = sorted({(int(u), int(i)) for u, i in rng.integers(0, 200, (4000, 2))} | {(i, i) for i in range(200)})
    df = spark.createDataFrame([(u, i, 1.0) for u, i in cells], "user_pos long, item_pos long, v double")
    blocksvd.singular_vectors(df, 200, 2)
    assert len(given) == 2 and max(given) <= 25 * spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("cells_held", [1, 1 << 20])
def test_packets_hold_every_tile(spark, monkeypatch, cells_held):
    for module in (reshape, blocksvd):
        monkeypatch.setattr(module, "TILE_ROWS", 4)
        monkeypatch.setattr(module, "TILE_COLUMNS", 4)
    monkeypatch.setattr(blocksvd, "PACKET_CELLS", cells_held)
    rows = [(u, i, float(u + i)) for u in range(30) for i in range(30) if (u * i) % 3 != 1]
    tiles = reshape.matrix_tiles(spark.createDataFrame(rows, "u long, i long, v double"), "u", "i", "v")
    packets = blocksvd._packets(tiles, "cb", "rb").collect()
    back = sorted((t.rb * 4 + r, p.cb * 4 + c, v) for p in packets for t in p.tiles for r, c, v in zip(t.r, t.c, t.v))
    assert back == sorted(rows)


def test_predictions_move_with_the_pairs(spark):
    """The values of the asked pairs only, and no pair of blocks of users and items."""
    users = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.5, -1.0])], "user_id long, val array<double>")
    items = spark.createDataFrame([(7, [3.0, 4.0]), (8, [0.0, 1.0])], "item_id long, val array<double>")
    asked = spark.createDataFrame([(1, 7), (1, 7), (2, 8), (3, 7), (1, 9), (None, 7)], "user_id long, item_id long")
    found = factorize.predict(users, items, asked)
    assert sorted(map(tuple, found.collect())) == [(1, 7, 11.0), (1, 7, 11.0), (2, 8, -1.0)]
    assert "CoGroup" not in found._jdf.queryExecution().executedPlan().toString()


def test_svd_scores_holds_every_user_and_item(spark):
    """The whole reconstructed matrix, also the pairs without a rating, and the values of numpy's."""
    d = "/root/testdata/sf0.001"
    ratings = fx.ratings(spark, d).toPandas()
    wide = ratings.pivot(index="user_id", columns="item_id", values="score").fillna(0.0).astype(float)
    u, s, vt = np.linalg.svd(wide.to_numpy(), full_matrices=False)
    want = (u[:, :6] * s[:6]) @ vt[:6]
    found = QUERIES["svd_scores"](spark, d).toPandas()
    assert len(found) == wide.size > len(ratings)
    got = found.pivot(index="user_id", columns="item_id", values="score").loc[wide.index, wide.columns]
    assert np.abs(got.to_numpy() - want).max() < 1e-6
