from __future__ import annotations

import math
import random

import numpy as np
import pytest

from quipu.llm import whitening
from tests.llm.cases import with_clashes

VECTORS = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """Usable vectors as whole numbers, by plain Python."""
    out = []
    for key, vector, *_ in rows:
        if vector is not None and vector and all(c is not None and math.isfinite(c) for c in vector):
            out.append((key, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector]))
    return out


def check(got, rows, limit=32):
    want = plain(rows)
    n, d = len(want), len(want[0][1])
    sums = [sum(x[i] for _, x in want) for i in range(d)]
    cov = [[sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for _, x in want) / n**3 for j in range(d)] for i in range(d)]
    values, axes = np.linalg.eigh(np.array(cov))
    values, axes = values[::-1], axes[:, ::-1]
    k = min(limit, d)
    assert len(got) == n * k
    assert {r.n for r in got} == {n}
    found = {}
    for r in got:
        found.setdefault((r.vec_id, r.component), []).append(r)
    centred = np.array([[(n * v - s) / n for v, s in zip(x, sums)] for _, x in want])
    onto = centred @ axes[:, :k] / np.sqrt(values[:k])
    white = np.zeros((n, k))
    for row, (key, x) in enumerate(want):
        exact = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        for c in range(k):
            r = found[key, c + 1].pop()
            assert r.deviation == exact
            assert r.explained == pytest.approx(values[c] / values.sum(), rel=1e-9)
            white[row, c] = r.whitened
    for c in range(k):
        sign = np.sign(white[:, c] @ onto[:, c])
        assert np.allclose(sign * white[:, c], onto[:, c], atol=1e-7)
    error = np.abs(white.T @ white / n - np.eye(k)).max()
    assert error < 1e-9
    assert all(abs(r.identity_error) < 1e-9 for r in got)


def vectors(spark, rows):
    return with_clashes(spark.createDataFrame(rows, VECTORS).repartition(3))


def random_rows(n, d, seed=1):
    rng = random.Random(seed)
    # A different spread per dimension keeps the eigenvalues apart.
    return [(i, [rng.gauss(0.3 * j, 0.1 + 0.2 * j) for j in range(d)], j_label) for i in range(n) for j_label in [i % 3]]


def test_whitening_against_exact_sums(spark):
    rows = random_rows(300, 7)
    rows += [rows[0], rows[0]]  # repeated keys and vectors
    odd = [(900, None, 1), (901, [1.0, None, 2.0, 0.0, 0.0, 0.0, 0.0], 1), (902, [float("nan")] * 7, 1), (903, [float("inf")] * 7, None)]
    odd += [(904, [-float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0, 0.0], 1)]
    check(whitening.components(vectors(spark, rows + odd), "vec_id", "embedding").collect(), rows)
    check(whitening.components(vectors(spark, random_rows(150, 40)), "vec_id", "embedding").collect(), random_rows(150, 40))


def test_large_and_hot_values_stay_exact(spark):
    rows = random_rows(120, 5) + [(1000 + i, [1.5] * 5, 0) for i in range(400)] + [(2000, [3e3, -2e3, 1.0, 0.0, 0.5], 0)]
    check(whitening.components(vectors(spark, rows), "vec_id", "embedding").collect(), rows)
    # Beyond the bound, and with more than a long can hold: no crash, and null where the long ends.
    far = rows + [(3000, [3e38, -3e38, 0.0, 0.0, 0.0], 0)]
    got = whitening.components(vectors(spark, far), "vec_id", "embedding").collect()
    assert len(got) == len(far) * 5
    assert all(r.deviation is None for r in got if r.vec_id == 3000)


def test_cross_products_are_exact():
    rng = np.random.default_rng(2)
    for high in (1, 2, 200, 1 << 20, 1 << 49):
        x = rng.integers(-high, high, (133, 6))
        sums, products = whitening.cross_products(x)
        o = x.astype(object)
        assert sums.tolist() == o.sum(axis=0).tolist()
        assert products.tolist() == (o.T @ o).tolist()
    assert whitening.cross_products(np.zeros((0, 3), np.int64))[0].tolist() == [0, 0, 0]


def test_defined_cases(spark):
    assert whitening.components(vectors(spark, [(1, None, 1)]), "vec_id", "embedding").collect() == []
    assert whitening.components(vectors(spark, [(1, [], 1)]), "vec_id", "embedding").count() == 0
    one = whitening.components(vectors(spark, [(1, [1.0, 2.0], 1), (None, [5.0], 1), (2, [], 1)]), "vec_id", "embedding").collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [
        (1, 1, 1, 0, None, None, None),
        (1, 2, 1, 0, None, None, None),
    ]
    # A dimension without variance: the component has no whitened values.
    flat = whitening.components(vectors(spark, [(i, [float(i), 4.0], 1) for i in range(5)]), "vec_id", "embedding").collect()
    assert {(r.component, r.whitened is None) for r in flat} == {(1, False), (2, True)}
    assert {round(r.explained, 9) for r in flat} == {0.0, 1.0}


def test_long_vectors(spark):
    rows = random_rows(60, 200)
    got = whitening.components(vectors(spark, rows), "vec_id", "embedding", 4).collect()
    check(got, rows, 4)


def test_columns_pass_through(spark):
    df = vectors(spark, random_rows(20, 3))
    out = whitening.transform(df, "embedding", whitening.fit(df, "embedding"))
    assert out.columns == [*df.columns, "deviation", "whitened"]
    assert out.count() == 20
