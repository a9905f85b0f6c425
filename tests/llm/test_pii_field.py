"""The field against enumeration, and on spans written otherwise and numbers that look alike."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quipu.llm import pii
from tests.llm.test_text_operators import planted

LINES = ("+1 (578) 555-6437 4111 1111 1111 1112", "tel 555-123-4567, a@b.org", "10.2.3.4 978-3-16-148410-0", "x@y 1.2.3.4@z.org")


def cuts(grid):
    """Every way to cut the stretch into candidate segments."""
    n = len(grid.ending) - 1
    ways = [[[]]] + [[] for _ in range(n)]
    for end in range(1, n + 1):
        for first, label, own in grid.ending[end]:
            ways[end] += [way + [(first, end, label, own)] for way in ways[first]]
    return ways[n]


def score(field, way):
    total, prev = 0.0, pii.OUT
    for _, _, label, own in way:
        total += field.pairs[prev, label] + sum(field.weights[x] for x in own)
        prev = label
    return total


def random_field(rng):
    return pii.Field(rng.normal(0, 2, len(pii.FEATURES)), rng.normal(0, 2, (pii.N_LABELS, pii.N_LABELS)))


@pytest.mark.parametrize("text", LINES)
def test_the_best_cut_is_the_best_of_all(text):
    grid = pii.lattice(text, 0, len(text))
    every = cuts(grid)
    assert len(every) > 4
    for seed in range(20):
        field = random_field(np.random.default_rng(seed))
        best = max(every, key=lambda way: score(field, way))
        found = field.best(grid)
        assert found == [(i, j, y) for i, j, y, _ in best if y != pii.OUT]


@pytest.mark.parametrize("text", LINES)
def test_the_gradient_is_that_of_the_likelihood(text):
    grid = pii.lattice(text, 0, len(text))
    every = cuts(grid)
    field = random_field(np.random.default_rng(5))
    gold_way = random.Random(6).choice(every)
    w, t = pii._gradient(field, grid, [(i, j, y) for i, j, y, _ in gold_way if y != pii.OUT])
    top = max(score(field, way) for way in every)
    total = sum(math.exp(score(field, way) - top) for way in every)
    expected_w, expected_t = np.zeros_like(w), np.zeros_like(t)
    for way in every:
        share = math.exp(score(field, way) - top) / total
        for sign, path in ((-share, way),) + (((1.0, way),) if way is gold_way else ()):
            prev = pii.OUT
            for _, _, label, own in path:
                np.add.at(expected_w, own, sign)
                expected_t[prev, label] += sign
                prev = label
    assert np.allclose(w, expected_w, atol=1e-6) and np.allclose(t, expected_t, atol=1e-6)


@pytest.fixture(scope="module")
def split():
    stretches = sorted({t[a:b] for t in planted(900) for a, b in pii.regions(t)})
    half = [zlib.crc32(s.encode()) % 2 for s in stretches]
    return [s for s, h in zip(stretches, half) if h], [s for s, h in zip(stretches, half) if not h]


def test_precision_and_recall_on_stretches_kept_out(split):
    found = pii.measure(pii.learn(split[0]), split[1], 5)
    right, made, wanted = (sum(n[i] for n in found.values()) for i in range(3))
    assert wanted > 300 and right >= 0.95 * made and right >= 0.85 * wanted
    assert found["card"][0] >= 0.95 * found["card"][1] and found["card"][0] == found["card"][2]


def test_lines_written_by_hand(split):
    model = pii.learn(split[0])
    more = {
        "card 4111 1111 1111 1112": [],
        "call 555-123-4567 now": [("phone", "555-123-4567")],
        "(020) 7946 0958": [("phone", "(020) 7946 0958")],
        "born 1984-03-12 in": [],
        "since 12/03/1984": [],
        "ISBN 978-3-16-148410-0": [],
        "isbn 0-306-40615-2": [],
        "years 1990-2005": [],
        "pi is 3.1415926535": [],
        "card 4785.3805.9239.1139": [("card", "4785.3805.9239.1139")] if pii.luhn("4785380592391139") else [],
        "host 10.20.300.40": [],
        "total 1 234 567 890": [],
    }
    for line, expected in more.items():
        base, every = pii.spans(line, model)
        assert [(pii.KINDS[k], line[s:e]) for s, e, k in every if (s, e, k) not in base] == expected, line


def test_variants_are_repeatable_and_hold_no_other_base_spans():
    for text in planted(200):
        made = pii.variants(text)
        assert made == pii.variants(text)
        for body, marked in made:
            assert all(0 <= s < e <= len(body) for s, e, _ in marked)
            assert set(pii.base_spans(body)) <= set(marked)
    assert pii.variants("no digits") == [] and pii.variants("") == []


def test_rare_base_spans_are_found_for_the_training(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") == 77, "write to bob@mail.example.com or +1 (578) 555-6437").otherwise(F.concat(F.lit("n "), "id")).alias("text"),
    )
    found = pii.sample_stretches(docs, fit_regions=20)
    assert len(found) == 20 and any(pii.base_spans(s) for s in found)
    assert found == pii.sample_stretches(docs.repartition(7), fit_regions=20)
    assert pii.fit(docs, fit_regions=20) is not None
    assert pii.fit(docs.where("doc_id != 77"), fit_regions=20) is None
