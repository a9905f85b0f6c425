"""Hot keys, copies and many blocks give the same rows as brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quipu.operators import blocks, cluster, evaluate, factorize, indexing, prep, recommend, similarity

RNG = np.random.default_rng(11)


def hot_pairs(n_users=30, n_items=40, seed=5) -> pd.DataFrame:
    """Ratings where one user and one item hold about a third of the rows each."""
    rng = np.random.default_rng(seed)
    cells = {(0, i) for i in range(n_items - 3)} | {(u, 0) for u in range(n_users)}
    while len(cells) < 130:
        cells.add((int(rng.integers(n_users)), int(rng.integers(n_items))))
    rows = [(u, i, int(rng.integers(1, 6))) for u, i in sorted(cells)]
    return pd.DataFrame(rows, columns=["user_id", "item_id", "score"])


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.createDataFrame(hot_pairs())


def test_dense_index_is_a_permutation(spark):
    df = spark.range(500).withColumnRenamed("id", "item_id")
    pos = [r["pos"] for r in indexing.dense_index(df, "item_id", "pos", buckets=7).collect()]
    assert sorted(pos) == list(range(500))


def test_sorted_index_over_many_ranges(spark):
    df = spark.range(300).select((F.col("id") % 13).alias("s"), "id")
    rows = indexing.sorted_index(df, [F.desc("s"), F.asc("id")], "pos", rows_per_part=23).orderBy("pos").collect()
    assert [(r["s"], r["id"]) for r in rows] == sorted(((i % 13, i) for i in range(300)), key=lambda x: (-x[0], x[1]))
    assert [r["pos"] for r in rows] == list(range(1, 301))


@pytest.mark.parametrize("slot_rows", [3, 10, 10_000])
def test_holdout_is_the_same_for_any_slot_size(spark, ratings, slot_rows):
    want = {(r["user_id"], r["item_id"]) for r in evaluate.holdout_split(ratings).where("is_test").collect()}
    rows = evaluate.holdout_split(ratings, slot_rows=slot_rows).collect()
    assert len(rows) == ratings.count()
    assert {(r["user_id"], r["item_id"]) for r in rows if r["is_test"]} == want
    sizes = hot_pairs().groupby("user_id").size()
    got = pd.Series([u for u, _ in want]).value_counts()
    assert all(got.get(u, 0) == (n * 30 + 50) // 100 for u, n in sizes.items())


def test_negatives_are_unseen_and_complete(spark, ratings):
    pdf = hot_pairs()
    items = spark.range(40).withColumnRenamed("id", "item_id")
    out = evaluate.negative_samples(ratings, ratings, items, 10).toPandas()
    seen = pdf.groupby("user_id").item_id.agg(set)
    sizes = out.groupby(["user_id", "item_id"]).negative.agg(["size", "nunique"])
    for (u, i), (size, unique) in sizes.iterrows():
        assert size == unique == min(10, 40 - len(seen[u]))
    assert not any(n in seen[u] for u, n in zip(out.user_id, out.negative))
    # The hot user has three unseen items left and still gets a row for each.
    assert set(out[out.user_id == 0].negative) == set(range(40)) - seen[0]
    assert len(sizes) == len(pdf)


def test_negatives_of_dense_users_equal_their_walks(spark, ratings):
    """The short list of unseen items gives the sample that walking the whole catalogue gives."""
    pdf = hot_pairs()
    seen = pdf.groupby("user_id").item_id.agg(set)
    items = spark.range(40).withColumnRenamed("id", "item_id")
    pos = {r["item_id"]: r["pos"] for r in indexing.dense_index(items, "item_id", "pos").collect()}
    prime = evaluate.next_prime(40)
    draws = ratings.select(
        "user_id",
        "item_id",
        indexing.hash_number(F.lit(29), F.col("user_id"), F.col("item_id")).alias("a"),
        indexing.hash_number(F.lit(29), F.col("user_id"), F.col("item_id"), start=9).alias("b"),
    ).collect()
    start = {(r["user_id"], r["item_id"]): (r["a"] % prime, r["b"] % (prime - 1) + 1) for r in draws}
    item_at = {p: i for i, p in pos.items()}
    for n in (3, 20):  # users count as dense below 4 n unseen items: some, then all of them
        got = evaluate.negative_samples(ratings, ratings, items, n).toPandas()
        for (u, i), rows in got.groupby(["user_id", "item_id"]):
            a, b = start[u, i]
            walk = [item_at[(a + j * b) % prime] for j in range(prime) if (a + j * b) % prime in item_at]
            assert rows.sort_values("draw").negative.tolist() == [x for x in walk if x not in seen[u]][:n]


def test_popular_unseen_matches_brute_force(spark, ratings):
    pdf = hot_pairs()
    pop = pdf.groupby("item_id").score.sum()
    order = sorted(pop.index, key=lambda i: (-pop[i], i))
    seen = pdf.groupby("user_id").item_id.agg(set)
    for head in (None, 4, 9):  # short heads are lengthened for the users that need it
        rows = recommend.popular_unseen(ratings, ratings, ratings, 4, head=head).collect()
        got = {u: {r["item_id"] for r in rows if r["user_id"] == u} for u in seen.index}
        for u in seen.index:
            assert got[u] == set([i for i in order if i not in seen[u]][:4])


@pytest.mark.parametrize("block_rows", [4, 19, blocks.BLOCK_ROWS])
@pytest.mark.parametrize("sparse", [True, False])
def test_block_topk_matches_brute_force(spark, monkeypatch, block_rows, sparse):
    monkeypatch.setattr(blocks, "SLICE_CELLS", 30 if block_rows == 19 else 8_000_000)
    rng = np.random.default_rng(1)
    a, b = rng.integers(-2, 3, (23, 6)).astype(float), rng.integers(-2, 3, (17, 6)).astype(float)

    def frame(m, key):
        rows = []
        for i, r in enumerate(m):
            at = np.nonzero(r)[0] if sparse else np.arange(6)
            rows.append((i * 3, [int(x) for x in at], [float(x) for x in r[at]]))
        df = spark.createDataFrame(rows, f"{key} long, idx array<int>, val array<double>")
        return df if sparse else df.drop("idx")

    gone = [(int(i) * 3, int(j) * 3) for i, j in rng.integers(0, 17, (60, 2))]
    exclude = spark.createDataFrame(gone + [(999, 0)], "l long, r long")
    rows = blocks.block_topk(frame(a, "l"), frame(b, "r"), 5, "l", "r", exclude=exclude, block_rows=block_rows, extremes=True).collect()
    s = a @ b.T
    got: dict[int, list] = {}
    for r in rows:
        got.setdefault(r["l"], []).append((r["r"], r["score"]))
        assert r["low"] == s.min() and r["high"] == s.max()
    for i in range(23):
        left = [(j * 3, s[i, j]) for j in range(17) if (i * 3, j * 3) not in set(gone)]
        assert sorted(got[i * 3]) == sorted(sorted(left, key=lambda x: (-x[1], x[0]))[:5])


def test_block_scores_only_asked_pairs(spark, monkeypatch):
    monkeypatch.setattr(blocks, "SLICE_CELLS", 5)
    left = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(9)], "l long, val array<double>")
    right = spark.createDataFrame([(i, [2.0, float(i)]) for i in range(7)], "r long, val array<double>")
    asked = spark.createDataFrame([(1, 2), (8, 6), (3, 99)], "l long, r long")
    rows = blocks.block_scores(left, right, asked, "l", "r", block_rows=2).collect()
    assert {(r["l"], r["r"], r["score"]) for r in rows} == {(1, 2, 4.0), (8, 6, 22.0)}


def test_neighbours_with_many_copies(spark):
    """A third of the items share one vector; every item still gets its k nearest."""
    rng = np.random.default_rng(2)
    m = rng.normal(size=(30, 4)).round(1)
    m[::3] = m[0]
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "id long, val array<double>")
    rows = similarity.neighbours(df, "id", 6).collect()
    got: dict[int, list] = {}
    for r in rows:
        got.setdefault(r["id"], []).append(r["neighbour"])
    s = np.round(m @ m.T, 9)
    for i in range(30):
        want = sorted((j for j in range(30) if j != i), key=lambda j: (-s[i, j], j))[:6]
        assert sorted(got[i]) == sorted(want)


def test_seen_once_and_dedupe_with_a_hot_key(spark):
    pdf = pd.DataFrame({"k": [1] * 50 + list(range(2, 60)), "v": range(108)})
    df = spark.createDataFrame(pdf)
    assert {r["k"] for r in prep.seen_once(df, ["k"]).collect()} == set(range(2, 60))
    assert {r["v"] for r in prep.dedupe(df, ["k"], ["v"]).where("k = 1").collect()} == {49}


def matrix(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.pivot(index="user_id", columns="item_id", values="score")


def rank_k(m: np.ndarray, k: int) -> np.ndarray:
    u, s, vt = np.linalg.svd(m, full_matrices=False)
    return (u[:, :k] * s[:k]) @ vt[:k]


def test_factorisation_matches_numpy(spark, ratings):
    dense = matrix(hot_pairs()).fillna(0)
    factors, sigma = factorize.factorize(ratings, "score", 6)
    assert np.allclose(sigma, np.linalg.svd(dense.values, compute_uv=False)[:6])
    full = rank_k(dense.values, 6)
    users = factorize.user_factors(ratings, "score", factors, 6)
    for r in factorize.predict(users, factors, ratings).collect():
        want = full[dense.index.get_loc(r["user_id"]), dense.columns.get_loc(r["item_id"])]
        assert abs(r["score"] - want) < 1e-6
    done = ratings.where("score > 3")
    best = factorize.recommend_all(ratings, "score", factors, 6, done, 3).toPandas()
    scaled = (full - full.min()) / (full.max() - full.min())
    gone = {(r["user_id"], r["item_id"]) for r in done.collect()}
    for u, rows in best.groupby("user_id"):
        at = dense.index.get_loc(u)
        left = [j for j, i in enumerate(dense.columns) if (u, i) not in gone]
        assert np.allclose(sorted(rows.score), sorted(sorted(scaled[at, left])[-3:]), atol=1e-6)
        assert not gone & {(u, i) for i in rows.item_id}
    assert best.user_id.nunique() == len(dense)


def test_centred_factorisation_matches_numpy(spark, ratings):
    wide = matrix(hot_pairs())
    means = wide.mean(axis=1)
    full = rank_k(wide.sub(means, axis=0).fillna(0).values, 4) + means.values[:, None]
    for r in factorize.predict_centered(ratings, "score", ratings, 4).collect():
        want = full[wide.index.get_loc(r["user_id"]), wide.columns.get_loc(r["item_id"])]
        assert abs(r["score"] - want) < 1e-6


def test_evaluation_properties(spark, ratings):
    items = spark.range(40).select(F.col("id").alias("item_id"), F.concat_ws(" ", F.lit("curso"), F.concat(F.lit("tema"), F.col("id") % 4)).alias("name"))

    class Content(recommend.ContentModel):
        def fit(self, r, c):
            return super().fit(r, c)

    models = [recommend.PopularityModel(), recommend.FactorModel(3), Content(F.split("name", " "))]
    rows = evaluate.compare(models, ratings, items, 10).collect()
    assert [r["model"] for r in rows] == ["popularity", "collaborative", "content"]
    for r in rows:
        assert 0 <= r["recall_5"] <= r["recall_10"] <= 1 and r["n_test"] == rows[0]["n_test"]


def test_result_does_not_depend_on_shuffle_partitions(spark, ratings):
    items = spark.range(40).withColumnRenamed("id", "item_id")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            split = evaluate.holdout_split(ratings)
            out.append(sorted(tuple(r) for r in evaluate.negative_samples(split.where("is_test"), split, items, 5).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1]


def test_exact_silhouette_over_blocks(spark):
    rng = np.random.default_rng(4)
    m = np.vstack([rng.normal(c, 0.3, (9, 3)) for c in (0, 2, 5)])
    labels = np.repeat([0, 1, 2], 9)
    df = spark.createDataFrame([(i, int(c), [float(x) for x in r]) for i, (c, r) in enumerate(zip(labels, m))], "id long, c int, v array<double>")
    dist = np.linalg.norm(m[:, None] - m[None], axis=2)
    s = []
    for i in range(27):
        a = dist[i, labels == labels[i]].sum() / 8
        b = min(dist[i, labels == c].mean() for c in range(3) if c != labels[i])
        s.append((b - a) / max(a, b))
    assert abs(cluster.silhouette_exact(df, "id", "c", "v").first()[0] - np.mean(s)) < 1e-9


@pytest.mark.parametrize("block_rows", [2, blocks.BLOCK_ROWS])
def test_worst_ratios_over_blocks(spark, block_rows):
    rng = np.random.default_rng(9)
    m, s = rng.normal(size=(9, 4)), rng.uniform(0.1, 1, 9)
    m[8] = m[0]
    df = spark.createDataFrame([(f"c{i}", float(s[i]), m[i].tolist()) for i in range(9)], "k string, s double, val array<double>")
    rows = {r.k: r.worst for r in blocks.block_worst_ratio(df, "k", block_rows).collect()}
    for i in range(9):
        far = [(s[i] + s[j]) / d for j in range(9) if j != i and (d := np.linalg.norm(m[i] - m[j])) > 1e-9]
        assert abs(rows[f"c{i}"] - max(far)) < 1e-9


def test_elbow_falls(spark):
    df = spark.createDataFrame(pd.DataFrame(RNG.normal(size=(80, 2)), columns=["a", "b"]))
    cost = [r["cost"] for r in cluster.elbow_curve(df, ["a", "b"], range(1, 5)).orderBy("k").collect()]
    pdf = df.toPandas()
    assert abs(cost[0] - ((pdf - pdf.mean()) ** 2).values.sum()) < 1e-6
    assert all(later <= earlier * 1.05 for earlier, later in zip(cost, cost[1:]))
