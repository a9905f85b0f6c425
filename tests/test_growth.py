"""Steps whose cost must grow no faster than their input, against plain forms of the same."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyspark.sql
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from quipu.operators import blocks, evaluate, prep, recommend, similarity, topics
from quipu.plans import queries_text
from quipu.session import on_all_tasks, settle


@pytest.mark.parametrize("m", [3, 128, 700, 1537, 4000])
@pytest.mark.parametrize("take", [1, 3])
def test_best_columns_are_those_of_a_full_sort(m, take):
    rng = np.random.default_rng(m)
    s = rng.integers(0, 40, (9, m)) / 8 + rng.integers(0, 2, (9, m)) * 1e-11  # ties once rounded
    s[1] = 2.0
    s[2, m // 2 :] = -np.inf
    s[3] = -np.inf
    r, c = blocks.best_columns(s, take)
    for i, row in enumerate(np.round(s, 9)):
        assert sorted(c[r == i]) == sorted(np.lexsort((np.arange(m), -row))[:take])
    s[4, 5 % m] = np.nan
    r, c = blocks.best_columns(s, take)
    assert len(c[r == 0]) == take


def frame(spark, n_users=25, n_items=60, seed=3):
    rng = np.random.default_rng(seed)
    rows = {(0, i) for i in range(50)} | {(int(rng.integers(n_users)), int(rng.integers(n_items))) for _ in range(300)}
    rows = [(u, f"i{i:02d}", int(rng.integers(1, 6))) for u, i in sorted(rows)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["user_id", "item_id", "score"])).repartition(3)


@pytest.mark.parametrize("limits", [{}, {"GROUP_PAIRS": 6, "BLOCK_POSITIONS": 7, "MEETING_PAIRS": 20}])
def test_ranks_from_packed_samples_are_those_from_rows(spark, monkeypatch, limits):
    pairs = frame(spark)
    items = spark.range(70).select(F.format_string("i%02d", "id").alias("item_id"))
    split = settle(evaluate.holdout_split(pairs), "split")
    test = split.where("is_test")
    model = recommend.PopularityModel().fit(split.where("NOT is_test"), items)
    plain = evaluate.negative_samples(test, split, items, 8)
    want = sorted(map(tuple, evaluate.hits(test, settle(plain, "plain"), model).collect()))
    want_rows = sorted(map(tuple, plain.collect()))
    for name, value in limits.items():
        monkeypatch.setattr(evaluate, name, value)
    packed = evaluate.negative_samples(test, split, items, 8, packed=True)
    assert sorted(map(tuple, packed.rows().collect())) == want_rows
    assert sorted(map(tuple, evaluate.hits(test, packed, model).collect())) == want
    assert len(want_rows) > 3 * len(want) > 0


def test_distance_sums_cut_both_sides_and_send_single_precision(spark):
    x = np.random.default_rng(5).standard_normal((2100, 4)).astype(np.float32)
    df = spark.createDataFrame([(i, i % 3, r.tolist()) for i, r in enumerate(x)], "k long, g long, val array<float>").repartition(4)
    left = blocks._vectors(df, "k", "g", "bigint", single=True)
    assert left.schema["val"].dataType.simpleString() == "array<float>"
    n_left, n_right, _ = blocks._grid(left, left, blocks.BLOCK_ROWS, even=True)
    assert n_left == n_right > 1
    got = {(r.k, r.g): r.total for r in blocks.block_distance_sums(df, "k", "g").collect()}
    y = x.astype(float)
    for i in (0, 7, 2099):
        far = np.linalg.norm(y - y[i], axis=1)
        assert all(abs(got[i, g] - far[np.arange(2100) % 3 == g].sum()) < 1e-6 for g in range(3))


def test_users_are_counted_from_rows_that_are_already_one_per_pair(spark):
    actions = spark.createDataFrame([(1, 1, 2, 1), (1, 1, 3, 2), (2, 1, 1, 1), (2, 2, 1, 1), (3, 3, 1, 1)], "user_id long, item_id long, views long, t long")
    items, done = actions.select("item_id").distinct(), actions.select("user_id", "item_id")
    out = prep.prepare_interactions(actions, items, done, ["t"])
    assert {(r.user_id, r.item_id) for r in out.collect()} == {(2, 1), (2, 2)}


def per_task(df):
    return sorted(r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect())


def test_a_large_file_of_one_row_group_is_spread(spark, tmp_path):
    """Many splits, but all rows in one of them."""
    tasks, path = spark.sparkContext.defaultParallelism, f"{tmp_path}/one"
    spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t")).coalesce(1).write.parquet(path)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "8k")
    try:
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() > tasks and per_task(df) == [4000]
        spread = on_all_tasks(df)
        assert spread.rdd.getNumPartitions() % tasks == 0 and per_task(spread)[-1] <= 1.2 * 4000 / tasks
        assert spread.select("id").distinct().count() == 4000
        assert on_all_tasks(df, 4000) is df  # little data stays if asked for
        even = spark.range(4000).repartition(tasks)
        assert on_all_tasks(even) is even
    finally:
        spark.conf.set(name, before)


def test_topics_are_fitted_by_all_tasks(spark, tmp_path, monkeypatch):
    tasks, n = spark.sparkContext.defaultParallelism, 2000
    posts = [(i, 0, "user", f"palabra{i % 7} tema{i % 3} curso{i % 5}") for i in range(n)]
    table = spark.createDataFrame(posts, "conv_id long, turn long, role string, text string").coalesce(1)
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    tokens = queries_text._topic_tokens(spark, str(tmp_path))
    assert len(per_task(tokens)) == tasks and sum(per_task(tokens)) == n
    fitted = []
    monkeypatch.setattr(topics, "as_terms", lambda df, f=topics.as_terms: fitted.append(df) or f(df))
    model = topics.fit_topics(settle(tokens.coalesce(1)), rounds=1)
    assert len(per_task(fitted[0])) == tasks and sum(per_task(fitted[0])) == n
    assert topics.assign_topics(model, tokens).count() == n


@pytest.mark.parametrize("text_users", [False, True])
@pytest.mark.parametrize("taken", [False, True])
def test_copies_beyond_a_list_are_not_scored(spark, monkeypatch, text_users, taken):
    """Lists over four groups of 30 equal items are those over all items, from far fewer scored ones."""
    rng = np.random.default_rng(5)
    items = pd.DataFrame({"item_id": np.arange(5, 125), "idx": [[g] if g < 3 else [] for g in [0, 1, 2, 3] * 30]})
    items["val"] = [[1.0] * len(i) for i in items.idx]
    users = pd.DataFrame({"user_id": np.arange(12), "pos": np.arange(12) % 3, "weight": 1.0})
    seen = pd.DataFrame({"user_id": rng.integers(0, 13, 150), "item_id": rng.integers(5, 125, 150)})
    # One user has seen the eight smallest items of its group, and one item twice.
    seen = pd.concat([seen.drop_duplicates(), pd.DataFrame({"user_id": 1, "item_id": [*range(6, 38, 4), 6]})]).astype("int64")
    if text_users:
        users["user_id"], seen["user_id"] = users.user_id.astype(str), seen.user_id.astype(str)
    vectors = spark.createDataFrame(items, "item_id long, idx array<int>, val array<double>")
    profiles, pairs = spark.createDataFrame(users), spark.createDataFrame(seen)
    scored, whole = [], similarity.block_topk

    def counted(left, right, *args, **more):
        scored.append(right.count())
        return whole(left, right, *args, **more)

    monkeypatch.setattr(similarity, "block_topk", counted)

    def lists():
        found = similarity.content_recommend(profiles, vectors, 3, profiles, vectors, seen=pairs if taken else None)
        return sorted(tuple(r) for r in found.select("user_id", "item_id", "score").collect())

    few = lists()
    monkeypatch.setattr(similarity, "representatives", lambda vectors, *args: vectors)
    assert few == lists() and len(few) == 36
    assert scored[0] < 0.8 * scored[1] == 0.8 * 120


@pytest.mark.parametrize("dense", [True, False])
def test_no_null_list_goes_to_an_arrow_function(spark, monkeypatch, dense):
    """Every row of a batch costs a run over the null lists at its end, so none is sent."""
    schemas, both = [], pyspark.sql.GroupedData.cogroup

    def seen(left, right):
        schemas.extend([left._df.schema, right._df.schema])
        return both(left, right)

    monkeypatch.setattr(pyspark.sql.GroupedData, "cogroup", seen)
    rows = [(i, [0, 2], [1.0, float(i)]) for i in range(4)] + [(9, [], [])][dense:]
    vectors = spark.createDataFrame(rows, "id long, idx array<int>, val array<double>")
    vectors = vectors.drop("idx") if dense else vectors
    left, right = vectors.withColumnRenamed("id", "a"), vectors.withColumnRenamed("id", "b")
    asked = spark.createDataFrame([(1, 2), (3, 3), (9, 1), (5, 1)], "a long, b long")
    found = {(r.a, r.b): r.score for r in blocks.block_scores(left, right, asked, "a", "b").collect()}
    assert found == {(1, 2): 3.0, (3, 3): 10.0} | ({} if dense else {(9, 1): 0.0})
    lists = [f for s in schemas for f in s.fields if isinstance(f.dataType, ArrayType)]
    assert len(lists) == 6 and not any(f.nullable for f in lists)
