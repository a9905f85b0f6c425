"""Keys of any type, users and items without terms, jobs to their published rows, no cuts."""

from __future__ import annotations

import os
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from quipu.functions import text
from quipu.operators import blocks, cluster, factorize, recommend, similarity, textmine, topics
from quipu.plans import fixtures as fx
from quipu.plans import jobs
from quipu.session import scratch_dir, scratch_job, scratch_path, settle
from quipu.sources import sinks

FOLDER = "/root/testdata/sf0.001"
IDS = ["00000123", "00000456", "A-7", "ñ1", "00000789"]


@pytest.fixture(scope="module")
def by_text(spark):
    """Ratings with text user ids, and a catalogue with an item that has no terms."""
    rows = [(IDS[u], i, float(1 + (u * 3 + i) % 5)) for u in range(4) for i in range(8) if (u + i) % 3]
    rows.append((IDS[4], 9, 5.0))  # a user whose only item has no terms
    ratings = spark.createDataFrame(rows, "user_id string, item_id long, score double")
    items = [(i, " ".join(["alpha", "beta", "gamma", "delta"][j] for j in range(4) if (i >> j) & 1 or j == i % 4)) for i in range(9)]
    catalog = spark.createDataFrame(items + [(9, "x"), (10, None)], "item_id long, name string")
    return ratings, catalog


def test_text_keys_come_back_unchanged(spark, by_text):
    ratings, _ = by_text
    factors, sigma = factorize.factorize(ratings, "score", 3)
    best = factorize.recommend_all(ratings, "score", factors, len(sigma), ratings, 2)
    assert {r.user_id for r in best.collect()} == set(IDS)
    scored = factorize.predict(factorize.user_factors(ratings, "score", factors, len(sigma)), factors, ratings)
    assert scored.count() == ratings.count() and scored.schema["user_id"].dataType.simpleString() == "string"


def test_text_keys_on_both_sides_against_brute_force(spark):
    rng = np.random.default_rng(4)
    a, b = rng.integers(-3, 4, (9, 5)).astype(float), rng.integers(-3, 4, (7, 5)).astype(float)
    left = spark.createDataFrame([(f"{i:03d}", r.tolist()) for i, r in enumerate(a)], "l string, val array<double>")
    right = spark.createDataFrame([(f"k{i}", r.tolist()) for i, r in enumerate(b)], "r string, val array<double>")
    gone = spark.createDataFrame([("000", "k1"), ("zzz", "k2")], "l string, r string")
    rows = blocks.block_topk(left, right, 3, "l", "r", exclude=gone, block_rows=4).collect()
    s = a @ b.T
    s[0, 1] = -np.inf
    for i in range(9):
        want = sorted(range(7), key=lambda j: (-s[i, j], f"k{j}"))[:3]
        assert {r.r for r in rows if r.l == f"{i:03d}"} == {f"k{j}" for j in want}


def test_blocks_are_bounded_by_cells(spark, monkeypatch):
    """Vectors as long as the vocabulary make more blocks, not larger ones, and give the same rows."""
    rng = np.random.default_rng(6)
    m = rng.integers(0, 5, (40, 300)).astype(float)
    df = spark.createDataFrame([(i, list(range(300)), r.tolist()) for i, r in enumerate(m)], "k long, idx array<int>, val array<double>")
    right = df.withColumnRenamed("k", "o")
    want = sorted(map(tuple, blocks.block_topk(df, right, 4, "k", "o").collect()))
    monkeypatch.setattr(blocks, "BLOCK_CELLS", 2_000)
    left_v = blocks._vectors(df, "k", None, "bigint")
    assert blocks._grid(left_v, left_v, blocks.BLOCK_ROWS)[:2] == (6, 6)
    assert sorted(map(tuple, blocks.block_topk(df, right, 4, "k", "o").collect())) == want


def test_content_lists_hold_every_user_and_item(spark, by_text):
    ratings, catalog = by_text
    tokens = text.terms(F.col("name"))
    weights, vocab = similarity.item_weights(catalog, tokens, min_df=1, max_df=1.0)
    vectors = similarity.item_vectors(weights, vocab)
    profiles = similarity.user_profiles(ratings, vectors, "score", normalise=True)
    rows = similarity.content_recommend(profiles, vectors, 11, ratings, catalog).collect()
    assert {(r.user_id, r.item_id) for r in rows} == {(u, i) for u in IDS for i in range(11)}
    assert all(r.score == 0 for r in rows if r.user_id == IDS[4] or r.item_id >= 9)
    model = recommend.ContentModel(tokens, min_df=1, max_df=1.0, max_features=3, runs=(1, 2)).fit(ratings, catalog)
    listed = model.recommend(ratings.select("user_id").distinct(), ratings, 20).collect()
    seen = {(r.user_id, r.item_id) for r in ratings.collect()}
    assert {(r.user_id, r.item_id) for r in listed} == {(u, i) for u in IDS for i in range(11)} - seen
    assert model.score(ratings.select("user_id", "item_id")).where("score IS NULL").count() == 0


def test_no_query_samples_its_rows():
    source = "\n".join(p.read_text() for p in Path("quipu").rglob("*.py") if "llm" not in p.parts)
    assert not re.search(r"\.sample\(", source) and "subsamplingRate=1.0" in source
    assert topics.fit_topics.__module__  # the rate is read back from the fitted model below


def test_topic_model_reads_every_post_each_round(spark):
    tokens = spark.createDataFrame([(i, ["aa", "bb"] if i % 2 else ["cc", "dd"]) for i in range(40)], "id long, tokens array<string>")
    model = topics.fit_topics(tokens, topics=2, rounds=3)
    assert model.stages[1].getSubsamplingRate() == 1.0


def test_block_solver_meets_every_row(spark):
    rows = [(i, [float(i % 3) * 10 + (i % 7) * 0.01, float(i % 3)]) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, val array<double>")
    centers = cluster.block_fit(df, "k", "val", 2, 3, passes=3)
    near = df.select((F.col("k") % 3).alias("g"), cluster.nearest_center(F.col("val"), centers).alias("c")).distinct().collect()
    assert len(near) >= 3 and len(centers) == 3
    one = cluster.block_fit(df, "k", "val", 2, 1, blocks=5, passes=1)[0]
    assert np.allclose(one, np.mean([v for _, v in rows], axis=0))


def test_texts_are_cut_once_and_never_shuffled(spark, monkeypatch):
    """An input with at least as many splits as tasks; fewer splits are spread first."""
    monkeypatch.setattr(textmine, "on_all_tasks", lambda df: df)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    counts = textmine.term_counts(docs, "doc_id", text.terms(F.col("text")), (1, 2))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert plan.rindex("Exchange") < plan.index("regexp_extract_all")  # the cut stands below every exchange
    assert not re.search(r"Exchange hashpartitioning\(doc_id#\d+L, \d+\)", plan)


def test_history_of_a_split_strongest_first(spark, by_text):
    ratings, catalog = by_text
    split = ratings.withColumn("is_test", F.col("item_id") % 2 == 0)
    rows = recommend.history(split, catalog, IDS[0], "train").collect()
    assert rows and all(r.item_id % 2 for r in rows)
    assert [r.score for r in rows] == sorted((r.score for r in rows), reverse=True)
    assert recommend.history(split, catalog, split="test").where("NOT is_test").count() == 0
    with pytest.raises(ValueError):
        recommend.history(split, catalog, split="none")


def test_jobs_publish_text_ids_and_lemmas(spark, by_text):
    ratings, catalog = by_text
    actions = ratings.select("user_id", "item_id", F.col("score").alias("views"), F.lit(1).alias("version"))
    done = ratings.where("score > 4").select("user_id", "item_id").unionByName(
        spark.createDataFrame([(u, 8) for u in IDS], "user_id string, item_id long")
    )
    path = scratch_path(spark, "published")
    out = jobs.recommend_job(actions, catalog, done, ["version"], publish_to=path)
    rows = sinks.read_current(spark, path).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, out.collect()))
    assert {r.user_id for r in rows} == {*IDS[:4], recommend.COLD_START_USER}

    posts = spark.createDataFrame([(1, "los cursos buenos"), (2, "curso de cursos")], "post long, message string")
    lemmas = spark.createDataFrame([("cursos", "curso")], "form string, lemma string")
    path = scratch_path(spark, "topics")
    jobs.topics_job(posts, "message", ["post"], text.spanish_stop_words(), lemmas=lemmas, publish_to=path)
    assert {r.post: r.clean_message for r in sinks.read_current(spark, path).collect()} == {1: "curso buenos", 2: "curso curso"}

    path = scratch_path(spark, "segments")
    jobs.segment_job(fx.grades(spark, FOLDER), ["day", "user_id"], fx.EVENT_TYPES, [[0.0] * 10, [1.0] * 10], publish_to=path)
    assert sinks.read_current(spark, path).count() > 0


def test_scratch_tables_go_with_their_job(spark):
    def tables():
        return {p for p in os.listdir(scratch_dir(spark)) if "-leftover-" in p}

    with scratch_job(spark):
        assert settle(spark.range(3), "leftover").count() == 3 and len(tables()) == 1
    assert not tables()


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_distributed_factorisation_matches_numpy(spark, folder):
    """Catalogues of over 100 items, which Spark does not solve on one machine."""
    ratings = settle(fx.ratings(spark, folder).select("user_id", "item_id", F.col("score").cast("double").alias("score")), "ratings")
    pdf = ratings.toPandas()
    wide = pdf.pivot(index="user_id", columns="item_id", values="score").fillna(0.0)
    assert wide.shape[1] > 100
    u, s, vt = np.linalg.svd(wide.to_numpy(), full_matrices=False)
    factors, sigma = factorize.factorize(ratings, "score")
    assert np.allclose(sigma, s[: len(sigma)], rtol=1e-8)
    want = (u[:, :6] * s[:6]) @ vt[:6]
    got = factorize.predict(factorize.user_factors(ratings, "score", factors, len(sigma)), factors, ratings).toPandas()
    at = {k: i for i, k in enumerate(wide.index)}, {k: i for i, k in enumerate(wide.columns)}
    values = want[got.user_id.map(at[0]).to_numpy(), got.item_id.map(at[1]).to_numpy()]
    assert np.abs(values - got.score.to_numpy()).max() < 1e-6
