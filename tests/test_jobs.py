"""Sinks, stored models and the batch jobs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quipu.functions import text
from quipu.operators import recommend, topics
from quipu.plans import fixtures as fx
from quipu.plans import jobs
from quipu.session import scratch_path
from quipu.sources import sinks
from quipu.sources.tables import read_delimited, read_json, read_table

FOLDER = "/root/testdata/sf0.001"


def test_recommendations_leave_out_completed_pairs(spark):
    done = {(str(r["user_id"]), r["item_id"]) for r in fx.completions(spark, FOLDER).collect()}
    ratings = fx.ratings(spark, FOLDER)
    users = {str(r["user_id"]) for r in ratings.select("user_id").distinct().collect()}
    out = jobs.recommend_job(
        fx.actions(spark, FOLDER), fx.catalog(spark, FOLDER), fx.completions(spark, FOLDER), fx.ACTION_ORDER,
        F.lit("2024-02-01").cast("date"),
    ).toPandas()
    cold = out[out.user_id == recommend.COLD_START_USER]
    known = out[out.user_id != recommend.COLD_START_USER]
    assert len(cold) == 5 and cold.score.max() == 1 and cold.score.min() == 0
    assert set(known.user_id) == users and known.groupby("user_id").size().max() <= 3
    assert not done & set(zip(known.user_id, known.item_id))
    assert known.score.between(0, 1).all() and set(out.run_date) == {"2024-02-01"}


def test_segments_use_a_stored_scaler(spark):
    grades = fx.grades(spark, FOLDER)
    features = [*fx.EVENT_TYPES, *[f"band_{q}" for q in fx.EVENT_TYPES]]
    scaler = {c: (0.0, 1.0) for c in features}
    centers = [[0.0] * 10, [20.0] * 5 + [2.0] * 5]
    rows = jobs.segment_job(grades, ["day", "user_id"], fx.EVENT_TYPES, centers, scaler).toPandas()
    near = np.linalg.norm(rows[features].values[:, None, :] - np.array(centers)[None], axis=2).argmin(axis=1) + 1
    assert (rows.cluster.values == near).all()


@pytest.fixture(scope="module")
def forum(spark):
    posts = fx.posts(spark, FOLDER)
    stop = text.spanish_stop_words() + text.FORUM_STOP_WORDS
    out, model = jobs.topics_job(posts, "message", ["conv_id", "turn"], stop)
    return posts, stop, out, model


def test_topics_are_distributions(spark, forum):
    posts, stop, out, model = forum
    scored = topics.assign_topics(model, topics.forum_tokens(posts, "message", stop)).toPandas()
    dist = np.array(scored.distribution.tolist())
    assert dist.shape[1] == 5 and np.allclose(dist.sum(axis=1), 1)
    assert (scored.topic.values == dist.argmax(axis=1) + 1).all()
    assert out.columns == ["conv_id", "turn", "clean_message", "topic"] and out.count() == posts.count()
    terms = topics.topic_terms(model, 10).toPandas()
    assert len(terms) == 50 and set(terms.groupby("topic")["rank"].max()) == {10}
    assert not set(terms.term) & set(stop)


def test_stored_topic_model_scores_the_same(spark, forum):
    posts, stop, out, model = forum
    path = scratch_path(spark, "topic-model")
    topics.save_model(model, path)
    again, _ = jobs.topics_job(posts, "message", ["conv_id", "turn"], stop, topics.load_model(path))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_full_refresh_replaces_and_survives_failure(spark):
    path = scratch_path(spark, "refresh")
    sinks.full_refresh(spark.range(5), path)
    sinks.full_refresh(spark.range(3), path)
    assert sinks.read_current(spark, path).count() == 3
    broken = spark.range(3).select(F.raise_error(F.lit("stop")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.full_refresh(broken, path)
    assert sinks.read_current(spark, path).count() == 3


def test_delimited_and_json_readers_keep_line_breaks(spark):
    df = spark.createDataFrame([(1, 'a "b", c\nd'), (2, "é")], "id long, message string")
    csv, js = scratch_path(spark, "csv"), scratch_path(spark, "json")
    sinks.export_delimited(df, csv)
    df.write.json(js)
    want = sorted(map(tuple, df.collect()))
    assert sorted(map(tuple, read_delimited(spark, csv, df.schema).collect())) == want
    assert sorted(map(tuple, read_json(spark, js, df.schema).collect())) == want


def test_scans_read_only_the_projected_columns(spark):
    plan = read_table(spark, FOLDER, "lineitem", ["l_orderkey"]).where("l_orderkey > 10")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan and "GreaterThan(l_orderkey,10)" in plan
