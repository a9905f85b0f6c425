"""Hand-made cases for the places where libraries differ."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quipu.functions import scores, text
from quipu.operators import prep, profile, quantiles, recommend, similarity, textmine


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v"))).first()[0]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_quantile_score_merges_repeated_edges(spark):
    values = [1, 1, 1, 1, 2, 3, 4, 7, 9, 20]
    df = frame(spark, [(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    edges = quantiles.quantile_edges(df, "v", 5)
    assert sorted(set(np.round(edges, 9))) == [1, 1.6, 3.4, 7.4, 20]
    got = [r["s"] for r in prep.quantile_score(df, "v", "s", 5).orderBy("i").collect()]
    assert got == [1, 1, 1, 1, 2, 2, 3, 3, 4, 4]
    with pytest.raises(ValueError):
        prep.quantile_score(df, "v", "s", 5, on_ties="error")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60), st.integers(1, 7))
def test_exact_quantiles_match_numpy_in_any_bucketing(spark, values, bucket):
    df = frame(spark, [(float(v),) for v in values], "v double")
    probs = [0, 0.1, 0.5, 0.9, 1]
    got = {r["prob"]: r["quantile"] for r in quantiles.exact_quantiles(df, "v", probs, bucket_values=bucket).collect()}
    assert np.allclose([got[i] for i in range(5)], np.quantile(values, probs))


def test_exact_quantiles_by_group(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 500), "v": rng.normal(size=500).round(2)})
    pdf.loc[:160, "v"] = 0.5
    df = spark.createDataFrame(pdf)
    got = quantiles.exact_quantiles(df, "v", [0.25, 0.5, 0.75], ["g"], bucket_values=17).collect()
    for r in got:
        assert math.isclose(r["quantile"], np.quantile(pdf[pdf.g == r["g"]].v, [0.25, 0.5, 0.75][r["prob"]]), abs_tol=1e-12)
    assert len(got) == 9


def test_bands(spark):
    df = frame(spark, [(-1.0,), (0.0,), (11.0,), (20.0,), (21.0,), (-2.0,)], "v double")
    assert [r[0] for r in df.select(scores.band(F.col("v"))).collect()] == [-1, -1, 1, 2, None, None]


def test_population_standard_score(spark):
    df = frame(spark, [(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "v double, c double")
    rows = prep.standardize(df, ["v", "c"]).orderBy("v").collect()
    assert [round(r["v_z"], 6) for r in rows] == [-1.069045, -0.267261, 1.336306]
    assert [r["c_z"] for r in rows] == [0.0, 0.0, 0.0]


def test_smoothed_idf(spark):
    docs = frame(spark, [(1, ["a", "b"]), (2, ["b"]), (3, ["c"])], "d int, t array<string>")
    counts = textmine.term_counts(docs, "d", F.col("t"))
    vocab = textmine.vocabulary(counts, docs)
    row = textmine.tfidf(counts, vocab, docs, "d").where("d = 1").orderBy("term").collect()
    a, b = math.log(4 / 2) + 1, math.log(4 / 3) + 1
    assert round(a, 6) == 1.693147 and round(b, 6) == 1.287682
    assert np.allclose([r["weight"] for r in row], np.array([a, b]) / math.hypot(a, b))


def test_cleaning(spark):
    assert one(spark, "Año, más! 3.5", text.strip_punctuation) == "Año más 35"
    assert one(spark, "Año, más! 3.5", text.clean_text) == "año más 35"
    assert one(spark, "Año ü 3, más!", text.clean_letters) == "Año   más"
    assert one(spark, "Uno, dos.\nTres!", text.clean_keep_stops) == "uno, dos. tres"


@pytest.mark.parametrize(
    ("message", "keywords", "span"),
    [
        ("quiero aprender. espero mas", ["espero", "aprender"], "espero mas"),
        ("quiero aprender. fin", ["aprender"], "aprender."),
        ("hola", ["aprender"], "NO"),
        ("", ["aprender"], "NO"),
    ],
)
def test_keyword_span(spark, message, keywords, span):
    assert one(spark, message, lambda c: text.keyword_span(c, keywords)) == span


def test_ngrams(spark):
    df = frame(spark, [(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(text.ngrams(F.col("t"), 1, 3)).collect()]
    assert got == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]
    assert [r[0] for r in df.select(text.ngrams(F.col("t"), 2, 2)).collect()] == [["a b", "b c"], [], []]


def test_stop_words_keep_repeats(spark):
    df = frame(spark, [(["uno", "de", "uno", "la"],)], "t array<string>")
    assert df.select(text.without(F.col("t"), ["de", "la"])).first()[0] == ["uno", "uno"]
    assert len(text.FORUM_STOP_WORDS) == len(set(text.FORUM_STOP_WORDS)) == 31


def test_lemmas_keep_order(spark):
    docs = frame(spark, [(1, ["cursos", "de", "cursos"]), (2, [])], "d int, t array<string>")
    lemmas = frame(spark, [("cursos", "curso")], "form string, lemma string")
    got = {r["d"]: r["tokens"] for r in textmine.tokens_with_lemmas(docs, "d", F.col("t"), lemmas).collect()}
    assert got == {1: ["curso", "de", "curso"], 2: []}


def test_cold_start_with_equal_sums(spark):
    ratings = frame(spark, [(u, i, 3) for u in (1, 2) for i in range(6)], "user_id long, item_id long, score int")
    rows = recommend.cold_start(ratings, F.lit("2024-01-01")).collect()
    assert sorted(r["item_id"] for r in rows) == [0, 1, 2, 3, 4]
    assert all(r["score"] is None and r["user_id"] == "00000001" for r in rows)


def test_latest_then_filter(spark):
    df = frame(spark, [(1, "A", "done"), (2, "A", "open"), (3, "B", "done")], "id int, u string, s string")
    assert [r["u"] for r in prep.latest_with_status(df, "u", "id", "s", "done").collect()] == ["B"]


def test_dedupe_needs_its_order(spark):
    df = frame(spark, [(1, 10, "x"), (1, 30, "z"), (1, 20, "y")], "k int, o int, p string")
    assert prep.dedupe(df, ["k"], ["o"]).first()["p"] == "z"
    assert prep.dedupe(df, ["k"], ["o"], "first").first()["p"] == "x"


def test_upper_keeps_null_unless_named(spark):
    df = frame(spark, [("a", None)], "a string, b string")
    assert tuple(prep.upper_all(df).first()) == ("A", None)
    assert tuple(prep.upper_all(df, "NONE").first()) == ("A", "NONE")


def test_jaccard(spark):
    links = frame(spark, [(1, "a"), (1, "b"), (2, "b"), (2, "c"), (3, "z")], "item_id long, category string")
    sets = similarity.category_sets(links, "item_id", "category")
    rows = {(r["item_id"], r["neighbour"]): r["score"] for r in similarity.neighbours(sets, "item_id", 2, "jaccard").collect()}
    assert math.isclose(rows[1, 2], 1 / 3) and rows[1, 3] == 0.0 and len(rows) == 6
    to_one = {r["item_id"]: r["score"] for r in similarity.similar_to(sets, "item_id", 1, "jaccard").collect()}
    assert math.isclose(to_one[2], 1 / 3) and to_one[3] == 0.0


def test_histogram_closes_last_bin(spark):
    df = frame(spark, [(0.0,), (1.0,), (2.0,), (2.0,)], "v double")
    got = {r["bin"]: r["n"] for r in profile.histogram(df, "v", 2).collect()}
    assert got == dict(enumerate(np.histogram([0, 1, 2, 2], bins=2)[0]))


def test_describe_matches_pandas(spark):
    s = pd.Series([3.0, 1.0, 4.0, 1.0, 5.0])
    row = profile.describe(spark.createDataFrame(s.to_frame("v")), "v").first()
    d = s.describe()
    assert np.allclose([row["n"], row["mean"], row["std"], row["min"], row["q25"], row["q50"], row["q75"], row["max"]], d.values)
