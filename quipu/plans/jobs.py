"""The three batch jobs, from input frames to the rows they publish.

With ``publish_to`` a job ends in a full refresh of that folder and returns the
published rows; without it the rows are only returned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.functions import morphology
from quipu.functions.scores import band
from quipu.operators import cluster, factorize, recommend, topics
from quipu.operators.prep import prepare_interactions, standardize
from quipu.operators.reshape import pivot_mean
from quipu.operators.textmine import tokens_with_lemmas
from quipu.session import on_all_tasks, settle
from quipu.sources import sinks


def _published(rows: DataFrame, path: str | None) -> DataFrame:
    if path is None:
        return rows
    sinks.full_refresh(rows, path)
    return sinks.read_current(rows.sparkSession, path)


def recommend_job(
    actions: DataFrame,
    catalog: DataFrame,
    completions: DataFrame,
    order: Sequence[str],
    run_date: Column | None = None,
    n: int = 3,
    n_cold: int = 5,
    publish_to: str | None = None,
) -> DataFrame:
    """Nightly recommendations: (item_id, user_id, score, run_date).

    ``n`` items per known user from the factorisation without completed pairs,
    and the most popular items for users without history.
    """
    stamp = F.date_format(run_date if run_date is not None else F.current_date(), "yyyy-MM-dd")
    ratings = prepare_interactions(actions, catalog, completions, order)
    factors, sigma = factorize.factorize(ratings, "score")
    personal = factorize.recommend_all(ratings, "score", factors, len(sigma), completions, n).select(
        "item_id", F.col("user_id").cast("string").alias("user_id"), "score", stamp.alias("run_date")
    )
    return _published(personal.unionByName(recommend.cold_start(ratings, stamp, n_cold)), publish_to)


def segment_job(
    grades: DataFrame,
    keys: Sequence[str],
    quizzes: Sequence[str],
    centers: Sequence[Sequence[float]],
    scaler: dict[str, tuple[float, float]] | None = None,
    run_date: Column | None = None,
    publish_to: str | None = None,
) -> DataFrame:
    """Learner segments: scores and bands per quiz, the closest stored centre, and the date.

    ``scaler`` holds mean and spread stored with the centres; without it they
    are refitted on this batch.
    """
    stamp = run_date if run_date is not None else F.current_date()
    table = segment_features(grades, keys, quizzes)
    features = [*quizzes, *[f"band_{q}" for q in quizzes]]
    scaled = standardize(table, features, scaler)
    vector = F.array(*[F.col(f"{c}_z") for c in features])
    segments = scaled.select(
        *keys, *features, cluster.nearest_center(vector, centers).alias("cluster"), stamp.alias("report_date")
    )
    return _published(segments, publish_to)


def segment_features(grades: DataFrame, keys: Sequence[str], quizzes: Sequence[str]) -> DataFrame:
    """One row per key with the mean grade of every quiz (-1 if missing) and its band."""
    table = pivot_mean(grades, keys, "quiz", "grade", quizzes)
    return table.withColumns({f"band_{q}": band(F.col(q)) for q in quizzes})


def topics_job(
    posts: DataFrame,
    message: str,
    columns: Sequence[str],
    stop_words: Sequence[str],
    model: PipelineModel | None = None,
    lemmas: DataFrame | None = None,
    publish_to: str | None = None,
    rules: Sequence[morphology.Rule] | None = morphology.SPANISH_PLURALS,
) -> tuple[DataFrame, PipelineModel]:
    """Topic of every post: the given columns, the cleaned text and the topic number.

    ``lemmas`` is (form, lemma); tokens it knows are replaced by their base form.  Without
    it base forms come from suffix ``rules``; None leaves the tokens as they are.
    Posts are cut into tokens once and every later step reads the written tokens.
    """
    tokens = topics.forum_tokens(on_all_tasks(posts), message, stop_words).select(*columns, "tokens")
    if lemmas is not None:
        numbered = settle(tokens.withColumn("__post", F.monotonically_increasing_id()), "numbered")
        base = tokens_with_lemmas(numbered, "__post", F.col("tokens"), lemmas)
        tokens = numbered.drop("tokens").join(base, "__post").drop("__post")
    elif rules is not None:
        tokens = tokens.withColumn("tokens", morphology.lemmas(F.col("tokens"), rules))
    tokens = settle(tokens, "tokens")
    if model is None:
        model = topics.fit_topics(tokens)
    scored = topics.assign_topics(model, tokens)
    rows = scored.select(*columns, F.array_join("tokens", " ").alias("clean_message"), "topic")
    return _published(rows, publish_to), model
