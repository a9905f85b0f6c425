"""Forum topics: cleaning, bag of words and LDA as one stored pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.functions import text
from quipu.session import on_all_tasks

TOPICS = 5  # fixed values: number of topics, vocabulary size and seed of the topic model
VOCABULARY = 500
SEED = 42
SMALL = 1_000  # so few posts are inferred faster than they are spread


def forum_tokens(posts: DataFrame, message: str, stop_words: Sequence[str], out: str = "tokens") -> DataFrame:
    cleaned = text.words(text.clean_text(F.col(message)))
    return posts.withColumn(out, text.without(cleaned, stop_words))


def fit_topics(
    tokens: DataFrame, topics: int = TOPICS, vocabulary: int = VOCABULARY, seed: int = SEED, rounds: int = 20
) -> PipelineModel:
    """Vocabulary and topic model together, so that scoring uses the terms of the fit.

    One-letter words are no terms.  Every round reads every post, so posts that lie in
    few tasks are spread first.
    """
    counts = CountVectorizer(inputCol="terms", outputCol="bag", vocabSize=vocabulary)
    lda = LDA(k=topics, seed=seed, featuresCol="bag", maxIter=rounds, subsamplingRate=1.0)
    return Pipeline(stages=[counts, lda]).fit(as_terms(on_all_tasks(tokens, SMALL)))


def as_terms(tokens: DataFrame) -> DataFrame:
    return tokens.withColumn("terms", F.filter("tokens", lambda w: F.length(w) > 1))


def assign_topics(model: PipelineModel, tokens: DataFrame) -> DataFrame:
    """Adds ``distribution`` and ``topic``, the strongest topic numbered from 1.

    A post without any known term gets the even distribution, so topic 1.
    """
    k = model.stages[1].getK()
    scored = model.transform(as_terms(tokens)).withColumn("distribution", vector_to_array("topicDistribution"))
    known = F.array_max("distribution") > 0
    scored = scored.withColumn("distribution", F.when(known, F.col("distribution")).otherwise(F.array_repeat(F.lit(1.0 / k), k)))
    strongest = F.array_position("distribution", F.array_max("distribution"))
    return scored.withColumn("topic", strongest.cast("int")).drop("bag", "topicDistribution", "terms")


def topic_terms(model: PipelineModel, n: int = 10) -> DataFrame:
    """The strongest terms of every topic: (topic, rank, term, weight)."""
    vocab = model.stages[0].vocabulary
    described = model.stages[1].describeTopics(n)
    words = F.array(*[F.lit(w) for w in vocab])
    return described.select(
        (F.col("topic") + 1).alias("topic"), F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "t")
    ).select(
        "topic", (F.col("rank") + 1).alias("rank"), F.element_at(words, F.col("t.termIndices") + 1).alias("term"),
        F.col("t.termWeights").alias("weight"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
