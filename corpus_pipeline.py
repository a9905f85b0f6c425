"""From raw documents to token digests: classify, deduplicate, decontaminate, encode.

Each stage takes what the one before has kept and is written before the next one
reads it, so a lost executor costs at most part of one stage.  Null texts count as
empty; rows are dropped only by the decisions of a stage; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quipu.llm import decontaminate, exact_dedup, quality, simhash, tokens
from quipu.session import settle
from quipu.sources.tables import read_table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones among them."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints, the document with the smallest id."""
    return simhash.dedup(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of ids and of decoded bytes."""
    return tokens.digests(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_classifier", classify),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: The classifier, the fingerprints and the tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
