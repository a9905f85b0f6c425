"""Term counts, vocabularies and tf-idf in long form (document, term, weight)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.functions import text
from quipu.operators.indexing import dense_index
from quipu.session import on_all_tasks


def term_counts(docs: DataFrame, key: str, tokens: Column, runs: tuple[int, int] = (1, 1)) -> DataFrame:
    """(key, term, tf), where terms are runs of ``runs[0]`` to ``runs[1]`` tokens.

    Texts are cut and their terms counted in the scan task; only (key, term, count)
    rows are shuffled.  The outer form of the explode keeps the optimizer from adding
    a filter that would cut every text once more.
    """
    cut = on_all_tasks(docs).select(key, tokens.alias("tokens"))
    terms = F.col("tokens") if runs == (1, 1) else text.ngrams(F.col("tokens"), *runs)
    spread = cut.select(key, F.explode_outer(terms).alias("term")).where(F.col("term").isNotNull())
    return spread.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(
    counts: DataFrame,
    docs: DataFrame,
    min_df: int = 1,
    max_df: float = 1.0,
    max_features: int | None = None,
) -> DataFrame:
    """(term, df, total): rare and too common terms dropped, then the most frequent kept."""
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    vocab = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    vocab = vocab.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n_docs))
    if max_features is not None:
        vocab = vocab.orderBy(F.desc("total"), "term").limit(max_features)
    return vocab


def tfidf(counts: DataFrame, vocab: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """tf x (ln((1+n)/(1+df)) + 1), scaled to length 1 per document."""
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    idf = F.log((1 + n_docs) / (1 + F.col("df"))) + 1
    raw = counts.join(vocab.select("term", "df"), "term").select(key, "term", (F.col("tf") * idf).alias("raw"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("raw") / norm).alias("weight"))


def term_positions(vocab: DataFrame) -> DataFrame:
    """(term, pos): column number of every vocabulary term."""
    return dense_index(vocab.select("term"), "term", "pos")


def pack(weights: DataFrame, positions: DataFrame, key: str) -> DataFrame:
    """One sparse vector per key: (key, idx, val).  A vector is as long as the vocabulary at most."""
    cell = F.struct(F.col("pos").cast("int").alias("i"), F.col("weight").alias("w"))
    cells = weights.join(positions, "term").groupBy(key).agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    return cells.select(key, F.col("cells.i").alias("idx"), F.col("cells.w").alias("val"))


def word_frequency(docs: DataFrame, tokens: Column, top: int | None = None) -> DataFrame:
    counted = docs.select(F.explode(tokens).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return counted if top is None else counted.orderBy(F.desc("n"), "term").limit(top)


def replace_lemmas(counts: DataFrame, lemmas: DataFrame, key: str) -> DataFrame:
    """Counts by base form; ``lemmas`` is (form, lemma) and unknown forms stay."""
    joined = counts.join(lemmas, F.col("term") == F.col("form"), "left")
    return joined.groupBy(key, F.coalesce("lemma", "term").alias("term")).agg(F.sum("tf").alias("tf"))


def tokens_with_lemmas(docs: DataFrame, key: str, tokens: Column, lemmas: DataFrame | None) -> DataFrame:
    """(key, tokens) with every token replaced by its base form, in text order."""
    base = docs.select(key, tokens.alias("tokens"))
    if lemmas is None:
        return base
    spread = base.select(key, F.posexplode_outer("tokens").alias("at", "form")).join(lemmas, "form", "left")
    word = F.struct("at", F.coalesce("lemma", "form").alias("w"))
    return spread.groupBy(key).agg(F.sort_array(F.collect_list(F.when(F.col("form").isNotNull(), word))).alias("ws")).select(
        key, F.col("ws.w").alias("tokens")
    )


def drop_terms(counts: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    return counts.where(~F.col("term").isin(sorted(set(stop_words))))
