"""Cleaning and selecting interaction rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.functions.scores import quantile_class, rescale, zscore
from quipu.operators.quantiles import quantile_edges
from quipu.session import settle


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "last") -> DataFrame:
    """One row per key: the last (or first) by ``order``; missing order values come before all others.

    The filter on the row number is applied per task before the shuffle as well,
    so a key that holds a large share of the rows sends one row per task.
    """
    sort = {"last": F.desc_nulls_last, "first": F.asc_nulls_first}[keep]
    best = Window.partitionBy(*keys).orderBy(*[sort(c) for c in order])
    return df.withColumn("__rn", F.row_number().over(best)).where("__rn = 1").drop("__rn")


def seen_once(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs exactly once."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), F.first(F.struct(*rest)).alias("only"))
        .where("n = 1")
        .select(*keys, "only.*")
        .select(*df.columns)
    )


def latest_with_status(df: DataFrame, key: str, version: str, status: str, wanted: str) -> DataFrame:
    """Latest row of every key, kept only if it has the wanted status."""
    return dedupe(df, [key], [version]).where(F.col(status) == wanted)


def members(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(other, on, "left_semi")


def non_members(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(other, on, "left_anti")


def users_with_items(pairs: DataFrame, least: int = 2) -> DataFrame:
    """Users with at least ``least`` different items, and how many."""
    distinct_pairs = pairs.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return distinct_pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_items")).where(F.col("n_items") >= least)


def users_with_rows(df: DataFrame, more_than: int = 1) -> DataFrame:
    return df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > more_than)


def frequent_items(df: DataFrame, more_than: int) -> DataFrame:
    return df.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > more_than)


def quantile_score(df: DataFrame, value: str, out: str, classes: int = 5, on_ties: str = "merge") -> DataFrame:
    """Add the quantile class 1..classes of ``value`` over the whole frame."""
    edges = quantile_edges(df, value, classes)
    if on_ties == "error" and len(set(edges)) < len(edges):
        raise ValueError(f"quantile edges of {value} repeat: {edges}")
    return df.withColumn(out, quantile_class(F.col(value), edges))


def minmax_scale(df: DataFrame, value: str, out: str) -> DataFrame:
    low = df.agg(F.min(value)).scalar()
    high = df.agg(F.max(value)).scalar()
    return df.withColumn(out, rescale(F.col(value), low, high))


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column, as numbers to store with a model."""
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def standardize(
    df: DataFrame, columns: Sequence[str], scaler: dict[str, tuple[float, float]] | None = None, suffix: str = "_z"
) -> DataFrame:
    """Standard scores by population spread; without a scaler it is fitted on the frame."""
    scaler = scaler or fit_scaler(df, columns)
    scored = {c + suffix: zscore(F.col(c), F.lit(scaler[c][0]), F.lit(scaler[c][1])) for c in columns}
    return df.withColumns(scored)


def upper_all(df: DataFrame, null_token: str | None = None) -> DataFrame:
    """Every column as upper-case text; missing values stay missing unless a token is named."""

    def text(name: str) -> Column:
        col = F.upper(F.col(name).cast("string"))
        return F.coalesce(col, F.lit(null_token)) if null_token is not None else col

    return df.select(*[text(c).alias(c) for c in df.columns])


def recode(value: Column, match: object, hit: object = 1, miss: object = 0) -> Column:
    return F.when(value == F.lit(match), F.lit(hit)).otherwise(F.lit(miss))


def prepare_interactions(
    actions: DataFrame, catalog: DataFrame, completions: DataFrame, order: Sequence[str], classes: int = 5
) -> DataFrame:
    """From raw actions to (user_id, item_id, views, score).

    Last action per pair, valid items, users who completed something, viewed at
    least once, users with two items or more, then the quantile class of views.
    The pairs are written twice on the way because each is scanned again: by the
    user filter, and by the quantile edges.
    """
    slim = actions.select("user_id", "item_id", "views", *[c for c in order if c != "views"])
    pairs = dedupe(slim, ["user_id", "item_id"], order).select("user_id", "item_id", "views")
    viewed = members(pairs.where(F.col("views") > 0), catalog.select("item_id"), "item_id")
    viewed = settle(viewed, "pairs")
    completers = completions.select("user_id").distinct()
    # A pair has one row by now, so rows are items.
    chosen = members(users_with_rows(viewed), completers, "user_id")
    selected = settle(members(viewed, chosen, "user_id"), "selected")
    return quantile_score(selected, "views", "score", classes)
