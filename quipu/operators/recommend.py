"""Recommenders behind one protocol: fit, score given pairs, recommend to all users."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.functions.scores import rescale
from quipu.operators import factorize, similarity
from quipu.operators.blocks import block_scores, block_topk
from quipu.operators.indexing import sorted_index
from quipu.operators.joins import broadcast_if_small
from quipu.operators.textmine import term_positions
from quipu.session import settle

COLD_START_USER = "00000001"  # fixed value: user id under which items for new users are stored


class Recommender(Protocol):
    """Anything that can be evaluated."""

    name: str

    def fit(self, ratings: DataFrame, catalog: DataFrame) -> "Recommender": ...

    def score(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` with a ``score`` column; null where the model knows nothing."""

    def recommend(self, users: DataFrame, exclude: DataFrame, n: int) -> DataFrame:
        """(user_id, item_id, score) of the best items per user."""


def popularity(ratings: DataFrame, value: str = "score") -> DataFrame:
    return ratings.groupBy("item_id").agg(F.sum(value).cast("double").alias("score"))


def cold_start(ratings: DataFrame, run_date: Column, n: int = 5, value: str = "score") -> DataFrame:
    """Most popular items for users without history, scaled among themselves."""
    best = popularity(ratings, value).orderBy(F.desc("score"), "item_id").limit(n)
    low, high = best.agg(F.min("score")).scalar(), best.agg(F.max("score")).scalar()
    return best.select(
        "item_id", F.lit(COLD_START_USER).alias("user_id"), rescale(F.col("score"), low, high).alias("score"),
        run_date.alias("run_date"),
    )


def popular_unseen(
    ratings: DataFrame, users: DataFrame, exclude: DataFrame, n: int, value: str = "score", head: int | None = None
) -> DataFrame:
    """Most popular items per user without the excluded pairs: (user_id, item_id, score).

    Items are ranked once.  Only exclusions among the first ``head`` ranks are read;
    users with too few items left there, and nobody else, go on with longer heads.
    The i-th excluded item of a user, by rank, pushes the list down only if its rank
    is below ``n + i``, so no user takes more than ``n`` ranks plus such exclusions.
    """
    order = [F.desc("score"), F.asc("item_id")]
    ranked = settle(sorted_index(popularity(ratings, value), order, "pos"), "ranked")
    total = ranked.count()
    head = min(total, head or max(64, 4 * n))
    pending = settle(users.select("user_id").distinct(), "users")
    pairs = exclude.select("user_id", "item_id").distinct()
    found: DataFrame | None = None
    while True:
        known = pairs.join(broadcast_if_small(ranked.where(F.col("pos") <= head).select("item_id", "pos")), "item_id")
        gone = settle(known.join(pending, "user_id", "left_semi").select("user_id", "pos"), "gone")
        counts = gone.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_gone"))
        short = settle(counts.where((F.lit(head) - F.col("n_gone") < n) & F.lit(head < total)).select("user_id"), "short")
        ready = pending.join(short, "user_id", "left_anti")
        some = _heads(ranked.where(F.col("pos") <= head), ready, gone.join(short, "user_id", "left_anti"), n, head)
        found = some if found is None else found.unionByName(some)
        if short.isEmpty():
            return found
        pending, head = short, min(total, 4 * head)


def _heads(ranked: DataFrame, users: DataFrame, gone: DataFrame, n: int, head: int) -> DataFrame:
    """The first ``n`` ranks of every user that are not gone; ``gone`` holds at most ``head`` ranks of a user."""
    of_user = Window.partitionBy("user_id").orderBy("pos")
    pushing = gone.withColumn("i", F.row_number().over(of_user)).where(F.col("pos") - F.col("i") < n).select("user_id", "pos")
    pushing = settle(pushing, "pushing")
    pushed = pushing.groupBy("user_id").agg(F.count(F.lit(1)).alias("pushed"))
    reach = F.least(F.lit(n) + F.coalesce("pushed", F.lit(0)), F.lit(head))
    heads = users.join(pushed, "user_id", "left").select(
        "user_id", F.explode(F.sequence(F.lit(1).cast("bigint"), reach.cast("bigint"))).alias("pos")
    )
    furthest = n + (pushed.agg(F.max("pushed")).first()[0] or 0)
    top = broadcast_if_small(ranked.where(F.col("pos") <= furthest))
    return heads.join(pushing, ["user_id", "pos"], "left_anti").join(top, "pos").select("user_id", "item_id", "score")


def top_per_user(scores: DataFrame, n: int) -> DataFrame:
    best = Window.partitionBy("user_id").orderBy(F.desc("score"), "item_id")
    return scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def most_downloaded(actions: DataFrame, catalog: DataFrame, own_counter: str, n: int = 5) -> DataFrame:
    """Items by the catalogue's own counter, shown with the summed actions."""
    sums = actions.groupBy("item_id").agg(F.sum("views").alias("sum_views"))
    return sums.join(catalog, "item_id").orderBy(F.desc(own_counter), "item_id").limit(n)


def history(
    ratings: DataFrame, catalog: DataFrame, user: object | None = None, split: str = "all", value: str = "score"
) -> DataFrame:
    """What users interacted with, with the catalogue columns; one user or all.

    ``split`` takes the training or the held-out part of ``evaluate.holdout_split``
    (``"train"``, ``"test"``), or ``"all"``.  One user's rows come strongest first.
    """
    if split not in ("all", "train", "test"):
        raise ValueError(f"no such split: {split}")
    chosen = ratings if user is None else ratings.where(F.col("user_id") == F.lit(user))
    if split != "all":
        chosen = chosen.where(F.col("is_test") == F.lit(split == "test"))
    named = chosen.join(catalog, "item_id", "left")
    return named if user is None else named.orderBy(F.desc(value), "item_id")


def unseen_items(ratings: DataFrame, catalog: DataFrame, user: object) -> DataFrame:
    """Catalogue items one user has not touched."""
    seen = ratings.where(F.col("user_id") == F.lit(user))
    return catalog.select("item_id").join(seen, "item_id", "left_anti")


def _attach(pairs: DataFrame, found: DataFrame) -> DataFrame:
    return pairs.join(found, ["user_id", "item_id"], "left")


class PopularityModel:
    name = "popularity"

    def fit(self, ratings: DataFrame, catalog: DataFrame) -> "PopularityModel":
        self.ratings = ratings
        self.items = settle(popularity(ratings), "popularity")
        return self

    def score(self, pairs: DataFrame) -> DataFrame:
        return pairs.join(self.items, "item_id", "left")

    def item_scores(self) -> DataFrame:
        """(item_id, score), the same for all users."""
        return self.items

    def recommend(self, users: DataFrame, exclude: DataFrame, n: int) -> DataFrame:
        return popular_unseen(self.ratings, users, exclude, n)


class FactorModel:
    name = "collaborative"

    def __init__(self, k: int = factorize.FACTORS):
        self.k = k

    def fit(self, ratings: DataFrame, catalog: DataFrame) -> "FactorModel":
        self.items, sigma = factorize.factorize(ratings, "score", self.k)
        self.users = settle(factorize.user_factors(ratings, "score", self.items, len(sigma)), "users")
        return self

    def score(self, pairs: DataFrame) -> DataFrame:
        asked = pairs.select("user_id", "item_id").distinct()
        return _attach(pairs, factorize.predict(self.users, self.items, asked))

    def recommend(self, users: DataFrame, exclude: DataFrame, n: int) -> DataFrame:
        known = self.users.join(users.select("user_id"), "user_id", "left_semi")
        return block_topk(known, self.items, n, "user_id", "item_id", exclude=exclude)


class ContentModel:
    """Cosine between the weighted profile of a user and the text of an item.

    Users and items without any vocabulary term score 0 with everything.
    ``limits`` are those of ``similarity.item_weights``: min_df, max_df, max_features, runs.
    """

    name = "content"

    def __init__(self, tokens: Column, weighted: bool = True, **limits):
        self.tokens, self.weighted, self.limits = tokens, weighted, limits

    def fit(self, ratings: DataFrame, catalog: DataFrame) -> "ContentModel":
        weights, vocab = similarity.item_weights(catalog, self.tokens, **self.limits)
        self.positions = settle(term_positions(vocab), "positions")
        packed = similarity.pack(weights, self.positions, "item_id")
        self.vectors = settle(similarity.with_blanks(packed, catalog, "item_id"), "vectors")
        strength = "score" if self.weighted else None
        profiles = similarity.packed_profiles(similarity.user_profiles(ratings, packed, strength, normalise=True))
        self.profiles = settle(similarity.with_blanks(profiles, ratings, "user_id"), "profiles")
        self.catalog = catalog
        return self

    def score(self, pairs: DataFrame) -> DataFrame:
        asked = pairs.select("user_id", "item_id").distinct()
        return _attach(pairs, block_scores(self.profiles, self.vectors, asked, "user_id", "item_id"))

    def recommend(self, users: DataFrame, exclude: DataFrame, n: int) -> DataFrame:
        known = self.profiles.join(users.select("user_id"), "user_id", "left_semi")
        return block_topk(known, self.vectors, n, "user_id", "item_id", exclude=exclude)
