"""Learner segments: k-means, cluster indices, assignment to stored centres."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.functions.scores import squared_distance
from quipu.operators.blocks import block_distance_sums, block_worst_ratio
from quipu.operators.joins import BROADCAST_CHARS, broadcast_if_small
from quipu.operators.multikmeans import STARTS, candidates, fit_many, points_of, start, sums_by_centre
from quipu.session import scratch_path, settle, spill_cache

STARVED = 0.01  # fixed value: share of the busiest centre's rows below which a centre starts again
GAIN = 1e-3  # a pass that lowers the cost by less is the last


def feature_vector(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)


def as_vector(df: DataFrame, column: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.transform(F.col(column), lambda x: x.cast("double"))))


def kmeans_fit(df: DataFrame, k: int, seed: int = 123, features: str = "features") -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster0", maxIter=50).fit(df)


def kmeans_assign(model: KMeansModel, df: DataFrame) -> DataFrame:
    """Adds ``cluster``, numbered from 1."""
    return model.transform(df).withColumn("cluster", F.col("cluster0") + 1).drop("cluster0")


def nearest_center(vector: Column, centers: Sequence[Sequence[float]]) -> Column:
    """1-based number of the closest centre; ties go to the lower number."""
    options = [
        F.struct(
            squared_distance(vector, F.array(*[F.lit(float(x)) for x in c])).alias("d"), F.lit(i + 1).alias("n")
        )
        for i, c in enumerate(centers)
    ]
    return F.array_min(F.array(*options))["n"]


def best_centers(
    df: DataFrame, columns: Sequence[str], ks: Sequence[int], starts: int = STARTS, seed: int = 123
) -> dict[int, tuple[float, list[list[float]]]]:
    """Per k the least cost of several starts and its centres; all k and starts share their passes."""
    vectors = spill_cache(points_of(df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("val")), "val"))
    try:
        return {k: (cost, c.tolist()) for k, (cost, c) in fit_many(vectors, len(columns), ks, starts, seed).items()}
    finally:
        vectors.unpersist()


def elbow_curve(
    df: DataFrame, columns: Sequence[str], ks: Sequence[int] = range(1, 11), seed: int = 123, starts: int = STARTS
) -> DataFrame:
    """Least within-cluster cost of several starts for every k, fitted together."""
    rows = [(k, float(cost)) for k, (cost, _) in best_centers(df, columns, ks, starts, seed).items()]
    return df.sparkSession.createDataFrame(pd.DataFrame(rows, columns=["k", "cost"]), "k int, cost double")


def cluster_profile(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in columns])


def cluster_centers(df: DataFrame, label: str, vector: str, size: int) -> DataFrame:
    """(label, n, center): one row per cluster, summed per task before the shuffle."""
    sums = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(F.col(vector)[i].cast("double")).alias(f"m{i}") for i in range(size)]
    )
    return sums.select(label, "n", F.array(*[f"m{i}" for i in range(size)]).alias("center"))


def davies_bouldin(df: DataFrame, label: str, vector: str, size: int) -> DataFrame:
    """Mean over clusters of the worst (spread + spread) / centre distance."""
    points = df.select(label, F.transform(F.col(vector), lambda x: x.cast("double")).alias("val"))
    centers = settle(cluster_centers(points, label, "val", size), "centers")
    spread = (
        points.join(broadcast_if_small(centers, chars=BROADCAST_CHARS), label)
        .groupBy(label)
        .agg(F.avg(F.sqrt(squared_distance(F.col("val"), F.col("center")))).alias("s"), F.first("center").alias("c"))
    )
    worst = block_worst_ratio(spread.select(label, "s", F.col("c").alias("val")), label)
    return worst.agg(F.avg("worst").alias("davies_bouldin"))


def silhouette_squared(df: DataFrame, features: str, label: str) -> float:
    """Silhouette with squared Euclidean distance, linear in the rows."""
    numbered = df.withColumn("__label", F.col(label).cast("double"))
    return ClusteringEvaluator(featuresCol=features, predictionCol="__label").evaluate(numbered)


def silhouette_exact(df: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """Silhouette with Euclidean distance over all points: one row with the mean.

    Compares every point with every other by definition; the distances stay
    inside the block tasks and only one sum per point and cluster comes out.
    """
    points = settle(df.select(key, F.col(label).cast("bigint").alias("grp"), F.col(vector).alias("val")), "points")
    sums = block_distance_sums(points, key, "grp")
    sizes = settle(points.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "sizes")
    own = points.select(key, F.col("grp").alias("own"))
    rows = sums.join(broadcast_if_small(sizes), "grp").join(own, key)
    mine = F.col("grp") == F.col("own")
    per_point = rows.groupBy(key).agg(
        F.max(F.when(mine, F.try_divide("total", F.col("n") - 1))).alias("a"),
        F.min(F.when(~mine, F.col("total") / F.col("n"))).alias("b"),
        F.max(F.when(mine, F.col("n"))).alias("n_own"),
    )
    s = F.when(F.col("n_own") == 1, 0.0).otherwise(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")))
    return per_point.agg(F.avg(F.coalesce(s, F.lit(0.0))).alias("silhouette"))


def mini_batches(df: DataFrame, key: str, vector: str, blocks: int = 8) -> DataFrame:
    """The points with their mini-batch, written to one folder per batch, so that a batch is read alone."""
    batch = F.pmod(F.xxhash64(key), F.lit(blocks)).alias("__block")
    points = df.select(F.col(vector).cast("array<double>").alias("val"), batch).where(F.col("val").isNotNull())
    path = scratch_path(df.sparkSession, "batches")
    points.write.mode("errorifexists").partitionBy("__block").parquet(path)
    return df.sparkSession.read.schema(points.schema).parquet(path)


def block_fit(
    df: DataFrame, key: str, vector: str, size: int, k: int, blocks: int = 8, passes: int = 2, seed: int = 2,
    batches: DataFrame | None = None,
) -> list[list[float]]:
    """Centres of the mini-batch solver.

    Rows fall into mini-batches by the hash of their key, so a pass reads every row once;
    on a cluster a batch is a share of the rows and not a fixed number.  Starts come from
    weighted k-means++ on shared candidates.  Each batch in turn moves the centres to the
    mean of all rows they have met.  A centre that has met less than ``STARVED`` of the
    busiest one's rows starts again, at the end of a pass, from the point farthest from all
    centres, and forgets what it met.  Passes end early when their cost no longer falls.
    Only the centres, ``k`` rows of ``size`` numbers, are on the driver.  ``batches`` are the
    ``mini_batches`` of ``df`` if several fits share them.
    """
    points = mini_batches(df, key, vector, blocks) if batches is None else batches
    chosen, weights = candidates(points, size, k, seed)
    centers = start(chosen, weights, k, np.random.default_rng([seed, k]))
    met, last = np.zeros(len(centers)), float("inf")
    for turn in range(passes):
        cost = 0.0
        for b in range(blocks):
            for at, (n, part, total) in sums_by_centre(points.where(F.col("__block") == b), [centers], size).items():
                cost += part
                met[at] += n
                # The running mean: what is new weighs as much as what was met before.
                centers[at] += (total - n * centers[at]) / met[at]
        starved = np.flatnonzero(met < STARVED * met.max())
        if not len(starved) and cost > (1 - GAIN) * last:
            break
        last = cost
        if turn < passes - 1:
            for at in starved:
                others = [c for i, c in enumerate(centers.tolist()) if i != at]
                far = F.array_min(F.array(*[squared_distance(F.col("val"), F.array(*map(F.lit, c))) for c in others]))
                centers[at] = points.select("val", far.alias("d")).orderBy(F.desc("d"), "val").first()["val"]
                met[at] = 0.0
    return centers.tolist()


def compare_clusterings(
    df: DataFrame, key: str, columns: Sequence[str], ks: Sequence[int] = range(3, 7), seed: int = 1, starts: int = STARTS
) -> DataFrame:
    """Davies-Bouldin and silhouette for several k, by the full and by the mini-batch solver.

    Both solvers fit on all rows and are judged on all rows.
    """
    base = feature_vector(df, columns).select(key, "features", F.array(*[F.col(c).cast("double") for c in columns]).alias("val"))
    base = spill_cache(base)
    rows = []
    try:
        fitted_all = fit_many(base.select("val"), len(columns), ks, starts, seed)
        batches = mini_batches(base, key, "val")
        labels = {}
        for k in ks:
            labels[f"full{k}"] = nearest_center(F.col("val"), fitted_all[k][1].tolist())
            labels[f"blocks{k}"] = nearest_center(F.col("val"), block_fit(base, key, "val", len(columns), k, batches=batches))
        # Each index reads the rows several times; the nearest centres are looked for once.
        judged = settle(base.select("features", "val", *[c.alias(name) for name, c in labels.items()]), "judged")
        for k in ks:
            for solver in ("full", "blocks"):
                labelled = judged.select("features", "val", F.col(f"{solver}{k}").alias("cluster"))
                db = davies_bouldin(labelled, "cluster", "val", len(columns)).first()[0]
                rows.append((k, solver, float(db), float(silhouette_squared(labelled, "features", "cluster"))))
    finally:
        base.unpersist()
    out = pd.DataFrame(rows, columns=["k", "solver", "davies_bouldin", "silhouette"])
    return df.sparkSession.createDataFrame(out, "k int, solver string, davies_bouldin double, silhouette double")
