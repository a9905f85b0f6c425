"""Exact quantiles without gathering a column in one task.

Equal values are counted first, the distinct values are range-partitioned into
buckets of bounded size, and only the buckets that hold a wanted rank are
sorted further.  Any number of groups can be handled in the same two passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quipu.session import settle

BUCKET_VALUES = 2_000_000


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), bucket_values: int = BUCKET_VALUES
) -> DataFrame:
    """Linearly interpolated quantiles: columns of ``by``, ``prob`` (position in ``probs``), ``quantile``."""
    by = list(by)
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("v"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    counted = settle(counted, "counts")
    values = counted.count()
    if values <= bucket_values:
        return _interpolate(_few_values(counted, probs, by), by)
    buckets = -(-values // bucket_values)
    # The partition number becomes data in the written table, so later passes agree on it.
    spread = settle(
        counted.repartitionByRange(buckets, *by, "v").withColumn("bucket", F.spark_partition_id()), "buckets"
    )

    # One row per group and bucket: a running total over them is a small window.
    totals = spread.groupBy(*by, "bucket").agg(F.sum("c").alias("rows"))
    per_group = Window.partitionBy(*(by or [F.lit(0)]))
    upto = per_group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    located = totals.select(
        *by,
        "bucket",
        (F.sum("rows").over(upto) - F.col("rows")).alias("before"),
        F.sum("rows").over(upto).alias("through"),
        F.sum("rows").over(per_group).alias("n"),
    )
    wanted = (
        _with_ranks(located, probs)
        .where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("through")))
        .select(*by, "bucket", "before", "prob", "position", "rank")
    )
    inside = Window.partitionBy(*by, "bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    needed = wanted.select(*by, "bucket", "before").distinct()
    ranked = spread.join(needed, [*by, "bucket"]).select(
        *by,
        "bucket",
        "v",
        (F.col("before") + F.sum("c").over(inside) - F.col("c")).alias("first_rank"),
        (F.col("before") + F.sum("c").over(inside)).alias("next_rank"),
    )
    hits = ranked.join(wanted.drop("before"), [*by, "bucket"]).where(
        (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("next_rank"))
    )
    return _interpolate(hits, by)


def _with_ranks(df: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Unroll the wanted positions among ``n`` rows and the ranks on either side of each."""
    shares = [F.struct(F.lit(i).alias("prob"), F.lit(float(q)).alias("share")) for i, q in enumerate(probs)]
    asked = df.withColumn("p", F.explode(F.array(*shares)))
    asked = asked.withColumn("prob", F.col("p.prob")).withColumn("position", (F.col("n") - 1) * F.col("p.share"))
    return asked.withColumn("rank", F.explode(F.array(F.floor("position"), F.ceil("position"))))


def _few_values(counted: DataFrame, probs: Sequence[float], by: list[str]) -> DataFrame:
    """The values at the wanted ranks when all distinct values fit in one bucket."""
    per_group = Window.partitionBy(*(by or [F.lit(0)]))
    upto = per_group.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.select(
        *by, "v", "c", F.sum("c").over(upto).alias("next_rank"), F.sum("c").over(per_group).alias("n")
    )
    return _with_ranks(ranked, probs).where(
        (F.col("rank") >= F.col("next_rank") - F.col("c")) & (F.col("rank") < F.col("next_rank"))
    )


def _interpolate(hits: DataFrame, by: list[str]) -> DataFrame:
    low, high = F.min("v"), F.max("v")
    share = F.max("position") - F.floor(F.max("position"))
    return hits.groupBy(*by, "prob").agg((low + (high - low) * share).alias("quantile"))


def quantile_edges(df: DataFrame, value: str, classes: int, bucket_values: int = BUCKET_VALUES) -> list[float]:
    """The ``classes + 1`` edges of equally filled classes, as numbers."""
    probs = [i / classes for i in range(classes + 1)]
    found = exact_quantiles(df, value, probs, bucket_values=bucket_values).collect()
    return [r["quantile"] for r in sorted(found, key=lambda r: r["prob"])]
