"""Consecutive positions for keys, without sorting all keys in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.session import settle

BUCKETS = 1024


def hash_number(*parts: Column, start: int = 1) -> Column:
    """Number in [0, 2^32) drawn from the parts; the same on every engine and every retry."""
    text = F.concat_ws("-", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), start, 8), 16, 10).cast("bigint")


def dense_index(df: DataFrame, key: str, out: str, buckets: int = BUCKETS) -> DataFrame:
    """Add positions 0..n-1 to a frame of distinct keys.

    Keys fall into hash buckets; each bucket is numbered by itself and starts
    where the ones before it end.  Only the bucket sizes meet in one place.
    """
    placed = df.withColumn("__bucket", hash_number(F.col(key)) % buckets)
    sizes = placed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__bucket", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__bucket").orderBy(key)
    numbered = placed.withColumn("__rn", F.row_number().over(inside))
    return (
        numbered.join(starts, "__bucket")
        .withColumn(out, F.col("__start") + F.col("__rn") - 1)
        .drop("__bucket", "__start", "__rn")
    )


def sorted_index(df: DataFrame, order: list[Column], out: str, rows_per_part: int = 500_000) -> DataFrame:
    """Add positions 1..n in the given total order.

    The rows are range-partitioned and written with their partition number;
    each partition is numbered by itself and starts where the earlier ones end.
    """
    base = settle(df, "unsorted")
    parts = max(1, -(-base.count() // rows_per_part))
    spread = settle(base.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "ranges")
    sizes = spread.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__part").orderBy(*order)
    numbered = spread.withColumn("__rn", F.row_number().over(inside)).join(starts, "__part")
    return numbered.withColumn(out, F.col("__start") + F.col("__rn")).drop("__part", "__start", "__rn")
