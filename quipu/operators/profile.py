"""Descriptive tables of the exploration notebooks."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.operators.quantiles import exact_quantiles


def group_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return group_count(df, keys).where("n > 1")


def share_pct(df: DataFrame, key: str) -> DataFrame:
    counts = group_count(df, [key])
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(key, "n", (F.col("n") * 100.0 / total).alias("pct"))


def dataset_counts(df: DataFrame, conditions: Mapping[str, Column], distinct: Sequence[str]) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_distinct(c).alias(f"n_{c}") for c in distinct],
        *[F.count_if(cond).alias(name) for name, cond in conditions.items()],
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, one row per column."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], list(df.columns), "column_name", "n_null")


def schema_profile(df: DataFrame) -> DataFrame:
    """Column names and types, with the number of values present in each."""
    present = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], list(df.columns), "column_name", "n_present")
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return present.select("column_name", F.element_at(types, F.col("column_name")).alias("column_type"), "n_present")


def describe(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample spread, extremes and exact quartiles."""
    basic = df.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quartiles = exact_quantiles(df, value, [0.25, 0.5, 0.75], by)
    named = [F.max(F.when(F.col("prob") == i, F.col("quantile"))).alias(f"q{25 * (i + 1)}") for i in range(3)]
    if by:
        return basic.join(quartiles.groupBy(*by).agg(*named), list(by), "left")
    return basic.select("*", *[quartiles.agg(c).scalar().alias(f"q{25 * (i + 1)}") for i, c in enumerate(named)])


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in one pass."""
    pairs = list(itertools.combinations_with_replacement(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("var_a"), F.lit(y).alias("var_b"), F.col(f"c{i}").alias("r")))
    return row.select(F.inline(F.array(*cells)))


def coverage(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """Percent of all rows passing each test, one decimal."""
    row = df.agg(*[(100 * F.avg(F.coalesce(t, F.lit(False)).cast("int"))).alias(n) for n, t in tests.items()])
    return row.unpivot([], list(tests), "variable", "pct").withColumn("pct", F.round("pct", 1))


def histogram(
    df: DataFrame, value: str, bins: int, bounds: tuple[float, float] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Rows per equal-width bin (0-based); the last bin includes its upper end."""
    if bounds is None:
        low, high = df.agg(F.min(value)).scalar(), df.agg(F.max(value)).scalar()
    else:
        low, high = F.lit(float(bounds[0])), F.lit(float(bounds[1]))
    v = F.col(value)
    position = F.floor((v - low) * bins / (high - low))
    return (
        df.where((v >= low) & (v <= high))
        .groupBy(*by, F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def kernel_density(df: DataFrame, value: str, grid: Sequence[float], bandwidth: float) -> DataFrame:
    """Gaussian density at the grid points; equal values are counted once."""
    counted = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("c")
    )
    total = counted.agg(F.sum("c")).scalar()
    z = (F.col("x") - F.col("v")) / F.lit(float(bandwidth))
    kernel = F.col("c") * F.exp(F.lit(-0.5) * z * z)
    points = counted.withColumn("x", F.explode(F.array(*[F.lit(float(g)) for g in grid])))
    scale = F.lit(1.0 / (bandwidth * (2.0 * 3.141592653589793) ** 0.5))
    sums = points.groupBy("x").agg(F.sum(kernel).alias("s"))
    return sums.select("x", (F.col("s") * scale / total).alias("density"))


def sparsity(pairs: DataFrame) -> DataFrame:
    """Share of empty cells of the user x item matrix, three decimals."""
    counts = pairs.agg(
        F.count_distinct("user_id", "item_id").alias("n_cells"),
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("item_id").alias("n_items"),
    )
    full = F.col("n_users").cast("double") * F.col("n_items")
    return counts.select("n_cells", "n_users", "n_items", F.round(1 - F.try_divide(F.col("n_cells"), full), 3).alias("sparsity"))


def item_support(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_users"))


def user_means(pairs: DataFrame, value: str) -> DataFrame:
    return pairs.groupBy("user_id").agg(F.avg(value).alias("user_mean"))


def region_rollup(actions: DataFrame, people: DataFrame, top: int = 10) -> DataFrame:
    """Views by region of the user, largest first.

    Views are summed per user before the join, so an active user joins as one row.
    """
    per_user = actions.groupBy("user_id").agg(F.sum("views").alias("views"))
    located = per_user.join(people.select("user_id", "region"), "user_id", "left")
    return located.where(F.col("region").isNotNull()).groupBy("region").agg(F.sum("views").alias("views")).orderBy(
        F.desc("views"), "region"
    ).limit(top)


def top_items(actions: DataFrame, catalog: DataFrame, top: int = 5, more_than: int | None = None) -> DataFrame:
    """Items with the highest mean views, optionally only those with more than so many rows."""
    rated = actions.groupBy("item_id").agg(F.avg("views").alias("mean_views"), F.count(F.lit(1)).alias("n_rows"))
    if more_than is not None:
        rated = rated.where(F.col("n_rows") > more_than)
    best = rated.join(catalog, "item_id", "inner")
    return best.orderBy(F.desc("mean_views"), "item_id").limit(top)

