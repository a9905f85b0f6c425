"""Numeric expressions shared by the recommenders and the segmentation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Right-closed grade bands and their labels.
BAND_EDGES = [-2, 0, 11, 20]
BAND_LABELS = [-1, 1, 2]


def band(value: Column, edges: Sequence[float] = BAND_EDGES, labels: Sequence[int] = BAND_LABELS) -> Column:
    """Label of the right-closed band holding ``value``; null outside all bands."""
    chosen = F.lit(None).cast("int")
    for low, high, label in zip(edges[:-1], edges[1:], labels):
        chosen = F.when((value > low) & (value <= high), F.lit(label)).otherwise(chosen)
    return chosen


def quantile_class(value: Column, edges: Sequence[float]) -> Column:
    """Class 1..q of a value among sorted quantile edges; bins close on the right."""
    inner = sorted(set(edges))[1:-1]
    above = [F.when(value > F.lit(e), 1).otherwise(0) for e in inner]
    total = F.lit(1)
    for one in above:
        total = total + one
    return F.when(value.isNotNull(), total).cast("int")


def rescale(value: Column, low: Column, high: Column) -> Column:
    """Position between low and high; null when they coincide."""
    return F.try_divide(value - low, high - low)


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """Standard score with the given spread; zero spread gives zero."""
    return F.when(std == 0, F.lit(0.0)).otherwise(F.try_divide(value - mean, std))


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)


def squared_distance(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)


def unit(vector: Column) -> Column:
    """Vector scaled to length 1; a zero vector stays zero."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm > 0, F.transform(vector, lambda x: x / norm)).otherwise(vector)
