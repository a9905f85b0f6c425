"""Joins with lookup dimensions and catalogues.

Plain joins leave the choice to Spark, which broadcasts a side whose measured
size is under its threshold and otherwise shuffles and splits skewed partitions.
Where a skewed partition could not be split, the helpers below give the plan
another shape.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


BROADCAST_ROWS = 100_000
BROADCAST_CHARS = 64_000_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, chars: int | None = None) -> DataFrame:
    """Mark a frame for broadcast, but only after counting that it is small.

    Rows of unbounded width, such as vectors, are also measured, written out as JSON of at most
    ``chars``.  The frame is read for it, so hand over a written table where it is costly to make.
    """
    few = df.limit(rows + 1)
    if chars is None:
        return F.broadcast(df) if few.count() <= rows else df
    written = F.length(F.to_json(F.struct("*")))
    n, size = few.agg(F.count(F.lit(1)), F.coalesce(F.sum(written), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and size <= chars else df


def catalog_left_join(catalog: DataFrame, facts: DataFrame, on: str) -> DataFrame:
    """Catalogue left-joined to its facts: columns of the catalogue, then of the facts.

    A left join cannot split a hot key on its right side.  The matching part is
    therefore an inner join, which can, and the rest are catalogue rows without facts.
    """
    extra = [c for c in facts.columns if c != on]
    matched = facts.join(catalog, on, "inner").select(*catalog.columns, *extra)
    lonely = catalog.join(facts.select(on).distinct(), on, "left_anti")
    blanks = [F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in extra]
    return matched.unionByName(lonely.select(*catalog.columns, *blanks))


def lookup_joins(
    df: DataFrame, dim: DataFrame, roles: Mapping[str, str], key: str = "id", label: str = "description"
) -> DataFrame:
    """Left-join one dimension once per role: foreign key column -> output column."""
    out = df
    for fk, name in roles.items():
        role = dim.select(F.col(key).alias(f"__{name}"), F.col(label).alias(name))
        out = out.join(role, F.col(fk) == F.col(f"__{name}"), "left").drop(f"__{name}")
    return out


def enrich(recommendations: DataFrame, catalog: DataFrame) -> DataFrame:
    """Recommendations with the catalogue columns of their item."""
    return recommendations.join(catalog, "item_id", "left")


def completions(participants: DataFrame, outcomes: DataFrame, on: str, status: str, wanted: str) -> DataFrame:
    """Distinct (user, item) pairs whose outcome has the wanted status."""
    done = outcomes.where(F.col(status) == wanted)
    return participants.join(done, on, "inner").select("user_id", "item_id").distinct()
