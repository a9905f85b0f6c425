"""Long and wide forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_mean(
    df: DataFrame, keys: Sequence[str], column: str, value: str, names: Sequence[str], missing: float = -1.0
) -> DataFrame:
    """One column per listed name with the mean of repeated cells."""
    wide = df.groupBy(*keys).pivot(column, list(names)).agg(F.avg(value))
    return wide.fillna(missing, subset=list(names))


def unpivot(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(keys), list(columns), name, value)


def crosstab(df: DataFrame, row: str, column: str, names: Sequence[str]) -> DataFrame:
    """Counts of ``row`` by the listed categories of ``column``."""
    return df.groupBy(row).pivot(column, list(names)).agg(F.count(F.lit(1))).fillna(0, subset=list(names))


def categories(df: DataFrame, column: str, most: int = 10_000) -> list[str]:
    """The categories of a column, for a pivot; refuses a column that is no category."""
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values; keep it in long form")
    return sorted(found)


def without_null_lists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empty lists in place of null ones, for rows that go to Arrow functions.

    Spark sizes an Arrow batch at every row it adds, and each time runs over all null lists at
    the batch's end, so a batch of them costs the square of its rows.
    """
    return df.withColumns({c: F.coalesce(c, F.array().cast(df.schema[c].dataType)) for c in columns})


def user_rows(pairs: DataFrame, value: str) -> DataFrame:
    """Sparse matrix row per user: sorted item positions and their values."""
    cells = F.sort_array(F.collect_list(F.struct(F.col("item_pos").alias("i"), F.col(value).cast("double").alias("v"))))
    return pairs.groupBy("user_id").agg(cells.alias("cells")).select(
        "user_id", F.col("cells.i").alias("indices"), F.col("cells.v").alias("values")
    )


#: Row and column ranges of one tile; a tile holds at most their product of cells.
TILE_ROWS, TILE_COLUMNS = 4096, 2048


def matrix_tiles(cells: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """Sparse matrix in tiles of row range x column range: (rb, cb, r, c, v).

    ``row`` and ``column`` are positions from 0.  A row with many cells is spread over the
    tiles of its range, a crowded column likewise, so no record grows with either side.
    ``r`` and ``c`` are positions inside the tile.
    """
    placed = cells.select(
        F.floor(F.col(row) / TILE_ROWS).alias("rb"),
        F.floor(F.col(column) / TILE_COLUMNS).alias("cb"),
        F.struct(
            (F.col(row) % TILE_ROWS).cast("int").alias("r"),
            (F.col(column) % TILE_COLUMNS).cast("int").alias("c"),
            F.col(value).cast("double").alias("v"),
        ).alias("cell"),
    )
    packed = placed.groupBy("rb", "cb").agg(F.collect_list("cell").alias("cells"))
    return packed.select("rb", "cb", F.col("cells.r").alias("r"), F.col("cells.c").alias("c"), F.col("cells.v").alias("v"))
