"""Scoring two sets of vectors against each other, block by block.

Both sides are cut into blocks of bounded size and every pair of blocks is one
cogroup: its scores exist only as slices of a matrix inside one task, and what
leaves the task is bounded (the best few per row, the requested pairs, or one
sum per group).  No pair of ids becomes a row unless it is part of the answer,
and neither side is broadcast or held whole anywhere.

Blocks are large, because every row is sent once per block of the other side.
Only when there would be fewer blocks than tasks is the left side cut finer, or, for sums
of distances, both sides.

A vector is ``val`` alone (dense), or ``idx`` with ``val`` (sparse).  Blocks hold a
bounded number of rows and, by the mean length of the vectors, of cells.  Keys may
be whole numbers or text; other types are compared as text.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, FloatType, IntegerType, LongType, ShortType

from quipu.operators.reshape import without_null_lists
from quipu.session import settle, task_count

BLOCK_ROWS = 32_768
FINEST_ROWS = 512
BLOCK_CELLS = 40_000_000  # values of one block, about 0.5 GB with their positions
SLICE_CELLS = 8_000_000  # cells of one dense set of vectors inside a task
SCORE_CELLS = 500_000  # cells of one slice of scores, small enough for the processor cache
PRUNE_PRODUCTS = 10**11  # pairs from which cells of similar vectors pay for themselves
RUN = 128  # neighbouring scores of a row that are first judged by their greatest
DIGITS = 9  # scores are ranked at this many decimals, so equal vectors tie exactly


def _block(column: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(column)), F.lit(blocks)).cast("int")


def key_type(*sides: tuple[DataFrame, str]) -> str:
    """``bigint`` if the keys of all sides are whole numbers, else ``string``."""
    whole = all(isinstance(df.schema[key].dataType, (ByteType, ShortType, IntegerType, LongType)) for df, key in sides)
    return "bigint" if whole else "string"


def _as_given(column: str, df: DataFrame, key: str) -> Column:
    return F.col(column).cast(df.schema[key].dataType).alias(key)


def _vectors(df: DataFrame, key: str, tag: str | None, kind: str, single: bool = False) -> DataFrame:
    """Vectors in one shape; with ``single``, values of single precision are sent as they are and widened in the task."""
    kept = single and df.schema["val"].dataType == ArrayType(FloatType())
    idx = F.col("idx").cast("array<int>") if "idx" in df.columns else F.lit(None).cast("array<int>")
    return df.select(
        F.col(key).cast(kind).alias("id"),
        (F.col(tag).cast("bigint") if tag else F.lit(None).cast("bigint")).alias("tag"),
        idx.alias("idx"),
        F.col("val").cast("array<float>" if kept else "array<double>").alias("val"),
        (F.col("extra") if "extra" in df.columns else F.lit(None)).cast("array<double>").alias("extra"),
    )


def _sizes(left: DataFrame, right: DataFrame) -> tuple:
    """Rows and cells of both sides."""
    size = [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("val").cast("bigint")), F.lit(0)).alias("cells")]
    return left.agg(*size).first(), right.agg(*size).first()


def _grid(
    left: DataFrame, right: DataFrame, rows: int, sizes: tuple | None = None, even: bool = False
) -> tuple[int, int, int]:
    """Blocks on the left, blocks on the right, shuffle partitions.

    With ``even`` both sides are cut for the tasks.  Every cut sends the other side once
    more, so this moves the least rows, but more comes out where it is one per right block.
    """
    spark = left.sparkSession
    (n_left, cells_left), (n_right, cells_right) = sizes or _sizes(left, right)
    blocks_right = max(1, -(-n_right // rows), -(-cells_right // BLOCK_CELLS))
    blocks_left = max(1, -(-n_left // rows), -(-cells_left // BLOCK_CELLS))
    wanted = 2 * task_count(spark) if rows == BLOCK_ROWS else 1
    if even:
        side = math.isqrt(wanted - 1) + 1
        blocks_left = max(blocks_left, min(side, -(-n_left // FINEST_ROWS)))
        blocks_right = max(blocks_right, min(side, -(-n_right // FINEST_ROWS)))
    else:
        blocks_left = max(blocks_left, min(-(-wanted // blocks_right), -(-n_left // FINEST_ROWS)))
    pairs = blocks_left * blocks_right
    return blocks_left, blocks_right, pairs if pairs <= 20_000 else 20_000


def _cogroup(
    left: DataFrame,
    right: DataFrame,
    pairs: DataFrame | None,
    kernel: Callable,
    schema: str,
    block_rows: int,
    sizes: tuple | None = None,
    even: bool = False,
) -> DataFrame:
    """Run ``kernel`` once per pair of blocks.

    It gets both sides as dicts (``ids``, ``tags``, ``lens``, ``squares``), a
    function giving the dense rows of a side, and the positions of the
    requested pairs, sorted by left row.
    """
    n_left, n_right, tasks = _grid(left, right, block_rows, sizes, even)
    rows = left.withColumns({"lb": _block("id", n_left), "rb": F.explode(F.sequence(F.lit(0), F.lit(n_right - 1)))})
    columns = right.withColumns({"rb": _block("id", n_right), "lb": F.explode(F.sequence(F.lit(0), F.lit(n_left - 1)))})
    asked = None
    if pairs is not None:
        asked = pairs.select(_block("id", n_left).alias("lb"), _block("other", n_right).alias("rb"), "id", "other")
    return _placed_cogroup(rows, columns, asked, kernel, schema, tasks)


def _placed_cogroup(
    rows: DataFrame, columns: DataFrame, asked: DataFrame | None, kernel: Callable, schema: str, tasks: int
) -> DataFrame:
    """``_cogroup`` for rows that know their cells ``lb`` and ``rb`` of the grid."""
    grid, shape = ["lb", "rb"], ["id", "tag", "idx", "val", "extra"]
    key = rows.schema["id"].dataType
    rows = rows.select(*grid, *shape, F.lit(None).cast(key).alias("other"))
    if asked is not None:
        rows = rows.unionByName(asked.select(*grid, "id", "other"), allowMissingColumns=True)

    rows = without_null_lists(rows, ["idx", "val", "extra"])
    columns = without_null_lists(columns, ["idx", "val", "extra"]).select(*grid, *[F.col(c).alias(f"r_{c}") for c in shape])  # both sides may be the same frame

    def read(table: pa.Table) -> dict:
        tagged = table["tag"].null_count < len(table)
        table = table.sort_by([("id", "ascending"), ("tag", "ascending")] if tagged else "id").combine_chunks()
        vals, idx = table["val"].combine_chunks(), table["idx"].combine_chunks()
        lens = vals.value_lengths().fill_null(0).to_numpy().astype(np.int64)
        flat = vals.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
        owner = np.repeat(np.arange(len(lens)), lens)
        cols = idx.flatten().to_numpy(zero_copy_only=False)
        if not len(cols):  # dense
            cols = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
        return {
            "ids": table["id"].to_numpy(),
            "tags": table["tag"].to_numpy(),
            "lens": lens,
            "squares": np.bincount(owner, weights=flat**2, minlength=len(lens)),
            "extra": table["extra"],
            "cells": (owner, cols, flat),
        }

    def run(lt: pa.Table, rt: pa.Table) -> pa.Table:
        rt = rt.rename_columns([c.removeprefix("r_") for c in rt.column_names])
        is_pair = lt["other"].is_valid().to_numpy()
        a, b = read(lt.filter(pa.array(~is_pair))), read(rt)
        # Only features that occur on both sides matter to a product.
        features = np.intersect1d(a["cells"][1], b["cells"][1])
        for side in (a, b):
            owner, cols, flat = side.pop("cells")
            at = np.searchsorted(features, cols)
            if len(features):
                shared = features[np.minimum(at, len(features) - 1)] == cols
            else:
                shared = np.zeros(len(cols), bool)
            side["owner"], side["at"], side["flat"] = owner[shared], at[shared], flat[shared]

        def dense(side: dict, low: int, high: int, first: int, last: int) -> np.ndarray:
            """Rows ``low:high`` and features ``first:last`` as a matrix."""
            s, e = np.searchsorted(side["owner"], [low, high])
            at = side["at"][s:e]
            inside = (at >= first) & (at < last)
            out = np.zeros((high - low, last - first))
            out[side["owner"][s:e][inside] - low, at[inside] - first] = side["flat"][s:e][inside]
            return out

        n, m, width = len(a["ids"]), len(b["ids"]), len(features)
        step = max(1, SLICE // max(m, 1))
        whole = dense(b, 0, m, 0, width).T if width <= 4 * step else None

        def products(low: int, high: int) -> np.ndarray:
            """Scores of left rows ``low:high`` against all right rows."""
            if whole is not None:
                return dense(a, low, high, 0, width) @ whole
            out = np.zeros((high - low, m))
            for f in range(0, width, step):
                g = min(f + step, width)
                out += dense(a, low, high, f, g) @ dense(b, 0, m, f, g).T
            return out

        at_l = at_r = np.zeros(0, dtype=np.int64)
        if is_pair.any() and n and m:
            asked = lt.filter(pa.array(is_pair))
            want_l, want_r = asked["id"].to_numpy(), asked["other"].to_numpy()
            at_l = np.minimum(np.searchsorted(a["ids"], want_l), n - 1)
            at_r = np.minimum(np.searchsorted(b["ids"], want_r), m - 1)
            known = (a["ids"][at_l] == want_l) & (b["ids"][at_r] == want_r)
            at_l, at_r = at_l[known], at_r[known]
            order = np.argsort(at_l, kind="stable")
            at_l, at_r = at_l[order], at_r[order]
        # Slices of left rows whose score matrix stays within the cell budget.
        height = max(1, SCORES // max(m, 1))
        slices = [(low, min(low + height, n)) for low in range(0, n, height)] if m else []
        return kernel(a, b, dense, products, slices, (at_l, at_r), width)

    SLICE, SCORES = SLICE_CELLS, min(SCORE_CELLS, SLICE_CELLS)
    lg = rows.repartition(tasks, *grid).groupBy(*grid)
    rg = columns.repartition(tasks, *grid).groupBy(*grid)
    return lg.cogroup(rg).applyInArrow(run, schema)


def _leading(s: np.ndarray, take: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``take`` greatest entries of every row; of equal ones the first."""
    cut = np.partition(s, s.shape[1] - take, axis=1)[:, s.shape[1] - take][:, None]
    above, level = s > cut, s == cut
    spare = take - above.sum(axis=1, keepdims=True)
    return np.nonzero(above | (level & (np.cumsum(level, axis=1) <= spare)))


def best_columns(scores: np.ndarray, take: int, digits: int = DIGITS) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``take`` best scores of every row, rounded; ties go to the first column.

    Runs of ``RUN`` columns are judged by their greatest score.  Scores above the ``take``-th
    greatest of these lie in runs above it, and of the runs level with it the first hold enough,
    so only ``take`` runs of a row are rounded and compared entry by entry.
    """
    n, m = scores.shape
    runs = -(-m // RUN)
    if runs <= 2 * take:
        return _leading(np.round(scores, digits), take)
    full = m // RUN
    top = np.empty((n, runs))
    scores[:, : full * RUN].reshape(n, full, RUN).max(axis=2, out=top[:, :full])
    if runs > full:
        scores[:, full * RUN :].max(axis=1, out=top[:, full])
    if np.isnan(top).any():
        return _leading(np.round(scores, digits), take)
    r, c = _leading(np.round(top, digits), take)
    at = (c[:, None] * RUN + np.arange(RUN)).reshape(n, take * RUN)
    near = np.round(scores[np.arange(n)[:, None], np.minimum(at, m - 1)], digits)
    near[at >= m] = -np.inf
    r, c = _leading(near, take)
    at = at[r, c]
    return r[at < m], at[at < m]


def topk_kernel(k: int, measure: str, kind: str, extremes: bool) -> tuple[Callable, str]:
    """The best ``k`` right rows of a block for every left row of a block, and the schema of the result."""
    id_type = pa.int64() if kind == "bigint" else pa.string()
    digits = DIGITS

    def kernel(a, b, dense, products, slices, asked, width):
        ids, others, scores, low, high = [], [], [], np.inf, -np.inf
        take = min(k, len(b["ids"]))
        for first, last in slices:
            raw = products(first, last)
            if measure == "jaccard":
                union = a["lens"][first:last, None] + b["lens"][None, :] - raw
                raw = np.divide(raw, union, out=np.zeros_like(raw), where=union > 0)
            if extremes:
                low, high = min(low, float(raw.min())), max(high, float(raw.max()))
            x, y = np.searchsorted(asked[0], [first, last])
            raw[asked[0][x:y] - first, asked[1][x:y]] = -np.inf
            r, c = best_columns(raw, take, digits)
            r, c = r[raw[r, c] > -np.inf], c[raw[r, c] > -np.inf]
            ids.append(a["ids"][first:last][r])
            others.append(b["ids"][c])
            scores.append(raw[r, c])

        def column(parts, kind):
            return pa.array(np.concatenate(parts) if parts else [], kind)

        out = [column(ids, id_type), column(others, id_type), column(scores, pa.float64())]
        names = ["id", "other", "score"]
        if extremes:
            # One more row carries the extremes of this pair of blocks.
            seen = low <= high
            n = len(out[0])
            out = [pa.concat_arrays([c, pa.nulls(1, c.type)]) for c in out]
            out += [pa.concat_arrays([pa.nulls(n, pa.float64()), pa.array([v if seen else None], pa.float64())]) for v in (low, high)]
            names += ["low", "high"]
        return pa.table(out, names=names)

    return kernel, f"id {kind}, other {kind}, score double" + (", low double, high double" if extremes else "")


def block_topk(
    left: DataFrame,
    right: DataFrame,
    k: int,
    left_key: str,
    right_key: str,
    exclude: DataFrame | None = None,
    measure: str = "dot",
    block_rows: int = BLOCK_ROWS,
    extremes: bool = False,
    prune: bool | None = None,
    count: dict | None = None,
) -> DataFrame:
    """The ``k`` best right rows for every left row: (left key, right key, score).

    ``exclude`` holds (left key, right key) pairs that must not appear.
    ``measure`` is ``dot`` or, for 0/1 vectors, ``jaccard``.  Ties go to the
    smaller right key.  With ``extremes`` the frame also has ``low`` and
    ``high``, the least and greatest score over all pairs before exclusion.

    From ``PRUNE_PRODUCTS`` pairs on, or with ``prune``, cells of similar vectors are formed
    first and only cells that can hold a result meet (``pruning``); the rows are the same.
    ``count``, if given, then gets the number of pairs that met, and of all.
    """
    kind = key_type((left, left_key), (right, right_key))
    left_v = settle(_vectors(left, left_key, None, kind), "left")
    right_v = settle(_vectors(right, right_key, None, kind), "right")
    pairs = None
    if exclude is not None:
        pairs = exclude.select(F.col(left_key).cast(kind).alias("id"), F.col(right_key).cast(kind).alias("other"))
    sizes = _sizes(left_v, right_v) if prune is None else None
    if prune is None:
        prune = sizes[0]["n"] * sizes[1]["n"] >= PRUNE_PRODUCTS
    if prune:
        from quipu.operators.pruning import pruned_scores  # built on this module

        scored = pruned_scores(left_v, right_v, pairs, k, measure, kind, extremes, count)
    else:
        kernel, schema = topk_kernel(k, measure, kind, extremes)
        scored = _cogroup(left_v, right_v, pairs, kernel, schema, block_rows, sizes)
    best = Window.partitionBy("id").orderBy(F.desc(F.round("score", DIGITS)), "other")
    if extremes:
        scored = settle(scored, "scored")
    found = scored.where("other IS NOT NULL").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    named = [_as_given("id", left, left_key), _as_given("other", right, right_key), F.col("score")]
    if not extremes:
        return found.select(*named)
    low, high = scored.agg(F.min("low")).scalar(), scored.agg(F.max("high")).scalar()
    return found.select(*named, low.alias("low"), high.alias("high"))


def block_scores(
    left: DataFrame, right: DataFrame, pairs: DataFrame, left_key: str, right_key: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Product of the two vectors for each requested pair; pairs without both vectors are absent."""
    kind = key_type((left, left_key), (right, right_key))
    id_type = pa.int64() if kind == "bigint" else pa.string()
    left_v = settle(_vectors(left, left_key, None, kind), "left")
    right_v = settle(_vectors(right, right_key, None, kind), "right")
    asked = pairs.select(F.col(left_key).cast(kind).alias("id"), F.col(right_key).cast(kind).alias("other"))

    def kernel(a, b, dense, products, slices, wanted, width):
        r, c = wanted
        scores = np.zeros(len(r))
        n, height = len(a["ids"]), max(1, budget // max(width, 1))
        start = np.searchsorted(b["owner"], np.arange(len(b["ids"]) + 1))
        for first in range(0, n if len(r) else 0, height):
            last = min(first + height, n)
            x, y = np.searchsorted(r, [first, last])
            mine = dense(a, first, last, 0, width) if x < y else None
            at = x
            while at < y:
                # As many pairs as unroll to a bounded number of right-hand cells.
                counts = start[c[at:y] + 1] - start[c[at:y]]
                run = max(1, int(np.searchsorted(np.cumsum(counts), budget // 4, side="right")))
                counts, stop = counts[:run], min(at + run, y)
                pair = np.repeat(np.arange(len(counts)), counts)
                cell = np.repeat(start[c[at:stop]] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
                weights = b["flat"][cell] * mine[r[at:stop][pair] - first, b["at"][cell]]
                scores[at:stop] = np.bincount(pair, weights=weights, minlength=stop - at)
                at = stop
        ids = [pa.array(a["ids"][r], id_type), pa.array(b["ids"][c], id_type)]
        return pa.table([*ids, pa.array(scores)], names=["id", "other", "score"])

    budget = SLICE_CELLS
    out = _cogroup(left_v, right_v, asked, kernel, f"id {kind}, other {kind}, score double", block_rows)
    return out.select(_as_given("id", left, left_key), _as_given("other", right, right_key), "score")


def block_distance_sums(points: DataFrame, key: str, group: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Sum of Euclidean distances from every point to the points of each group: (key, group, total)."""
    kind = key_type((points, key))
    id_type = pa.int64() if kind == "bigint" else pa.string()
    vectors = settle(_vectors(points, key, group, kind, single=True), "points")

    def kernel(a, b, dense, products, slices, asked, width):
        groups, at = np.unique(b["tags"], return_inverse=True)
        onto = np.zeros((len(b["ids"]), len(groups)))
        onto[np.arange(len(b["ids"])), at] = 1.0
        ids, grps, parts = [], [], []
        for first, last in slices:
            sq = a["squares"][first:last, None] + b["squares"][None, :] - 2.0 * products(first, last)
            dist = np.sqrt(np.maximum(sq, 0.0))
            dist[a["ids"][first:last, None] == b["ids"][None, :]] = 0.0
            ids.append(np.repeat(a["ids"][first:last], len(groups)))
            grps.append(np.tile(groups, last - first).astype(np.int64))
            parts.append((dist @ onto).ravel())

        def column(values, kind):
            return pa.array(np.concatenate(values) if values else [], kind)

        return pa.table(
            [column(ids, id_type), column(grps, pa.int64()), column(parts, pa.float64())], names=["id", "grp", "part"]
        )

    parts = _cogroup(vectors, vectors, None, kernel, f"id {kind}, grp bigint, part double", block_rows, even=True)
    return parts.groupBy(_as_given("id", points, key), F.col("grp").alias(group)).agg(F.sum("part").alias("total"))


def block_worst_ratio(centers: DataFrame, key: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per centre the greatest (spread + spread) / distance to another centre: (key, worst).

    ``centers`` has the spread ``s`` and the dense vector ``val``; centres at the same
    place are left out, as their ratio is undefined.
    """
    kind = key_type((centers, key))
    id_type = pa.int64() if kind == "bigint" else pa.string()
    # The spread travels as the last value of the vector.
    longer = centers.select(key, F.concat(F.col("val").cast("array<double>"), F.array(F.col("s").cast("double"))).alias("val"))
    vectors = settle(_vectors(longer, key, None, kind), "centers")

    def kernel(a, b, dense, products, slices, asked, width):
        ids, worst = [], []
        right = dense(b, 0, len(b["ids"]), 0, width)
        for first, last in slices:
            left = dense(a, first, last, 0, width)
            square = (left[:, :-1] ** 2).sum(axis=1)[:, None] + (right[:, :-1] ** 2).sum(axis=1)[None, :]
            gap = square - 2.0 * (left[:, :-1] @ right[:, :-1].T)
            # Where rounding could matter, by differences: equal centres are then exactly zero apart.
            r, c = np.nonzero(gap <= 1e-9 * square)
            gap[r, c] = ((left[r, :-1] - right[c, :-1]) ** 2).sum(axis=1)
            apart = np.sqrt(gap)
            apart[a["ids"][first:last, None] == b["ids"][None, :]] = 0.0
            both = left[:, -1:] + right[None, :, -1]
            ratio = np.divide(both, apart, out=np.full_like(apart, -np.inf), where=apart > 0)
            top = ratio.max(axis=1)
            ids.append(a["ids"][first:last][top > -np.inf])
            worst.append(top[top > -np.inf])
        columns = [pa.array(np.concatenate(x) if x else [], t) for x, t in ((ids, id_type), (worst, pa.float64()))]
        return pa.table(columns, names=["id", "worst"])

    found = _cogroup(vectors, vectors, None, kernel, f"id {kind}, worst double", block_rows)
    return found.groupBy(_as_given("id", centers, key)).agg(F.max("worst").alias("worst"))
