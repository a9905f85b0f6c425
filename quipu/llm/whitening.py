"""PCA whitening of vectors by exact integer cross-products from bit planes.

Entries become whole numbers, x = floor(``SCALE`` * c) + ``SHIFT``.  Each Arrow batch takes off its
least value per dimension and cuts what is left into bit planes: bit b of a dimension over
all rows, packed into 64-bit words.  The number of common bits of two planes, weighted by
their powers of two, gives the exact sum of products of two dimensions.  Tasks add their
batches as Python integers and give out one row per cell of the scatter matrix, so what is
shuffled depends on the dimensions and the tasks and not on the rows.  The centred matrix
n * sum(xy) - sum(x) * sum(y) is formed from integers before it is divided and decomposed.

On the driver: the scatter matrix of the dimensions (d * d numbers; the vectors may be
long, but d * d must fit) and its eigenvectors, which go to the tasks that whiten.

Defined cases: rows whose vector is null or holds nulls or non-finite entries are left out.
Vectors of one length make one space: the length that most rows have (ties: the longer) is
fitted, and rows of other lengths are left out, as are vectors without entries.  Entries
beyond +-2**50 after scaling count as that bound.  Repeated rows count as often as they
stand.  A direction without variance (an eigenvalue below 1e-13 of the largest, as with a
single row) has null ``whitened`` and takes no part in ``identity_error``, which is null if
no direction has variance; ``explained`` is null then too.  Equal eigenvalues share their
directions in any rotation.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import column

SCALE, SHIFT = 64, 1_000_000  # fixed values: x = floor(64 * c) + 1000000
COMPONENTS = 32  # fixed value: components returned at most
BOUND = 1 << 50
#: Rows of one set of planes, and bits of one limb of a sum.
PLANE_ROWS = 1 << 16
LIMB = 40
NO_VARIANCE = 1e-13
CELLS = "i int, j int, high long, middle long, low long"


def usable(vector: Column) -> Column:
    """Whether the vector and all its entries are there and finite."""
    entries = vector.cast("array<double>")
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return entries.isNotNull() & ~F.coalesce(bad, F.lit(True))


def whole_numbers(entries: np.ndarray) -> np.ndarray:
    """floor(64 c), without the shift."""
    return np.clip(np.floor(entries * SCALE), -BOUND, BOUND).astype(np.int64)


def matrix(vectors: pa.Array, d: int) -> np.ndarray:
    """The vectors of an Arrow list array as rows."""
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), d)


def planes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of the columns of a matrix of whole numbers >= 0: their words, dimension and bit."""
    n, d = values.shape
    bits = int(values.max(initial=0)).bit_length()
    words, dims, powers = [], [], []
    for b in range(bits):
        flags = ((values >> b) & 1).astype(np.uint8)
        used = np.flatnonzero(flags.any(axis=0))
        packed = np.zeros((len(used), -(-n // 64) * 8), np.uint8)
        packed[:, : -(-n // 8)] = np.packbits(flags[:, used], axis=0).T
        words.append(packed.view(np.uint64))
        dims.append(used)
        powers.append(np.full(len(used), b))
    if not words:
        return np.zeros((0, 0), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(words), np.concatenate(dims), np.concatenate(powers)


def cross_products(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and sums of products of the columns, as Python integers."""
    n, d = values.shape
    sums, products = np.zeros(d, object), np.zeros((d, d), object)
    if not n:
        return sums, products
    least = values.min(axis=0)
    words, dims, powers = planes(values - least)
    bits = int(powers.max(initial=0)) + 1
    # All pairs of planes whose bits add up to the same power are counted into one matrix.
    counts = np.zeros((2 * bits, d, d), np.int64)
    for k in range(len(words)):
        common = np.bitwise_count(words[k:] & words[k]).sum(axis=1, dtype=np.int64)
        np.add.at(counts, (powers[k] + powers[k:], dims[k], dims[k:]), common)
        np.add.at(counts, (powers[k] + powers[k + 1 :], dims[k + 1 :], dims[k]), common[1:])
    for power, part in enumerate(counts):
        if part.any():
            products += part.astype(object) << power
    ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
    for dim, power, count in zip(dims.tolist(), powers.tolist(), ones.tolist()):
        sums[dim] += count << power
    # Back from differences to the least values to the numbers themselves.
    low = least.astype(object)
    products += np.multiply.outer(low, sums) + np.multiply.outer(sums, low) + n * np.multiply.outer(low, low)
    return sums + n * low, products


def scatter(vectors: DataFrame, name: str, d: int) -> tuple[int, list[int], list[list[int]]]:
    """Rows, sums and sums of products of ``floor(64 c)`` over all vectors, which have ``d`` entries each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            whole = whole_numbers(matrix(batch.column(0), d))
            for at in range(0, len(whole), PLANE_ROWS):
                s, p = cross_products(whole[at : at + PLANE_ROWS])
                sums, products = sums + s, products + p
            n += len(whole)
        if n:
            i, j = np.triu_indices(d)
            cells = [n, *sums.tolist(), *products[i, j].tolist()]
            at_i = [-1, *[-1] * d, *i.tolist()]
            at_j = [-1, *range(d), *j.tolist()]
            mask = (1 << LIMB) - 1
            limbs = [[c >> 2 * LIMB for c in cells], [c >> LIMB & mask for c in cells], [c & mask for c in cells]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["i", "j", "high", "middle", "low"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([at_i, at_j, *limbs], kinds)], names=names)

    cells = vectors.select(column(vectors, name).cast("array<double>")).mapInArrow(run, CELLS)
    total = cells.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("high", "middle", "low")])
    n, sums, products = 0, [0] * d, [[0] * d for _ in range(d)]
    for r in total.collect():
        value = (r.high << 2 * LIMB) + (r.middle << LIMB) + r.low
        if r.i >= 0:
            products[r.i][r.j] = products[r.j][r.i] = value
        elif r.j >= 0:
            sums[r.j] = value
        else:
            n = value
    return n, sums, products


def fit(vectors: DataFrame, vector: str, components: int = COMPONENTS) -> dict | None:
    """Means, directions and variances of the usable vectors; None if there are none.

    ``n``, ``d``, ``sums`` (of floor(64 c)), ``axes`` (d x k, unit eigenvectors), ``scales``
    (square roots of the eigenvalues, nan without variance), ``explained`` and ``identity_error``.
    """
    good = vectors.where(usable(column(vectors, vector)))
    length = F.size(column(good, vector))
    common = good.groupBy(length.alias("d")).agg(F.count(F.lit(1)).alias("n")).where("d > 0")
    most = common.orderBy(F.desc("n"), F.desc("d")).first()
    if most is None:
        return None
    d = most.d
    n, sums, products = scatter(good.where(length == d), vector, d)
    # Whole numbers up to here; one correctly rounded division per cell.
    square = n * n
    cov = np.array([[(n * products[i][j] - sums[i] * sums[j]) / square for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, d)
    trace = sum(n * products[i][i] - sums[i] * sums[i] for i in range(d)) / square
    kept = values[:k] > max(NO_VARIANCE * values[0], 0.0)
    scales = np.sqrt(np.where(kept, values[:k], np.nan))
    onto = axes[:, :k][:, kept] / scales[kept]
    error = float(np.abs(onto.T @ cov @ onto - np.eye(int(kept.sum()))).max()) if kept.any() else None
    return {
        "n": n,
        "d": d,
        "sums": sums,
        "axes": axes[:, :k],
        "scales": scales,
        "explained": [float(v) / trace if trace else None for v in np.maximum(values[:k], 0.0)],
        "identity_error": error,
    }


def deviations(whole: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Per row the exact sum of (n x - S)^2."""
    reach = max((max(abs(int(a) * n - s), abs(int(b) * n - s)) for a, b, s in zip(whole.min(axis=0), whole.max(axis=0), sums)), default=0)
    if reach**2 * whole.shape[1] < 1 << 63:
        off = whole * n - np.array(sums, np.int64)
        return (off * off).sum(axis=1).tolist()
    off = whole.astype(object) * n - np.array(sums, object)
    return (off * off).sum(axis=1).tolist()


def centred(whole: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, from the whole part of S / n and the rest."""
    base = [s // n for s in sums]
    rest = np.array([(s - b * n) / n for s, b in zip(sums, base)])
    return (whole - np.array(base, np.int64)) - rest


def transform(vectors: DataFrame, vector: str, fitted: dict | None) -> DataFrame:
    """The usable rows with ``deviation`` (decimal string) and ``whitened`` (one value per component), replacing such columns."""
    names = [c for c in vectors.columns if c not in ("deviation", "whitened")]
    quoted = ["`" + c.replace("`", "``") + "`" for c in names]
    shape = "struct<deviation: string, whitened: array<double>>"
    if fitted is None:
        return vectors.limit(0).select(*quoted, F.lit(None).cast("string").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened"))
    n, d, sums, scales = fitted["n"], fitted["d"], fitted["sums"], fitted["scales"]
    onto = fitted["axes"] / scales
    kind = pa.struct([("deviation", pa.string()), ("whitened", pa.list_(pa.float64()))])

    @F.arrow_udf(shape)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            if not len(batch):
                yield pa.array([], kind)
                continue
            whole = whole_numbers(matrix(batch, d))
            out = centred(whole, n, sums) @ onto
            flat = pa.array(out.ravel(), pa.float64(), mask=np.isnan(out.ravel()))
            offsets = np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]
            exact = pa.array([str(v) for v in deviations(whole, n, sums)], pa.string())
            yield pa.StructArray.from_arrays([exact, pa.ListArray.from_arrays(offsets, flat)], ["deviation", "whitened"])

    good = vectors.where(usable(column(vectors, vector)) & (F.size(column(vectors, vector)) == d))
    found = good.select(*quoted, run(column(good, vector).cast("array<double>")).alias("__white"))
    return found.select(*quoted, "__white.*")


def components(vectors: DataFrame, key: str, vector: str, limit: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: key, component, n, deviation, whitened, explained, identity_error.

    ``deviation`` is null where the exact number is beyond a long.
    """
    narrow = vectors.select(column(vectors, key).alias("key"), column(vectors, vector).alias("vector"))
    fitted = fit(narrow, "vector", limit)
    shares = fitted["explained"] if fitted else []
    error, n = (fitted["identity_error"], fitted["n"]) if fitted else (None, None)
    white = transform(narrow, "vector", fitted)
    rows = white.select("key", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    known = F.array(*[F.lit(s).cast("double") for s in shares]) if shares else F.lit(None).cast("array<double>")
    return rows.select(
        F.col("key").alias(key),
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS long)").alias("deviation"),
        "whitened",
        F.get(known, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
