"""SimHash near-duplicates, with candidates from pigeonring filtering.

A fingerprint has 64 bits over word shingles.  For at most t differing bits it is
cut into t + 1 segments on a ring.  If two fingerprints differ in at most t bits,
then from some segment on every chain of l consecutive segments differs in at most
l * t / (t + 1) bits in all: nothing in the first, one bit at most in the first two,
and so on.  The first two segments are the join key (the second in all its variants
of one flipped bit on one side), the longer chains prune, and the full distance
decides.  Only distinct fingerprints are joined, so copies cost nothing.

Keys with more than ``hot`` fingerprints are compared in square tiles of bounded
size, which give out a spanning forest of their links instead of all pairs.

Defined cases: a null or empty text, or one of blanks only, has fingerprint zero,
which links like any other.  A text with fewer words than a shingle is one shingle.
Null ids count as larger than any id; a group of null ids only has component null.
Repeated rows share their component.  Empty tables give empty tables; other columns
are not read by ``mark`` and pass through ``dedup`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import column, keep_marked
from quipu.session import settle

SHINGLE = 3
MAX_BITS = 3
SEED = 42
HOT = 512
_CHUNK = 1 << 16


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint: a bit is 1 if it is set in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False)))
    hashed = map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles)
    hashes = np.fromiter(hashed, dtype=">u8", count=len(shingles)).view(np.uint8).reshape(-1, 8)
    ones = sum(
        np.unpackbits(hashes[i : i + _CHUNK], axis=1).sum(axis=0, dtype=np.int64) for i in range(0, len(hashes), _CHUNK)
    )
    return int.from_bytes(np.packbits(ones * 2 > len(shingles)).tobytes(), "big")


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint's 64 bits as a long."""

    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            prints = [fingerprint_of(t.as_py(), shingle) for t in batch]
            yield pa.array(np.array(prints, dtype=np.uint64).view(np.int64))

    return run(text)


def _segments(parts: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment, from the highest bits on."""
    edges = [round(64 * i / parts) for i in range(parts + 1)]
    return [(64 - b, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _cut(value: Column, segment: tuple[int, int]) -> Column:
    shift, width = segment
    if width == 64:
        return value
    return F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << width) - 1))


def _keys(prints: DataFrame, parts: int, flips: bool) -> DataFrame:
    """(fp, turn, key): two neighbouring segments from each start; with ``flips`` also one bit off in the second."""
    ring = _segments(parts)
    made = []
    for turn in range(parts):
        second = ring[(turn + 1) % parts]
        masks = [0] + ([1 << b for b in range(second[1])] if flips and parts > 1 else [])
        key = F.shiftleft(_cut(F.col("fp"), ring[turn]), 32)
        key = key.bitwiseOR(_cut(F.col("fp"), second)) if parts > 1 else _cut(F.col("fp"), ring[turn])
        made += [F.struct(F.lit(turn).alias("turn"), key.bitwiseXOR(F.lit(m)).alias("key")) for m in masks]
    return prints.select("fp", F.explode(F.array(*made)).alias("k")).select("fp", "k.turn", "k.key")


def _chains_hold(a: Column, b: Column, turn: Column, max_bits: int) -> Column:
    """Every chain from the start ``turn`` stays within its share of the bits, the whole ring included."""
    parts = max_bits + 1
    ring = _segments(parts)
    differs = a.bitwiseXOR(b)
    held = F.bit_count(differs) <= max_bits
    for start in range(parts):
        for length in range(3, parts):
            bits = sum((F.bit_count(_cut(differs, ring[(start + i) % parts])) for i in range(length)), F.lit(0))
            held = held & ((turn != start) | (bits <= length * max_bits // parts))
    return held


def _forest(max_bits: int):
    """Links of one tile, as a forest that joins what the links join."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        a, b = left["a"].to_numpy(np.int64), right["b"].to_numpy(np.int64)
        near = np.bitwise_count((a[:, None] ^ b[None, :]).view(np.uint64)) <= max_bits
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        links = []
        for i, j in zip(*np.nonzero(near), strict=True):
            x, y = int(a[i]), int(b[j])
            if (p := find(x)) != (q := find(y)):
                root[p] = q
                links.append((x, y))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def links(prints: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT) -> DataFrame:
    """(a, b): pairs of different fingerprints at most ``max_bits`` apart; of crowded keys a spanning forest.

    ``prints`` has the distinct fingerprints as ``fp``.
    """
    parts = max_bits + 1
    plain, flipped = _keys(prints, parts, False), _keys(prints, parts, max_bits > 0)
    crowded = plain.groupBy("turn", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot)
    crowded = settle(crowded, "op10-crowded")
    any_hot = not crowded.isEmpty()
    left = plain.join(crowded, ["turn", "key"], "left_anti") if any_hot else plain
    left, right = left.withColumnRenamed("fp", "a"), flipped.withColumnRenamed("fp", "b")
    # Spark sizes a table after an explode as the one before it: 68 rows a fingerprint would be broadcast as one.
    pairs = left.join(right.hint("merge"), ["turn", "key"]).where(F.col("a") < F.col("b"))
    found = pairs.where(_chains_hold(F.col("a"), F.col("b"), F.col("turn"), max_bits)).select("a", "b")
    if any_hot:
        found = found.unionByName(_tiled(plain, flipped, crowded, max_bits, hot))
    return found.distinct()


def _tiled(plain: DataFrame, flipped: DataFrame, crowded: DataFrame, max_bits: int, side: int) -> DataFrame:
    """The crowded keys' links; each tile holds about ``side`` fingerprints of either side."""
    on = ["turn", "key"]
    wide = flipped.join(crowded, on, "left_semi").groupBy(*on).agg(F.count(F.lit(1)).alias("m"))
    sizes = crowded.join(wide, on).select(
        *on, F.ceil(F.col("n") / side).cast("int").alias("rows"), F.ceil(F.col("m") / side).cast("int").alias("cols")
    )
    sizes = settle(sizes, "op10-tiles")

    def spread(df: DataFrame, name: str, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("fp"), F.col(own)).cast("int").alias(f"t_{own}")
        across = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"t_{other}")
        return df.join(sizes, on).select(F.col("fp").alias(name), *on, mine, across)

    tile = [*on, "t_rows", "t_cols"]
    left, right = spread(plain, "a", "rows", "cols"), spread(flipped, "b", "cols", "rows")
    return left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInPandas(_forest(max_bits), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(fp, root): for every linked fingerprint the smallest one that it reaches.

    Each round takes the smallest label of the neighbours and then the label's own
    label, so chains shrink quickly; both are written, which ends the lineage.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = settle(both, "op10-links")
    labels = settle(both.groupBy(F.col("a").alias("fp")).agg(F.least(F.col("fp"), F.min("b")).alias("root")), "op10-roots")
    while True:
        told = both.join(labels, F.col("b") == F.col("fp")).select(F.col("a").alias("fp"), "root")
        old = labels.select("fp", "root", F.col("root").alias("was"))
        next_ = told.withColumn("was", F.lit(None).cast("long")).unionByName(old).groupBy("fp")
        next_ = settle(next_.agg(F.min("root").alias("root"), F.max("was").alias("was")), "op10-told")
        up = next_.select(F.col("fp").alias("at"), F.col("root").alias("top"))
        jumped = next_.join(up, F.col("root") == F.col("at")).select("fp", F.col("top").alias("root"), "was")
        labels = settle(jumped, "op10-roots")
        if labels.where("root <> was").isEmpty():
            return labels.select("fp", "root")


def mark(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, hot: int = HOT
) -> DataFrame:
    """One row per document: (row, doc_id, text_key, fingerprint, component_id, kept).

    ``kept`` holds for one row of each component, that of the smallest id.
    """
    body = column(docs, text)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        column(docs, key).alias("doc_id"),
        F.xxhash64(body).alias("text_key"),
        fingerprint(body, shingle).alias("fp"),
    )
    rows = settle(rows, "op10-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    prints = settle(rows.groupBy("fp").agg(first), "op10-prints")
    roots = components(links(prints.select("fp"), max_bits, hot))
    named = prints.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    named = settle(named, "op10-named")
    heads = settle(named.groupBy("root").agg(F.min("first").alias("head")), "op10-heads")
    owners = settle(named.join(heads, "root").select("fp", "head.doc_id", "head.row"), "op10-owners")
    owners = owners.select(F.col("fp").alias("of"), F.col("doc_id").alias("component_id"), F.col("row").alias("head"))
    return rows.join(owners, F.col("fp") == F.col("of")).select(
        "row",
        "doc_id",
        "text_key",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        (F.col("row") == F.col("head")).alias("kept"),
    )


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """One document of each component, with all its columns."""
    marked = settle(mark(docs, key, text, **limits), "op10-marked")
    return keep_marked(docs, marked, {"doc_id": column(docs, key), "text_key": F.xxhash64(column(docs, text))})
