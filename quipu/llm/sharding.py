"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a ring; a key belongs to the next point
clockwise.  A shard takes rows only up to its capacity; rows beyond it go on to the
next other shards clockwise until one has room.  All arcs ask their own shard first,
then the second, and so on; within an arc, keys ask by cell, a hash class of their places.

Only the counts of the arcs (``shards x vnodes`` numbers, whatever the table's size)
are planned on the driver.  Rows get their place in the arc from counts of small
cells of the ring plus a row number inside a cell.  A cell is cut into lanes, over
which the rows of one hot key are spread, so no task holds a key's rows together.  Lanes come
from row numbers: where an arc's rows go to several shards, which of a cell's rows go where
depends on how the table is split when read; counts and bounds do not.

Defined cases: a null key is a key like any other; repeated rows are placed one by
one; a null text has size 1 (no bytes, plus 1) and checksum 0; an empty table gives
an empty table.  Other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.llm.common import column
from quipu.session import settle

RING = 1 << 60
VNODES = 64
CELLS = 64  # per arc
LANES = 64


def _point(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def position(key: Column) -> Column:
    """Place on the ring: the first 60 bits of the key's MD5."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


class Ring:
    def __init__(self, shards: int, vnodes: int = VNODES):
        points = sorted((_point(f"shard-{s}-{v}"), s) for s in range(shards) for v in range(vnodes))
        self.shards, self.points, self.owners = shards, [p for p, _ in points], [s for _, s in points]

    def arc_of(self, place: int) -> int:
        return bisect.bisect_left(self.points, place) % len(self.points)

    def order(self, arc: int) -> list[int]:
        """All shards, clockwise from an arc."""
        around = self.owners[arc:] + self.owners[:arc]
        return list(dict.fromkeys(around))

    def arc_column(self, place: Column) -> Column:
        """The arc's number by binary search: ``log2(points)`` comparisons."""
        points = F.array(*[F.lit(p) for p in self.points])
        low, high = F.lit(0), F.lit(len(self.points))
        steps = F.sequence(F.lit(1), F.lit(len(self.points).bit_length()))
        start = F.struct(low.alias("a"), high.alias("b"))

        def halve(s: Column, _: Column) -> Column:
            mid = F.floor((s["a"] + s["b"]) / 2).cast("int")
            right = (s["a"] < s["b"]) & (F.get(points, mid) < place)
            return F.struct(
                F.when(right, mid + 1).otherwise(s["a"]).alias("a"), F.when(right, s["b"]).otherwise(mid).alias("b")
            )

        return F.aggregate(steps, start, halve)["a"] % len(self.points)

    def plan(self, counts: dict[int, int], room: Sequence[int]) -> list[tuple[int, int, int, int, int]]:
        """Pieces (arc, from, to, shard, first slot): ranks from..to of an arc go to a shard."""
        left, asked, used = list(room), {a: 0 for a in counts}, [0] * self.shards
        orders = {a: self.order(a) for a in counts}
        pieces = []
        for hop in range(self.shards):
            for arc in sorted(counts):
                shard = orders[arc][hop]
                n = min(counts[arc] - asked[arc], left[shard])
                if n > 0:
                    pieces.append((arc, asked[arc], asked[arc] + n, shard, used[shard]))
                    asked[arc] += n
                    left[shard] -= n
                    used[shard] += n
        return pieces


def capacities(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """Without slack the counts are at most one apart; else everyone may take (1 + slack) of the mean."""
    if slack > 0:
        return [math.ceil(total * (1 + slack) / shards)] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def assign(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", vnodes: int = VNODES, slack: float = 0.0
) -> DataFrame:
    """(key, size, text_crc32, shard, slot) of every row; slots count from 0 in each shard without gaps."""
    ring = Ring(shards, vnodes)
    body = F.coalesce(column(docs, text), F.lit(""))
    rows = docs.select(
        column(docs, key).alias("key"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
        position(column(docs, key)).alias("place"),
        # Written before use, so a row keeps its lane whatever is recomputed later.
        F.pmod(F.monotonically_increasing_id(), F.lit(LANES)).cast("int").alias("lane"),
    )
    cell = F.pmod(F.xxhash64("place"), F.lit(CELLS)).cast("int")
    rows = settle(rows.withColumn("arc", ring.arc_column(F.col("place"))).withColumn("cell", cell), "op1-rows")
    place = ["arc", "cell", "lane"]
    cells = settle(rows.groupBy(*place).agg(F.count(F.lit(1)).alias("n")), "op1-cells")
    counts = {r["arc"]: r["n"] for r in cells.groupBy("arc").agg(F.sum("n").alias("n")).collect()}  # shards x vnodes
    pieces = ring.plan(counts, capacities(sum(counts.values()), shards, slack))
    before = Window.partitionBy("arc").orderBy("cell", "lane").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(*place, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy(*place).orderBy("place", "key", "size", "text_crc32"))
    ranked = rows.withColumn("inside", inside - 1).join(offsets, place)
    ranked = ranked.withColumn("rank", F.col("before") + F.col("inside"))
    spark = docs.sparkSession
    planned = spark.createDataFrame(pieces, "p_arc int, low long, high long, shard int, base long")
    # At most shards x shards x vnodes pieces, each row of the join meets exactly one.
    here = (F.col("arc") == F.col("p_arc")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    return ranked.join(F.broadcast(planned), here).select(
        "key", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("low")).alias("slot")
    )
