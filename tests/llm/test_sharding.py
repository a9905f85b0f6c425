from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quipu.llm import sharding
from tests.llm.cases import documents


def key_text(key) -> str:
    return "" if key is None else str(key)


def test_counts_slots_and_sizes(spark):
    docs = documents(spark)
    rows = sharding.assign(docs, 8).collect()
    assert len(rows) == docs.count()
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
    sizes = Counter({s: len(v) for s, v in by_shard.items()})
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    want = Counter(
        (d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in docs.select("doc_id", "text").collect()
    )
    assert Counter((r.key, r.size, r.text_crc32) for r in rows) == want


def test_equals_the_sequential_ring(spark):
    """Rows ask their own shard first, hop by hop, arcs in ring order."""
    docs = spark.range(700).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    ring = sharding.Ring(5, 7)
    arcs = defaultdict(list)
    for key in range(700):
        arcs[ring.arc_of(sharding._point(key_text(key)))].append(key)
    room = sharding.capacities(700, 5)
    left = {a: len(k) for a, k in arcs.items()}
    want = Counter()
    for hop in range(5):
        for arc in sorted(arcs):
            shard = ring.order(arc)[hop]
            n = min(left[arc], room[shard])
            left[arc] -= n
            room[shard] -= n
            want[arc, shard] += n
    got = Counter()
    for r in sharding.assign(docs, 5, vnodes=7).collect():
        got[ring.arc_of(sharding._point(key_text(r.key))), r.shard] += 1
    assert got == +want


@pytest.mark.parametrize("slack", [0.0, 0.25])
def test_hot_key_and_slack(spark, slack):
    docs = spark.range(900).select(F.when(F.col("id") < 400, 7).otherwise(F.col("id")).alias("doc_id"), F.lit(None).cast("string").alias("text"))
    counts = Counter(r.shard for r in sharding.assign(docs, 4, slack=slack).collect())
    assert sum(counts.values()) == 900
    assert max(counts.values()) <= -(-900 * (1 + slack) // 4)


def test_most_rows_stay_when_a_shard_is_added(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    before = {r.key: r.shard for r in sharding.assign(docs, 8, slack=0.2).collect()}
    after = {r.key: r.shard for r in sharding.assign(docs, 9, slack=0.2).collect()}
    moved = sum(before[k] != after[k] for k in before)
    assert moved < 0.3 * len(before)


def test_empty_table(spark):
    assert sharding.assign(documents(spark).limit(0), 8).count() == 0
