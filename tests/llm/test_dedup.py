from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from quipu.llm import exact_dedup, simhash
from tests.llm.cases import documents, lower_ascii


def order(key) -> tuple:
    return (key is not None, key or 0)


@pytest.mark.parametrize("broadcast", [exact_dedup.BROADCAST_GROUPS, 0])
@pytest.mark.parametrize("digests", [True, False])
def test_exact_against_brute_force(spark, broadcast, digests):
    docs = documents(spark)
    groups = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        groups[lower_ascii(r.text)].append(r.doc_id)
    want = Counter((i, max(ids, key=order), len(ids)) for ids in groups.values() for i in ids)
    rows = exact_dedup.mark(docs, digests=digests, broadcast=broadcast).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in rows) == want
    assert sum(r.kept for r in rows) == len(groups)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)
    if digests:
        prints = Counter(hashlib.sha256(t.encode()).hexdigest() for t, ids in groups.items() for _ in ids)
        assert Counter(r.digest for r in rows) == prints


def test_exact_keeps_one_of_each_with_all_columns(spark):
    docs = documents(spark)
    kept = exact_dedup.dedup(docs)
    assert kept.columns == docs.columns
    rows = kept.select("doc_id", "text").collect()
    texts = {lower_ascii(r.text) for r in docs.select("text").collect()}
    assert Counter(lower_ascii(r.text) for r in rows) == Counter(texts)
    best = {}
    for r in docs.select("doc_id", "text").collect():
        t = lower_ascii(r.text)
        best[t] = max(best.get(t), r.doc_id, key=order) if t in best else r.doc_id
    assert all(best[lower_ascii(r.text)] == r.doc_id for r in rows)


def test_prefix_and_length_agree_but_texts_differ(spark):
    base = "x" * 400
    docs = spark.createDataFrame([(1, base + "a"), (2, base + "b"), (3, base + "A")], "doc_id long, text string")
    rows = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.mark(docs).collect()}
    assert rows == {1: (3, 2, False), 2: (2, 1, True), 3: (3, 2, True)}


def test_empty_tables(spark):
    docs = documents(spark).limit(0)
    assert exact_dedup.mark(docs).count() == 0 and exact_dedup.dedup(docs).count() == 0
    assert simhash.mark(docs).count() == 0 and simhash.dedup(docs).count() == 0


def brute_print(text: str | None, shingle: int = 3) -> int:
    words = [w for w in lower_ascii(text).replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words)] if len(words) < shingle else [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: dict[int, int], max_bits: int = 3) -> dict[int, int]:
    """Print -> representative print, by comparing all."""
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = list(root)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    return {p: find(p) for p in keys}


def test_prints_equal_sparks_hash(spark):
    text = "The quick brown"
    assert simhash.fingerprint_of(text) == spark.range(1).select(F.xxhash64(F.lit(text.lower()))).first()[0] % 2**64


def test_simhash_against_brute_force(spark):
    docs = documents(spark)
    given = docs.select("doc_id", "text").collect()
    prints = Counter(brute_print(r.text) for r in given)
    root = brute_components(prints)
    smallest = {}
    for r in given:
        if r.doc_id is not None:
            k = root[brute_print(r.text)]
            smallest[k] = min(smallest.get(k, r.doc_id), r.doc_id)
    want = Counter((r.doc_id, f"{brute_print(r.text):016x}", smallest.get(root[brute_print(r.text)])) for r in given)
    rows = simhash.mark(docs).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in rows) == want
    assert sum(r.kept for r in rows) == len(set(root.values()))
    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root.values()))


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 5])
@pytest.mark.parametrize("hot", [3, simhash.HOT])
def test_links_join_what_all_pairs_join(spark, max_bits, hot):
    import random

    rng = random.Random(max_bits)
    prints = set()
    for _ in range(8):
        base = rng.getrandbits(64)
        for _ in range(30):
            p = base
            for _ in range(rng.randint(0, 5)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    root = brute_components(dict.fromkeys(prints, 1), max_bits)
    signed = {p - 2**64 if p >= 2**63 else p: p for p in prints}
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    edges = simhash.links(frame, max_bits, hot)
    pairs = [(signed[r.a], signed[r.b]) for r in edges.collect()]
    assert all((a ^ b).bit_count() <= max_bits for a, b in pairs)
    if hot == simhash.HOT:
        want = {frozenset((a, b)) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= max_bits}
        assert {frozenset(p) for p in pairs} == want
    got = {signed[r.fp]: r.root for r in simhash.components(edges).collect()}
    for p in prints:
        others = {q for q in prints if root[q] == root[p]}
        if len(others) > 1:
            assert {got[q] for q in others} == {min(k for k, v in signed.items() if v in others)}
        else:
            assert p not in got


def test_keys_after_an_explode_are_not_broadcast(spark):
    """Spark sizes the 68 keys of a fingerprint like the fingerprint; a driver cannot hold them all."""
    prints = spark.range(300).select(F.xxhash64("id").alias("fp"))
    plan = simhash.links(prints)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
