from __future__ import annotations

import hashlib
import random
import time
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quipu.llm import periodic
from tests.llm.cases import documents, texts, with_clashes


def brute_runs(words):
    """Every stretch of every distance whose words repeat, checked for its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and (j + q - i) >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_row(key, text, echoes):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    h = zlib.crc32(str(key).encode())
    if echoes and key is not None and words and h % 10 == 0:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = 1000 * best[1] // best[2] if runs else None
    return len(runs), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept)


def periodic_words(rng):
    """Stretches of one to nine words, repeated, nested in each other and between other words."""
    words = []
    for _ in range(rng.randint(1, 6)):
        unit = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        times = rng.choice([1, 1, 3, 4, 5, 9, 30])
        inner = unit * times
        words += (inner + [rng.choice("abcd")]) * rng.choice([1, 1, 2, 5]) + inner[: rng.randint(0, len(inner))]
    return [w.encode() for w in words]


def test_runs_against_all_distances():
    rng = random.Random(3)
    docs = [periodic_words(rng) for _ in range(400)]
    docs += [[rng.choice([b"x", b"y"]) for _ in range(rng.randint(0, 80))] for _ in range(600)]
    docs += [[], [b"a"], [b"a"] * 5, [b"a"] * 6, [b"a", b"b"] * 4, [b"a", b"b"] * 3 + [b"a"], [b"a"] * 500]
    # Fibonacci words have many runs, most of them of a smaller exponent.
    a, b = [b"0"], [b"0", b"1"]
    for _ in range(12):
        a, b = b, b + a
    docs += [b, b * 4, docs[0], docs[0]]
    want = [brute_runs(d) for d in docs]
    assert [r for d in docs for r in periodic.runs_of([d])] == [r for w in want for r in [w]]
    assert periodic.runs_of(docs) == want  # together, where no repeat crosses documents
    assert sum(map(len, want)) > 300


@pytest.mark.parametrize("echoes", [True, False])
def test_digests_against_brute_force(spark, echoes):
    docs = documents(spark).where("text IS NULL OR length(text) < 100000")
    rng = random.Random(9)
    more = [(10_000 + i, b" ".join(periodic_words(rng)).decode(), "en", "s", 1) for i in range(300)]
    more += [(20_000, "a\x1cb a\x1cb " * 9, "en", "s", 1), (20_001, "\ta \x0b a\x0ca\r\na a a a  ", "en", "s", 1), (-7, "é é é é é é é", "en", "s", 1)]
    docs = docs.unionByName(with_clashes(spark.createDataFrame(more, docs.schema.simpleString()[7:].split(",row:")[0].replace(":", " ").replace(">", ""))))
    docs = docs.withColumn("period", F.lit("gone"))
    got = periodic.digests(docs, echoes=echoes)
    assert set(docs.columns) < set(got.columns)
    rows = got.collect()
    names = [f.split()[0] for f in periodic.RESULT.split(", ")]
    assert len(rows) == docs.count()
    for r in rows:
        assert tuple(r[n] for n in names) == brute_row(r.doc_id, r.text, echoes), r.text
    assert sum(r.n_runs > 0 for r in rows) > 100
    assert periodic.digests(docs.limit(0)).count() == 0


def test_long_texts_take_time_in_proportion(spark):
    """Long texts: one word, a long period, and a phrase behind many different words."""
    phrase = "one two three four five six".split()
    behind = " ".join(w for i in range(20_000) for w in [f"w{i}", *phrase])
    long = ["long " * 300_000 + "end", " ".join(f"v{i % 50_000}" for i in range(250_000)), behind]
    start = time.process_time()
    runs = periodic.runs_of([periodic.split_words(t) for t in long])
    assert runs == [[(0, 300_000, 1)], [(0, 250_000, 50_000)], []]
    assert time.process_time() - start < 60
    found = spark.createDataFrame([(t,) for t in texts()], "text string").select(periodic.runs(F.col("text")).alias("r")).collect()
    assert [(x.start, x.length, x.period) for x in found[-1].r] == [(0, 30_000, 1)]
