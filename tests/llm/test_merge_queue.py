from __future__ import annotations

import hashlib
import random
import time
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quipu.llm import merge_queue, queries
from tests.llm.cases import documents

TRICKY = [
    "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "don't I'LL 'S 's'", "x  \n\n y\t", "\x85\x1c  z",
    "ab" * 20_000, "z" * 30_000, " " * 50_000 + "x", "日本語 " * 20_000 + "é", "a՘b \U0002b73a\U000323b0 ᲊ", "\U0001f600" * 300, "\x00\x01",
]


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(merge_queue.default_vocabulary())


def ids_of(text):
    return [i for part in merge_queue.vocabulary(merge_queue.default_vocabulary()).encode(text) for i in part]


def random_texts(n, seed=4):
    rng = random.Random(seed)
    chars = [lambda: rng.randrange(32, 127), lambda: rng.randrange(0x80, 0x3000), lambda: rng.randrange(0x1F300, 0x1F700), lambda: 32, lambda: 10]
    return ["".join(chr(rng.choice(chars)()) for _ in range(rng.randrange(200))) for _ in range(n)]


def test_ids_equal_the_library(library):
    texts = TRICKY + random_texts(2000) + pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    want = library.encode_batch(texts, add_special_tokens=False)
    for text, expected in zip(texts, want):
        assert ids_of(text) == expected.ids, text[:80]


def test_every_character_is_split_as_the_library_does(library):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 7 == 0)]
    texts = [f"a{c}b1{c}2,{c}.  {c}  x" for c in chars]
    for text, expected in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ids_of(text) == expected.ids, text


def test_decoding_equals_the_library(library):
    rng = random.Random(8)
    words = merge_queue.vocabulary(merge_queue.default_vocabulary())
    for _ in range(2000):
        ids = [rng.randrange(50_257) for _ in range(rng.randrange(20))]
        assert words.decode(ids).decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False)
    assert words.decode([None, 99_999, *ids_of("x")]) == b"x"


def test_small_word_tables_change_nothing(monkeypatch):
    texts = random_texts(200)
    want = [ids_of(t) for t in texts]
    monkeypatch.setattr(merge_queue, "TABLE_WORDS", 10)
    words = merge_queue.Vocabulary(merge_queue.default_vocabulary())
    assert [[i for part in words.encode(t) for i in part] for t in texts] == want
    assert len(words.words) <= 10


def test_one_long_word_takes_time_in_proportion():
    start = time.process_time()
    assert len(ids_of("ab" * 500_000)) > 1000
    assert time.process_time() - start < 60


def test_digests(spark, library):
    docs = documents(spark).unionByName(
        spark.createDataFrame([(i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string"), allowMissingColumns=True
    )
    docs = docs.withColumn("n_tokens", F.lit("gone"))
    got = merge_queue.digests(docs)
    assert set(docs.columns) < set(got.columns)

    def row(key, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        return key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    want = Counter(row(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert Counter(tuple(r) for r in got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == want
    assert merge_queue.digests(docs.limit(0)).count() == 0
    pairs = docs.select("text", merge_queue.encoded(F.col("text")).alias("ids")).withColumn("back", merge_queue.decoded(F.col("ids")))
    assert pairs.where("back != coalesce(text, '')").count() == 0


def test_new_queries_cover_their_tables(spark):
    folder = "/root/testdata/sf0.001"
    n_docs = spark.read.parquet(f"{folder}/documents.parquet").count()
    for name in ("op11_periodic_runs", "op13_bpe_merge_queue"):
        assert queries.QUERIES[name](spark, folder).count() == n_docs
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").count()
    white = queries.QUERIES["op12_whitening"](spark, folder)
    assert white.count() == 32 * vectors
    assert white.agg(F.max("identity_error")).first()[0] < 1e-9
