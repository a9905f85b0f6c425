from __future__ import annotations

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from quipu.llm import decontaminate, exact_dedup, quality, simhash, tokens
from tests.llm.cases import documents, with_clashes


def labelled(spark, seed=1, n=400):
    rng = random.Random(seed)
    words = ["the", "on", "erth", "and", "ingly", "of", "thon", "edble"]
    docs, labels = [], []
    for i in range(n):
        own = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        good = rng.random() < 0.7
        if not good:
            own = [w.upper() + "!!" for w in own] if i % 2 else own[:1] * len(own)
        docs.append((i, f"{i} " + " ".join(own) + "."))
        labels.append((i, int(good), 0))
    labels += [(5, None, 1), (None, 1, 0), labels[3], (10**6, 0, 0)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    return docs, with_clashes(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    trees = quality.fit(docs, labels)
    rows = docs.select("doc_id", quality.held_out(docs.doc_id).alias("out"), quality.score(docs.text, trees).alias("score"))
    truth = {r.doc_id: r.quality for r in labels.dropna(subset=["quality"]).collect()}
    out = [r for r in rows.collect() if r.out]
    assert len(out) > 80 and sum((r.score >= 0.5) == truth[r.doc_id] for r in out) >= 0.95 * len(out)


def test_quality_never_learns_held_out_labels(spark):
    docs, labels = labelled(spark)
    flipped = labels.withColumn("quality", (1 - labels.quality).cast("int")).where(quality.held_out(labels.doc_id))
    rest = labels.where(~quality.held_out(labels.doc_id) | labels.doc_id.isNull())
    a, b = quality.fit(docs, labels), quality.fit(docs, rest.unionByName(flipped))
    assert np.array_equal(a.value, b.value) and np.array_equal(a.threshold, b.threshold)


def test_flat_trees_against_node_by_node(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4))
    x[:50, 2] = 0.0
    trees = quality.learn(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float), trees=5, depth=3)
    want = []
    for row in x:
        total = trees.start
        for t in range(5):
            node = 0
            while node < 7:
                node = 2 * node + 1 + int(row[trees.feature[t, node]] > trees.threshold[t, node])
            total += trees.value[t, node - 7]
        want.append(total)
    assert np.allclose(trees.raw(x), want)


def test_quality_awkward_rows(spark):
    docs, (_, labels) = documents(spark), labelled(spark)
    trees = quality.fit(docs, labels)
    scores = [r[0] for r in docs.select(quality.score(docs.text, trees)).collect()]
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
    none = quality.fit(docs, labels.limit(0))
    assert {r[0] for r in docs.select(quality.score(docs.text, none)).collect()} == {0.5}
    kept = quality.keep_good(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert quality.keep_good(docs.limit(0), labels).count() == 0


def test_pipeline_equals_its_stages(spark, tmp_path):
    docs, labels = labelled(spark)
    more = documents(spark, extra=False).withColumn("doc_id", F.col("doc_id") + 2000)
    docs = with_clashes(docs.unionByName(more, allowMissingColumns=True))
    items = spark.createDataFrame([(1, docs.where("doc_id = 0").first().text)], "item_id long, text string")
    for name, table in (("documents", docs), ("labels", labels), ("benchmark", items)):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    step = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, step, str(tmp_path)).cache()
        assert after.columns == docs.columns and after.count() <= step.count()
        assert after.exceptAll(step).count() == 0
        step = after
    # Each stage's decisions hold for what is left.
    assert exact_dedup.mark(step).where("group_size > 1").count() == 0
    assert simhash.mark(step).groupBy("component_id").count().where("count > 1").count() == 0
    assert decontaminate.judge(step, items).where("contaminated").count() == 0
    want = Counter(tuple(r) for r in tokens.digests(step).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(tuple(r) for r in out.collect()) == want and sum(want.values()) > 100


def test_pipeline_over_an_empty_table(spark, tmp_path):
    docs, labels = labelled(spark)
    for name, table in (("documents", documents(spark).limit(0)), ("labels", labels.limit(0))):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
