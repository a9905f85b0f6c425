"""One query per operator, over the whole of its table, and the SQL that states the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.llm import (
    decontaminate,
    exact_dedup,
    html_extract,
    licenses,
    merge_queue,
    periodic,
    pii,
    quality,
    sharding,
    simhash,
    tokens,
    url_filter,
    whitening,
)
from quipu.llm.common import WORD
from quipu.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL_WORDS = f"regexp_extract_all({SQL_LOWER}, '{WORD}')"


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return keep


@query("op1_sharding")
def _(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    return sharding.assign(docs, shards=8).select(
        F.col("key").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op2_url_filter")
def _(spark, d):
    pages = read_table(spark, d, "pages", ["page_id", "url"])
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict")


@query("op3_quality_classifier")
def _(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    trees = quality.fit(docs, read_table(spark, d, "labels", ["doc_id", "quality"]))
    scored = docs.select(
        "doc_id",
        F.coalesce(quality.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        quality.score(F.col("text"), trees).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query(
    "op4_exact_dedup",
    f"""WITH t AS (SELECT doc_id, {SQL_LOWER} AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256 FROM t""",
)
def _(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    marked = exact_dedup.mark(docs, digests=True)
    return marked.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query(
    "op7_decontamination",
    f"""WITH i AS (SELECT item_id, {SQL_WORDS} AS w FROM benchmark), d AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
        iw AS (SELECT DISTINCT item_id, n, array_to_string(w[s + 1 : s + n], ' ') AS t FROM
               (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS s FROM i WHERE len(w) > 0)),
        dw AS (SELECT doc_id, n, s, array_to_string(w[s + 1 : s + n], ' ') AS t FROM
               (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
        hit AS (SELECT doc_id, s, n, item_id FROM dw JOIN iw USING (n, t)),
        pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY 1),
        its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM
                (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY 1)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)""",
)
def _(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    items = read_table(spark, d, "benchmark", ["item_id", "text"])
    return decontaminate.judge(docs, items).drop("text_key")


@query("op5_html_extraction")
def _(spark, d):
    return html_extract.extract(read_table(spark, d, "pages", ["page_id", "url", "html"]))


@query("op6_byte_bpe")
def _(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    return tokens.digests(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op8_license_scan")
def _(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    found = docs.select("doc_id", licenses.scan_column(F.col("text")).alias("scan"))
    return found.select("doc_id", "scan.*").drop("spans")


@query("op9_pii")
def _(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    found = docs.select("doc_id", pii.find(F.col("text"), pii.fit(docs)).alias("found"))
    return found.select(
        "doc_id", *[f"found.n_{kind}" for kind in pii.KINDS], "found.base_sha256", F.col("found.listed").alias("spans")
    )


@query("op10_simhash")
def _(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    return simhash.mark(docs).select("doc_id", "fingerprint", "component_id")


@query("op11_periodic_runs")
def _(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    return periodic.digests(docs, echoes=True).drop("text")


@query("op12_whitening")
def _(spark, d):
    return whitening.components(read_table(spark, d, "embeddings", ["vec_id", "embedding"]), "vec_id", "embedding")


@query("op13_bpe_merge_queue")
def _(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    return merge_queue.digests(docs).drop("text")
