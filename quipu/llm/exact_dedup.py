"""Exact duplicates by progressive refinement: length, then a prefix hash, then a full hash.

Two passes over the texts.  The first keeps only a length and the hash of a short
prefix per row; counting those narrow rows shows which groups can hold equal texts
at all.  The second pass hashes whole texts of the surviving groups.  No text is
shuffled by ``mark``.

Defined cases: a null text counts as empty, so all null and empty texts are one
group.  Rows with a null id count as smaller than any id.  Of rows that repeat both
text and id one stays.  An empty table gives an empty table.  Columns other than the
id and the text are not read by ``mark`` and pass through ``dedup`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import column, keep_marked, lower_ascii
from quipu.operators.joins import broadcast_if_small
from quipu.session import settle

PREFIX_CHARS = 128
#: Groups are broadcast up to this number; each is two numbers of 8 bytes.
BROADCAST_GROUPS = 1_000_000


def _narrow(docs: DataFrame, key: str, text: str) -> DataFrame:
    norm = lower_ascii(column(docs, text))
    return docs.select(column(docs, key).alias("doc_id"), norm.alias("norm")).select(
        "doc_id",
        "norm",
        F.octet_length("norm").cast("long").alias("size"),
        F.xxhash64(F.substring("norm", 1, PREFIX_CHARS)).alias("prefix"),
    )


def surviving_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(size, prefix) of every group of two or more rows that agree in length and prefix."""
    first = settle(_narrow(docs, key, text).select("size", "prefix"), "op4-first")
    sizes = first.groupBy("size").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("size")
    same_size = first.join(broadcast_if_small(sizes, BROADCAST_GROUPS), "size", "left_semi")
    groups = same_size.groupBy("size", "prefix").agg(F.count(F.lit(1)).alias("n"))
    return settle(groups.where("n > 1").select("size", "prefix"), "op4-groups")


def mark(
    docs: DataFrame, key: str = "doc_id", text: str = "text", digests: bool = False, broadcast: int = BROADCAST_GROUPS
) -> DataFrame:
    """One row per document: (row, doc_id, keep_id, group_size, kept, digest, text_key).

    Of equal texts the row with the largest id stays.  ``digest`` is the SHA-256 of
    the normalised text; without ``digests`` only rows of surviving groups have one.
    ``text_key`` (64 bits of the normalised text) names a row's text in later joins.
    With more surviving groups than ``broadcast`` every text is hashed in the scan,
    which gives the same groups and still moves no text.
    """
    groups = surviving_groups(docs, key, text)
    rows = _narrow(docs, key, text)
    full = F.sha2("norm", 256)
    if groups.count() <= broadcast:
        hits = groups.withColumn("open", F.lit(True))
        rows = rows.join(F.broadcast(hits), ["size", "prefix"], "left")
        rows = rows.withColumn("open", F.coalesce("open", F.lit(False)))
    else:
        rows = rows.withColumn("open", F.lit(True))
    second = settle(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "open",
            (full if digests else F.when(F.col("open"), full)).alias("digest"),
            F.xxhash64("norm").alias("text_key"),
        ),
        "op4-second",
    )
    top = F.max(F.struct("doc_id", "row")).alias("top")
    copies = second.where("open").groupBy("digest").agg(F.count(F.lit(1)).alias("n"), top).where("n > 1")
    # Written first: then both sides of the join are plain shuffles, whose hot keys Spark can split.
    copies = settle(copies.select(F.col("digest").alias("of"), "n", "top"), "op4-copies")
    found = F.col("n").isNotNull()
    shape = ["row", "doc_id", "keep_id", "group_size", "kept", "digest", "text_key"]
    joined = second.where("open").join(copies, F.col("digest") == F.col("of"), "left").withColumns(
        {
            "keep_id": F.when(found, F.col("top.doc_id")).otherwise(F.col("doc_id")),
            "group_size": F.coalesce("n", F.lit(1)).cast("long"),
            "kept": ~found | (F.col("row") == F.col("top.row")),
        }
    )
    # Rows outside of surviving groups are alone, and may have no digest to be joined by.
    alone = second.where("NOT open").withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
    return joined.select(*shape).unionByName(alone.select(*shape))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    marked = settle(mark(docs, key, text).where("group_size > 1"), "op4-marked")
    keys = {"doc_id": column(docs, key), "text_key": F.xxhash64(lower_ascii(column(docs, text)))}
    return keep_marked(docs, marked, keys)
