"""Benchmark decontamination: test n-grams as a broadcast hash set, scanned over training windows.

A window of L words always holds one block of q = (L + 1) // 2 words that starts at
a multiple of q.  So only every q-th block of a document is looked up in the
broadcast set of blocks that occur in the benchmark's windows; only around a hit are
whole windows formed and compared, as text, with the benchmark's windows.  The result
equals a scan of every window.  Words are hashed once and blocks by the hashes of their
words; blocks of all lengths are looked up in one pass, whose rows are numbered and
written once, so nothing depends on how the documents are split when read.

Defined cases: a null or empty text has no words and is clean; an item without words
has no window, one with fewer than ``n`` words is one window of its own length.
Repeated items and documents are judged each for itself; items without an id count as
one item, which the list of ids leaves out; empty tables give no hits.
Columns other than the ids and texts are not read by ``scan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import column, without_rows, words
from quipu.session import settle

WINDOW = 10
#: Rows of one broadcast.  More blocks are joined by a shuffle, more windows compared in parts.
BROADCAST_ROWS = 500_000


def _run(array: str | Column, start: Column, length: Column) -> Column:
    """``length`` words from the 0-based ``start`` as one text; no word holds a blank."""
    return F.array_join(F.slice(array, (start + 1).cast("int"), length.cast("int")), " ")


def windows(items: DataFrame, key: str = "item_id", text: str = "text", n: int = WINDOW) -> DataFrame:
    """(item_id, length, window): the distinct windows of every item."""
    rows = items.select(column(items, key).alias("item_id"), words(column(items, text)).alias("w"))
    rows = rows.where(F.size("w") > 0).withColumn("length", F.least(F.size("w"), F.lit(n)))
    starts = F.sequence(F.lit(0), F.size("w") - F.col("length"))
    rows = rows.select("item_id", "w", "length", F.explode(starts).alias("at"))
    return rows.select("item_id", "length", _run("w", F.col("at"), F.col("length")).alias("window")).distinct()


def _word_hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _block_hash(hashes: str, start: Column, q: int) -> Column:
    return F.xxhash64(F.slice(hashes, (start + 1).cast("int"), q))


def _blocks(texts: DataFrame, q: int) -> DataFrame:
    """(q, block): hashes of all q-word blocks inside the windows."""
    hashed = texts.select(_word_hashes(F.split("window", " ")).alias("h"))
    parts = hashed.select("h", F.explode(F.sequence(F.lit(0), F.size("h") - q)).alias("at"))
    return parts.select(F.lit(q).alias("q"), _block_hash("h", F.col("at"), q).alias("block"))


def _passes(df: DataFrame, by: Column, rows: int) -> list[DataFrame]:
    """``df`` in parts of about ``rows`` rows at most."""
    parts = max(1, -(-df.count() // rows))
    return [df] if parts == 1 else [df.where(F.pmod(by, F.lit(parts)) == i) for i in range(parts)]


def scan(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    n: int = WINDOW,
    broadcast: int = BROADCAST_ROWS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows, hits and windows.

    Rows are (row, doc_id, text_key, n_words), one per document; hits are
    (row, at, length, window), one per place where a benchmark window occurs;
    windows are (item_id, length, window).
    """
    known = settle(windows(items, item_key, item_text, n), "op7-windows")
    texts = settle(known.select("length", "window").distinct(), "op7-texts")
    lengths = [r["length"] for r in texts.select("length").distinct().orderBy("length").collect()]  # at most n
    tokens = docs.select(column(docs, key).alias("doc_id"), column(docs, text).alias("t")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("t").alias("text_key"), words(F.col("t")).alias("w")
    )
    longest = {q: [n for n in lengths if (n + 1) // 2 == q] for q in sorted({(n + 1) // 2 for n in lengths})} or {1: []}
    blocks: DataFrame | None = None
    for q, of_q in longest.items():
        own = _blocks(texts.where(F.col("length").isin(of_q)), q)
        blocks = own if blocks is None else blocks.unionByName(own)
    blocks = settle(blocks.distinct(), "op7-blocks")
    near = settle(_near_hits(tokens, blocks, {q: max(of_q, default=0) for q, of_q in longest.items()}, broadcast), "op7-near")
    rows = near.where(F.col("first")).select("row", "doc_id", "text_key", "n_words")
    hits = rows.select("row", *[F.lit(0).alias(c) for c in ("at", "length")], F.lit("").alias("window")).limit(0)
    for q, of_q in longest.items():
        for length in of_q:
            own = texts.where(F.col("length") == length)
            hits = hits.unionByName(_verified(near.where(F.col("q") == q), own, length, q, broadcast))
    return rows, settle(hits.distinct(), "op7-hits"), known


def _near_hits(tokens: DataFrame, blocks: DataFrame, longest: dict[int, int], broadcast: int) -> DataFrame:
    """Blocks at multiples of q that the benchmark holds, with the words around them.

    ``longest`` has the longest window of every q.  The first block of every document is
    returned whether it is held or not, so that the same pass lists the documents.
    """
    def lookups(q: int) -> Column:
        last = F.greatest(F.lit(0), F.floor((F.size("h") - q) / q)).cast("int")
        block = lambda i: F.struct(F.lit(q).alias("q"), (i * q).alias("at"), _block_hash("h", i * q, q).alias("block"))
        return F.transform(F.sequence(F.lit(0), last), block)

    hashed = tokens.withColumn("h", _word_hashes(F.col("w")))
    spread = hashed.select("row", "doc_id", "text_key", "w", F.explode(F.concat(*map(lookups, longest))).alias("b"))
    spread = spread.select("row", "doc_id", "text_key", "w", "b.*")
    # A window around the block starts at most longest - q words before it and ends as far behind it.
    span = F.create_map(*[F.lit(x) for pair in longest.items() for x in pair])[F.col("q")]
    begin = F.greatest(F.lit(0), F.col("at") - (span - F.col("q")))
    first = (F.col("q") == min(longest)) & (F.col("at") == 0)
    around = [begin.alias("begin"), F.slice("w", begin + 1, F.col("at") - begin + F.greatest(span, F.col("q"))).alias("reach")]
    kept = ["row", "doc_id", "text_key", F.size("w").cast("long").alias("n_words"), "q", "at", first.alias("first")]
    held = blocks.withColumn("hit", F.lit(True))
    if blocks.count() <= broadcast:
        marked = spread.join(F.broadcast(held), ["q", "block"], "left").where(F.col("hit") | first)
        return marked.select(*kept, "hit", *around).withColumn("reach", F.when(F.col("hit"), F.col("reach")))
    # Too many blocks for a broadcast: the words around each lookup are moved instead of whole texts.
    moved = spread.select(*kept, "block", *around).join(held, ["q", "block"], "left").where(F.col("hit") | F.col("first"))
    return moved.drop("block").withColumn("reach", F.when(F.col("hit"), F.col("reach")))


def _verified(near: DataFrame, texts: DataFrame, length: int, q: int, broadcast: int) -> DataFrame:
    """Windows of that length around the hits which are windows of the benchmark, compared as text."""
    around = near.where(F.size("reach") >= length)
    starts = F.sequence(F.lit(0), F.size("reach") - length)
    around = around.select("row", "begin", "reach", F.explode(starts).alias("s"))
    around = around.select(
        "row", (F.col("begin") + F.col("s")).alias("at"), _run("reach", F.col("s"), F.lit(length)).alias("window")
    )
    found: DataFrame | None = None
    for some in _passes(texts, F.xxhash64("window"), broadcast):
        hit = around.join(F.broadcast(some.select("window")), "window", "left_semi")
        found = hit if found is None else found.unionByName(hit)
    return found.select("row", "at", F.lit(length).alias("length"), "window")


def judge(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """One row per document: (doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated).

    The digest is over the ids of the items found, sorted as text and joined by commas.
    """
    rows, hits, known = scan(docs, items, **names)
    places = F.sequence(F.col("at"), F.col("at") + F.col("length") - 1)
    hit = hits.select("row", F.explode(places).alias("p")).distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    of = hits.select("row", "window").distinct().join(known.select("item_id", "window"), "window")
    of = of.select("row", F.col("item_id").cast("string").alias("item")).distinct().groupBy("row")
    listed = F.array_join(F.sort_array(F.collect_list("item")), ",")
    of = of.agg(F.count(F.lit(1)).alias("n_items"), listed.alias("items"))
    return (
        rows.join(hit, "row", "left")
        .join(of, "row", "left")
        .select(
            "doc_id",
            "text_key",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).alias("n_items"),
            F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The documents that hold no benchmark window, with all their columns."""
    rows, hits, _ = scan(docs, items, key=key, text=text, **names)
    bad = rows.join(hits.select("row").distinct(), "row", "left_semi").select("doc_id", "text_key").distinct()
    return without_rows(docs, bad, {"doc_id": column(docs, key), "text_key": F.xxhash64(column(docs, text))})
