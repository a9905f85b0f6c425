"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are learned on the driver from a bounded sample of labelled rows
(``FIT_ROWS``); their features are computed by Spark.  A fitted model is a few
arrays in heap order (children of node i are 2i + 1 and 2i + 2), which all rows of a
batch traverse together, one level at a time.  Labels, source, language and id are
never features.

Defined cases: a null or empty text has all statistics zero and gets the score of
that leaf.  Without labelled rows every score is 0.5; with labels of one kind, that
label's share with one row of each kind added.  Several labels of one id count as
their mean; null labels and ids are not learned from.  Repeated rows get equal
scores; columns other than the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import column

FIT_ROWS = 20_000
TREES = 40
DEPTH = 4
RATE = 0.2
BINS = 64

_UPPER = np.arange(65, 91)
_LOWER = np.arange(97, 123)
_DIGIT = np.arange(48, 58)
_HIGH = np.arange(128, 256)
_PLAIN_MARKS = np.frombuffer(b".,;:'\"()?-", np.uint8)
_MARKS = np.array([b for b in range(33, 127) if not chr(b).isalnum()])
FEATURES = (
    "log_bytes", "log_words", "mean_word", "sd_word", "long_words", "one_char_words", "distinct_words", "repeated_next",
    "upper", "lower", "digits", "beyond_ascii", "plain_marks", "odd_marks", "top_mark", "stops", "line_breaks", "blanks",
    "lines_seen_before", "mean_line",
)


def statistics(text: str | None) -> list[float]:
    """Statistics of the whole text, in the order of ``FEATURES``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(FEATURES)
    n = len(raw)
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), raw.split(b"\n")
    many = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    marks = bytes_[_MARKS]
    letters = max(1, int(bytes_[_UPPER].sum() + bytes_[_LOWER].sum()))
    return [
        np.log1p(n),
        np.log1p(len(words)),
        float(sizes.mean()),
        float(sizes.std()),
        float((sizes > 15).mean()),
        float((sizes == 1).mean()),
        len(set(words)) / many,
        sum(map(eq, words, words[1:])) / many,
        bytes_[_UPPER].sum() / letters,
        bytes_[_LOWER].sum() / n,
        bytes_[_DIGIT].sum() / n,
        bytes_[_HIGH].sum() / n,
        bytes_[_PLAIN_MARKS].sum() / many,
        (marks.sum() - bytes_[_PLAIN_MARKS].sum()) / many,
        marks.max() / many,
        bytes_[ord(".")] / many,
        bytes_[10] / many,
        bytes_[32] / n,
        1 - len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
    ]


@dataclass
class Trees:
    """Flattened trees: rows are trees, columns nodes in heap order; ``value`` holds the leaves' scores."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            while inner and node[:1].size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - inner]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def learn(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> Trees:
    """Boost complete trees of ``depth`` levels on logistic loss, with splits at histogram edges."""
    inner, leaves = 2**depth - 1, 2**depth
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    flat = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), start)
    if len(y) == 0 or y.min() == y.max():
        return flat
    width = x.shape[1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    codes = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    total = np.full(len(y), start)
    made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            best = np.zeros(count)
            cut = np.full(count, bins + 1)
            for f in range(width):
                at = (node - first) * (bins + 1) + codes[:, f]
                g = np.bincount(at, grad, count * (bins + 1)).reshape(count, -1).cumsum(axis=1)
                h = np.bincount(at, hess, count * (bins + 1)).reshape(count, -1).cumsum(axis=1)
                gain = g**2 / (h + 1) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                gain[(h < 1) | (h[:, -1:] - h < 1)] = 0
                gain[:, len(edges[f]) :] = 0
                top = gain.argmax(axis=1)
                value = gain[np.arange(count), top]
                better = value > best + 1e-9
                best[better], cut[better] = value[better], top[better]
                feature[first : first + count][better] = f
                threshold[first : first + count][better] = edges[f][np.minimum(top[better], len(edges[f]) - 1)]
            chosen = feature[node]
            node = 2 * node + 1 + (codes[np.arange(len(y)), chosen] > cut[node - first])
        leaf = node - inner
        g, h = np.bincount(leaf, grad, leaves), np.bincount(leaf, hess, leaves)
        value = rate * g / (h + 1)
        total = total + value[leaf]
        made.append((feature, threshold, value))
    return Trees(*[np.stack(part) for part in zip(*made, strict=True)], start)


def statistics_column(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([statistics(t.as_py()) for t in batch], pa.list_(pa.float64()))

    return run(text)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    key: str = "doc_id",
    text: str = "text",
    fit_rows: int = FIT_ROWS,
) -> Trees:
    """Learn from labelled rows that are not held out; about ``fit_rows`` ids are chosen by hash."""
    ids = labels.select(column(labels, key).alias("id"), column(labels, label).cast("double").alias("y")).dropna()
    ids = ids.where(~held_out(F.col("id"))).groupBy("id").agg(F.avg("y").alias("y"))
    share = min(1.0, fit_rows / max(1, ids.count()))
    chosen = ids.where(F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    texts = docs.select(column(docs, key).alias("doc"), column(docs, text).alias("t"))
    # The sample is bounded by fit_rows; of documents that repeat an id one is learned from.
    rows = texts.join(F.broadcast(chosen), F.col("doc") == F.col("id")).select("id", "y", statistics_column(F.col("t")).alias("x"))
    sample = rows.groupBy("id").agg(F.min(F.struct("y", "x")).alias("s")).select("id", "s.y", "s.x").toPandas().sort_values("id")
    x = np.array(sample["x"].tolist(), dtype=float).reshape(len(sample), len(FEATURES))
    return learn(x, (sample["y"].to_numpy(float) >= 0.5).astype(float))


def held_out(key: Column) -> Column:
    """Rows that no label may be learned from."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1


def score(text: Column, trees: Trees) -> Column:
    """Probability that the text is good."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch], dtype=float).reshape(len(batch), len(FEATURES))
            yield pa.array(trees.score(x))

    return run(text)


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", **names) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    trees = fit(docs, labels, text=text, **names)
    scored = docs.withColumn("__quality", score(column(docs, text), trees))
    return scored.where(F.col("__quality") >= 0.5).drop("__quality")
