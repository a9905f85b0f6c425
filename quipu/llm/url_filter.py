"""URL filter: host and path rules, and gradient-boosted trees for every URL that no rule fits.

The trees see lexical features only: lengths, depth, digit ratio, entropy, counts of
parameters, and smoothed block rates of the host's suffixes, the path's first segment alone
and under its top-level domain, and the file suffix.  They learn from URLs that the rules
label, each distinct URL once; the fit takes at most about ``fit_rows`` of them, chosen by
hash.  Rates count all labelled URLs; those a URL is learned with leave out its own fold.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits
no rule and gets the trees' verdict.  Without any labelled URL, or with labels of one
kind only, that one verdict (allow, if there is none) holds for the rest.  Repeated
rows get equal verdicts; other columns pass through.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import column
from quipu.operators.joins import broadcast_if_small
from quipu.session import settle

#: The rules of the contract, as (verdict, host and path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
FIT_ROWS = 8_000
TREES = 12
DEPTH = 4
SMOOTHING = 20.0
FOLDS = 5
KINDS = ("tld", "domain", "segment", "branch", "file")
SUFFIXES = 50_000  # broadcast up to this number of distinct suffixes
PREFIX = "__url_"


def _rest(url: Column) -> Column:
    """What stands behind the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host(url: Column) -> Column:
    raw = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def match(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        own, slash, start = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + start)
        hit = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, hit).otherwise(found)
    return found


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.char_length(text).cast("double")
    kinds = F.array_distinct(F.split(text, ""))

    def part(total: Column, c: Column) -> Column:
        share = (n - F.char_length(F.replace(text, c, F.lit("")))) / n
        return total - F.when(share > 0, share * F.log2(share)).otherwise(F.lit(0.0))

    return F.when(n > 0, F.aggregate(kinds, F.lit(0.0), part)).otherwise(F.lit(0.0))


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    length = F.char_length(url).cast("double")
    return {
        "length": length,
        "host_length": F.char_length(host).cast("double"),
        "path_length": F.char_length(path).cast("double"),
        "depth": _count(path, "/[^/]"),
        "labels": _count(host, "[^.]+"),
        "digit_ratio": _count(url, "[0-9]") / F.greatest(length, F.lit(1.0)),
        "host_digits": _count(host, "[0-9]"),
        "path_digits": _count(path, "[0-9]"),
        "hyphens": _count(url, "-"),
        "entropy": entropy(url),
        "params": F.when(F.char_length(query) > 0, _count(query, "&") + 1).otherwise(F.lit(0.0)),
        "query_length": F.char_length(query).cast("double"),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
        "secure": F.startswith(url, F.lit("https")).cast("double"),
    }


def _suffixes(host: Column, path: Column) -> dict[str, Column]:
    """What block rates are counted by; in the order of ``KINDS``."""
    tld = F.regexp_extract(host, r"([^.]*)$", 1)
    segment = F.regexp_extract(path, r"^/+([^/]*)/", 1)  # a last segment is a file
    return {
        "tld": tld,
        "domain": F.regexp_extract(host, r"([^.]*\.?[^.]*)$", 1),
        "segment": segment,
        "branch": F.concat(tld, F.lit("/"), segment),
        "file": F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1),
    }


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """The pages with the parts of their URL, under names of their own."""
    text = F.coalesce(column(pages, url), F.lit(""))
    out = pages.withColumn(PREFIX + "text", text)
    out = out.withColumns({PREFIX + "host": host(F.col(PREFIX + "text")), PREFIX + "path": path(F.col(PREFIX + "text"))})
    out = out.withColumns({PREFIX + k: c for k, c in _suffixes(F.col(PREFIX + "host"), F.col(PREFIX + "path")).items()})
    return out.withColumn(PREFIX + "match", match(F.col(PREFIX + "host"), F.col(PREFIX + "path")))


class UrlModel:
    """Block rates and trees; ``only`` is set where the labels are all of one kind."""

    def __init__(self, rates: dict[str, DataFrame], prior: float, trees: GBTClassificationModel | None, only: str | None):
        self.rates, self.prior, self.trees, self.only = rates, prior, trees, only

    def features(self, rows: DataFrame, rates: dict[str, DataFrame] | None = None) -> DataFrame:
        """Adds the vector ``__url_features``; ``rates`` may be by fold instead of the model's."""
        cols = lexical(*[F.col(PREFIX + k) for k in ("text", "host", "path")])
        out = rows.withColumns({f"{PREFIX}f_{k}": c for k, c in cols.items()})
        names = [f"{PREFIX}f_{k}" for k in cols]
        for kind, rate in (rates or self.rates).items():
            keys = [c for c in rate.columns if c != f"{PREFIX}r_{kind}"]
            out = out.join(broadcast_if_small(rate, SUFFIXES), keys, "left")
            out = out.withColumn(f"{PREFIX}r_{kind}", F.coalesce(f"{PREFIX}r_{kind}", F.lit(self.prior)))
            names.append(f"{PREFIX}r_{kind}")
        return VectorAssembler(inputCols=names, outputCol=PREFIX + "features").transform(out)

    def judge(self, rows: DataFrame) -> DataFrame:
        """Adds ``__url_score``, the probability of block."""
        if self.only is not None:
            return rows.withColumn(PREFIX + "score", F.lit(1.0 if self.only == "block" else 0.0))
        from pyspark.ml.functions import vector_to_array

        scored = self.trees.transform(self.features(rows))
        return scored.withColumn(PREFIX + "score", vector_to_array(PREFIX + "probability")[1])


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS, trees: int = TREES, depth: int = DEPTH) -> UrlModel:
    """Learn from the rows of ``parsed`` that a rule labels, each distinct URL once."""
    parts = [PREFIX + k for k in ("text", "host", "path", *KINDS)]
    labelled = rows.where(F.col(PREFIX + "match").isNotNull())
    label = (F.col(PREFIX + "match.verdict") == "block").cast("double").alias(PREFIX + "label")
    fold = F.pmod(F.xxhash64(PREFIX + "text", F.lit("fold")), F.lit(FOLDS)).alias(PREFIX + "fold")
    urls = settle(labelled.select(*parts, label).distinct().withColumn(PREFIX + "fold", fold), "op2-labelled")
    total, blocked = urls.agg(F.count(F.lit(1)), F.sum(PREFIX + "label")).first()
    if not blocked or blocked == total:
        return UrlModel({}, 0.0, None, "block" if blocked else "allow")
    prior = blocked / total
    rates, by_fold = {}, {}
    for kind in KINDS:
        name, key = f"{PREFIX}r_{kind}", PREFIX + kind
        counts = urls.groupBy(key, PREFIX + "fold").agg(F.count(F.lit(1)).alias("n"), F.sum(PREFIX + "label").alias("b"))
        counts = settle(counts, "op2-counts")
        totals = counts.groupBy(key).agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b"))
        rate = (F.col("all_b") + SMOOTHING * prior) / (F.col("all_n") + SMOOTHING)
        rates[kind] = settle(totals.select(key, rate.alias(name)), "op2-rates")
        others = (F.col("all_b") - F.col("b") + SMOOTHING * prior) / (F.col("all_n") - F.col("n") + SMOOTHING)
        by_fold[kind] = settle(counts.join(totals, key).select(key, PREFIX + "fold", others.alias(name)), "op2-fold-rates")
    model = UrlModel(rates, prior, None, None)
    share = min(1.0, fit_rows / total)
    chosen = urls.where(F.pmod(F.xxhash64(PREFIX + "text", F.lit("fit")), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    sample = settle(model.features(chosen, by_fold).select(PREFIX + "features", PREFIX + "label").coalesce(2), "op2-sample")
    learner = GBTClassifier(
        featuresCol=PREFIX + "features", labelCol=PREFIX + "label", maxIter=trees, maxDepth=depth, seed=7, stepSize=0.3
    )
    learner.setPredictionCol(PREFIX + "prediction")
    learner.setProbabilityCol(PREFIX + "probability").setRawPredictionCol(PREFIX + "raw")
    model.trees = learner.fit(sample)
    return model


def judge(pages: DataFrame, url: str = "url", **limits) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule``, ``verdict`` and ``score``; columns of these names are replaced."""
    rows = parsed(pages, url)
    scored = fit(rows, **limits).judge(rows)
    method = F.when(F.col(PREFIX + "score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    new = {
        "host": F.col(PREFIX + "host"),
        "path": F.col(PREFIX + "path"),
        "rule": F.col(PREFIX + "match.rule"),
        "verdict": F.coalesce(F.col(PREFIX + "match.verdict"), method),
        "score": F.col(PREFIX + "score"),
    }
    kept = [scored["`" + c.replace("`", "``") + "`"] for c in pages.columns if c not in new]
    return scored.select(*kept, *[c.alias(n) for n, c in new.items()])
