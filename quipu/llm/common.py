"""Expressions that several of the operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.operators.joins import broadcast_if_small
from quipu.session import settle

#: A key is an id and 8 bytes, so with numeric ids a broadcast stays below 100 MB.
BROADCAST_KEYS = 1_000_000
# Fixed value: a word is a run of digits, a-z and characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def column(df: DataFrame, name: str) -> Column:
    """The column of that very name, also where it holds a dot or a backtick."""
    return df["`" + name.replace("`", "``") + "`"]


def without_rows(docs: DataFrame, bad: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """``docs`` without the rows whose keys are in ``bad``; nulls are equal to each other.

    ``keys`` maps columns of ``bad`` to expressions over ``docs``.  Up to
    ``BROADCAST_KEYS`` bad keys are broadcast and no text is moved; beyond that both
    sides are shuffled, with hot keys split by Spark.
    """
    names = {f"__key_{i}": k for i, k in enumerate(keys)}
    left = docs.withColumns({n: keys[k] for n, k in names.items()})
    right = settle(bad.select(*[F.col(k).alias(f"{n}_bad") for n, k in names.items()]), "bad-keys")
    right = broadcast_if_small(right, BROADCAST_KEYS)
    same = [left[n].eqNullSafe(right[f"{n}_bad"]) for n in names]
    return left.join(right, same, "left_anti").drop(*names)


def keep_marked(docs: DataFrame, marked: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """The rows of ``docs`` that ``marked`` keeps, with all their columns.

    ``marked`` has one row per row of ``docs`` that may go: the columns in ``keys``
    and ``kept``.  Rows with equal keys are copies of each other, of which at most
    one is kept; they are combined in the scan tasks before they are moved.
    """
    pairs = marked.groupBy(*keys).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    pairs = settle(pairs, "marked-pairs")
    rest = without_rows(docs, pairs.where("NOT kept"), keys)
    twins = pairs.where("kept AND n > 1").select(*keys)
    if twins.isEmpty():
        return rest
    names = {f"__twin_{i}": k for i, k in enumerate(keys)}
    named = docs.withColumns({n: keys[k] for n, k in names.items()})
    wanted = settle(twins.select(*[F.col(k).alias(f"{n}_of") for n, k in names.items()]), "twins")
    same = [named[n].eqNullSafe(wanted[f"{n}_of"]) for n in names]
    tied = named.join(broadcast_if_small(wanted, BROADCAST_KEYS), same, "left_semi").dropDuplicates(list(names))
    return without_rows(rest, twins, keys).unionByName(tied.drop(*names))
