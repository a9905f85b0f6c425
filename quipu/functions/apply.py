"""User functions that no built-in expresses, run over whole Arrow batches."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def apply_text(value: Column, function: Callable[[str], str]) -> Column:
    """``function`` of every text; null stays null.  Equal texts of a batch are computed once."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            known = batch.dictionary_encode()
            made = pa.array([None if t is None else function(t) for t in known.dictionary.to_pylist()], pa.string())
            yield made.take(known.indices)

    return run(value)


def strip_accents(text: str) -> str:
    """Letters without their accents."""
    return "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")
