"""Text expressions. All run inside the JVM on whole texts."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from importlib import resources

from pyspark.sql import Column
from pyspark.sql import functions as F

# Domain words dropped from forum posts besides the Spanish stop words.
FORUM_STOP_WORDS = [
    "buenas", "buenos", "dias", "tardes", "tengo", "espero", "ie", "auala", "aula", "traves", "tener",
    "promuevo", "promover", "democracia", "intercultural", "convivencia", "áreas", "competencia",
    "desarrollo", "lectura", "leer", "lectora", "desarrollar", "realizar", "hacer", "curricular",
    "diverso", "diferente", "noches", "estimada", "estimadas",
]
# Extra stop words of the word-frequency table and of the resource vectors.
CLOUD_STOP_WORDS = ["aula", "curso"]
RESOURCE_STOP_WORDS = ["yine"]

# Keywords of the three forum questions, in the order in which they are tried.
QUESTION_KEYWORDS = {
    "pre1": [
        "expectativa", "expectativas", "espectativas", "espectativa", "fortalecer", "deseo", "desearia",
        "contento", "contenta", "tengo", "estoy", "espero", "entusiasmada", "entusiasmado", "me interesa",
        "pretendo", "aprender", "permitirá", "permitir", "reforzar", "adquirir",
    ],
    "pre2": ["promuevo", "promoviendo", "convivencia", "democrática", "intercultural"],
    "pre3": [
        "desarrollo", "competencia", "organizo", "competencia lectora", "curriculares", "comprensión", "lectura",
    ],
}

WORD = r"[\p{L}\p{N}_]"


@functools.cache
def _word_list(name: str) -> tuple[str, ...]:
    lines = resources.files("quipu.functions").joinpath(name).read_text("utf-8").splitlines()
    return tuple(line for line in lines if line and not line.startswith("#"))


def spanish_stop_words() -> list[str]:
    """The packaged public list; neither a session nor Spark's own files are needed."""
    return list(_word_list("spanish_stop_words.txt"))


def strip_punctuation(text: Column) -> Column:
    """Keep letters, digits, underscore and blanks."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}_\s]", "")


def clean_text(text: Column) -> Column:
    return strip_punctuation(F.lower(text))


def clean_letters(text: Column) -> Column:
    """Keep Latin letters with the Spanish accents, and blanks."""
    return F.regexp_replace(text, r"[^a-zA-Z\sñÑáéíóúÁÉÍÓÚ]", "")


def clean_keep_stops(text: Column) -> Column:
    """Lower-case on one line, with full stops and commas kept."""
    kept = F.regexp_replace(text, r"[^\p{L}\p{N}_\s.,]", "")
    return F.lower(F.regexp_replace(kept, "\n", " "))


def join_fields(*fields: Column) -> Column:
    """One text from several fields; a missing field counts as empty."""
    return F.concat_ws(" ", *fields)


def words(clean: Column) -> Column:
    """Blank-separated words of a text whose punctuation is already gone."""
    return F.filter(F.split(clean, r"\s+"), lambda w: w != "")


def terms(text: Column) -> Column:
    """Lower-case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD}{{2,}})"), F.lit(1))


def without(tokens: Column, stop_words: Sequence[str]) -> Column:
    """Drop the given words and keep repeats of all others."""
    return F.filter(tokens, lambda w: ~w.isin(sorted(set(stop_words))))


def ngrams(tokens: Column, smallest: int, largest: int) -> Column:
    """All runs of ``smallest`` to ``largest`` consecutive tokens.

    Runs of n are runs of n - 1 zipped with the tokens n - 1 places on.
    """
    runs, out = tokens, []
    for n in range(1, largest + 1):
        if n > 1:
            count = F.greatest(F.size(tokens) - F.lit(n - 1), F.lit(0))
            heads, tails = F.slice(runs, F.lit(1), count), F.slice(tokens, F.lit(n), count)
            runs = F.zip_with(heads, tails, lambda a, b: F.concat_ws(" ", a, b))
        if n >= smallest:
            out.append(runs)
    return F.concat(*out)


def keyword_span(text: Column, keywords: Sequence[str]) -> Column:
    """From the first listed keyword found through the next full stop, else "NO".

    Keywords are tried in list order, not in text order; without a later full
    stop the span runs to the end.
    """
    lowered = F.lower(text)
    start = F.coalesce(*[F.nullif(F.locate(k, lowered), F.lit(0)) for k in keywords])
    stop = F.call_function("locate", F.lit("."), text, start)
    length = F.when(stop > 0, stop - start + 1).otherwise(F.length(text))
    return F.coalesce(F.substr(text, start, length), F.lit("NO"))
