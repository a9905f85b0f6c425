"""Base forms of words by suffix rules and exceptions, as column expressions.

Rules are tried from the longest suffix to the shortest; the first whose suffix ends the
word, and leaves a stem of the least length, replaces it.  Exceptions go first.  Words no
rule fits, and null, stay as they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, str, int]

#: Spanish plurals, as suffix, what stands for it, and the least stem before it.
SPANISH_PLURALS: tuple[Rule, ...] = (
    ("iones", "ión", 1),
    ("ces", "z", 2),
    ("ales", "al", 2),
    ("eles", "el", 2),
    ("iles", "il", 2),
    ("oles", "ol", 2),
    ("ares", "ar", 2),
    ("eres", "er", 2),
    ("ores", "or", 2),
    ("ades", "ad", 2),
    ("udes", "ud", 2),
    ("anes", "án", 3),
    ("enes", "en", 2),
    ("eyes", "ey", 1),
    ("as", "a", 2),
    ("es", "e", 3),
    ("os", "o", 2),
)
#: Spanish words that end like plurals or whose plural follows no rule.
SPANISH_EXCEPTIONS: dict[str, str] = {
    "análisis": "análisis",
    "antes": "antes",
    "campus": "campus",
    "crisis": "crisis",
    "después": "después",
    "énfasis": "énfasis",
    "entonces": "entonces",
    "gracias": "gracias",
    "hipótesis": "hipótesis",
    "jueves": "jueves",
    "jóvenes": "joven",
    "lunes": "lunes",
    "martes": "martes",
    "menos": "menos",
    "meses": "mes",
    "miércoles": "miércoles",
    "países": "país",
    "síntesis": "síntesis",
    "tesis": "tesis",
    "veces": "vez",
    "viernes": "viernes",
}


def by_length(rules: Sequence[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda r: -len(r[0]))


def lemma(word: Column, rules: Sequence[Rule] = SPANISH_PLURALS, exceptions: Mapping[str, str] = SPANISH_EXCEPTIONS) -> Column:
    """The base form of one word."""
    found: Column | None = None
    for form, base in exceptions.items():
        found = F.when(word == form, F.lit(base)) if found is None else found.when(word == form, F.lit(base))
    for suffix, base, stem in by_length(rules):
        fits = word.endswith(suffix) & (F.char_length(word) >= stem + len(suffix))
        made = F.concat(F.substr(word, F.lit(1), F.char_length(word) - len(suffix)), F.lit(base))
        found = F.when(fits, made) if found is None else found.when(fits, made)
    return word if found is None else found.otherwise(word)


def lemmas(
    tokens: Column, rules: Sequence[Rule] = SPANISH_PLURALS, exceptions: Mapping[str, str] = SPANISH_EXCEPTIONS
) -> Column:
    """The base forms of an array of words, in order."""
    return F.transform(tokens, lambda w: lemma(w, rules, exceptions))
