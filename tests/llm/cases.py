"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHING = "row long, digest string, kept boolean, fp long, `a.b` string, w string, block long, size long, score double"


def texts(seed: int = 0, n: int = 60) -> list[str | None]:
    rng = random.Random(seed)
    words = [a + b for a in ("the", "on", "er", "é", "Th", "MIX") for b in ("", "an", "ing", "ß", "7")]
    out: list[str | None] = []
    for _ in range(n):
        out.append(" ".join(rng.choice(words) for _ in range(rng.randint(5, 60))).capitalize() + ".")
    out += [out[0], out[0], out[1].upper(), None, None, "", "   ", "one", "Two words", "\n", "日本語 テキスト", "a" * 5000]
    out.append("long " * 30_000 + "end")
    return out


def documents(spark: SparkSession, seed: int = 0, repeated: bool = True, extra: bool = True) -> DataFrame:
    rows = [(i * 3 % 997, t, "en", "src", len(t or "")) for i, t in enumerate(texts(seed))]
    if repeated:
        rows += [rows[2], rows[2], (None, "no id", None, None, None), (None, "no id", None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    return with_clashes(df) if extra else df


def with_clashes(df: DataFrame) -> DataFrame:
    nulls = [f"CAST(NULL AS {c.rsplit(' ', 1)[1]}) AS {c.rsplit(' ', 1)[0]}" for c in CLASHING.split(", ")]
    return df.selectExpr("*", *nulls)


def lower_ascii(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
