from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quipu.functions import morphology
from quipu.plans import jobs


def one_by_one(word, rules, exceptions):
    if word is None or word in exceptions:
        return exceptions.get(word)
    for suffix, base, stem in sorted(rules, key=lambda r: -len(r[0])):
        if word.endswith(suffix) and len(word) - len(suffix) >= stem:
            return word[: len(word) - len(suffix)] + base
    return word


WORDS = [
    *morphology.SPANISH_EXCEPTIONS, "educaciones", "luces", "docentes", "niñas", "libros", "as", "más", "mes", "es", "ces", "iones",
    "actividades", "tutores", "leyes", "clases", "juguetes", "sol", "", "x", None, "s" * 5000 + "os",
]


@pytest.mark.parametrize("rules", [morphology.SPANISH_PLURALS, (("s", "", 1), ("ss", "ss", 0)), ()])
@pytest.mark.parametrize("exceptions", [morphology.SPANISH_EXCEPTIONS, {}])
def test_lemmas_equal_the_rules_one_by_one(spark, rules, exceptions):
    df = spark.createDataFrame([(WORDS,), ([],), (None,)], "w array<string>")
    got = [r.l for r in df.select(morphology.lemmas(F.col("w"), rules, exceptions).alias("l")).collect()]
    assert got == [[one_by_one(w, rules, exceptions) for w in WORDS], [], None]


def test_common_plurals(spark):
    pairs = {"educaciones": "educación", "luces": "luz", "docentes": "docente", "actividades": "actividad", "tutores": "tutor", "lunes": "lunes"}
    df = spark.createDataFrame([(w,) for w in pairs], "w string")
    assert {r.w: r.l for r in df.select("w", morphology.lemma(F.col("w")).alias("l")).collect()} == pairs


def test_the_topics_job_uses_base_forms(spark):
    posts = spark.createDataFrame([(i, f"las actividades de los docentes {i % 3}") for i in range(12)], "post long, message string")
    out, _ = jobs.topics_job(posts, "message", ["post"], ["las", "de", "los"])
    assert {r.clean_message[:-2] for r in out.collect()} == {"actividad docente"}
    plain, _ = jobs.topics_job(posts, "message", ["post"], ["las", "de", "los"], rules=None)
    assert {r.clean_message[:-2] for r in plain.collect()} == {"actividades docentes"}
