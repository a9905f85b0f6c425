"""Text cleaning, vocabularies, tf-idf and topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from quipu.functions import morphology, text
from quipu.functions.apply import apply_text, strip_accents
from quipu.operators import textmine, topics
from quipu.plans import fixtures as fx
from quipu.plans import jobs
from quipu.plans.registry import query
from quipu.session import on_all_tasks, scratch_path, settle
from quipu.sources.tables import read_table

# Words that the invented prose of the fixtures contains, for spans that are found.
FIXTURE_KEYWORDS = ["que la", "the", "und", "les"]


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(words)) if w) + "]"


W = r"[\p{L}\p{N}_]"
SQL_CLEAN = r"regexp_replace(lower({}), '[^\p{{L}}\p{{N}}_\s]', '', 'g')"
SQL_TERMS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]{{2,}}')"
_FORUM = sql_list(text.spanish_stop_words() + text.FORUM_STOP_WORDS)
SQL_POST_TOKENS = f"""{fx.SQL_POSTS},
tokens AS (SELECT conv_id, turn, conv_id || '-' || turn AS post,
    list_filter(regexp_split_to_array({SQL_CLEAN.format('message')}, '\\s+'),
                lambda w: w <> '' AND NOT list_contains({_FORUM}, w)) AS tokens FROM posts)"""


def post_key():
    return F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("post")


def forum_stop_words() -> list[str]:
    return text.spanish_stop_words() + text.FORUM_STOP_WORDS


@query("clean_text", f"SELECT doc_id, {SQL_CLEAN.format('text')} AS clean FROM documents")
def _(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    return docs.select("doc_id", text.clean_text(F.col("text")).alias("clean"))


@query("clean_letters", r"SELECT doc_id, regexp_replace(text, '[^a-zA-Z\sñÑáéíóúÁÉÍÓÚ]', '', 'g') AS clean FROM documents")
def _(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    return docs.select("doc_id", text.clean_letters(F.col("text")).alias("clean"))


SQL_KEEP_STOPS = r"lower(regexp_replace(regexp_replace({}, '[^\p{{L}}\p{{N}}_\s.,]', '', 'g'), '\n', ' ', 'g'))"


@query("clean_keep_stops", f"SELECT doc_id, {SQL_KEEP_STOPS.format('text')} AS clean FROM documents")
def _(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    return docs.select("doc_id", text.clean_keep_stops(F.col("text")).alias("clean"))


@query("item_text", "SELECT p_partkey AS item_id, concat_ws(' ', p_name, nullif(p_type, 'PROMO'), p_brand) AS txt FROM part")
def _(spark, d):
    part = read_table(spark, d, "part", ["p_partkey", "p_name", "p_type", "p_brand"])
    fields = [F.col("p_name"), F.nullif("p_type", F.lit("PROMO")), F.col("p_brand")]
    return part.select(F.col("p_partkey").alias("item_id"), text.join_fields(*fields).alias("txt"))


_QUESTIONS = {**text.QUESTION_KEYWORDS, "common": FIXTURE_KEYWORDS}


def _span_sql(keywords) -> str:
    at = "CASE " + " ".join(f"WHEN strpos(t, '{k}') > 0 THEN strpos(t, '{k}')" for k in keywords) + " END"
    tail = f"substr(t, {at})"
    return (
        f"CASE WHEN ({at}) IS NULL THEN 'NO' WHEN strpos({tail}, '.') > 0 "
        f"THEN substr({tail}, 1, strpos({tail}, '.')) ELSE {tail} END"
    )


_SPANS = ", ".join(f"{_span_sql(k)} AS {name}" for name, k in _QUESTIONS.items())
SQL_SPANS = f"""{fx.SQL_POSTS}, clean AS (SELECT conv_id, turn, {SQL_KEEP_STOPS.format('message')} AS t FROM posts),
spans AS (SELECT conv_id, turn, {_SPANS} FROM clean)"""


def _spans(spark, d):
    clean = fx.posts(spark, d).select("conv_id", "turn", text.clean_keep_stops(F.col("message")).alias("t"))
    return clean.select("conv_id", "turn", *[text.keyword_span(F.col("t"), k).alias(n) for n, k in _QUESTIONS.items()])


@query("keyword_span", f"WITH {SQL_SPANS} SELECT * FROM spans")
def _(spark, d):
    return _spans(spark, d)


@query(
    "keyword_coverage",
    f"WITH {SQL_SPANS} "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS question, count(*) AS n_posts, count(*) FILTER (WHERE {n} <> 'NO') AS n_answered, "
        f"round(100 * avg(({n} <> 'NO')::INT), 6) AS pct FROM spans"
        for n in _QUESTIONS
    ),
)
def _(spark, d):
    cells = [
        F.struct(
            F.lit(n).alias("question"),
            F.count(F.lit(1)).alias("n_posts"),
            F.count_if(F.col(n) != "NO").alias("n_answered"),
            F.round(100 * F.avg((F.col(n) != "NO").cast("int")), 6).alias("pct"),
        )
        for n in _QUESTIONS
    ]
    return _spans(spark, d).agg(F.array(*cells).alias("rows")).select(F.inline("rows"))


@query("apply_scalar_udf", "SELECT doc_id, strip_accents(text) AS plain FROM documents")
def _(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    return docs.select("doc_id", apply_text(F.col("text"), strip_accents).alias("plain"))


@query("size_class", "SELECT doc_id, CASE WHEN length(text) > 1000 THEN 'long' ELSE 'short' END AS size_class FROM documents")
def _(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    return docs.select("doc_id", F.when(F.char_length("text") > 1000, "long").otherwise("short").alias("size_class"))


@query("tokens_clean", f"WITH {SQL_POST_TOKENS} SELECT conv_id, turn, array_to_string(tokens, ' ') AS tokens FROM tokens")
def _(spark, d):
    tokens = topics.forum_tokens(fx.posts(spark, d), "message", forum_stop_words())
    return tokens.select("conv_id", "turn", F.array_join("tokens", " ").alias("tokens"))


SQL_LEMMAS = r"""lemmas AS (SELECT DISTINCT term AS form, left(term, length(term) - 1) AS lemma FROM (
    SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents)
  WHERE length(term) > 3 AND term LIKE '%s')"""


def _lemmas(spark, d):
    docs = read_table(spark, d, "documents", ["text"])
    forms = docs.select(F.explode(text.terms(F.col("text"))).alias("form")).distinct()
    plural = forms.where((F.length("form") > 3) & F.col("form").endswith("s"))
    return plural.select("form", F.expr("left(form, length(form) - 1)").alias("lemma"))


@query(
    "lemma_lookup",
    f"""WITH {SQL_POST_TOKENS}, {SQL_LEMMAS}, w AS (SELECT post, unnest(tokens) AS term FROM tokens)
        SELECT post, coalesce(lemma, term) AS term, count(*) AS tf FROM w LEFT JOIN lemmas ON term = form GROUP BY ALL""",
)
def _(spark, d):
    tokens = topics.forum_tokens(fx.posts(spark, d), "message", forum_stop_words()).select(post_key(), "tokens")
    counts = textmine.term_counts(tokens, "post", F.col("tokens"))
    return textmine.replace_lemmas(counts, _lemmas(spark, d), "post")


_SQL_RULES = " ".join(
    [f"WHEN w = '{form}' THEN '{base}'" for form, base in morphology.SPANISH_EXCEPTIONS.items()]
    + [
        f"WHEN w LIKE '%{suffix}' AND length(w) >= {stem + len(suffix)} THEN left(w, length(w) - {len(suffix)}) || '{base}'"
        for suffix, base, stem in morphology.by_length(morphology.SPANISH_PLURALS)
    ]
)


@query(
    "lemma_rules",
    f"""WITH {SQL_POST_TOKENS} SELECT conv_id, turn,
          array_to_string(list_transform(tokens, lambda w: CASE {_SQL_RULES} ELSE w END), ' ') AS lemmas FROM tokens""",
)
def _(spark, d):
    tokens = topics.forum_tokens(fx.posts(spark, d), "message", forum_stop_words())
    return tokens.select("conv_id", "turn", F.array_join(morphology.lemmas(F.col("tokens")), " ").alias("lemmas"))


@query(
    "bag_of_words",
    f"""WITH {SQL_POST_TOKENS}, w AS (SELECT post, unnest(tokens) AS term FROM tokens),
        c AS (SELECT post, term, count(*) AS tf FROM w WHERE length(term) > 1 GROUP BY ALL),
        v AS (SELECT term FROM c GROUP BY 1 ORDER BY sum(tf) DESC, term LIMIT 500)
        SELECT post, term, tf FROM c WHERE term IN (SELECT term FROM v)""",
)
def _(spark, d):
    posts = topics.as_terms(topics.forum_tokens(fx.posts(spark, d), "message", forum_stop_words())).select(post_key(), "terms")
    counts = textmine.term_counts(posts, "post", F.col("terms"))
    vocab = textmine.vocabulary(counts, posts, max_features=500)
    return counts.join(vocab.select("term"), "term", "left_semi").select("post", "term", "tf")


_STOP = sql_list(text.spanish_stop_words() + text.RESOURCE_STOP_WORDS)
SQL_DOC_TOKENS = f"""t AS (SELECT doc_id, list_filter({SQL_TERMS.format('text')}, lambda w: NOT list_contains({_STOP}, w)) AS t FROM documents)"""


def _doc_tokens(spark, d):
    """The documents and the expression of their tokens."""
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    return docs, text.without(text.terms(F.col("text")), text.spanish_stop_words() + text.RESOURCE_STOP_WORDS)


def _runs_sql(largest: int) -> str:
    at = [f"lead(term, {n}) OVER (PARTITION BY doc_id ORDER BY i)" for n in range(1, largest)]
    longer = [" || ' ' || ".join(["term", *[f"n{k}" for k in range(1, n)]]) for n in range(2, largest + 1)]
    named = ", ".join(f"{a} AS n{i + 1}" for i, a in enumerate(at))
    parts = ["SELECT doc_id, term FROM x"] + [f"SELECT doc_id, {e} FROM x WHERE n{i + 1} IS NOT NULL" for i, e in enumerate(longer)]
    return f"""x AS (SELECT *, {named} FROM (SELECT doc_id, unnest(t) AS term, generate_subscripts(t, 1) AS i FROM t)),
g AS ({' UNION ALL '.join(parts)})"""


@query(
    "ngram_counts",
    f"""WITH {SQL_DOC_TOKENS}, {_runs_sql(3)}
        SELECT term, count(DISTINCT doc_id) AS df, count(*) AS total FROM g GROUP BY 1 HAVING count(DISTINCT doc_id) >= 5""",
)
def _(spark, d):
    docs, tokens = _doc_tokens(spark, d)
    counts = textmine.term_counts(docs, "doc_id", tokens, (1, 3))
    return textmine.vocabulary(counts, docs, min_df=5)


@query(
    "vocab_pruned",
    f"""WITH {SQL_DOC_TOKENS}, {_runs_sql(2)}
        SELECT term, count(DISTINCT doc_id) AS df, count(*) AS total FROM g GROUP BY 1
        HAVING count(DISTINCT doc_id) >= 5 AND count(DISTINCT doc_id) <= 0.7 * (SELECT count(*) FROM documents)
        ORDER BY total DESC, term LIMIT 500""",
)
def _(spark, d):
    docs, tokens = _doc_tokens(spark, d)
    counts = textmine.term_counts(docs, "doc_id", tokens, (1, 2))
    return textmine.vocabulary(counts, docs, 5, 0.7, 500)


@query(
    "tfidf",
    f"""WITH {SQL_DOC_TOKENS}, n AS (SELECT count(*) AS n FROM documents),
        c AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM t) GROUP BY ALL),
        v AS (SELECT term, count(*) AS df FROM c GROUP BY 1 HAVING count(*) >= 5 AND count(*) <= 0.7 * (SELECT n FROM n)),
        r AS (SELECT doc_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS raw FROM c JOIN v USING (term), n)
        SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM r""",
)
def _(spark, d):
    docs, tokens = _doc_tokens(spark, d)
    counts = settle(textmine.term_counts(docs, "doc_id", tokens), "terms")
    vocab = textmine.vocabulary(counts, docs, 5, 0.7)
    return textmine.tfidf(counts, vocab, docs, "doc_id").withColumn("weight", F.round("weight", 6))


@query(
    "word_freq",
    f"""WITH {fx.SQL_POSTS} SELECT term, count(*) AS n FROM (SELECT unnest({SQL_TERMS.format('message')}) AS term FROM posts)
        WHERE NOT list_contains({sql_list(text.spanish_stop_words() + text.CLOUD_STOP_WORDS)}, term)
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 200""",
)
def _(spark, d):
    kept = text.without(text.terms(F.col("message")), text.spanish_stop_words() + text.CLOUD_STOP_WORDS)
    return textmine.word_frequency(fx.posts(spark, d), kept, 200)


# --- topics ------------------------------------------------------------------


def _topic_tokens(spark, d):
    posts = on_all_tasks(fx.posts(spark, d), topics.SMALL)
    return settle(topics.forum_tokens(posts, "message", forum_stop_words()), "tokens")


@query("topic_model")
def _(spark, d):
    tokens = _topic_tokens(spark, d)
    model = topics.fit_topics(tokens)
    scored = topics.assign_topics(model, tokens)
    return scored.groupBy("topic").agg(F.count(F.lit(1)).alias("n_posts"))


@query("topic_terms")
def _(spark, d):
    return topics.topic_terms(topics.fit_topics(_topic_tokens(spark, d)), 10)


@query("topic_assign")
def _(spark, d):
    tokens = _topic_tokens(spark, d)
    return topics.assign_topics(topics.fit_topics(tokens), tokens).select("conv_id", "turn", "distribution", "topic")


@query("model_roundtrip")
def _(spark, d):
    tokens = _topic_tokens(spark, d)
    path = scratch_path(spark, "model")
    topics.save_model(topics.fit_topics(tokens), path)
    return topics.assign_topics(topics.load_model(path), tokens).select("conv_id", "turn", "topic")


@query("model_roundtrip_same", f"WITH {fx.SQL_POSTS} SELECT count(*) AS n_posts, 0::BIGINT AS n_changed FROM posts")
def _(spark, d):
    tokens = _topic_tokens(spark, d)
    path = scratch_path(spark, "model")
    model = topics.fit_topics(tokens)
    topics.save_model(model, path)
    keys = ["conv_id", "turn", "topic", "distribution"]
    before = topics.assign_topics(model, tokens).select(*keys, F.lit(1).alias("sign"))
    after = topics.assign_topics(topics.load_model(path), tokens).select(*keys, F.lit(-1).alias("sign"))
    sums = before.unionByName(after).groupBy(*keys).agg(F.sum("sign").alias("change"), F.count_if(F.col("sign") > 0).alias("n"))
    return sums.agg(F.sum("n").alias("n_posts"), F.count_if(F.col("change") != 0).alias("n_changed"))


@query("topics_batch")
def _(spark, d):
    posts = fx.posts(spark, d)
    out, _ = jobs.topics_job(posts, "message", ["conv_id", "turn", "role"], forum_stop_words())
    return out
