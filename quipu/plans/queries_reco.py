"""Recommendation, similarity, evaluation and segmentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from quipu.functions import text
from quipu.operators import cluster, evaluate, factorize, joins, prep, recommend, silhouette, similarity, textmine
from quipu.plans import fixtures as fx
from quipu.plans import jobs
from quipu.plans.registry import query
from quipu.session import settle
from quipu.sources.tables import read_table

N_NEGATIVES = 50  # fixed value: sampled negatives per held-out pair


def r6(col):
    return F.round(col, 6)


def item_tokens():
    return text.terms(text.join_fields(F.col("name"), F.col("kind"), F.col("brand")))


def _long_score(df):
    return df.withColumn("score", F.col("score").cast("bigint"))


# --- popularity --------------------------------------------------------------


@query(
    "popularity_coldstart",
    f"""WITH {fx.SQL_RATINGS}, p AS (SELECT item_id, sum(score) AS s FROM ratings GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)
        SELECT item_id, '00000001' AS user_id,
               round((s - (SELECT min(s) FROM p))::DOUBLE / nullif((SELECT max(s) - min(s) FROM p), 0), 6) AS score,
               '{fx.RUN_DATE}' AS run_date FROM p""",
)
def _(spark, d):
    best = recommend.cold_start(fx.ratings(spark, d), F.lit(fx.RUN_DATE))
    return best.withColumn("score", r6("score"))


@query(
    "popular_unseen",
    f"""WITH {fx.SQL_RATINGS}, p AS (SELECT item_id, sum(score)::DOUBLE AS score FROM ratings GROUP BY 1)
        SELECT user_id, item_id, score FROM (
          SELECT u.user_id, p.item_id, p.score,
                 row_number() OVER (PARTITION BY u.user_id ORDER BY p.score DESC, p.item_id) AS rank
          FROM (SELECT DISTINCT user_id FROM ratings) u, p
          WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = u.user_id AND r.item_id = p.item_id))
        WHERE rank <= 10""",
)
def _(spark, d):
    ratings = settle(fx.ratings(spark, d), "ratings")
    return recommend.popular_unseen(ratings, ratings, ratings, 10)


@query(
    "popular_resources",
    f"""WITH {fx.SQL_ACTIONS}, {fx.SQL_CATALOG}
        SELECT item_id, name, size, sum_views FROM (SELECT item_id, sum(views) AS sum_views FROM actions GROUP BY 1)
        JOIN catalog USING (item_id) ORDER BY size DESC, item_id LIMIT 5""",
)
def _(spark, d):
    top = recommend.most_downloaded(fx.actions(spark, d), fx.catalog(spark, d), "size")
    return top.select("item_id", "name", "size", "sum_views")


@query(
    "reco_enriched",
    f"""WITH {fx.SQL_RATINGS} SELECT user_id, item_id, score, rank, name, kind, brand FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM ratings)
        LEFT JOIN catalog USING (item_id) WHERE rank <= 3""",
)
def _(spark, d):
    top = recommend.top_per_user(_long_score(fx.ratings(spark, d)), 3)
    full = joins.enrich(top.withColumn("rank", F.col("rank").cast("bigint")), fx.catalog(spark, d))
    return full.select("user_id", "item_id", "score", "rank", "name", "kind", "brand")


# --- factorisation -----------------------------------------------------------


@query("svd_factors")
def _(spark, d):
    factors, _ = factorize.factorize(fx.ratings(spark, d), "score")
    return factors


@query("svd_scores")
def _(spark, d):
    ratings = settle(fx.ratings(spark, d), "ratings")
    factors, sigma = factorize.factorize(ratings, "score")
    users = settle(factorize.user_factors(ratings, "score", factors, len(sigma)), "users")
    return factorize.reconstruct(users, factors, len(sigma))


@query("svd_centered")
def _(spark, d):
    ratings = settle(fx.ratings(spark, d), "ratings")
    return factorize.predict_centered(ratings, "score", ratings)


@query("svd_recommend")
def _(spark, d):
    ratings = settle(fx.ratings(spark, d), "ratings")
    factors, sigma = factorize.factorize(ratings, "score")
    return factorize.recommend_all(ratings, "score", factors, len(sigma), fx.completions(spark, d), 3)


@query("reco_batch")
def _(spark, d):
    return jobs.recommend_job(
        fx.actions(spark, d), fx.catalog(spark, d), fx.completions(spark, d), fx.ACTION_ORDER, F.lit(fx.RUN_DATE).cast("date")
    )


@query(
    "reco_batch_counts",
    f"""WITH {fx.SQL_RATINGS}, rated AS (SELECT DISTINCT item_id FROM ratings),
        done AS (SELECT user_id, count(*) AS n FROM completions WHERE item_id IN (SELECT item_id FROM rated) GROUP BY 1),
        users AS (SELECT DISTINCT user_id FROM ratings),
        known AS (SELECT user_id::VARCHAR AS user_id, least(3, (SELECT count(*) FROM rated) - coalesce(n, 0))::BIGINT AS n_items
                  FROM users LEFT JOIN done USING (user_id))
        SELECT user_id, n_items, '{fx.RUN_DATE}' AS run_date FROM known WHERE n_items > 0
        UNION ALL SELECT '00000001', least(5, (SELECT count(*) FROM rated))::BIGINT, '{fx.RUN_DATE}'""",
)
def _(spark, d):
    out = jobs.recommend_job(
        fx.actions(spark, d), fx.catalog(spark, d), fx.completions(spark, d), fx.ACTION_ORDER, F.lit(fx.RUN_DATE).cast("date")
    )
    return out.groupBy("user_id", "run_date").agg(F.count_distinct("item_id").alias("n_items"))


# --- content -----------------------------------------------------------------

SQL_ITEM_VECTORS = f"""t AS (SELECT item_id, unnest(regexp_extract_all(lower(concat_ws(' ', name, kind, brand)), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM catalog),
c AS (SELECT item_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT count(*) AS n FROM catalog),
v AS (SELECT term, count(*) AS df FROM c GROUP BY 1 HAVING count(*) >= 5 AND count(*) <= 0.7 * (SELECT n FROM n)),
raw AS (SELECT item_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS raw FROM c JOIN v USING (term), n),
vec AS (SELECT item_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY item_id)) AS w FROM raw)"""


def _profile_sql(strength: str) -> str:
    return f"""sums AS (SELECT user_id, term, sum(({strength}) * w) AS s FROM ratings JOIN vec USING (item_id) GROUP BY 1, 2),
tot AS (SELECT user_id, sum({strength}) AS total FROM ratings GROUP BY 1),
mean_profile AS (SELECT user_id, term, s / total AS m FROM sums JOIN tot USING (user_id)),
profile AS (SELECT user_id, term, m / sqrt(sum(m * m) OVER (PARTITION BY user_id)) AS w FROM mean_profile)"""


def _vectors(spark, d):
    """Packed item vectors and the term of every position."""
    weights, vocab = similarity.item_weights(fx.catalog(spark, d), item_tokens())
    positions = settle(textmine.term_positions(vocab), "positions")
    return settle(textmine.pack(weights, positions, "item_id"), "vectors"), positions


@query(
    "user_profile_weighted",
    f"""WITH {fx.SQL_RATINGS}, {SQL_ITEM_VECTORS}, {_profile_sql('score')}
        SELECT user_id, term, round(w, 6) AS weight FROM profile""",
)
def _(spark, d):
    vectors, positions = _vectors(spark, d)
    profiles = similarity.user_profiles(fx.ratings(spark, d), vectors, "score", normalise=True)
    return profiles.join(positions, "pos").select("user_id", "term", r6("weight").alias("weight"))


@query(
    "user_profile_mean",
    f"""WITH {fx.SQL_RATINGS}, {SQL_ITEM_VECTORS}, {_profile_sql('1')}
        SELECT user_id, term, round(m, 6) AS weight FROM mean_profile""",
)
def _(spark, d):
    vectors, positions = _vectors(spark, d)
    profiles = similarity.user_profiles(fx.ratings(spark, d), vectors, None, normalise=False)
    return profiles.join(positions, "pos").select("user_id", "term", r6("weight").alias("weight"))


@query(
    "profile_top_tokens",
    f"""WITH {fx.SQL_RATINGS}, {SQL_ITEM_VECTORS}, {_profile_sql('score')}
        SELECT user_id, term, rank, round(w, 6) AS weight FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(w, 9) DESC, term) AS rank FROM profile) WHERE rank <= 10""",
)
def _(spark, d):
    vectors, positions = _vectors(spark, d)
    profiles = similarity.user_profiles(fx.ratings(spark, d), vectors, "score", normalise=True)
    top = similarity.top_terms(profiles, positions, 10)
    return top.select("user_id", "term", F.col("rank").cast("bigint").alias("rank"), r6("weight").alias("weight"))


SQL_CONTENT = """scored AS (SELECT p.user_id, i.item_id, sum(p.w * i.w) AS score FROM profile p JOIN vec i USING (term) GROUP BY 1, 2),
full_scores AS (
  SELECT u.user_id, c.item_id, coalesce(s.score, 0) AS score
  FROM (SELECT DISTINCT user_id FROM ratings) u CROSS JOIN catalog c LEFT JOIN scored s ON s.user_id = u.user_id AND s.item_id = c.item_id)"""


@query(
    "content_scores",
    f"""WITH {fx.SQL_RATINGS}, {SQL_ITEM_VECTORS}, {_profile_sql('score')}, {SQL_CONTENT}
        SELECT user_id, item_id, round(score, 6) AS score FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM full_scores)
        WHERE rank <= 10""",
)
def _(spark, d):
    vectors, _ = _vectors(spark, d)
    ratings = settle(fx.ratings(spark, d), "ratings")
    profiles = similarity.user_profiles(ratings, vectors, "score", normalise=True)
    best = similarity.content_recommend(profiles, vectors, 10, ratings, fx.catalog(spark, d))
    return best.withColumn("score", r6("score"))


@query(
    "content_recommend",
    f"""WITH {fx.SQL_RATINGS}, {SQL_ITEM_VECTORS}, {_profile_sql('1')}, {SQL_CONTENT}
        SELECT user_id, item_id, round(score, 6) AS score FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM full_scores f
          WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = f.user_id AND r.item_id = f.item_id))
        WHERE rank <= 5""",
)
def _(spark, d):
    vectors, _ = _vectors(spark, d)
    ratings = settle(fx.ratings(spark, d), "ratings")
    profiles = similarity.user_profiles(ratings, vectors, None, normalise=True)
    best = similarity.content_recommend(profiles, vectors, 5, ratings, fx.catalog(spark, d), seen=ratings)
    return best.withColumn("score", r6("score"))


# --- similar items -----------------------------------------------------------


@query(
    "item_cosine",
    f"""WITH {fx.SQL_CATALOG}, {SQL_ITEM_VECTORS},
        s AS (SELECT a.item_id, b.item_id AS neighbour, sum(a.w * b.w) AS score FROM vec a JOIN vec b USING (term)
              WHERE a.item_id <> b.item_id GROUP BY 1, 2),
        f AS (SELECT a.item_id, b.item_id AS neighbour, coalesce(score, 0) AS score
              FROM (SELECT DISTINCT item_id FROM vec) a JOIN (SELECT DISTINCT item_id FROM vec) b ON a.item_id <> b.item_id
              LEFT JOIN s ON s.item_id = a.item_id AND s.neighbour = b.item_id)
        SELECT item_id, neighbour, round(score, 6) AS score FROM (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, neighbour) AS rank FROM f)
        WHERE rank <= 10""",
)
def _(spark, d):
    vectors, _ = _vectors(spark, d)
    return similarity.neighbours(vectors, "item_id", 10).withColumn("score", r6("score"))


@query(
    "similar_to_item",
    f"""WITH {fx.SQL_PAIRS}, {fx.SQL_CATALOG}, {SQL_ITEM_VECTORS},
        top AS (SELECT item_id FROM pairs JOIN catalog USING (item_id) GROUP BY 1 ORDER BY sum(views) DESC, 1 LIMIT 1),
        s AS (SELECT b.item_id, sum(a.w * b.w) AS score FROM vec a JOIN vec b USING (term)
              WHERE a.item_id = (SELECT item_id FROM top) GROUP BY 1)
        SELECT v.item_id, round(coalesce(score, 0), 6) AS score FROM (SELECT DISTINCT item_id FROM vec) v LEFT JOIN s USING (item_id)
        WHERE v.item_id <> (SELECT item_id FROM top)""",
)
def _(spark, d):
    vectors, _ = _vectors(spark, d)
    valid = prep.members(fx.actions(spark, d).select("item_id", "views"), fx.catalog(spark, d), "item_id")
    top = valid.groupBy("item_id").agg(F.sum("views").alias("s")).orderBy(F.desc("s"), "item_id").first()
    return similarity.similar_to(vectors, "item_id", top["item_id"]).withColumn("score", r6("score"))


@query(
    "jaccard_items",
    f"""WITH {fx.SQL_CATALOG},
        s AS (SELECT a.item_id, b.item_id AS neighbour, (a.kind = b.kind)::INT + (a.brand = b.brand)::INT AS i
              FROM catalog a JOIN catalog b ON a.item_id <> b.item_id)
        SELECT item_id, neighbour, round(i / (4 - i), 6) AS score FROM (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY i DESC, neighbour) AS rank FROM s) WHERE rank <= 10""",
)
def _(spark, d):
    items = fx.catalog(spark, d)
    links = items.select("item_id", F.explode(F.array("kind", "brand")).alias("category"))
    sets = similarity.category_sets(links, "item_id", "category")
    return similarity.neighbours(sets, "item_id", 10, measure="jaccard").withColumn("score", r6("score"))


@query(
    "embedding_cosine_topk",
    """WITH s AS (SELECT a.vec_id, b.vec_id AS neighbour,
                 list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score
               FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
       SELECT vec_id, neighbour, round(score, 6) AS score FROM (
         SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(score, 9) DESC, neighbour) AS rank FROM s) WHERE rank <= 10""",
)
def _(spark, d):
    vectors = similarity.dense_unit(read_table(spark, d, "embeddings", ["vec_id", "embedding"]), "vec_id", "embedding")
    return similarity.neighbours(vectors, "vec_id", 10).withColumn("score", r6("score"))


# --- evaluation --------------------------------------------------------------

SQL_SPLIT = f"""{fx.SQL_RATINGS},
split AS (
  SELECT user_id, item_id, score,
    row_number() OVER (PARTITION BY user_id ORDER BY md5('29-' || user_id || '-' || item_id), item_id)
      <= (count(*) OVER (PARTITION BY user_id) * 30 + 50) // 100 AS is_test
  FROM ratings)"""

SQL_NEGATIVES = f"""{SQL_SPLIT},
items AS (SELECT item_id, row_number() OVER (ORDER BY ('0x' || substr(md5(item_id::VARCHAR), 1, 8))::BIGINT % 1024, item_id) - 1 AS pos FROM catalog),
total AS (SELECT count(*) AS m FROM items),
prime AS (
  SELECT m, min(p) AS p FROM (SELECT m, unnest(range(m, m + 500)) AS p FROM total) c
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT unnest(range(2, 2000)) AS q) f WHERE f.q * f.q <= c.p AND c.p % f.q = 0) GROUP BY m),
seen AS (SELECT user_id, count(*) AS n_seen FROM ratings GROUP BY 1),
test AS (
  SELECT t.user_id, t.item_id, least({N_NEGATIVES}, m - n_seen) AS need, n_seen, m, p,
    ('0x' || substr(md5('29-' || t.user_id || '-' || t.item_id), 1, 8))::BIGINT % p AS start,
    ('0x' || substr(md5('29-' || t.user_id || '-' || t.item_id), 9, 8))::BIGINT % (p - 1) + 1 AS step
  FROM split t JOIN seen USING (user_id), prime WHERE is_test),
walk AS (SELECT user_id, item_id, need, start, step, p, unnest(range(0, least(p, need + n_seen + p - m))) AS j FROM test),
negatives AS (
  SELECT user_id, item_id, negative, draw FROM (
    SELECT w.user_id, w.item_id, i.item_id AS negative, need,
           row_number() OVER (PARTITION BY w.user_id, w.item_id ORDER BY j) AS draw
    FROM walk w JOIN items i ON i.pos = (w.start + w.j * w.step) % w.p
    WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = w.user_id AND r.item_id = i.item_id))
  WHERE draw <= need)"""

SQL_HITS = f"""{SQL_NEGATIVES},
pop AS (SELECT item_id, sum(score) AS score FROM split WHERE NOT is_test GROUP BY 1),
ranked AS (
  SELECT t.user_id, t.item_id, own.score AS own,
    1 + count(*) FILTER (WHERE o.score > own.score OR (o.score = own.score AND o.item_id < t.item_id)) AS r
  FROM test t LEFT JOIN pop own ON own.item_id = t.item_id
  LEFT JOIN negatives g ON g.user_id = t.user_id AND g.item_id = t.item_id
  LEFT JOIN pop o ON o.item_id = g.negative GROUP BY ALL),
hits AS (
  SELECT user_id, item_id, CASE WHEN own IS NOT NULL THEN r END AS rank,
    CASE WHEN own IS NOT NULL AND r <= 5 THEN 1 ELSE 0 END AS hit_5,
    CASE WHEN own IS NOT NULL AND r <= 10 THEN 1 ELSE 0 END AS hit_10 FROM ranked)"""


def _split(spark, d):
    ratings = fx.ratings(spark, d).select("user_id", "item_id", F.col("score").cast("bigint").alias("score"))
    return evaluate.holdout_split(settle(ratings, "ratings"))


@query("holdout_split", f"WITH {SQL_SPLIT} SELECT user_id, item_id, score, is_test::INT AS is_test FROM split")
def _(spark, d):
    return _split(spark, d).withColumn("is_test", F.col("is_test").cast("int"))


@query("negative_samples", f"WITH {SQL_NEGATIVES} SELECT user_id, item_id, negative, draw FROM negatives")
def _(spark, d):
    split = settle(_split(spark, d), "split")
    drawn = evaluate.negative_samples(split.where("is_test"), split, fx.catalog(spark, d), N_NEGATIVES)
    return drawn.withColumn("draw", F.col("draw").cast("bigint"))


def _hits(spark, d):
    split, items = settle(_split(spark, d), "split"), fx.catalog(spark, d)
    test = split.where("is_test")
    negatives = evaluate.negative_samples(test, split, items, N_NEGATIVES, packed=True)
    return evaluate.hits(test, negatives, recommend.PopularityModel().fit(split.where("NOT is_test"), items))


@query("hits_at_k", f"WITH {SQL_HITS} SELECT user_id, item_id, rank, hit_5, hit_10 FROM hits")
def _(spark, d):
    return _hits(spark, d).withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "recall_per_user",
    f"""WITH {SQL_HITS} SELECT user_id, count(*) AS n_test, sum(hit_5)::BIGINT AS hits_5, sum(hit_10)::BIGINT AS hits_10,
          round(sum(hit_5) / count(*), 6) AS recall_5, round(sum(hit_10) / count(*), 6) AS recall_10 FROM hits GROUP BY 1""",
)
def _(spark, d):
    out = evaluate.recall_per_user(_hits(spark, d))
    return out.withColumns({"recall_5": r6("recall_5"), "recall_10": r6("recall_10")})


@query(
    "recall_at_k",
    f"""WITH {SQL_HITS} SELECT 'popularity' AS model, count(*) AS n_test, round(sum(hit_5) / count(*), 6) AS recall_5,
          round(sum(hit_10) / count(*), 6) AS recall_10 FROM hits""",
)
def _(spark, d):
    out = evaluate.recall_global(_hits(spark, d), "popularity")
    return out.withColumns({"recall_5": r6("recall_5"), "recall_10": r6("recall_10")})


@query("model_comparison")
def _(spark, d):
    ratings = fx.ratings(spark, d).select("user_id", "item_id", "score")
    models = [recommend.PopularityModel(), recommend.FactorModel(), recommend.ContentModel(item_tokens())]
    return evaluate.compare(models, settle(ratings, "ratings"), fx.catalog(spark, d), N_NEGATIVES)


@query(
    "model_comparison_popularity",
    f"""WITH {SQL_HITS} SELECT 'popularity' AS model, count(*) AS n_test, round(sum(hit_5) / count(*), 6) AS recall_5,
          round(sum(hit_10) / count(*), 6) AS recall_10 FROM hits""",
)
def _(spark, d):
    ratings = settle(fx.ratings(spark, d).select("user_id", "item_id", "score"), "ratings")
    out = evaluate.compare([recommend.PopularityModel()], ratings, fx.catalog(spark, d), N_NEGATIVES)
    return out.withColumns({"recall_5": r6("recall_5"), "recall_10": r6("recall_10")})


@query(
    "rmse_known",
    f"""WITH {fx.SQL_RATINGS}, m AS (SELECT user_id, avg(score) AS m FROM ratings GROUP BY 1)
        SELECT count(*) AS n, round(sqrt(avg((score - m) ** 2)), 6) AS rmse FROM ratings JOIN m USING (user_id)""",
)
def _(spark, d):
    ratings = settle(fx.ratings(spark, d), "ratings")
    predicted = factorize.centered(ratings, "score").select("user_id", "item_id", F.col("user_mean").alias("score"))
    return evaluate.rmse(ratings, predicted).withColumn("rmse", r6("rmse"))


@query("rmse_factor_model")
def _(spark, d):
    ratings = settle(fx.ratings(spark, d).select("user_id", "item_id", "score"), "ratings")
    model = recommend.FactorModel().fit(ratings, fx.catalog(spark, d))
    return evaluate.rmse(ratings, model.score(ratings.select("user_id", "item_id"))).withColumn("rmse", r6("rmse"))


# --- segmentation ------------------------------------------------------------

FEATURES = [*fx.EVENT_TYPES, *[f"band_{q}" for q in fx.EVENT_TYPES]]
# Stored centres of a four-segment model over the ten standardised features.
CENTERS = [
    [-0.6, -0.6, -0.6, -0.6, -0.6, -0.7, -0.7, -0.7, -0.7, -0.7],
    [1.2, 0.1, -0.3, -0.2, 0.1, 1.1, 0.2, -0.4, -0.1, 0.0],
    [-0.2, 1.3, 0.1, -0.3, -0.1, -0.3, 1.2, 0.0, -0.2, 0.1],
    [0.0, -0.1, 0.9, 1.0, 0.8, 0.1, -0.2, 1.0, 0.9, 1.1],
]


def _band_sql(c: str) -> str:
    return f"CASE WHEN {c} > -2 AND {c} <= 0 THEN -1 WHEN {c} > 0 AND {c} <= 11 THEN 1 WHEN {c} > 11 AND {c} <= 20 THEN 2 END"


SQL_FEATURES = f"""{fx.SQL_GRADES},
wide AS (SELECT day, user_id, {', '.join(f"coalesce(avg(grade) FILTER (WHERE quiz = '{q}'), -1) AS {q}" for q in fx.EVENT_TYPES)}
         FROM grades GROUP BY 1, 2),
feats AS (SELECT *, {', '.join(f'{_band_sql(q)} AS band_{q}' for q in fx.EVENT_TYPES)} FROM wide),
st AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in FEATURES)} FROM feats),
z AS (SELECT feats.*, [{', '.join(f'({c} - m_{c}) / s_{c}' for c in FEATURES)}] AS v FROM feats, st),
dist AS (SELECT *, [{', '.join(f'list_distance(v, {c}::DOUBLE[])' for c in CENTERS)}] AS ds FROM z)"""


@query(
    "segment_batch",
    f"""WITH {SQL_FEATURES} SELECT day, user_id, {', '.join(f'round({q}, 6) AS {q}' for q in fx.EVENT_TYPES)},
          {', '.join(f'band_{q}' for q in fx.EVENT_TYPES)},
          list_position(ds, list_min(ds))::INT AS cluster, '{fx.RUN_DATE}' AS report_date FROM dist""",
)
def _(spark, d):
    out = jobs.segment_job(
        fx.grades(spark, d), ["day", "user_id"], fx.EVENT_TYPES, CENTERS, run_date=F.lit(fx.RUN_DATE)
    )
    return out.withColumns({q: r6(q) for q in fx.EVENT_TYPES})


def _standard_features(spark, d):
    table = settle(jobs.segment_features(fx.grades(spark, d), ["day", "user_id"], fx.EVENT_TYPES), "features")
    scaled = prep.standardize(table, FEATURES)
    return settle(scaled, "scaled"), [f"{c}_z" for c in FEATURES]


@query("kmeans_fit")
def _(spark, d):
    scaled, cols = _standard_features(spark, d)
    _, centers = cluster.best_centers(scaled, cols, [4])[4]
    vector = F.array(*[F.col(c) for c in cols])
    return scaled.select("day", "user_id", cluster.nearest_center(vector, centers).alias("cluster"))


@query("elbow_curve")
def _(spark, d):
    scaled, cols = _standard_features(spark, d)
    return cluster.elbow_curve(scaled, cols)


@query(
    "elbow_first",
    f"""WITH {SQL_FEATURES} SELECT 1::INT AS k, round(sum(list_sum(list_transform(v, lambda x: x * x))), 3) AS cost FROM z""",
)
def _(spark, d):
    scaled, cols = _standard_features(spark, d)
    return cluster.elbow_curve(scaled, cols, ks=[1], starts=1).withColumn("cost", F.round("cost", 3))


@query("cluster_comparison")
def _(spark, d):
    scaled, cols = _standard_features(spark, d)
    return cluster.compare_clusterings(scaled, "user_id", cols)


_EMB_CENTERS = [[(1.0 if i % 8 == j else -0.25) * 0.2 for i in range(64)] for j in range(4)]


@query(
    "nearest_center",
    f"""WITH x AS (SELECT vec_id, [{', '.join(f'list_distance(embedding::DOUBLE[], {c}::DOUBLE[])' for c in _EMB_CENTERS)}] AS ds FROM embeddings)
        SELECT vec_id, list_position(ds, list_min(ds))::INT AS cluster FROM x""",
)
def _(spark, d):
    vectors = read_table(spark, d, "embeddings", ["vec_id", "embedding"])
    as_double = F.transform("embedding", lambda x: x.cast("double"))
    return vectors.select("vec_id", cluster.nearest_center(as_double, _EMB_CENTERS).alias("cluster"))


@query(
    "cluster_profile",
    f"""WITH {SQL_FEATURES}, a AS (SELECT *, list_position(ds, list_min(ds))::INT AS cluster FROM dist)
        SELECT cluster, count(*) AS n, {', '.join(f'round(avg({q}), 6) AS mean_{q}' for q in fx.EVENT_TYPES)} FROM a GROUP BY 1""",
)
def _(spark, d):
    out = jobs.segment_job(fx.grades(spark, d), ["day", "user_id"], fx.EVENT_TYPES, CENTERS, run_date=F.lit(fx.RUN_DATE))
    prof = cluster.cluster_profile(out, "cluster", fx.EVENT_TYPES)
    return prof.withColumns({f"mean_{q}": r6(f"mean_{q}") for q in fx.EVENT_TYPES})


@query(
    "davies_bouldin",
    """WITH e AS (SELECT label, vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
       c AS (SELECT label, i, avg(x) AS m FROM e GROUP BY 1, 2),
       dd AS (SELECT label, vec_id, sqrt(sum((x - m) ** 2)) AS dist FROM e JOIN c USING (label, i) GROUP BY 1, 2),
       s AS (SELECT label, avg(dist) AS s FROM dd GROUP BY 1),
       m AS (SELECT a.label AS la, b.label AS lb, sqrt(sum((a.m - b.m) ** 2)) AS m FROM c a JOIN c b ON a.i = b.i AND a.label <> b.label GROUP BY 1, 2),
       w AS (SELECT la, max((x.s + y.s) / m) AS worst FROM m JOIN s x ON x.label = la JOIN s y ON y.label = lb GROUP BY 1)
       SELECT round(avg(worst), 6) AS davies_bouldin FROM w""",
)
def _(spark, d):
    vectors = read_table(spark, d, "embeddings", ["embedding", "label"])
    return cluster.davies_bouldin(vectors, "label", "embedding", 64).select(r6("davies_bouldin").alias("davies_bouldin"))


def _silhouette_sql(distance: str) -> str:
    return f"""WITH p AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
       n AS (SELECT label, count(*) AS n FROM p GROUP BY 1),
       t AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum({distance}) AS t FROM p a, p b GROUP BY 1, 2, 3),
       x AS (SELECT vec_id, max(CASE WHEN own = other THEN t / nullif(n - 1, 0) END) AS a, min(CASE WHEN own <> other THEN t / n END) AS b
             FROM t JOIN n ON n.label = other GROUP BY 1)
       SELECT round(avg(coalesce((b - a) / greatest(a, b), 0)), 6) AS silhouette FROM x"""


@query("silhouette_sq", _silhouette_sql("list_distance(a.e, b.e) ** 2"))
def _(spark, d):
    vectors = cluster.as_vector(read_table(spark, d, "embeddings", ["embedding", "label"]), "embedding")
    value = cluster.silhouette_squared(vectors, "features", "label")
    return vectors.agg(F.round(F.lit(value), 6).alias("silhouette"))


@query("silhouette_exact", _silhouette_sql("CASE WHEN a.vec_id = b.vec_id THEN 0 ELSE list_distance(a.e, b.e) END"))
def _(spark, d):
    vectors = read_table(spark, d, "embeddings", ["vec_id", "embedding", "label"])
    return cluster.silhouette_exact(vectors, "vec_id", "label", "embedding").select(r6("silhouette").alias("silhouette"))


@query("silhouette_interval")
def _(spark, d):
    scaled, cols = _standard_features(spark, d)
    points = scaled.select("day", "user_id", F.array(*[F.col(c) for c in cols]).alias("val"))
    _, centers = cluster.best_centers(scaled, cols, [4])[4]
    labelled = points.withColumn("cluster", cluster.nearest_center(F.col("val"), centers))
    return silhouette.silhouette_interval(labelled, "user_id", "cluster", "val", width=0.05)
