"""Sources, projections, filters, joins, aggregates, windows and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quipu.functions.scores import band
from quipu.operators import joins, prep, profile, recommend, reshape
from quipu.operators.indexing import dense_index
from quipu.plans import fixtures as fx
from quipu.plans.registry import query
from quipu.session import scratch_path
from quipu.sources import committed, sinks
from quipu.sources.tables import read_delimited, read_json, read_table


def r6(col):
    return F.round(col, 6)


# --- sources and sinks -------------------------------------------------------


@query("scan_project", "SELECT l_orderkey AS order_id, l_partkey AS item_id, l_quantity AS views FROM lineitem")
def _(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"]).withColumnsRenamed(
        {"l_orderkey": "order_id", "l_partkey": "item_id", "l_quantity": "views"}
    )


@query(
    "cross_source_join",
    """SELECT e.event_id, e.user_id, e.value, c.c_mktsegment AS segment
       FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey""",
)
def _(spark, d):
    grades = read_table(spark, d, "events", ["event_id", "user_id", "value"])
    people = read_table(spark, d, "customer", ["c_custkey", "c_mktsegment"])
    return grades.join(people, F.col("user_id") == F.col("c_custkey"), "left").select(
        "event_id", "user_id", "value", F.col("c_mktsegment").alias("segment")
    )


@query("scan_posts", f"WITH {fx.SQL_POSTS} SELECT * FROM posts")
def _(spark, d):
    return fx.posts(spark, d)


@query("export_roundtrip", f"WITH {fx.SQL_POSTS} SELECT conv_id, turn, message FROM posts")
def _(spark, d):
    path = scratch_path(spark, "export")
    sinks.export_delimited(fx.posts(spark, d).select("conv_id", "turn", "message"), path)
    schema = StructType(
        [StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("message", StringType())]
    )
    return read_delimited(spark, path, schema)


@query("export_lines_roundtrip", f"WITH {fx.SQL_POSTS} SELECT conv_id, turn, message FROM posts")
def _(spark, d):
    path = scratch_path(spark, "lines")
    posts = fx.posts(spark, d).select("conv_id", "turn", "message")
    sinks.export_lines(posts, path)
    return read_json(spark, path, posts.schema)


@query("full_refresh_sink", f"WITH {fx.SQL_PAIRS} SELECT item_id, count(*) AS n_users FROM pairs GROUP BY 1")
def _(spark, d):
    path = scratch_path(spark, "target")
    sinks.full_refresh(fx.pairs(spark, d).groupBy("item_id").agg(F.lit(0).cast("bigint").alias("n_users")), path)
    sinks.full_refresh(profile.item_support(fx.pairs(spark, d)), path)
    return sinks.read_current(spark, path)


@query("workbook_roundtrip", f"WITH {fx.SQL_POSTS} SELECT conv_id, turn, message FROM posts")
def _(spark, d):
    path = scratch_path(spark, "workbooks")
    posts = fx.posts(spark, d).select("conv_id", "turn", "message")
    committed.refresh(posts, path, "xlsx")
    return committed.read_refreshed(spark, path, posts.schema)


@query("committed_refresh", f"WITH {fx.SQL_PAIRS} SELECT item_id, count(*) AS n_users FROM pairs GROUP BY 1")
def _(spark, d):
    path = scratch_path(spark, "refreshed")
    support = profile.item_support(fx.pairs(spark, d))
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in support.schema.fields)
    committed.refresh(support.withColumn("n_users", F.lit(0).cast("bigint")), path, columns=columns)
    committed.refresh(support, path, columns=columns)
    return committed.read_refreshed(spark, path, support.schema)


# --- projections, filters, predicates ---------------------------------------


@query("filter_active", "SELECT p_partkey AS item_id, p_name AS name, p_retailprice AS price FROM part WHERE p_type <> 'PROMO' AND p_size >= 10")
def _(spark, d):
    part = read_table(spark, d, "part").where((F.col("p_type") != "PROMO") & (F.col("p_size") >= 10))
    return part.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"))


@query(
    "filter_in_notin",
    """SELECT event_id, user_id, event_type FROM events
       WHERE event_type IN ('click', 'view', 'purchase') AND user_id NOT IN (2, 3, 19797, 276201) AND props <> ''""",
)
def _(spark, d):
    events = read_table(spark, d, "events", ["event_id", "user_id", "event_type", "props"])
    kept = events.where(
        F.col("event_type").isin("click", "view", "purchase")
        & ~F.col("user_id").isin(2, 3, 19797, 276201)
        & (F.col("props") != "")
    )
    return kept.select("event_id", "user_id", "event_type")


@query(
    "filter_not_null",
    "SELECT o_orderkey, o_custkey FROM orders WHERE nullif(o_orderpriority, '5-LOW') IS NOT NULL",
)
def _(spark, d):
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    return orders.where(F.nullif("o_orderpriority", F.lit("5-LOW")).isNotNull()).select("o_orderkey", "o_custkey")


@query("filter_null", "SELECT o_orderkey, o_custkey FROM orders WHERE nullif(o_orderpriority, '5-LOW') IS NULL")
def _(spark, d):
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    return orders.where(F.nullif("o_orderpriority", F.lit("5-LOW")).isNull()).select("o_orderkey", "o_custkey")


@query(
    "drop_null_rows",
    """SELECT * FROM (SELECT event_id, nullif(event_type, 'error') AS kind, nullif(user_id, 7) AS user_id FROM events)
       WHERE event_id IS NOT NULL AND kind IS NOT NULL AND user_id IS NOT NULL""",
)
def _(spark, d):
    events = read_table(spark, d, "events", ["event_id", "event_type", "user_id"])
    return events.select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("kind"), F.nullif("user_id", F.lit(7)).alias("user_id")
    ).dropna("any")


@query(
    "normalize_catalog",
    """SELECT upper(p_partkey::VARCHAR) AS p_partkey, upper(p_name) AS p_name, upper(p_brand) AS p_brand,
              coalesce(upper(nullif(p_type, 'PROMO')), 'NONE') AS p_type, upper(p_size::VARCHAR) AS p_size FROM part""",
)
def _(spark, d):
    part = read_table(spark, d, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    return prep.upper_all(part.withColumn("p_type", F.nullif("p_type", F.lit("PROMO"))), null_token="NONE")


@query("recode_flag", "SELECT doc_id, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS passed FROM labels")
def _(spark, d):
    return read_table(spark, d, "labels").select("doc_id", prep.recode(F.col("quality"), 1).alias("passed"))


_LINE_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
    "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


@query(
    "schema_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS column_type, count({c}) AS n_present FROM lineitem"
        for c, t in _LINE_TYPES.items()
    ),
)
def _(spark, d):
    return profile.schema_profile(read_table(spark, d, "lineitem"))


# --- joins -------------------------------------------------------------------

_ROLES = """FROM supplier s
  LEFT JOIN nation a ON s.s_nationkey = a.n_nationkey
  LEFT JOIN nation b ON s.s_suppkey % 25 = b.n_nationkey
  LEFT JOIN nation c ON (s.s_suppkey * 7) % 31 = c.n_nationkey
  LEFT JOIN nation e ON (s.s_nationkey + 1) % 25 = e.n_nationkey"""


def _supplier_roles(spark, d):
    supplier = read_table(spark, d, "supplier", ["s_suppkey", "s_nationkey"]).select(
        "s_suppkey",
        F.col("s_nationkey").alias("home_id"),
        (F.col("s_suppkey") % 25).alias("billing_id"),
        ((F.col("s_suppkey") * 7) % 31).alias("shipping_id"),
        ((F.col("s_nationkey") + 1) % 25).alias("next_id"),
    )
    dim = read_table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("description"))
    roles = {"home_id": "home", "billing_id": "billing", "shipping_id": "shipping", "next_id": "next_door"}
    return joins.lookup_joins(supplier, dim, roles).select("s_suppkey", *roles.values())


@query(
    "role_lookup",
    f"SELECT s_suppkey, a.n_name AS home, b.n_name AS billing, c.n_name AS shipping, e.n_name AS next_door {_ROLES}",
)
def _(spark, d):
    return _supplier_roles(spark, d)


@query(
    "role_lookup_filtered",
    f"""SELECT s_suppkey, a.n_name AS home, b.n_name AS billing, c.n_name AS shipping, e.n_name AS next_door {_ROLES}
        WHERE a.n_name <> 'NATION_3' AND c.n_name >= 'NATION_1'""",
)
def _(spark, d):
    return _supplier_roles(spark, d).where((F.col("home") != "NATION_3") & (F.col("shipping") >= "NATION_1"))


@query("completions", f"WITH {fx.SQL_ACTIONS}, {fx.SQL_COMPLETIONS} SELECT * FROM completions")
def _(spark, d):
    return fx.completions(spark, d)


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
       WHERE rn = 1 AND o_orderstatus = 'F'""",
)
def _(spark, d):
    orders = read_table(spark, d, "orders", ["o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice"])
    return prep.latest_with_status(orders, "o_custkey", "o_orderkey", "o_orderstatus", "F")


@query(
    "catalog_left_actions",
    f"""WITH {fx.SQL_PAIRS}, {fx.SQL_CATALOG}
        SELECT item_id, name, kind, user_id, views FROM catalog LEFT JOIN pairs USING (item_id)""",
)
def _(spark, d):
    catalog = fx.catalog(spark, d).select("item_id", "name", "kind")
    return joins.catalog_left_join(catalog, fx.pairs(spark, d), "item_id")


@query(
    "right_join_catalog",
    f"""WITH {fx.SQL_ACTIONS}, {fx.SQL_CATALOG}, m AS (SELECT item_id, avg(views) AS mean_views FROM actions GROUP BY 1)
        SELECT c.item_id, c.name, round(m.mean_views, 6) AS mean_views FROM m RIGHT JOIN catalog c ON m.item_id = c.item_id""",
)
def _(spark, d):
    means = fx.actions(spark, d).groupBy("item_id").agg(F.avg("views").alias("mean_views"))
    return means.join(fx.catalog(spark, d), "item_id", "right").select("item_id", "name", r6("mean_views").alias("mean_views"))


@query(
    "unique_pairs_only",
    f"""WITH {fx.SQL_ACTIONS}
        SELECT user_id, item_id, any_value(views) AS views FROM actions GROUP BY 1, 2 HAVING count(*) = 1""",
)
def _(spark, d):
    return prep.seen_once(fx.actions(spark, d).select("user_id", "item_id", "views"), ["user_id", "item_id"])


@query(
    "semi_valid_actions",
    f"""WITH {fx.SQL_ACTIONS}, {fx.SQL_CATALOG}
        SELECT user_id, item_id, views, l_orderkey, l_linenumber::BIGINT AS line FROM actions
        WHERE item_id IN (SELECT item_id FROM catalog)""",
)
def _(spark, d):
    rows = prep.members(fx.actions(spark, d), fx.catalog(spark, d), "item_id")
    return rows.select("user_id", "item_id", "views", "l_orderkey", F.col("l_linenumber").cast("bigint").alias("line"))


@query(
    "anti_completed",
    f"""WITH {fx.SQL_PAIRS}, {fx.SQL_COMPLETIONS}
        SELECT * FROM pairs p WHERE NOT EXISTS (
          SELECT 1 FROM completions c WHERE c.user_id = p.user_id AND c.item_id = p.item_id)""",
)
def _(spark, d):
    return prep.non_members(fx.pairs(spark, d), fx.completions(spark, d), ["user_id", "item_id"])


# --- aggregates --------------------------------------------------------------


@query("group_count", f"WITH {fx.SQL_ACTIONS} SELECT l_returnflag, status, count(*) AS n FROM actions GROUP BY ALL")
def _(spark, d):
    return profile.group_count(fx.actions(spark, d), ["l_returnflag", "status"])


@query(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def _(spark, d):
    return profile.duplicate_keys(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("popularity_sum", f"WITH {fx.SQL_ACTIONS} SELECT item_id, sum(views) AS sum_views FROM actions GROUP BY 1")
def _(spark, d):
    return fx.actions(spark, d).groupBy("item_id").agg(F.sum("views").alias("sum_views"))


@query(
    "popularity_mean",
    f"WITH {fx.SQL_ACTIONS} SELECT item_id, round(avg(views), 6) AS mean_views FROM actions GROUP BY 1",
)
def _(spark, d):
    return fx.actions(spark, d).groupBy("item_id").agg(r6(F.avg("views")).alias("mean_views"))


@query(
    "active_users",
    f"WITH {fx.SQL_ACTIONS} SELECT user_id, count(DISTINCT item_id) AS n_items FROM actions GROUP BY 1 HAVING count(DISTINCT item_id) >= 2",
)
def _(spark, d):
    return prep.users_with_items(fx.actions(spark, d))


@query(
    "active_users_rows",
    f"WITH {fx.SQL_ACTIONS} SELECT user_id, count(*) AS n_rows FROM actions GROUP BY 1 HAVING count(*) > 1",
)
def _(spark, d):
    return prep.users_with_rows(fx.actions(spark, d))


@query(
    "frequent_items",
    f"WITH {fx.SQL_ACTIONS} SELECT item_id, count(*) AS n_rows FROM actions GROUP BY 1 HAVING count(*) > 30",
)
def _(spark, d):
    return prep.frequent_items(fx.actions(spark, d), 30)


@query(
    "share_pct",
    "SELECT lang, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM documents GROUP BY 1",
)
def _(spark, d):
    return profile.share_pct(read_table(spark, d, "documents", ["lang"]), "lang").withColumn("pct", r6("pct"))


@query("distinct_values", "SELECT DISTINCT event_type, user_id FROM events")
def _(spark, d):
    return read_table(spark, d, "events", ["event_type", "user_id"]).distinct()


@query(
    "dataset_counts",
    f"""WITH {fx.SQL_ACTIONS}
        SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_user_id, count(DISTINCT item_id) AS n_item_id,
               count(*) FILTER (WHERE status = 'F') AS n_done FROM actions""",
)
def _(spark, d):
    return profile.dataset_counts(fx.actions(spark, d), {"n_done": F.col("status") == "F"}, ["user_id", "item_id"])


@query(
    "null_profile",
    """WITH t AS (SELECT event_id, nullif(event_type, 'error') AS event_type, nullif(user_id, 7) AS user_id FROM events)
       SELECT 'event_id' AS column_name, count(*) - count(event_id) AS n_null FROM t
       UNION ALL SELECT 'event_type', count(*) - count(event_type) FROM t
       UNION ALL SELECT 'user_id', count(*) - count(user_id) FROM t""",
)
def _(spark, d):
    events = read_table(spark, d, "events", ["event_id", "event_type", "user_id"])
    return profile.null_profile(
        events.withColumn("event_type", F.nullif("event_type", F.lit("error"))).withColumn(
            "user_id", F.nullif("user_id", F.lit(7))
        )
    )


_STATS = """count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std,
  min(l_extendedprice) AS min, max(l_extendedprice) AS max, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25,
  round(quantile_cont(l_extendedprice, 0.5), 4) AS q50, round(quantile_cont(l_extendedprice, 0.75), 4) AS q75"""


@query(
    "describe_by_group",
    f"""SELECT l_returnflag AS grp, {_STATS} FROM lineitem GROUP BY 1
        UNION ALL SELECT 'all', {_STATS} FROM lineitem""",
)
def _(spark, d):
    lines = read_table(spark, d, "lineitem", ["l_returnflag", "l_extendedprice"]).withColumnRenamed("l_returnflag", "grp")
    both = profile.describe(lines, "l_extendedprice", ["grp"]).unionByName(
        profile.describe(lines, "l_extendedprice").withColumn("grp", F.lit("all"))
    )
    return both.withColumns({c: F.round(c, 4) for c in ["mean", "std", "q25", "q50", "q75"]})


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS var_a, '{b}' AS var_b, round(corr({a}, {b}), 6) + 0.0 AS r FROM lineitem" for a in _CORR for b in _CORR
    ),
)
def _(spark, d):
    return profile.correlations(read_table(spark, d, "lineitem", _CORR), _CORR).withColumn("r", r6("r") + F.lit(0.0))


@query(
    "coverage_pct",
    """SELECT 'discounted' AS variable, round(100 * avg((l_discount > 0)::INT), 1) AS pct FROM lineitem
       UNION ALL SELECT 'returned', round(100 * avg((l_returnflag = 'R')::INT), 1) FROM lineitem
       UNION ALL SELECT 'repeated', round(100 * avg((l_quantity > 1)::INT), 1) FROM lineitem""",
)
def _(spark, d):
    lines = read_table(spark, d, "lineitem", ["l_discount", "l_returnflag", "l_quantity"])
    return profile.coverage(
        lines,
        {
            "discounted": F.col("l_discount") > 0,
            "returned": F.col("l_returnflag") == "R",
            "repeated": F.col("l_quantity") > 1,
        },
    )


@query(
    "histogram",
    """WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
       SELECT 'range' AS scope, event_type, least(floor(value * 10 / 120.0), 9)::INT AS bin, count(*) AS n
       FROM events WHERE value BETWEEN 0 AND 120 GROUP BY ALL
       UNION ALL
       SELECT 'full', 'all', least(floor((value - lo) * 20 / (hi - lo)), 19)::INT, count(*) FROM events, b GROUP BY ALL""",
)
def _(spark, d):
    events = read_table(spark, d, "events", ["event_type", "value"])
    ranged = profile.histogram(events, "value", 10, (0, 120), ["event_type"]).withColumn("scope", F.lit("range"))
    full = profile.histogram(events, "value", 20).withColumn("scope", F.lit("full")).withColumn("event_type", F.lit("all"))
    return ranged.unionByName(full).select("scope", "event_type", "bin", "n")


@query(
    "kde_grid",
    """WITH g AS (SELECT unnest(range(0, 56, 5))::DOUBLE AS x), c AS (SELECT l_quantity AS v, count(*) AS c FROM lineitem GROUP BY 1)
       SELECT x, round(sum(c * exp(-0.5 * ((x - v) / 2.5) ** 2)) / (2.5 * sqrt(2 * pi())) / (SELECT count(*) FROM lineitem), 9) AS density
       FROM g, c GROUP BY x""",
)
def _(spark, d):
    lines = read_table(spark, d, "lineitem", ["l_quantity"])
    return profile.kernel_density(lines, "l_quantity", range(0, 56, 5), 2.5).withColumn("density", F.round("density", 9))


@query(
    "matrix_sparsity",
    f"""WITH {fx.SQL_PAIRS}, c AS (
          SELECT count(*) AS n_cells, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items FROM pairs)
        SELECT *, round(1 - n_cells / (n_users::DOUBLE * n_items), 3) AS sparsity FROM c""",
)
def _(spark, d):
    return profile.sparsity(fx.pairs(spark, d))


@query("item_support", f"WITH {fx.SQL_PAIRS} SELECT item_id, count(*) AS n_users FROM pairs GROUP BY 1")
def _(spark, d):
    return profile.item_support(fx.pairs(spark, d))


@query(
    "user_mean_center",
    f"""WITH {fx.SQL_PAIRS}
        SELECT user_id, item_id, round(views - avg(views) OVER (PARTITION BY user_id), 6) + 0.0 AS centered FROM pairs""",
)
def _(spark, d):
    pairs = fx.pairs(spark, d)
    return pairs.join(profile.user_means(pairs, "views"), "user_id").select(
        "user_id", "item_id", (r6(F.col("views") - F.col("user_mean")) + F.lit(0.0)).alias("centered")
    )


@query(
    "region_rollup",
    f"""WITH {fx.SQL_ACTIONS}, {fx.SQL_PEOPLE}
        SELECT region, sum(views) AS views FROM actions JOIN people USING (user_id) WHERE region IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def _(spark, d):
    return profile.region_rollup(fx.actions(spark, d), fx.people(spark, d))


# --- windows, sorts, top-k, set operations ----------------------------------


@query(
    "topn_per_user",
    f"""WITH {fx.SQL_PAIRS} SELECT user_id, item_id, views AS score, rank FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY views DESC, item_id) AS rank FROM pairs) WHERE rank <= 3""",
)
def _(spark, d):
    scores = fx.pairs(spark, d).withColumnRenamed("views", "score")
    return recommend.top_per_user(scores, 3).withColumn("rank", F.col("rank").cast("bigint"))


def _dedupe_sql(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in _LINE_ORDER)
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1"""


_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _deduped(spark, d, keep):
    lines = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", *_LINE_ORDER])
    kept = prep.dedupe(lines, ["l_orderkey", "l_linenumber"], _LINE_ORDER, keep)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


@query("dedupe_last", _dedupe_sql("DESC"))
def _(spark, d):
    return _deduped(spark, d, "last")


@query("dedupe_first", _dedupe_sql("ASC"))
def _(spark, d):
    return _deduped(spark, d, "first")


def _top_sql(having: str) -> str:
    return f"""WITH {fx.SQL_ACTIONS}, {fx.SQL_CATALOG}
      SELECT item_id, name, round(mean_views, 6) AS mean_views, n_rows FROM (
        SELECT item_id, avg(views) AS mean_views, count(*) AS n_rows FROM actions GROUP BY 1 {having}) JOIN catalog USING (item_id)
      ORDER BY round(mean_views, 9) DESC, item_id LIMIT 5"""


@query("top_courses", _top_sql(""))
def _(spark, d):
    top = profile.top_items(fx.actions(spark, d), fx.catalog(spark, d))
    return top.select("item_id", "name", r6("mean_views").alias("mean_views"), "n_rows")


@query("top_frequent_courses", _top_sql("HAVING count(*) > 30"))
def _(spark, d):
    top = profile.top_items(fx.actions(spark, d), fx.catalog(spark, d), more_than=30)
    return top.select("item_id", "name", r6("mean_views").alias("mean_views"), "n_rows")


@query(
    "union_recos",
    f"""WITH {fx.SQL_PAIRS}, p AS (SELECT item_id, sum(views) AS score FROM pairs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)
        SELECT item_id, user_id::VARCHAR AS user_id, views AS score FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY views DESC, item_id) AS rank FROM pairs) WHERE rank <= 3
        UNION ALL SELECT item_id, '00000001', score FROM p""",
)
def _(spark, d):
    pairs = fx.pairs(spark, d)
    personal = recommend.top_per_user(pairs.withColumnRenamed("views", "score"), 3).select(
        F.col("user_id").cast("string").alias("user_id"), "item_id", "score"
    )
    popular = recommend.popularity(pairs, "views").orderBy(F.desc("score"), "item_id").limit(5)
    return personal.unionByName(popular.withColumn("user_id", F.lit(recommend.COLD_START_USER)))


@query(
    "unseen_items",
    f"""WITH {fx.SQL_PAIRS}, {fx.SQL_CATALOG}, u AS (SELECT user_id FROM pairs GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 1)
        SELECT item_id FROM catalog EXCEPT SELECT item_id FROM pairs WHERE user_id IN (SELECT user_id FROM u)""",
)
def _(spark, d):
    pairs = fx.pairs(spark, d)
    busiest = pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "user_id").first()
    return recommend.unseen_items(pairs, fx.catalog(spark, d), busiest["user_id"])


@query("user_item_sets", f"WITH {fx.SQL_ACTIONS} SELECT DISTINCT user_id, item_id FROM actions")
def _(spark, d):
    return fx.actions(spark, d).select("user_id", "item_id").distinct()


# --- scores and reshaping ----------------------------------------------------


@query("prepare_interactions", f"WITH {fx.SQL_RATINGS} SELECT user_id, item_id, score FROM ratings")
def _(spark, d):
    return fx.ratings(spark, d).select("user_id", "item_id", F.col("score").cast("bigint").alias("score"))


@query(
    "quantile_score",
    f"""WITH {fx.SQL_PAIRS}, edges AS (SELECT quantile_cont(views, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS e FROM pairs)
        SELECT user_id, item_id, 1 + len(list_filter(list_distinct(e), lambda x: x > e[1] AND x < e[6] AND views > x)) AS score
        FROM pairs, edges""",
)
def _(spark, d):
    scored = prep.quantile_score(fx.pairs(spark, d), "views", "score", 5)
    return scored.select("user_id", "item_id", F.col("score").cast("bigint").alias("score"))


@query(
    "quartile_score",
    """WITH edges AS (SELECT quantile_cont(l_extendedprice, [0, 0.25, 0.5, 0.75, 1]) AS e FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_extendedprice,
              1 + (l_extendedprice > e[2])::BIGINT + (l_extendedprice > e[3])::BIGINT + (l_extendedprice > e[4])::BIGINT AS score
       FROM lineitem, edges""",
)
def _(spark, d):
    lines = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice"])
    scored = prep.quantile_score(lines, "l_extendedprice", "score", 4, on_ties="error")
    return scored.withColumn("score", F.col("score").cast("bigint"))


@query(
    "score_bands",
    f"""WITH {fx.SQL_GRADES}, g AS (SELECT day, user_id, quiz, CASE WHEN quiz = 'error' THEN -1 ELSE grade END AS grade FROM grades)
        SELECT day, user_id, quiz, grade, CASE WHEN grade > -2 AND grade <= 0 THEN -1 WHEN grade > 0 AND grade <= 11 THEN 1
          WHEN grade > 11 AND grade <= 20 THEN 2 END AS band FROM g""",
)
def _(spark, d):
    grades = fx.grades(spark, d).withColumn("grade", F.when(F.col("quiz") == "error", -1.0).otherwise(F.col("grade")))
    return grades.withColumn("band", band(F.col("grade")))


@query(
    "minmax_scale",
    f"""WITH {fx.SQL_PAIRS}, b AS (SELECT min(views) AS lo, max(views) AS hi FROM pairs)
        SELECT user_id, item_id, round((views - lo) / (hi - lo), 6) AS scaled FROM pairs, b""",
)
def _(spark, d):
    scaled = prep.minmax_scale(fx.pairs(spark, d), "views", "scaled")
    return scaled.select("user_id", "item_id", r6("scaled").alias("scaled"))


@query(
    "standardize",
    """WITH b AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer)
       SELECT c_custkey, round((c_acctbal - m) / s, 6) + 0.0 AS z FROM customer, b""",
)
def _(spark, d):
    people = read_table(spark, d, "customer", ["c_custkey", "c_acctbal"])
    return prep.standardize(people, ["c_acctbal"]).select("c_custkey", (r6("c_acctbal_z") + F.lit(0.0)).alias("z"))


_PIVOT = ", ".join(f"round(coalesce(avg(grade) FILTER (WHERE quiz = '{q}'), -1), 6) AS \"{q}\"" for q in fx.EVENT_TYPES)


@query("quiz_pivot", f"WITH {fx.SQL_GRADES} SELECT day, user_id, {_PIVOT} FROM grades GROUP BY 1, 2")
def _(spark, d):
    wide = reshape.pivot_mean(fx.grades(spark, d), ["day", "user_id"], "quiz", "grade", fx.EVENT_TYPES)
    return wide.withColumns({q: r6(q) for q in fx.EVENT_TYPES})


@query(
    "unpivot_scores",
    f"""WITH {fx.SQL_GRADES}, w AS (SELECT day, user_id, {_PIVOT} FROM grades GROUP BY 1, 2)
        {' UNION ALL '.join(f"SELECT day, user_id, '{q}' AS quiz, {q} AS grade FROM w" for q in fx.EVENT_TYPES)}""",
)
def _(spark, d):
    wide = reshape.pivot_mean(fx.grades(spark, d), ["day", "user_id"], "quiz", "grade", fx.EVENT_TYPES)
    return reshape.unpivot(wide, ["day", "user_id"], fx.EVENT_TYPES, "quiz", "grade").withColumn("grade", r6("grade"))


_KINDS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "crosstab_category",
    "SELECT p_brand, " + ", ".join(f"count(*) FILTER (WHERE p_type = '{k}') AS \"{k}\"" for k in _KINDS) + " FROM part GROUP BY 1",
)
def _(spark, d):
    part = read_table(spark, d, "part", ["p_brand", "p_type"])
    return reshape.crosstab(part, "p_brand", "p_type", reshape.categories(part, "p_type"))


@query(
    "user_history",
    f"WITH {fx.SQL_RATINGS} SELECT user_id, item_id, score, name, kind, brand FROM ratings LEFT JOIN catalog USING (item_id)",
)
def _(spark, d):
    seen = recommend.history(fx.ratings(spark, d), fx.catalog(spark, d))
    return seen.select("user_id", "item_id", F.col("score").cast("bigint").alias("score"), "name", "kind", "brand")


@query(
    "user_vectors",
    f"""WITH {fx.SQL_RATINGS}, items AS (
          SELECT item_id, row_number() OVER (ORDER BY ('0x' || substr(md5(item_id::VARCHAR), 1, 8))::BIGINT % 1024, item_id) - 1 AS pos
          FROM (SELECT DISTINCT item_id FROM ratings))
        SELECT user_id, string_agg(pos::VARCHAR, ',' ORDER BY pos) AS indices,
               string_agg(score::BIGINT::VARCHAR, ',' ORDER BY pos) AS "values"
        FROM ratings JOIN items USING (item_id) GROUP BY 1""",
)
def _(spark, d):
    ratings = fx.ratings(spark, d)
    items = dense_index(ratings.select("item_id").distinct(), "item_id", "item_pos")
    rows = reshape.user_rows(ratings.join(items, "item_id"), "score")
    whole = F.transform("values", lambda v: v.cast("bigint"))
    return rows.select("user_id", F.array_join("indices", ",").alias("indices"), F.array_join(whole, ",").alias("values"))
