"""The entities of the recommender and the segmentation, bound to the given tables.

Each frame has its twin as a SQL common table expression, for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.operators.joins import completions as completed_pairs
from quipu.operators.prep import prepare_interactions
from quipu.sources.tables import read_table

ACTION_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_discount", "l_tax"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
RUN_DATE = "2024-02-01"


def actions(spark: SparkSession, d: str) -> DataFrame:
    """Raw actions: one row per line item, so pairs repeat."""
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    lines = read_table(
        spark, d, "lineitem", [*ACTION_ORDER, "l_partkey", "l_quantity", "l_linestatus", "l_returnflag"]
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("views"),
        F.col("l_linestatus").alias("status"),
        "l_returnflag",
        *ACTION_ORDER,
    )


def pairs(spark: SparkSession, d: str) -> DataFrame:
    """Views summed per user and item."""
    return actions(spark, d).groupBy("user_id", "item_id").agg(F.sum("views").alias("views"))


def catalog(spark: SparkSession, d: str, valid_only: bool = True) -> DataFrame:
    part = read_table(spark, d, "part")
    if valid_only:
        part = part.where(F.col("p_type") != "PROMO")
    return part.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("kind"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").cast("bigint").alias("size"),
        F.col("p_retailprice").alias("price"),
    )


def completions(spark: SparkSession, d: str) -> DataFrame:
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey"]).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id")
    )
    lines = read_table(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_linestatus"]).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("item_id"), F.col("l_linestatus").alias("status")
    )
    return completed_pairs(orders, lines, "order_id", "status", "F")


def ratings(spark: SparkSession, d: str) -> DataFrame:
    """Prepared interactions: (user_id, item_id, views, score)."""
    return prepare_interactions(actions(spark, d), catalog(spark, d), completions(spark, d), ACTION_ORDER)


def grades(spark: SparkSession, d: str) -> DataFrame:
    """Quiz grades: (day, user_id, quiz, grade) with grades up to 20."""
    events = read_table(spark, d, "events", ["ts", "user_id", "event_type", "value"])
    return events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        "user_id",
        F.col("event_type").alias("quiz"),
        F.least(F.lit(20.0), F.col("value") / 10).alias("grade"),
    )


def posts(spark: SparkSession, d: str) -> DataFrame:
    """Forum posts without those of the administrator."""
    table = read_table(spark, d, "conversations")
    return table.where(F.col("role") != "system").select("conv_id", "turn", "role", F.col("text").alias("message"))


def people(spark: SparkSession, d: str) -> DataFrame:
    customer = read_table(spark, d, "customer", ["c_custkey", "c_nationkey"])
    nation = read_table(spark, d, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("user_id"), F.col("n_name").alias("region")
    )


SQL_ACTIONS = """actions AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, l_quantity AS views, l_linestatus AS status, l_returnflag,
         l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_discount, l_tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
SQL_PAIRS = SQL_ACTIONS + """,
pairs AS (SELECT user_id, item_id, sum(views) AS views FROM actions GROUP BY ALL)"""
SQL_CATALOG = """catalog AS (
  SELECT p_partkey AS item_id, p_name AS name, p_type AS kind, p_brand AS brand, p_size::BIGINT AS size,
         p_retailprice AS price
  FROM part WHERE p_type <> 'PROMO')"""
SQL_COMPLETIONS = "completions AS (SELECT DISTINCT user_id, item_id FROM actions WHERE status = 'F')"
SQL_SELECTED = f"""{SQL_ACTIONS},
{SQL_CATALOG},
{SQL_COMPLETIONS},
last_action AS (
  SELECT user_id, item_id, views FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY {', '.join(c + ' DESC' for c in ACTION_ORDER)}) AS rn
    FROM actions) WHERE rn = 1),
viewed AS (
  SELECT * FROM last_action WHERE views > 0 AND item_id IN (SELECT item_id FROM catalog)),
selected AS (
  SELECT * FROM viewed
  WHERE user_id IN (SELECT user_id FROM viewed GROUP BY 1 HAVING count(DISTINCT item_id) >= 2)
    AND user_id IN (SELECT user_id FROM completions))"""
SQL_RATINGS = f"""{SQL_SELECTED},
edges AS (SELECT quantile_cont(views, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS e FROM selected),
ratings AS (
  SELECT user_id, item_id, views,
    1 + len(list_filter(list_distinct(e), lambda x: x > e[1] AND x < e[6] AND views > x)) AS score
  FROM selected, edges)"""
SQL_GRADES = """grades AS (
  SELECT strftime(ts, '%Y-%m-%d') AS day, user_id, event_type AS quiz, least(20.0, value / 10) AS grade FROM events)"""
SQL_POSTS = "posts AS (SELECT conv_id, turn, role, text AS message FROM conversations WHERE role <> 'system')"
SQL_PEOPLE = """people AS (
  SELECT c_custkey AS user_id, n_name AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""
