"""Adapter: present the driver's star-schema test tables as a ratings data set.

ratings  <- lineitem ⋈ orders   (user = o_custkey, item = l_partkey,
                                 rating = 1 + floor((l_quantity - 1) / 10))
users    <- customer            (age, gender, occupation, zip code derived)
items    <- part                (title, release date, word flags as genres)

Every function has a DataFrame form (used by the engine) and the same
definition as a SQL CTE (used by the DuckDB oracle), kept side by side so the
two cannot drift apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The words of the part names that play the role of genre flags,
# in alphabetical order.
GENRES = ["anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large",
          "new", "old", "plate", "red", "ring", "rod", "small", "widget"]

RELEASE_EPOCH = "1990-01-01"
RELEASE_STEP_DAYS = 60
NO_RELEASE_SIZE = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rating_of(quantity: Column) -> Column:
    return (F.floor((quantity - 1) / 10) + 1).cast("int")


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a rating event, duplicates on (user, item) included.

    ``pos`` is a stable arrival order (ship date, order key, line number)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"),
                    F.col("l_partkey").alias("item_id"),
                    rating_of(F.col("l_quantity")).alias("rating"),
                    F.col("l_shipdate").alias("rated_at"),
                    F.struct("l_shipdate", "l_orderkey", "l_linenumber",
                             "l_quantity", "l_extendedprice").alias("pos")))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per (user, item): the earliest event wins.

    A hash aggregate with map-side partial ``min(struct)`` instead of a window:
    a hot (user, item) key is combined before the shuffle."""
    first = (raw_ratings(spark, sf_dir)
             .groupBy("user_id", "item_id")
             .agg(F.min(F.struct("pos", "rating", "rated_at")).alias("f")))
    return first.select("user_id", "item_id",
                        F.col("f.rating").alias("rating"),
                        F.col("f.rated_at").alias("rated_at"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        (F.lit(18) + F.lit(2) * F.col("c_nationkey")).cast("int").alias("age"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.col("c_mktsegment").alias("occupation"),
        F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0").alias("zip_code"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    words = F.split(F.col("p_name"), " ")
    release = F.when(F.col("p_size") == NO_RELEASE_SIZE, F.lit(None).cast("date")).otherwise(
        F.date_add(F.lit(RELEASE_EPOCH).cast("date"), F.col("p_size") * RELEASE_STEP_DAYS))
    return p.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        release.alias("release_date"),
        *[F.array_contains(words, g).alias(g) for g in GENRES])


# --------------------------------------------------------------------------
# The same definitions as DuckDB CTEs for the oracle.
# --------------------------------------------------------------------------

SQL_RAW_RATINGS = """raw_ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(floor((l_quantity - 1) / 10) + 1 AS INTEGER) AS rating,
         l_shipdate AS rated_at,
         row_number() OVER (PARTITION BY o_custkey, l_partkey
                            ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS dup_rank
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

SQL_RATINGS = """ratings AS (
  SELECT user_id, item_id, rating, rated_at FROM raw_ratings WHERE dup_rank = 1)"""

SQL_USERS = """users AS (
  SELECT c_custkey AS user_id, CAST(18 + 2 * c_nationkey AS INTEGER) AS age,
         CASE WHEN c_custkey % 3 = 0 THEN 'F' ELSE 'M' END AS gender,
         c_mktsegment AS occupation,
         lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code
  FROM customer)"""

SQL_ITEMS = ("items AS (\n  SELECT p_partkey AS item_id, p_name AS title,\n"
             f"         CASE WHEN p_size = {NO_RELEASE_SIZE} THEN NULL "
             f"ELSE CAST(DATE '{RELEASE_EPOCH}' + {RELEASE_STEP_DAYS} * p_size AS DATE) END AS release_date,\n"
             + ",\n".join(f"         list_contains(string_split(p_name, ' '), '{g}') AS \"{g}\"" for g in GENRES)
             + "\n  FROM part)")

BASE_CTES = {"raw_ratings": SQL_RAW_RATINGS, "ratings": SQL_RATINGS,
             "users": SQL_USERS, "items": SQL_ITEMS}
BASE_ORDER = ["raw_ratings", "ratings", "users", "items"]


def with_ctes(body: str, *extra: str) -> str:
    """Prefix an oracle query with the adapter CTEs and any extra named CTEs."""
    parts = [BASE_CTES[n] for n in BASE_ORDER] + list(extra)
    return "WITH " + ",\n".join(parts) + "\n" + body
