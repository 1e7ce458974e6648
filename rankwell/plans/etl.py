"""Registered queries: raw-file parsing, constraints, idempotent load (step 2).

The driver tables are rendered to the raw delimited formats in-plan and parsed
back, so the parsers and checks run over every row; the oracle rebuilds the
expected typed rows directly from the source tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rankwell.operators import quality
from rankwell.sources import adapter as A
from rankwell.sources import rawfiles as RF
from rankwell.sources.adapter import GENRES, with_ctes

FIRST_LOAD_BEFORE = "1996-01-01 00:00:00"
ARRIVAL = ["rated_at", "pos"]


def q_parse_items(spark, sf):
    return RF.parse_items(RF.render_items(A.items(spark, sf), GENRES), GENRES)


def q_parse_users(spark, sf):
    return RF.parse_users(RF.render_users(A.users(spark, sf)))


def q_parse_ratings(spark, sf):
    return RF.parse_ratings(RF.render_ratings(A.ratings(spark, sf)))


def q_malformed_counts(spark, sf):
    """Q4: well-formed / malformed line counts of the rendered ratings file."""
    lines = RF.render_ratings(A.ratings(spark, sf))
    good, bad = RF.split_malformed(lines, "\t", RF.RATING_FIELDS)
    return good.agg(F.count(F.lit(1)).alias("well_formed")).select(
        "well_formed", bad.agg(F.count(F.lit(1))).scalar().alias("malformed"))


def q_duplicates(spark, sf):
    """Q2: (user, item) keys that occur more than once among the raw events."""
    return quality.duplicate_keys(A.raw_ratings(spark, sf), ["user_id", "item_id"])


def q_domain(spark, sf):
    """Q1: quarantined rows per table and reason (empty when all rows are valid)."""
    _, bad_r = quality.check_ratings(A.raw_ratings(spark, sf).drop("pos"))
    _, bad_u = quality.check_users(A.users(spark, sf))
    _, bad_i = quality.check_items(A.items(spark, sf))
    parts = [bad_r.select(F.lit("ratings").alias("table_name"), "reason"),
             bad_u.select(F.lit("users").alias("table_name"), "reason"),
             bad_i.select(F.lit("items").alias("table_name"), "reason")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


def q_foreign_keys(spark, sf):
    """Q3: raw rating events whose user or item key is unknown."""
    _, rejected = quality.foreign_keys(A.raw_ratings(spark, sf).drop("pos", "rated_at"),
                                       A.users(spark, sf), A.items(spark, sf))
    return rejected.select("user_id", "item_id", "rating", "reason")


def _loads(spark, sf):
    raw = A.raw_ratings(spark, sf)
    first = raw.filter(F.col("rated_at") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    stored = quality.insert_new(first, first.limit(0), ["user_id", "item_id"], ARRIVAL)
    new = quality.insert_new(raw, stored, ["user_id", "item_id"], ARRIVAL)
    return raw, stored, new


def q_insert_new(spark, sf):
    """Second load of all events on top of a first load of the pre-1996
    events; only unseen (user, item) keys are inserted, first event wins."""
    _, _, new = _loads(spark, sf)
    return new.select("user_id", "item_id", "rating", "rated_at")


def q_etl_stats(spark, sf):
    """Q5: read / duplicate / inserted counts of the two loads (one row)."""
    raw, stored, new = _loads(spark, sf)
    again = quality.insert_new(raw, stored.unionByName(new), ["user_id", "item_id"], ARRIVAL)
    return raw.agg(F.count(F.lit(1)).alias("rows_read")).select(
        "rows_read",
        stored.agg(F.count(F.lit(1))).scalar().alias("first_load_inserted"),
        new.agg(F.count(F.lit(1))).scalar().alias("second_load_inserted"),
        quality.duplicate_keys(raw, ["user_id", "item_id"]).agg(F.count(F.lit(1))).scalar().alias("duplicate_keys"),
        again.agg(F.count(F.lit(1))).scalar().alias("third_load_inserted"))


def q_surrogate_key(spark, sf):
    """Q7: rating_id = rank of (user_id, item_id)."""
    return quality.surrogate_key(A.ratings(spark, sf), ["user_id", "item_id"]).select(
        "rating_id", "user_id", "item_id", "rating")


QUERIES = {
    "S1_parse_items": q_parse_items,
    "S2_parse_users": q_parse_users,
    "S3_parse_ratings": q_parse_ratings,
    "Q4_malformed_counts": q_malformed_counts,
    "Q2_duplicate_keys": q_duplicates,
    "Q1_domain_check": q_domain,
    "Q3_foreign_keys": q_foreign_keys,
    "S8_insert_new": q_insert_new,
    "Q5_etl_stats": q_etl_stats,
    "Q7_surrogate_key": q_surrogate_key,
}

_FLAGS = ", ".join(f'"{g}"' for g in GENRES)
_RAW = "raw_ratings"
_FIRST = f"""first AS (SELECT user_id, item_id, rating, rated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY rated_at, dup_rank) AS r
  FROM raw_ratings WHERE rated_at < TIMESTAMP '{FIRST_LOAD_BEFORE}') WHERE r = 1)"""
_NEW = """new AS (SELECT r.user_id, r.item_id, r.rating, r.rated_at FROM ratings r
  WHERE NOT EXISTS (SELECT 1 FROM first f WHERE f.user_id = r.user_id AND f.item_id = r.item_id))"""

ORACLE = {
    "S1_parse_items": with_ctes(f"""
SELECT item_id, title, release_date, CAST(NULL AS DATE) AS video_release_date, CAST(NULL AS VARCHAR) AS url, {_FLAGS}
FROM items"""),
    "S2_parse_users": with_ctes("SELECT user_id, age, gender, occupation, zip_code FROM users"),
    "S3_parse_ratings": with_ctes("""
SELECT user_id, item_id, rating, CAST(epoch(rated_at) AS BIGINT) AS timestamp, rated_at FROM ratings"""),
    "Q4_malformed_counts": with_ctes("SELECT count(*) AS well_formed, CAST(0 AS BIGINT) AS malformed FROM ratings"),
    "Q2_duplicate_keys": with_ctes("""
SELECT user_id, item_id, count(*) AS n_rows FROM raw_ratings GROUP BY user_id, item_id HAVING count(*) > 1"""),
    "Q1_domain_check": with_ctes("""
SELECT table_name, reason, count(*) AS n_rows FROM (
  SELECT 'ratings' AS table_name, CASE WHEN user_id IS NULL THEN 'user_id is null' WHEN item_id IS NULL THEN 'item_id is null'
         WHEN rating IS NULL THEN 'rating is null' WHEN rating NOT BETWEEN 1 AND 5 THEN 'rating out of range' END AS reason
  FROM raw_ratings
  UNION ALL SELECT 'users', CASE WHEN user_id IS NULL THEN 'user_id is null'
         WHEN gender IS NOT NULL AND gender NOT IN ('M', 'F') THEN 'gender not M/F' END FROM users
  UNION ALL SELECT 'items', CASE WHEN item_id IS NULL THEN 'item_id is null' WHEN title IS NULL THEN 'title is null' END
  FROM items) WHERE reason IS NOT NULL GROUP BY table_name, reason"""),
    "Q3_foreign_keys": with_ctes("""
SELECT r.user_id, r.item_id, r.rating,
       CASE WHEN u.user_id IS NULL THEN 'unknown user' ELSE 'unknown item' END AS reason
FROM raw_ratings r LEFT JOIN users u ON u.user_id = r.user_id
LEFT JOIN items i ON i.item_id = r.item_id
WHERE u.user_id IS NULL OR i.item_id IS NULL"""),
    "S8_insert_new": with_ctes("SELECT * FROM new", _FIRST, _NEW),
    "Q5_etl_stats": with_ctes("""
SELECT (SELECT count(*) FROM raw_ratings) AS rows_read, (SELECT count(*) FROM first) AS first_load_inserted,
       (SELECT count(*) FROM new) AS second_load_inserted,
       (SELECT count(*) FROM (SELECT 1 FROM raw_ratings GROUP BY user_id, item_id HAVING count(*) > 1)) AS duplicate_keys,
       CAST(0 AS BIGINT) AS third_load_inserted""", _FIRST, _NEW),
    "Q7_surrogate_key": with_ctes("""
SELECT row_number() OVER (ORDER BY user_id, item_id) AS rating_id, user_id, item_id, rating FROM ratings"""),
}
