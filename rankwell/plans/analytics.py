"""Registered queries: SQL views and exploratory statistics (step 0-1)."""

from __future__ import annotations

from rankwell.operators import stats
from rankwell.sources import adapter as A
from rankwell.sources.adapter import GENRES, with_ctes

# top_items on the small test scales: no item reaches 50 ratings below sf0.1.
TOP_MIN_RATINGS = 35
TOP_LIMIT = 100
AGE_BINS = 20
RATING_BINS = 5


def _data(spark, sf):
    return A.ratings(spark, sf), A.users(spark, sf), A.items(spark, sf)


def q_top_items(spark, sf):
    r, _, i = _data(spark, sf)
    return stats.top_items(r, i, min_ratings=TOP_MIN_RATINGS, limit=TOP_LIMIT)


def q_item_stats(spark, sf):
    r, _, i = _data(spark, sf)
    return stats.item_stats(r, i)


def q_user_stats(spark, sf):
    r, u, _ = _data(spark, sf)
    return stats.user_stats(r, u)


def q_global_summary(spark, sf):
    r, u, i = _data(spark, sf)
    return stats.global_summary(r, u, i)


def q_rating_distribution(spark, sf):
    r, _, _ = _data(spark, sf)
    return stats.value_distribution(r, "rating")


def q_gender_distribution(spark, sf):
    _, u, _ = _data(spark, sf)
    return stats.value_distribution(u, "gender")


def q_genre_counts(spark, sf):
    _, _, i = _data(spark, sf)
    return stats.genre_counts(i, GENRES, top=10)


def q_avg_rating_by_gender(spark, sf):
    r, u, _ = _data(spark, sf)
    return stats.avg_rating_by(r, u, "gender")


def q_user_activity(spark, sf):
    r, _, _ = _data(spark, sf)
    return stats.activity(r, "user_id")


def q_item_activity(spark, sf):
    r, _, _ = _data(spark, sf)
    return stats.activity(r, "item_id")


def q_correlations(spark, sf):
    r, u, _ = _data(spark, sf)
    return stats.correlations(r, u)


def q_rating_histogram(spark, sf):
    r, _, _ = _data(spark, sf)
    return stats.histogram(r, "rating", RATING_BINS)


def q_age_histogram(spark, sf):
    _, u, _ = _data(spark, sf)
    return stats.histogram(u, "age", AGE_BINS)


def q_item_non_null_share(spark, sf):
    _, _, i = _data(spark, sf)
    return stats.non_null_share(i, ["item_id", "title", "release_date"])


def q_items_with_release(spark, sf):
    _, _, i = _data(spark, sf)
    return stats.drop_missing(i, ["release_date"]).select("item_id", "title", "release_date")


def q_table_counts(spark, sf):
    r, u, i = _data(spark, sf)
    return stats.table_counts({"items": i, "users": u, "ratings": r})


def q_high_ratings(spark, sf):
    """Threshold filter (rating >= 4)."""
    r, _, _ = _data(spark, sf)
    return r.filter("rating >= 4").select("user_id", "item_id", "rating")


def q_read_users_ordered(spark, sf):
    """Named columns ordered by key."""
    _, u, _ = _data(spark, sf)
    return u.select("user_id", "age", "gender", "occupation", "zip_code").orderBy("user_id")


QUERIES = {
    "A3_top_items": q_top_items,
    "S7_read_users_ordered": q_read_users_ordered,
    "A1_item_stats": q_item_stats,
    "A2_user_stats": q_user_stats,
    "A5_global_summary": q_global_summary,
    "A6_rating_distribution": q_rating_distribution,
    "A6_gender_distribution": q_gender_distribution,
    "A7_genre_counts": q_genre_counts,
    "A8_avg_rating_by_gender": q_avg_rating_by_gender,
    "A9_user_activity": q_user_activity,
    "A9_item_activity": q_item_activity,
    "A10_correlations": q_correlations,
    "A11_rating_histogram": q_rating_histogram,
    "A11_age_histogram": q_age_histogram,
    "P6_item_non_null_share": q_item_non_null_share,
    "P6_items_with_release": q_items_with_release,
    "A15_table_counts": q_table_counts,
    "P7_high_ratings": q_high_ratings,
}

_ITEM_STATS = """
SELECT i.item_id, i.title, CAST(count(r.rating) AS BIGINT) AS total_ratings,
       round(avg(r.rating), 6) AS avg_rating, min(r.rating) AS min_rating, max(r.rating) AS max_rating,
       round(stddev_samp(r.rating), 6) AS stddev_rating
FROM items i LEFT JOIN {src} r ON i.item_id = r.item_id
GROUP BY i.item_id, i.title"""

_USER_STATS = """
SELECT u.user_id, u.age, u.gender, u.occupation, CAST(count(r.rating) AS BIGINT) AS total_ratings,
       round(avg(r.rating), 6) AS avg_rating, min(r.rating) AS min_rating, max(r.rating) AS max_rating
FROM users u LEFT JOIN {src} r ON u.user_id = r.user_id
GROUP BY u.user_id, u.age, u.gender, u.occupation"""

_GENRE_UNION = " UNION ALL ".join(
    f"SELECT '{g}' AS genre, CAST(sum(CAST(\"{g}\" AS INTEGER)) AS BIGINT) AS count FROM items" for g in GENRES)


def _hist_sql(table: str, col: str, bins: int) -> str:
    return f"""
, b AS (SELECT CAST(min({col}) AS DOUBLE) AS lo, CAST(max({col}) AS DOUBLE) AS hi FROM {table}),
h AS (SELECT CASE WHEN b.hi = b.lo THEN 0 ELSE CAST(least({bins - 1}, floor((CAST(t.{col} AS DOUBLE) - b.lo) / (b.hi - b.lo) * {bins})) AS INTEGER) END AS bin,
             count(*) AS c
      FROM {table} t, b WHERE t.{col} IS NOT NULL GROUP BY 1),
bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range({bins}))
SELECT bins.bin, round(b.lo + bins.bin * (b.hi - b.lo) / {bins}, 6) AS lower,
       round(b.lo + (bins.bin + 1) * (b.hi - b.lo) / {bins}, 6) AS upper,
       CAST(coalesce(h.c, 0) AS BIGINT) AS count
FROM bins CROSS JOIN b LEFT JOIN h ON h.bin = bins.bin"""


ORACLE = {
    "S7_read_users_ordered": with_ctes("SELECT user_id, age, gender, occupation, zip_code FROM users ORDER BY user_id"),
    "A3_top_items": with_ctes(f"""
SELECT r.item_id, i.title, count(*) AS total_ratings, round(avg(r.rating), 6) AS avg_rating,
       round(avg(r.rating), 2) AS avg_rating_rounded
FROM ratings r JOIN items i ON i.item_id = r.item_id
GROUP BY r.item_id, i.title HAVING count(*) >= {TOP_MIN_RATINGS}
ORDER BY avg(r.rating) DESC, count(*) DESC, r.item_id LIMIT {TOP_LIMIT}"""),
    "A1_item_stats": with_ctes(_ITEM_STATS.format(src="ratings")),
    "A2_user_stats": with_ctes(_USER_STATS.format(src="ratings")),
    "A5_global_summary": with_ctes("""
SELECT (SELECT count(*) FROM ratings) AS n_ratings, (SELECT count(*) FROM users) AS n_users,
       (SELECT count(*) FROM items) AS n_items,
       (SELECT count(DISTINCT user_id) FROM ratings) AS n_rating_users,
       (SELECT count(DISTINCT item_id) FROM ratings) AS n_rated_items,
       (SELECT round(avg(rating), 6) FROM ratings) AS mean_rating,
       (SELECT min(rating) FROM ratings) AS min_rating, (SELECT max(rating) FROM ratings) AS max_rating,
       (SELECT round(avg(age), 6) FROM users) AS mean_age,
       (SELECT min(age) FROM users) AS min_age, (SELECT max(age) FROM users) AS max_age,
       (SELECT min(rated_at) FROM ratings) AS first_rated_at, (SELECT max(rated_at) FROM ratings) AS last_rated_at"""),
    "A6_rating_distribution": with_ctes("""
SELECT rating, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM ratings), 6) AS pct
FROM ratings GROUP BY rating"""),
    "A6_gender_distribution": with_ctes("""
SELECT gender, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM users), 6) AS pct
FROM users GROUP BY gender"""),
    "A7_genre_counts": with_ctes(f"""
SELECT genre, count FROM ({_GENRE_UNION}) g ORDER BY count DESC, genre LIMIT 10"""),
    "A8_avg_rating_by_gender": with_ctes("""
SELECT u.gender, round(avg(r.rating), 6) AS avg_rating, count(*) AS n_ratings
FROM ratings r JOIN users u ON r.user_id = u.user_id GROUP BY u.gender"""),
    "A9_user_activity": with_ctes("""
SELECT user_id, count(*) AS num_ratings, round(avg(rating), 6) AS avg_rating FROM ratings GROUP BY user_id"""),
    "A9_item_activity": with_ctes("""
SELECT item_id, count(*) AS num_ratings, round(avg(rating), 6) AS avg_rating FROM ratings GROUP BY item_id"""),
    "A10_correlations": with_ctes("""
, pu AS (SELECT user_id, count(*) AS n, avg(rating) AS m FROM ratings GROUP BY user_id),
pi AS (SELECT item_id, count(*) AS n, avg(rating) AS m FROM ratings GROUP BY item_id)
SELECT round((SELECT corr(n, m) FROM pu), 6) AS corr_user_count_avg,
       round((SELECT corr(n, m) FROM pi), 6) AS corr_item_count_avg,
       round((SELECT corr(u.age, pu.m) FROM pu JOIN users u ON u.user_id = pu.user_id), 6) AS corr_age_avg"""),
    "A11_rating_histogram": with_ctes(_hist_sql("ratings", "rating", RATING_BINS)),
    "A11_age_histogram": with_ctes(_hist_sql("users", "age", AGE_BINS)),
    "P6_item_non_null_share": with_ctes("""
, c AS (SELECT count(*) AS n, count(item_id) AS a, count(title) AS b, count(release_date) AS d FROM items)
SELECT 'item_id' AS column_name, a AS non_null, round(a * 100.0 / n, 6) AS pct FROM c
UNION ALL SELECT 'title', b, round(b * 100.0 / n, 6) FROM c
UNION ALL SELECT 'release_date', d, round(d * 100.0 / n, 6) FROM c"""),
    "P6_items_with_release": with_ctes("""
SELECT item_id, title, release_date FROM items WHERE release_date IS NOT NULL"""),
    "A15_table_counts": with_ctes("""
SELECT 'items' AS table_name, count(*) AS row_count FROM items
UNION ALL SELECT 'users', count(*) FROM users
UNION ALL SELECT 'ratings', count(*) FROM ratings"""),
    "P7_high_ratings": with_ctes("""
SELECT user_id, item_id, rating FROM ratings WHERE rating >= 4"""),
}
