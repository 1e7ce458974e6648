"""Registered queries that complete the inventory: checks on rows with defects, saved and reloaded results, error reports.

Defects are derived from the tables by fixed rules, so both sides have rows to find.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rankwell.operators import cluster, features, metrics, predict, quality, stats
from rankwell.plans import etl, learning
from rankwell.plans import modelling as M
from rankwell.plans.analytics import TOP_LIMIT
from rankwell.session import cut_lineage, ensure_checkpoint_dir
from rankwell.sources import adapter as A
from rankwell.sources import rawfiles as RF
from rankwell.sources import sinks
from rankwell.sources.adapter import GENRES, with_ctes

#: The rating threshold of the top-items view; a fixed value.
VIEW_MIN_RATINGS = 50
ERROR_BINS = 50
SAMPLE_ITEMS = 10


def _folder(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _mix():
    return F.col("user_id") * 31 + F.col("item_id")


def defective_ratings(spark, sf):
    """Raw events, some with a rating that is out of range or without a user."""
    raw = A.raw_ratings(spark, sf).drop("pos")
    return raw.withColumn("rating", F.when(_mix() % 97 == 0, F.col("rating") + 9).otherwise(F.col("rating"))).withColumn(
        "user_id", F.when(F.col("item_id") % 89 == 0, F.lit(None)).otherwise(F.col("user_id")))


def q_domain_defects(spark, sf):
    """Q1: quarantined rows per table and reason."""
    users = A.users(spark, sf).withColumn("gender", F.when(F.col("user_id") % 50 == 0, "X").otherwise(F.col("gender")))
    items = A.items(spark, sf).withColumn("title", F.when(F.col("item_id") % 40 != 0, F.col("title")))
    found = {"ratings": quality.check_ratings(defective_ratings(spark, sf))[1], "users": quality.check_users(users)[1],
             "items": quality.check_items(items)[1]}
    out = None
    for name, bad in found.items():
        part = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "reason", "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def q_foreign_key_defects(spark, sf):
    """Q3: events of users and items that are not stored."""
    users = A.users(spark, sf).filter("user_id % 10 <> 0")
    items = A.items(spark, sf).filter("item_id % 15 <> 0")
    _, rejected = quality.foreign_keys(A.raw_ratings(spark, sf).drop("pos", "rated_at"), users, items)
    return rejected.select("user_id", "item_id", "rating", "reason")


def q_malformed_lines(spark, sf):
    """Q4: lines that lost their last field."""
    lines = RF.render_ratings(A.ratings(spark, sf))
    part = F.split("value", "\t")
    cut = (part[0].cast("bigint") * 31 + part[1].cast("bigint")) % 53 == 0
    lines = lines.withColumn("value", F.when(cut, F.regexp_replace("value", "\t[^\t]*$", "")).otherwise(F.col("value")))
    good, bad = RF.split_malformed(lines, "\t", RF.RATING_FIELDS)
    return good.agg(F.count(F.lit(1)).alias("well_formed")).select("well_formed", bad.agg(F.count(F.lit(1))).scalar().alias("malformed"))


def q_etl_defects(spark, sf):
    """Q5: a load that rejects bad rows, unknown keys and duplicates, each counted."""
    good, bad = quality.check_ratings(defective_ratings(spark, sf))
    known, rejected = quality.foreign_keys(good, A.users(spark, sf).filter("user_id % 10 <> 0"), A.items(spark, sf))
    new = quality.insert_new(known, known.limit(0), ["user_id", "item_id"], ["rated_at", "rating"])
    n = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return good.agg(F.count(F.lit(1)).alias("valid")).select("valid", n(bad).alias("invalid"), n(rejected).alias("unknown_keys"), n(new).alias("inserted"))


def q_audit(spark, sf):
    """Q6: after a reload with changed ages, the rows that keep and that renew their update time."""
    users = A.users(spark, sf)
    stored = cut_lineage(quality.audit_columns(users))
    changed = users.withColumn("age", F.when(F.col("user_id") % 7 == 0, F.col("age") + 1).otherwise(F.col("age")))
    again = cut_lineage(quality.audit_columns(changed, stored, ["user_id"]))
    old = stored.select("user_id", F.col("created_at").alias("c"), F.col("updated_at").alias("u"))
    return again.join(old, "user_id").select("user_id", (F.col("created_at") == F.col("c")).alias("same_created"),
                                             (F.col("updated_at") == F.col("u")).alias("same_updated"))


def q_top_items_view(spark, sf):
    """A3 with the view's own threshold."""
    return stats.top_items(A.ratings(spark, sf), A.items(spark, sf), min_ratings=VIEW_MIN_RATINGS, limit=TOP_LIMIT)


def q_error_gap(spark, sf):
    """RMSE over MAE in percent, improvement over the global mean."""
    train, test = M.split_frames(spark, sf)
    base = metrics.rmse_mae(predict.baseline_predict(test, train)).select("rmse").scalar()
    return metrics.rmse_mae(M.knn_predictions(spark, sf)).select(
        "rmse", "mae", F.round((F.col("rmse") - F.col("mae")) / F.col("mae") * 100, 4).alias("gap_pct"),
        F.round((base - F.col("rmse")) / base * 100, 4).alias("improvement_pct"))


def q_error_histogram(spark, sf):
    """50 bins of the error, to 6 decimals."""
    errors = metrics.error_columns(M.knn_predictions(spark, sf)).select(F.floor(F.col("error") * 1e6 + 0.5).alias("error"))
    return stats.histogram(errors, "error", ERROR_BINS).select("bin", "count")


def q_cluster_titles(spark, sf):
    """The first items with their clusters and titles (the limit is the report)."""
    clusters = cluster.item_clusters(M.kmeans(spark, sf, [M.K_MAIN]), M.K_MAIN)
    return clusters.join(A.items(spark, sf).select("item_id", "title"), "item_id").select("item_id", "cluster", "title").orderBy("item_id").limit(SAMPLE_ITEMS)


def q_user_clusters_table(spark, sf):
    """The user clusters written twice into their table; the second write adds nothing."""
    root = _folder(spark, "tables")
    rows, _, _ = M.user_clusters(spark, sf)
    sinks.write_result_table(rows, root, "user_clusters")
    sinks.write_result_table(rows, root, "user_clusters")
    return spark.read.parquet(f"{root}/user_clusters").select("user_id", "cluster_number", "distance_to_centroid", "model_version")


def q_csv_export(spark, sf):
    """Item statistics exported and read back."""
    path = _folder(spark, "export")
    sinks.export_csv(stats.item_stats(A.ratings(spark, sf), A.items(spark, sf)).select("item_id", "total_ratings", "avg_rating"), path)
    return spark.read.option("header", "true").schema("item_id bigint, total_ratings bigint, avg_rating double").csv(path)


BLOCK_USERS = 10


def q_similarity_block(spark, sf):
    """Similarities of the ten smallest users with one another, exported and read back."""
    path = _folder(spark, "export")
    block = predict.similarity_block(M.unit_profiles(spark, sf, M.K_MAIN), M.K_MAIN, BLOCK_USERS)
    sinks.export_csv(block, path)
    return spark.read.option("header", "true").schema(block.schema).csv(path)


def _raw_files(spark, sf):
    """A folder with the tables as raw files: ratings, users, items and the three lookup lists."""
    path = _folder(spark, "raw")
    ratings, users, items = A.ratings(spark, sf), A.users(spark, sf), A.items(spark, sf)
    n = lambda df: df.agg(F.count(F.lit(1)).cast("string").alias("n"))
    info = None
    for label, df in (("users", users), ("items", items), ("ratings", ratings)):
        line = n(df).select(F.concat("n", F.lit(" " + label)).alias("value"))
        info = line if info is None else info.unionByName(line)
    used = items.select(F.explode(F.array(*[F.when(F.col(g), F.lit(f"{g}|{i}")) for i, g in enumerate(GENRES)])).alias("value"))
    files = {"u.data": RF.render_ratings(ratings), "u.user": RF.render_users(users), "u.item": RF.render_items(items, GENRES),
             "u.genre": used.filter("value is not null").distinct(), "u.occupation": users.select(F.col("occupation").alias("value")).filter(
                 "value is not null").distinct(), "u.info": info}
    for name, lines in files.items():
        lines.write.text(f"{path}/{name}")
    return path


def q_lookup_files(spark, sf):
    """The genre, occupation and count lists as text files, read by the file readers."""
    path = _raw_files(spark, sf)
    lines = lambda name: RF.read_lines(spark, f"{path}/{name}")
    genres = RF.parse_lookup_names(lines("u.genre"), r"\|").select(F.lit("genre").alias("list"), "name", F.col("id").cast("bigint").alias("n"))
    jobs = RF.parse_lookup_names(lines("u.occupation")).select(F.lit("occupation").alias("list"), "name", F.lit(None).cast("bigint").alias("n"))
    info = RF.parse_info(lines("u.info")).select(F.lit("info").alias("list"), F.col("label").alias("name"), "n")
    return genres.unionByName(jobs).unionByName(info)


def q_landing(spark, sf):
    """The tables' raw files landed twice; the second run finds whole copies and writes nothing."""
    src, dst = _raw_files(spark, sf), _folder(spark, "landed")
    first = sinks.land_raw(spark, src, dst).select("file", F.col("status").alias("first_run"))
    again = sinks.land_raw(spark, src, dst)
    return again.join(first, "file").select("file", "n_lines", "size", "checksum", "first_run", F.col("status").alias("second_run"))


def q_users_from_file(spark, sf):
    """Users landed as a text file and read by the file reader."""
    path = _folder(spark, "raw")
    RF.render_users(A.users(spark, sf)).write.text(path)
    return RF.parse_users(RF.read_lines(spark, path))


def q_saved_forest(spark, sf):
    """The saved and reloaded forest predicts the same for every test row."""
    path = _folder(spark, "model")
    model = learning.forest(spark, sf)
    sinks.save_model(model, path)
    _, rows = learning.feature_frames(spark, sf)
    key = ["user_id", "item_id"]
    one = features.predict_forest(model, rows).select(*key, F.col("predicted").alias("p"))
    two = features.predict_forest(sinks.load_pipeline(path), rows).select(*key, F.col("predicted").alias("q"))
    return one.join(two, key).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p") == F.col("q")).alias("same"))


def q_forest_invariants(spark, sf):
    """One prediction for each test row, none missing, all in the range of ratings."""
    return learning.q_forest_predictions(spark, sf).agg(
        F.count(F.lit(1)).alias("n"), F.count("predicted").alias("predicted"), F.count_if(F.col("predicted").between(1, 5)).alias("in_range"))


def q_importance_invariants(spark, sf):
    """Importances are not negative and sum to 1."""
    names = len(features.BASE_FEATURES) + len(GENRES)
    return features.feature_importances(spark, learning.forest(spark, sf), GENRES, names).agg(
        F.count(F.lit(1)).alias("n_features"), F.round(F.sum("importance"), 6).alias("total"), F.count_if(F.col("importance") < 0).alias("negative"))


QUERIES = {
    "Q1_domain_defects": q_domain_defects,
    "Q3_foreign_key_defects": q_foreign_key_defects,
    "Q4_malformed_lines": q_malformed_lines,
    "Q5_etl_defects": q_etl_defects,
    "Q6_audit_columns": q_audit,
    "A3_top_items_view": q_top_items_view,
    "E3_error_gap": q_error_gap,
    "A11_error_histogram": q_error_histogram,
    "M4_cluster_titles": q_cluster_titles,
    "S9_user_clusters_table": q_user_clusters_table,
    "S10_csv_export": q_csv_export,
    "S10_similarity_block": q_similarity_block,
    "S4_users_from_file": q_users_from_file,
    "S4_lookup_files": q_lookup_files,
    "S5_landing": q_landing,
    "S11_saved_forest": q_saved_forest,
    "R7_forest_invariants": q_forest_invariants,
    "R8_importance_invariants": q_importance_invariants,
}

_DEFECTIVE = """defective AS (SELECT CASE WHEN item_id % 89 = 0 THEN NULL ELSE user_id END AS user_id, item_id,
  CASE WHEN (user_id * 31 + item_id) % 97 = 0 THEN rating + 9 ELSE rating END AS rating, rated_at FROM raw_ratings)"""
_REASON = """CASE WHEN user_id IS NULL THEN 'user_id is null' WHEN item_id IS NULL THEN 'item_id is null'
  WHEN rating IS NULL THEN 'rating is null' WHEN rating NOT BETWEEN 1 AND 5 THEN 'rating out of range' END"""

#: The lines of the raw files, as SQL.
_LINES = f"""lines AS MATERIALIZED (
  SELECT 'u.data' AS file, concat_ws(chr(9), user_id, item_id, rating, CAST(epoch(rated_at) AS BIGINT)) AS line FROM ratings
  UNION ALL SELECT 'u.user', concat_ws('|', user_id, age, gender, occupation, zip_code) FROM users
  UNION ALL SELECT 'u.item', concat_ws('|', item_id, title, coalesce(strftime(release_date, '%d-%b-%Y'), ''), '', '',
    {", ".join(f'CAST("{g}" AS INTEGER)' for g in GENRES)}) FROM items
  UNION ALL SELECT 'u.genre', line FROM ({" UNION ALL ".join(f"SELECT '{g}|{i}' AS line WHERE EXISTS (SELECT 1 FROM items WHERE \"{g}\")" for i, g in enumerate(GENRES))})
  UNION ALL SELECT DISTINCT 'u.occupation', occupation FROM users WHERE occupation IS NOT NULL
  UNION ALL SELECT 'u.info', concat(count(*), ' users') FROM users
  UNION ALL SELECT 'u.info', concat(count(*), ' items') FROM items
  UNION ALL SELECT 'u.info', concat(count(*), ' ratings') FROM ratings)"""

ORACLE = {
    "Q1_domain_defects": with_ctes(f"""
SELECT table_name, reason, count(*) AS n_rows FROM (
  SELECT 'ratings' AS table_name, {_REASON} AS reason FROM defective
  UNION ALL SELECT 'users', CASE WHEN user_id % 50 = 0 THEN 'gender not M/F' END FROM users
  UNION ALL SELECT 'items', CASE WHEN item_id % 40 = 0 THEN 'title is null' END FROM items)
WHERE reason IS NOT NULL GROUP BY table_name, reason""", _DEFECTIVE),
    "Q3_foreign_key_defects": with_ctes("""
SELECT r.user_id, r.item_id, r.rating, CASE WHEN r.user_id % 10 = 0 THEN 'unknown user' ELSE 'unknown item' END AS reason
FROM raw_ratings r WHERE r.user_id % 10 = 0 OR r.item_id % 15 = 0"""),
    "Q4_malformed_lines": with_ctes("""
SELECT count(*) FILTER (WHERE (user_id * 31 + item_id) % 53 <> 0) AS well_formed,
       count(*) FILTER (WHERE (user_id * 31 + item_id) % 53 = 0) AS malformed FROM ratings"""),
    "Q5_etl_defects": with_ctes(f"""
SELECT (SELECT count(*) FROM defective WHERE {_REASON} IS NULL) AS valid, (SELECT count(*) FROM defective WHERE {_REASON} IS NOT NULL) AS invalid,
       (SELECT count(*) FROM defective WHERE {_REASON} IS NULL AND user_id % 10 = 0) AS unknown_keys,
       (SELECT count(DISTINCT (user_id, item_id)) FROM defective WHERE {_REASON} IS NULL AND user_id % 10 <> 0) AS inserted""", _DEFECTIVE),
    "Q6_audit_columns": with_ctes("SELECT user_id, true AS same_created, user_id % 7 <> 0 OR age IS NULL AS same_updated FROM users"),
    "A3_top_items_view": with_ctes(f"""
SELECT r.item_id, i.title, count(*) AS total_ratings, round(avg(r.rating), 6) AS avg_rating,
       round(avg(r.rating), 2) AS avg_rating_rounded
FROM ratings r JOIN items i ON i.item_id = r.item_id
GROUP BY r.item_id, i.title HAVING count(*) >= {VIEW_MIN_RATINGS}
ORDER BY avg(r.rating) DESC, count(*) DESC, r.item_id LIMIT {TOP_LIMIT}"""),
    "E3_error_gap": with_ctes(f"""
, k AS (SELECT {M._RMSE} FROM {M._PRED}),
b AS (SELECT round(sqrt(avg((rating - g) * (rating - g))), 6) AS base FROM test, (SELECT avg(rating) AS g FROM train))
SELECT rmse, mae, round((rmse - mae) / mae * 100, 4) AS gap_pct, round((base - rmse) / base * 100, 4) AS improvement_pct FROM k, b""", *M._knn_ctes()),
    "A11_error_histogram": with_ctes(f"""
, e AS (SELECT CAST(floor((rating - predicted) * 1e6 + 0.5) AS DOUBLE) AS x FROM {M._PRED}),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM e),
h AS (SELECT CAST(least({ERROR_BINS - 1}, floor((x - lo) / (hi - lo) * {ERROR_BINS})) AS INTEGER) AS bin, count(*) AS c FROM e, b GROUP BY 1)
SELECT CAST(r.range AS INTEGER) AS bin, coalesce(h.c, 0) AS count FROM range({ERROR_BINS}) r LEFT JOIN h ON h.bin = r.range""", *M._knn_ctes()),
    "M4_cluster_titles": with_ctes(f"""
SELECT a.item_id, a.cluster, i.title FROM kmm_a{M.ORACLE_STEPS} a JOIN items i ON i.item_id = a.item_id
ORDER BY a.item_id LIMIT {SAMPLE_ITEMS}""", *M._BASE, *M.OK.kmeans_ctes([M.K_MAIN], M.ORACLE_STEPS, tag="m")[0]),
    "S9_user_clusters_table": M.ORACLE["M5_user_clusters"],
    "S10_csv_export": with_ctes("""
SELECT i.item_id, count(r.rating) AS total_ratings, round(avg(r.rating), 6) AS avg_rating
FROM items i LEFT JOIN ratings r ON r.item_id = i.item_id GROUP BY i.item_id"""),
    "S4_users_from_file": etl.ORACLE["S2_parse_users"],
    "S4_lookup_files": with_ctes("""
SELECT 'genre' AS list, split_part(line, '|', 1) AS name, CAST(split_part(line, '|', 2) AS BIGINT) AS n FROM lines WHERE file = 'u.genre'
UNION ALL SELECT 'occupation', line, NULL FROM lines WHERE file = 'u.occupation'
UNION ALL SELECT 'info', split_part(line, ' ', 2), CAST(split_part(line, ' ', 1) AS BIGINT) FROM lines WHERE file = 'u.info'""", _LINES),
    "S5_landing": with_ctes("""
SELECT file, count(*) AS n_lines, CAST(sum(strlen(line) + 1) AS BIGINT) AS size,
       CAST(sum(CAST('0x' || substr(md5(line), 1, 15) AS BIGINT)) AS VARCHAR) AS checksum, 'uploaded' AS first_run, 'present' AS second_run
FROM lines GROUP BY file""", _LINES),
    "S10_similarity_block": with_ctes(f"""
, few AS (SELECT *, row_number() OVER (ORDER BY user_id) AS nth FROM unitm ORDER BY user_id LIMIT {BLOCK_USERS})
SELECT a.user_id, {", ".join(f"max(floor(({' + '.join(f'a.z{c} * b.z{c}' for c in range(M.K_MAIN))}) * 1e9 + 0.5) / 1e9) FILTER (WHERE b.nth = {j}) AS s{j}" for j in range(1, BLOCK_USERS + 1))}
FROM few a JOIN few b ON true GROUP BY a.user_id""", *M._knn_ctes()),
    "S11_saved_forest": with_ctes("SELECT count(*) AS n, count(*) AS same FROM test", *M._BASE),
    "R7_forest_invariants": with_ctes("SELECT count(*) AS n, count(*) AS predicted, count(*) AS in_range FROM test", *M._BASE),
    "R8_importance_invariants": f"SELECT CAST({len(features.BASE_FEATURES) + len(GENRES)} AS BIGINT) AS n_features, 1.0 AS total, CAST(0 AS BIGINT) AS negative",
}
