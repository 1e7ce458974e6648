"""Registered queries: matrix, clustering, KNN prediction, metrics, grid (steps 4-6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankwell.operators import cluster, metrics, nearest, predict, recommend, similarity, splits
from rankwell.plans import oracle_kmeans as OK
from rankwell.plans.splitting import GRID_FRACTION, SEED, SQL_SAMPLE, SQL_SPLIT, SQL_TEST, SQL_TRAIN, TEST_FRACTION
from rankwell.session import cut_lineage
from rankwell.sources import adapter as A
from rankwell.sources.adapter import with_ctes

K_MAIN = 5
N_MAIN = 10
#: The swept numbers of clusters, the grid and the ranks of the evaluation.
SWEEP_KS = list(range(2, 11))
GRID_KS = [2, 5, 8, 12, 15]
GRID_NS = [5, 10, 20]
MAX_ITER = 300
# Lloyd steps unrolled in the oracle; the engine stops when stable (<= 28 on sf0.01).
ORACLE_STEPS = 40
USER_STEPS = 60
RANK_KS = [5, 10, 20]

# Frames that several queries of one session share; only those of the last data set are kept.
_memo: dict = {}


def _stamp(spark, sf):
    """Sizes and modification times of the files that ratings, users and items come from."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for table in ("lineitem", "orders", "customer", "part"):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf}/{table}.parquet")
        out += [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in path.getFileSystem(conf).listStatus(path)]
    return tuple(out)


def _key(spark, sf, *rest):
    data = (spark.sparkContext.applicationId, sf, _stamp(spark, sf))
    for old in [k for k in _memo if k[0] != data]:
        del _memo[old]
    return (data,) + rest


def split_frames(spark, sf):
    key = _key(spark, sf, "split")
    if key not in _memo:
        rows = A.ratings(spark, sf).select("user_id", "item_id", "rating")
        train, test = splits.train_test(cut_lineage(splits.stratified_split(rows, TEST_FRACTION, SEED)))
        # A table of its own: two filters of one table cannot be told apart in a join of both.
        _memo[key] = (train, cut_lineage(test))
    return _memo[key]


def kmeans(spark, sf, ks):
    key = _key(spark, sf, "kmeans", tuple(ks))
    if key not in _memo:
        train, _ = split_frames(spark, sf)
        _memo[key] = cluster.lloyd(train, ks, MAX_ITER)
    return _memo[key]


def unit_profiles(spark, sf, k, ks=None):
    key = _key(spark, sf, "unit", k, tuple(ks or [k]))
    if key not in _memo:
        train, _ = split_frames(spark, sf)
        res = kmeans(spark, sf, ks or [k])
        prof = cluster.user_cluster_profile(train, cluster.item_clusters(res, k), k)
        _memo[key] = cut_lineage(cluster.unit_centred(prof, k))
    return _memo[key]


def neighbours(spark, sf, k, n, ks=None):
    key = _key(spark, sf, "nb", k, n, tuple(ks or [k]))
    if key not in _memo:
        train, test = split_frames(spark, sf)
        _memo[key] = cut_lineage(predict.top_neighbours(test, train, unit_profiles(spark, sf, k, ks), k, n))
    return _memo[key]


def knn_predictions(spark, sf, k=K_MAIN, n=N_MAIN, fallback="observed"):
    train, test = split_frames(spark, sf)
    return predict.predict(test, train, unit_profiles(spark, sf, k), k, n, fallback,
                           neighbours=neighbours(spark, sf, k, n))


# ------------------------------------------------------------------ queries

def q_utility_summary(spark, sf):
    train, _ = split_frames(spark, sf)
    return cluster.utility_summary(train)


def q_test_nunique(spark, sf):
    """Number of distinct items in the test split."""
    from rankwell.operators import stats
    _, test = split_frames(spark, sf)
    return stats.nunique(test, "item_id", "n_test_items")


def q_item_vectors(spark, sf):
    """The transposed utility matrix in long form — items as rows."""
    train, _ = split_frames(spark, sf)
    return train.select(F.col("item_id").alias("row_id"), F.col("user_id").alias("col_id"),
                        F.col("rating").alias("value"))


def q_item_clusters(spark, sf):
    return cluster.item_clusters(kmeans(spark, sf, [K_MAIN]), K_MAIN)


def q_wcss_sweep(spark, sf):
    return cluster.wcss(kmeans(spark, sf, SWEEP_KS)).select("k", "wcss", "converged")


def q_elbow(spark, sf):
    return cluster.elbow(cluster.wcss(kmeans(spark, sf, SWEEP_KS)))


def q_cluster_sizes(spark, sf):
    return cluster.cluster_sizes(kmeans(spark, sf, [K_MAIN]).assign, K_MAIN)


def q_user_profile(spark, sf):
    train, _ = split_frames(spark, sf)
    prof = cluster.user_cluster_profile(train, cluster.item_clusters(kmeans(spark, sf, [K_MAIN]), K_MAIN), K_MAIN)
    return prof.select("user_id", *[F.round(f"p{c}", 6).alias(f"p{c}") for c in range(K_MAIN)])


def q_top_neighbours(spark, sf):
    return neighbours(spark, sf, K_MAIN, N_MAIN).select(
        "user_id", "item_id", "neighbour_id", F.round("sim", 9).alias("sim"), "rating", "rank")


def _pred_out(p):
    return p.select("user_id", "item_id", "rating", F.round("predicted", 6).alias("predicted"), "source")


def q_predict(spark, sf):
    return _pred_out(knn_predictions(spark, sf))


def q_predict_zero_filled(spark, sf):
    return _pred_out(knn_predictions(spark, sf, fallback="zero_filled"))


def q_knn_metrics(spark, sf):
    return metrics.rmse_mae(knn_predictions(spark, sf))


def q_baseline_metrics(spark, sf):
    train, test = split_frames(spark, sf)
    return metrics.rmse_mae(predict.baseline_predict(test, train))


def q_ranking(spark, sf):
    return metrics.ranking_metrics(knn_predictions(spark, sf), RANK_KS)


def q_ranking_per_user(spark, sf):
    return metrics.ranking_metrics_per_user(knn_predictions(spark, sf), RANK_KS)


def q_recommendation_coverage(spark, sf):
    """E5 variant: distinct recommended items over the catalogue."""
    return metrics.coverage(q_recommend(spark, sf), A.items(spark, sf))


def q_coverage(spark, sf):
    _, test = split_frames(spark, sf)
    return metrics.coverage(test, A.items(spark, sf))


def q_error_summary(spark, sf):
    return metrics.error_summary(knn_predictions(spark, sf))


def q_error_bands(spark, sf):
    return metrics.error_bands(knn_predictions(spark, sf))


def q_compare(spark, sf):
    train, test = split_frames(spark, sf)
    return metrics.compare({"global_mean": predict.baseline_predict(test, train),
                            "knn": knn_predictions(spark, sf)})


def grid_sample(spark, sf):
    """The tenth of the test rows that a cheap grid looks at."""
    key = _key(spark, sf, "grid sample")
    if key not in _memo:
        _, test = split_frames(spark, sf)
        _memo[key] = cut_lineage(splits.sample_fraction(test, GRID_FRACTION, SEED).select("user_id", "item_id", "rating"))
    return _memo[key]


def grid(spark, sf, sampled=False):
    """RMSE for every (K, N) on the test rows or on their sample.  One side-by-side K-Means for all K; per K one
    top-max(N) neighbour search and one plan whose conditional sums give every N."""
    train, test = split_frames(spark, sf)
    if sampled:
        test = grid_sample(spark, sf)
    out = None
    for k in GRID_KS:
        found = (predict.top_neighbours(test, train, unit_profiles(spark, sf, k, GRID_KS), k, max(GRID_NS)) if sampled
                 else neighbours(spark, sf, k, max(GRID_NS), GRID_KS))
        p = predict.predict_many(test, train, found, GRID_NS)
        row = metrics.rmse_mae_many(p, GRID_NS).select(F.lit(k).alias("k"), "n", "rmse", "mae")
        out = row if out is None else out.unionByName(row)
    return out


def q_grid(spark, sf):
    return grid(spark, sf)


def q_grid_sample(spark, sf):
    """R4 on a tenth of the test rows: searches the neighbours of these rows only."""
    return grid(spark, sf, sampled=True)


def q_grid_pivot(spark, sf):
    """K rows × N columns of RMSE."""
    return (grid(spark, sf).groupBy("k").pivot("n", GRID_NS).agg(F.first("rmse"))
            .select("k", *[F.col(str(n)).alias(f"rmse_n{n}") for n in GRID_NS]))


def q_best_params(spark, sf):
    """The (K, N) with the smallest RMSE (ties: smaller K, then N)."""
    return grid(spark, sf).orderBy("rmse", "k", "n").limit(1)


def main_profile(spark, sf):
    train, _ = split_frames(spark, sf)
    return cluster.user_cluster_profile(train, cluster.item_clusters(kmeans(spark, sf, [K_MAIN]), K_MAIN), K_MAIN)


def q_recommend(spark, sf):
    """Top-10 unseen items per user from the preferred item cluster."""
    train, _ = split_frames(spark, sf)
    clusters = cluster.item_clusters(kmeans(spark, sf, [K_MAIN]), K_MAIN)
    return recommend.recommend_top_n(train, clusters, main_profile(spark, sf), K_MAIN, N_MAIN)


def nearest_users(spark, sf):
    key = _key(spark, sf, "near")
    if key not in _memo:
        _memo[key] = cut_lineage(nearest.nearest_users(unit_profiles(spark, sf, K_MAIN), K_MAIN, N_MAIN))
    return _memo[key]


def q_nearest_users(spark, sf):
    """The ten most similar users of every user."""
    return nearest_users(spark, sf).select("user_id", "neighbour_id", F.round("sim", 9).alias("sim"), "rank")


def q_recommend_knn(spark, sf):
    """R5 ('knn'): top-10 unseen items of the nearest users."""
    train, _ = split_frames(spark, sf)
    return nearest.recommend_knn(train, nearest_users(spark, sf), N_MAIN)


def q_recommend_hybrid(spark, sf):
    """R5 ('hybrid'): both lists merged."""
    return nearest.recommend_hybrid(q_recommend(spark, sf), q_recommend_knn(spark, sf), N_MAIN)


#: Similar items of the registered query: cosine over the users who rated both.
MIN_COSINE = 0.15


def q_item_similarity(spark, sf):
    """M8: all pairs of items with a cosine of at least MIN_COSINE."""
    train, _ = split_frames(spark, sf)
    return similarity.item_similarity(train, MIN_COSINE)


USER_K = 4


def user_clusters(spark, sf):
    key = _key(spark, sf, "uc")
    if key not in _memo:
        _memo[key] = recommend.user_clusters(main_profile(spark, sf), K_MAIN, USER_K, MAX_ITER)
    return _memo[key]


def q_user_clusters(spark, sf):
    return user_clusters(spark, sf)[0]


def q_user_clusters_convergence(spark, sf):
    """M5: whether the user clustering is stable."""
    rows, _, stable = user_clusters(spark, sf)
    return rows.agg(F.count(F.lit(1)).alias("n_users")).select("n_users", F.lit(stable).alias("converged"))


def q_cluster_distribution(spark, sf):
    return recommend.cluster_distribution(user_clusters(spark, sf)[0])


QUERIES = {
    "R5_recommend_top_n": q_recommend,
    "R5_recommend_knn": q_recommend_knn,
    "R5_recommend_hybrid": q_recommend_hybrid,
    "J8_nearest_users": q_nearest_users,
    "M8_item_similarity": q_item_similarity,
    "M5_user_clusters": q_user_clusters,
    "M5_convergence": q_user_clusters_convergence,
    "A4_cluster_distribution": q_cluster_distribution,
    "A16_utility_summary": q_utility_summary,
    "A12_test_nunique": q_test_nunique,
    "A18_item_vectors": q_item_vectors,
    "M1_item_clusters": q_item_clusters,
    "M2_wcss_sweep": q_wcss_sweep,
    "M3_elbow": q_elbow,
    "M4_cluster_sizes": q_cluster_sizes,
    "A17_user_cluster_profile": q_user_profile,
    "W3_top_neighbours": q_top_neighbours,
    "R1_predict_ratings": q_predict,
    "R2_predict_zero_filled": q_predict_zero_filled,
    "E1_E2_knn_metrics": q_knn_metrics,
    "R3_baseline_metrics": q_baseline_metrics,
    "E4_ranking_metrics": q_ranking,
    "E5_coverage": q_coverage,
    "E4_ranking_per_user": q_ranking_per_user,
    "E5_recommendation_coverage": q_recommendation_coverage,
    "A13_error_summary": q_error_summary,
    "A14_error_bands": q_error_bands,
    "R9_compare_models": q_compare,
    "R4_grid_search": q_grid,
    "R4_grid_search_sample": q_grid_sample,
    "A19_grid_pivot": q_grid_pivot,
    "A20_best_params": q_best_params,
}

# ------------------------------------------------------------------ oracle SQL

_BASE = [SQL_SPLIT, SQL_TRAIN, SQL_TEST]


def _profile_sql(k: int, assign: str, tag: str) -> list[str]:
    ps = ",\n".join(f"    coalesce(avg(t.rating) FILTER (WHERE a.cluster = {c}), 0.0) AS p{c}" for c in range(k))
    mean = "(" + " + ".join(f"p{c}" for c in range(k)) + f") / {float(k)}"
    xs = ", ".join(f"p{c} - {mean} AS x{c}" for c in range(k))
    norm = "sqrt(" + " + ".join(f"x{c} * x{c}" for c in range(k)) + ")"
    zs = ", ".join(f"CASE WHEN {norm} > 1e-12 THEN x{c} / {norm} ELSE 0.0 END AS z{c}" for c in range(k))
    return [f"""prof{tag} AS MATERIALIZED (SELECT t.user_id,
{ps}
  FROM train t JOIN {assign} a ON t.item_id = a.item_id GROUP BY t.user_id)""",
            f"cen{tag} AS MATERIALIZED (SELECT user_id, {xs} FROM prof{tag})",
            f"unit{tag} AS MATERIALIZED (SELECT user_id, {zs} FROM cen{tag})"]


def _neighbour_sql(k: int, n: int, tag: str) -> list[str]:
    dot = " + ".join(f"zu.z{c} * zv.z{c}" for c in range(k))
    return [f"""ranked{tag} AS MATERIALIZED (
  SELECT * FROM (
    SELECT p.user_id, p.item_id, t.user_id AS neighbour_id, t.rating,
           floor(({dot}) * 1e9 + 0.5) / 1e9 AS sim,
           row_number() OVER (PARTITION BY p.user_id, p.item_id
                              ORDER BY floor(({dot}) * 1e9 + 0.5) / 1e9 DESC, t.user_id) AS rank
    FROM test p JOIN train t ON t.item_id = p.item_id
    JOIN unit{tag} zu ON zu.user_id = p.user_id JOIN unit{tag} zv ON zv.user_id = t.user_id)
  WHERE rank <= {n})"""]


def _predict_sql(n: int, tag: str, fallback: str = "observed") -> list[str]:
    if fallback == "observed":
        means = ["im AS (SELECT item_id, avg(rating) AS item_mean FROM train GROUP BY item_id)",
                 "um AS (SELECT user_id, avg(rating) AS user_mean FROM train GROUP BY user_id)"]
    else:
        means = ["im AS (SELECT item_id, sum(rating) / (SELECT count(DISTINCT user_id) FROM train) AS item_mean "
                 "FROM train GROUP BY item_id)",
                 "um AS (SELECT user_id, sum(rating) / (SELECT count(DISTINCT item_id) FROM train) AS user_mean "
                 "FROM train GROUP BY user_id)"]
    return means + [
        "ku AS (SELECT DISTINCT user_id FROM train)",
        f"""agg{tag}_{n} AS (SELECT user_id, item_id, sum(sim * rating) AS ws, sum(abs(sim)) AS ss
  FROM ranked{tag} WHERE rank <= {n} GROUP BY user_id, item_id)""",
        f"""src{tag}_{n} AS (
  SELECT p.user_id, p.item_id, p.rating, g.ws, g.ss, im.item_mean, um.user_mean,
         CASE WHEN ku.user_id IS NULL THEN 'cold_user' WHEN im.item_mean IS NULL THEN 'cold_item'
              WHEN coalesce(g.ss, 0) = 0 THEN 'zero_similarity' ELSE 'knn' END AS source
  FROM test p LEFT JOIN agg{tag}_{n} g ON g.user_id = p.user_id AND g.item_id = p.item_id
  LEFT JOIN im ON im.item_id = p.item_id LEFT JOIN um ON um.user_id = p.user_id
  LEFT JOIN ku ON ku.user_id = p.user_id)""",
        f"""pred{tag}_{n} AS (
  SELECT user_id, item_id, rating, source,
         CASE source WHEN 'cold_user' THEN coalesce(item_mean, 3.0) WHEN 'cold_item' THEN user_mean
                     WHEN 'zero_similarity' THEN item_mean
                     ELSE greatest(1.0, least(5.0, ws / ss)) END AS predicted
  FROM src{tag}_{n})"""]


def _knn_ctes(k=K_MAIN, n=N_MAIN, fallback="observed", tag="m"):
    km, assign = OK.kmeans_ctes([k], ORACLE_STEPS, tag=tag)
    return (_BASE + km + _profile_sql(k, OK.assignment_of(assign, k), tag) + _neighbour_sql(k, n, tag)
            + _predict_sql(n, tag, fallback))


def _q(body, ctes):
    return with_ctes(body, *ctes)


_PRED = f"pred{'m'}_{N_MAIN}"
_RMSE = "round(sqrt(avg((rating - predicted) * (rating - predicted))), 6) AS rmse, round(avg(abs(rating - predicted)), 6) AS mae"


def _sweep_ctes():
    km, assign = OK.kmeans_ctes(SWEEP_KS, ORACLE_STEPS, tag="s")
    wc, name = OK.wcss_sql(assign, tag="s")
    return km + wc + [OK.converged_sql(ORACLE_STEPS, "s"), f"sweep AS (SELECT w.k, w.wcss, c.converged FROM {name} w JOIN kms_conv c ON c.k = w.k)"]


#: The sample takes the place of the test rows.
_SAMPLED = [SQL_SPLIT, SQL_TRAIN, SQL_TEST.replace("test AS (", "whole_test AS (", 1),
            SQL_SAMPLE.replace("sample AS (", "test AS MATERIALIZED (", 1).replace("FROM test", "FROM whole_test")]


def _grid_ctes(base=_BASE):
    ctes, parts = list(base), []
    nmax = max(GRID_NS)
    means_done = False
    km, assign = OK.kmeans_ctes(GRID_KS, ORACLE_STEPS, tag="g")
    ctes += km
    for k in GRID_KS:
        tag = f"g{k}"
        ctes += _profile_sql(k, OK.assignment_of(assign, k), tag) + _neighbour_sql(k, nmax, tag)
        for n in GRID_NS:
            pc = _predict_sql(n, tag)
            if means_done:
                pc = pc[3:]
            means_done = True
            ctes += pc
            parts.append(f"SELECT {k} AS k, {n} AS n, {_RMSE} FROM pred{tag}_{n}")
    ctes.append("grid AS (" + " UNION ALL ".join(parts) + ")")
    return ctes


_D2 = """elb AS (SELECT k, lead(wcss) OVER (ORDER BY k) - 2 * wcss + lag(wcss) OVER (ORDER BY k) AS d2 FROM sweep)"""

def _user_ctes():
    """M5: the quantized profile cells as ratings of (user = point, item cluster = dimension)."""
    cells = " UNION ALL ".join(
        f"SELECT user_id AS item_id, {c} AS user_id, CAST(floor(p{c} * {recommend.PROFILE_UNITS}.0 + 0.5) AS BIGINT) AS rating FROM profm" for c in range(K_MAIN))
    km, assign = OK.kmeans_ctes([USER_K], USER_STEPS, train="cells", tag="u")
    return _BASE + OK.kmeans_ctes([K_MAIN], ORACLE_STEPS, tag="m")[0] + _profile_sql(
        K_MAIN, OK.assignment_of(f"kmm_a{ORACLE_STEPS}", K_MAIN), "m") + [f"cells AS MATERIALIZED ({cells})"] + km + [
        OK.converged_sql(USER_STEPS, "u"),
        f"""uc AS MATERIALIZED (SELECT item_id AS user_id, cluster AS cluster_number,
  round(sqrt(greatest(0.0, d / 1000000.0)) / {recommend.PROFILE_UNITS}.0, 6) AS distance_to_centroid, 'v1' AS model_version FROM {assign})"""]


_PREF = "pref AS (SELECT user_id, cluster, row_number() OVER (PARTITION BY user_id ORDER BY floor(p * 1e6) DESC, cluster) AS pref FROM (" + " UNION ALL ".join(
    f"SELECT user_id, {c} AS cluster, p{c} AS p FROM profm" for c in range(K_MAIN)) + "))"

ORACLE = {
    "M5_user_clusters": _q("SELECT * FROM uc", _user_ctes()),
    "M5_convergence": _q("SELECT (SELECT count(*) FROM uc) AS n_users, converged FROM kmu_conv", _user_ctes()),
    "A4_cluster_distribution": _q("""
SELECT cluster_number, model_version, count(DISTINCT user_id) AS total_users, round(avg(distance_to_centroid), 6) AS avg_distance
FROM uc GROUP BY cluster_number, model_version""", _user_ctes()),
    "R5_recommend_top_n": _q(f"""
, ist AS (SELECT t.item_id, a.cluster, avg(t.rating) AS mean, count(*) AS cnt
          FROM train t JOIN {OK.assignment_of(f"kmm_a{ORACLE_STEPS}", K_MAIN)} a ON a.item_id = t.item_id
          GROUP BY t.item_id, a.cluster),
rk AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY mean DESC, cnt DESC, item_id) AS slot FROM ist),
{_PREF},
cand AS (SELECT p.user_id, r.item_id, r.mean, r.slot, p.pref FROM pref p JOIN rk r ON r.cluster = p.cluster
         WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = p.user_id AND t.item_id = r.item_id)),
top AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pref, slot) AS rank FROM cand)
SELECT user_id, item_id, round(mean, 6) AS predicted_rating, round(mean, 6) AS recommendation_score, rank,
       'v1' AS model_version, 'kmeans' AS algorithm FROM top WHERE rank <= {N_MAIN}""", _knn_ctes()),
    "A16_utility_summary": _q("""
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items, count(*) AS n_cells,
       round((1.0 - count(*) / (count(DISTINCT user_id) * count(DISTINCT item_id))) * 100, 6) AS sparsity_pct
FROM train""", _BASE),
    "A12_test_nunique": _q("SELECT count(DISTINCT item_id) AS n_test_items FROM test", _BASE),
    "A18_item_vectors": _q("SELECT item_id AS row_id, user_id AS col_id, rating AS value FROM train", _BASE),
    "M1_item_clusters": _q(f"SELECT item_id, cluster FROM kmm_a{ORACLE_STEPS} WHERE k = {K_MAIN}",
                           _BASE + OK.kmeans_ctes([K_MAIN], ORACLE_STEPS, tag="m")[0]),
    "M2_wcss_sweep": _q("SELECT k, wcss, converged FROM sweep", _BASE + _sweep_ctes()),
    "M3_elbow": _q("SELECT arg_min(k, d2) AS elbow_k FROM elb WHERE d2 IS NOT NULL",
                   _BASE + _sweep_ctes() + [_D2]),
    "M4_cluster_sizes": _q(f"""
SELECT cluster, count(*) AS n_items, round(count(*) * 100.0 / (SELECT count(*) FROM kmm_a{ORACLE_STEPS}), 6) AS pct
FROM kmm_a{ORACLE_STEPS} GROUP BY cluster""", _BASE + OK.kmeans_ctes([K_MAIN], ORACLE_STEPS, tag="m")[0]),
    "A17_user_cluster_profile": _q("SELECT user_id, " + ", ".join(f"round(p{c}, 6) AS p{c}" for c in range(K_MAIN))
                                   + " FROM profm", _knn_ctes()),
    "W3_top_neighbours": _q("SELECT user_id, item_id, neighbour_id, round(sim, 9) AS sim, rating, rank FROM rankedm",
                            _knn_ctes()),
    "R1_predict_ratings": _q(f"SELECT user_id, item_id, rating, round(predicted, 6) AS predicted, source FROM {_PRED}",
                             _knn_ctes()),
    "R2_predict_zero_filled": _q(
        f"SELECT user_id, item_id, rating, round(predicted, 6) AS predicted, source FROM {_PRED}",
        _knn_ctes(fallback="zero_filled")),
    "E1_E2_knn_metrics": _q(f"SELECT count(*) AS n, {_RMSE} FROM {_PRED}", _knn_ctes()),
    "R3_baseline_metrics": _q("""
SELECT count(*) AS n, round(sqrt(avg((rating - m) * (rating - m))), 6) AS rmse, round(avg(abs(rating - m)), 6) AS mae
FROM test, (SELECT avg(rating) AS m FROM train)""", _BASE),
    "E4_ranking_metrics": _q(f"""
, top AS (SELECT *, row_number() OVER (ORDER BY predicted DESC, user_id, item_id) AS pos FROM {_PRED}),
tot AS (SELECT count(*) FILTER (WHERE rating >= 4) AS rel FROM {_PRED})
SELECT k, round(count(*) FILTER (WHERE pos <= k AND rating >= 4) / CAST(k AS DOUBLE), 6) AS precision_at_k,
       round(CASE WHEN (SELECT rel FROM tot) > 0
                  THEN count(*) FILTER (WHERE pos <= k AND rating >= 4) / (SELECT rel FROM tot) ELSE 0.0 END, 6) AS recall_at_k
FROM top, (SELECT unnest([{', '.join(map(str, RANK_KS))}]) AS k) ks GROUP BY k""", _knn_ctes()),
    "E4_ranking_per_user": _q(f"""
, top AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY predicted DESC, item_id) AS pos FROM {_PRED}),
rel AS (SELECT user_id, count(*) FILTER (WHERE rating >= 4) AS rel FROM {_PRED} GROUP BY user_id),
ks AS (SELECT unnest([{', '.join(map(str, RANK_KS))}]) AS k),
hits AS (SELECT ks.k, r.user_id, r.rel,
                (SELECT count(*) FROM top t WHERE t.user_id = r.user_id AND t.pos <= ks.k AND t.rating >= 4) AS h
         FROM rel r CROSS JOIN ks WHERE r.rel > 0)
SELECT k, round(avg(h / CAST(k AS DOUBLE)), 6) AS precision_at_k, round(avg(h / CAST(rel AS DOUBLE)), 6) AS recall_at_k
FROM hits GROUP BY k""", _knn_ctes()),
    "E5_coverage": _q("""
SELECT (SELECT count(DISTINCT item_id) FROM test) AS n_test_items, count(*) AS catalogue,
       round((SELECT count(DISTINCT item_id) FROM test) * 100.0 / count(*), 6) AS coverage_pct FROM items""", _BASE),
    "A13_error_summary": _q(f"""
SELECT round(avg(rating - predicted), 6) AS mean_error, round(stddev_pop(rating - predicted), 6) AS std_error,
       round(quantile_cont(abs(rating - predicted), 0.5), 6) AS median_abs_error,
       round(quantile_cont(abs(rating - predicted), 0.9), 6) AS p90_abs_error FROM {_PRED}""", _knn_ctes()),
    "A14_error_bands": _q(f"""
, e AS (SELECT abs(rating - predicted) AS a FROM {_PRED})
SELECT round(avg(CASE WHEN a < 0.5 THEN 1.0 ELSE 0.0 END) * 100, 6) AS lt_0_5,
       round(avg(CASE WHEN a < 1.0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS lt_1_0,
       round(avg(CASE WHEN a < 1.5 THEN 1.0 ELSE 0.0 END) * 100, 6) AS lt_1_5,
       round(avg(CASE WHEN a >= 2.0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS ge_2_0,
       round(avg(CASE WHEN a >= 0.5 AND a < 1.0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS band_0_5_1_0,
       round(avg(CASE WHEN a >= 1.0 AND a < 1.5 THEN 1.0 ELSE 0.0 END) * 100, 6) AS band_1_0_1_5,
       round(avg(CASE WHEN a >= 1.5 AND a < 2.0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS band_1_5_2_0,
       round(avg(CASE WHEN a >= 2.0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS band_ge_2_0,
       round(avg(CASE WHEN a < 0.5 THEN 1.0 ELSE 0.0 END) * 100, 6) AS band_lt_0_5 FROM e""", _knn_ctes()),
    "R9_compare_models": _q(f"""
, m AS (SELECT 'global_mean' AS model, round(sqrt(avg((rating - g) * (rating - g))), 6) AS rmse,
               round(avg(abs(rating - g)), 6) AS mae FROM test, (SELECT avg(rating) AS g FROM train)
        UNION ALL SELECT 'knn', {_RMSE} FROM {_PRED})
SELECT model, rmse, mae,
       round(((SELECT rmse FROM m WHERE model = 'global_mean') - rmse) / (SELECT rmse FROM m WHERE model = 'global_mean') * 100, 6)
         AS improvement_pct FROM m""", _knn_ctes()),
    "R4_grid_search": _q("SELECT k, n, rmse, mae FROM grid", _grid_ctes()),
    "R4_grid_search_sample": _q("SELECT k, n, rmse, mae FROM grid", _grid_ctes(_SAMPLED)),
    "A19_grid_pivot": _q("SELECT k, " + ", ".join(f"max(rmse) FILTER (WHERE n = {n}) AS rmse_n{n}" for n in GRID_NS)
                         + " FROM grid GROUP BY k", _grid_ctes()),
    "A20_best_params": _q("SELECT k, n, rmse, mae FROM grid ORDER BY rmse, k, n LIMIT 1", _grid_ctes()),
}

_R5 = ORACLE["R5_recommend_top_n"]
_R5_HEAD = _R5[:_R5.rindex("\nSELECT user_id, item_id, round(mean, 6) AS predicted_rating")]
ORACLE["E5_recommendation_coverage"] = _R5_HEAD + f"""
SELECT count(DISTINCT item_id) AS n_test_items, (SELECT count(*) FROM items) AS catalogue,
       round(count(DISTINCT item_id) * 100.0 / (SELECT count(*) FROM items), 6) AS coverage_pct
FROM top WHERE rank <= {N_MAIN}"""

_NEAR = [f"""nearm AS MATERIALIZED (SELECT * FROM (
  SELECT user_id, neighbour_id, sim, row_number() OVER (PARTITION BY user_id ORDER BY sim DESC, neighbour_id) AS rank FROM (
    SELECT zu.user_id, zv.user_id AS neighbour_id, floor(({" + ".join(f"zu.z{c} * zv.z{c}" for c in range(K_MAIN))}) * 1e9 + 0.5) / 1e9 AS sim
    FROM unitm zu JOIN unitm zv ON zu.user_id <> zv.user_id) WHERE sim > 0) WHERE rank <= {N_MAIN})"""]
_KNN_LIST = [f"""knnl AS MATERIALIZED (SELECT * FROM (
  SELECT user_id, item_id, score / weights AS mean, score / 1e9 AS points, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM (
    SELECT n.user_id, t.item_id, sum(CAST(floor(n.sim * 1e9 + 0.5) AS BIGINT) * t.rating)::BIGINT AS score, sum(CAST(floor(n.sim * 1e9 + 0.5) AS BIGINT))::BIGINT AS weights
    FROM nearm n JOIN train t ON t.user_id = n.neighbour_id
    WHERE NOT EXISTS (SELECT 1 FROM train s WHERE s.user_id = n.user_id AND s.item_id = t.item_id) GROUP BY n.user_id, t.item_id))
  WHERE rank <= {N_MAIN})"""]
ORACLE["J8_nearest_users"] = _q("SELECT user_id, neighbour_id, round(sim, 9) AS sim, rank FROM nearm", _knn_ctes() + _NEAR)
ORACLE["R5_recommend_knn"] = _q("""
SELECT user_id, item_id, round(mean, 6) AS predicted_rating, round(points, 6) AS recommendation_score, rank,
       'v1' AS model_version, 'knn' AS algorithm FROM knnl""", _knn_ctes() + _NEAR + _KNN_LIST)
ORACLE["R5_recommend_hybrid"] = _R5_HEAD + ", " + ", ".join(_NEAR + _KNN_LIST) + f""",
lists AS (SELECT user_id, item_id, round(mean, 6) AS mean, rank FROM top WHERE rank <= {N_MAIN}
          UNION ALL SELECT user_id, item_id, round(mean, 6), rank FROM knnl),
fused AS (SELECT user_id, item_id, sum(floor({nearest.FUSION_POINTS} / ({nearest.FUSION_RANK} + rank)))::BIGINT AS points, avg(mean) AS mean
          FROM lists GROUP BY user_id, item_id)
SELECT user_id, item_id, round(mean, 6) AS predicted_rating, round(points / {float(nearest.FUSION_POINTS)}, 6) AS recommendation_score, rank,
       'v1' AS model_version, 'hybrid' AS algorithm
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY points DESC, item_id) AS rank FROM fused) WHERE rank <= {N_MAIN}"""
ORACLE["M8_item_similarity"] = _q(f"""
, nrm AS MATERIALIZED (SELECT item_id, sum(rating * rating)::BIGINT AS n2 FROM train GROUP BY item_id),
dots AS (SELECT a.item_id AS i, b.item_id AS j, sum(a.rating * b.rating)::BIGINT AS dot
         FROM train a JOIN train b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY a.item_id, b.item_id)
SELECT i AS item_id_1, j AS item_id_2, round(dot / sqrt(p.n2::DOUBLE * q.n2), 6) AS similarity_score, 'v1' AS model_version
FROM dots JOIN nrm p ON p.item_id = i JOIN nrm q ON q.item_id = j WHERE dot / sqrt(p.n2::DOUBLE * q.n2) >= {MIN_COSINE}""", _BASE)
