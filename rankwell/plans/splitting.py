"""Registered queries: reproducible splits (step 3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankwell.operators import splits
from rankwell.sources import adapter as A
from rankwell.sources.adapter import with_ctes

SEED = 42
TEST_FRACTION = 0.2
GRID_FRACTION = 0.1
SAMPLE_N = 1000
FOLDS = 5


def split_of(spark, sf):
    return splits.stratified_split(A.ratings(spark, sf), TEST_FRACTION, SEED)


def q_split(spark, sf):
    return split_of(spark, sf).select("user_id", "item_id", "rating", "is_test")


def q_split_counts(spark, sf):
    return (split_of(spark, sf).groupBy("rating", "is_test")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def q_sample_fraction(spark, sf):
    _, test = splits.train_test(split_of(spark, sf))
    return splits.sample_fraction(test, GRID_FRACTION, SEED).select("user_id", "item_id", "rating")


def q_sample_n(spark, sf):
    _, test = splits.train_test(split_of(spark, sf))
    return splits.sample_n(test, SAMPLE_N, SEED).select("user_id", "item_id", "rating")


def q_kfold(spark, sf):
    return splits.kfold_assign(A.ratings(spark, sf), FOLDS).select("user_id", "item_id", "rating", "fold")


def q_fold_base_sizes(spark, sf):
    """Size of base = head ∪ tail and of test for every fold."""
    assigned = splits.kfold_assign(A.ratings(spark, sf), FOLDS)
    out = None
    for f in range(FOLDS):
        base, test = splits.fold_sets(assigned, f)
        row = base.agg(F.count(F.lit(1)).alias("base_rows")).select(
            F.lit(f).alias("fold"), "base_rows", test.agg(F.count(F.lit(1))).scalar().alias("test_rows"))
        out = row if out is None else out.unionByName(row)
    return out


def q_leave_n_out_ua(spark, sf):
    return splits.leave_n_out(A.ratings(spark, sf), 1, 10, 100000).select("user_id", "item_id", "rating", "is_test")


def q_leave_n_out_capped(spark, sf):
    return splits.leave_n_out(A.ratings(spark, sf), 11, 20, 5000).select("user_id", "item_id", "rating", "is_test")


def q_leave_n_out_all(spark, sf):
    """X5 without a limit on all test rows."""
    return splits.leave_n_out(A.ratings(spark, sf), 1, 10).select("user_id", "item_id", "rating", "is_test")


QUERIES = {
    "X1_stratified_split": q_split,
    "X1_split_counts": q_split_counts,
    "X2_sample_fraction": q_sample_fraction,
    "X3_sample_n": q_sample_n,
    "X4_kfold": q_kfold,
    "A21_fold_base_sizes": q_fold_base_sizes,
    "X5_leave_n_out_ua": q_leave_n_out_ua,
    "X5_leave_n_out_capped": q_leave_n_out_capped,
    "X5_leave_n_out_all": q_leave_n_out_all,
}

MD5 = f"md5(concat_ws('|', '{SEED}', CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR)))"

SQL_SPLIT = f"""split AS (
  SELECT user_id, item_id, rating, rated_at,
         row_number() OVER (PARTITION BY rating ORDER BY {MD5}, user_id, item_id)
           <= floor({TEST_FRACTION} * count(*) OVER (PARTITION BY rating) + 0.5) AS is_test
  FROM ratings)"""
SQL_TRAIN = "train AS (SELECT user_id, item_id, rating, rated_at FROM split WHERE NOT is_test)"
SQL_TEST = "test AS (SELECT user_id, item_id, rating, rated_at FROM split WHERE is_test)"
SQL_SAMPLE = f"""sample AS (
  SELECT user_id, item_id, rating FROM (
    SELECT *, row_number() OVER (ORDER BY {MD5}, user_id, item_id) AS rn FROM test)
  WHERE rn <= floor({GRID_FRACTION} * (SELECT count(*) FROM test) + 0.5))"""
SQL_KFOLD = f"""kfold AS (
  SELECT user_id, item_id, rating,
         CAST(floor((row_number() OVER (ORDER BY rated_at, user_id, item_id) - 1) * {FOLDS}
                    / (SELECT count(*) FROM ratings)) AS INTEGER) AS fold
  FROM ratings)"""


def _lno(start, stop, cap=None):
    inside = f"o.place <= {cap}" if cap else "o.place IS NOT NULL"
    return f"""
, arrival AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rated_at, user_id, item_id) AS nth FROM ratings),
offered AS MATERIALIZED (SELECT user_id, item_id, row_number() OVER (ORDER BY rated_at, user_id, item_id) AS place
  FROM arrival WHERE nth BETWEEN {start} AND {stop})
SELECT a.user_id, a.item_id, a.rating, coalesce({inside}, false) AS is_test
FROM arrival a LEFT JOIN offered o ON a.user_id = o.user_id AND a.item_id = o.item_id"""


ORACLE = {
    "X1_stratified_split": with_ctes("SELECT user_id, item_id, rating, is_test FROM split", SQL_SPLIT),
    "X1_split_counts": with_ctes("SELECT rating, is_test, count(*) AS n_rows FROM split GROUP BY rating, is_test",
                                 SQL_SPLIT),
    "X2_sample_fraction": with_ctes("SELECT * FROM sample", SQL_SPLIT, SQL_TEST, SQL_SAMPLE),
    "X3_sample_n": with_ctes(f"SELECT user_id, item_id, rating FROM test ORDER BY {MD5}, user_id, item_id LIMIT {SAMPLE_N}",
                             SQL_SPLIT, SQL_TEST),
    "X4_kfold": with_ctes("SELECT * FROM kfold", SQL_KFOLD),
    "A21_fold_base_sizes": with_ctes(f"""
SELECT CAST(f.range AS INTEGER) AS fold, (SELECT count(*) FROM kfold WHERE fold <> f.range) AS base_rows,
       (SELECT count(*) FROM kfold WHERE fold = f.range) AS test_rows
FROM range({FOLDS}) f""", SQL_KFOLD),
    "X5_leave_n_out_ua": with_ctes(_lno(1, 10, 100000)),
    "X5_leave_n_out_capped": with_ctes(_lno(11, 20, 5000)),
    "X5_leave_n_out_all": with_ctes(_lno(1, 10)),
}
