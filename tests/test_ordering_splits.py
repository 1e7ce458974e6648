"""Exact distributed ranks and the reproducible splits."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from rankwell.operators import ordering, splits


def test_global_rank_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("a"), (F.col("id") % 3).alias("g"))
    got = ordering.global_rank(df, ["a"], "r", partitions=7).select("a", "r")
    ref = df.select("a", F.row_number().over(Window.orderBy("a")).alias("r"))
    assert sorted(got.collect()) == sorted(ref.collect())


def test_rank_within_matches_window(spark):
    df = spark.range(0, 3000).select((F.col("id") % 4).alias("g"), (F.col("id") * 31 % 3001).alias("a"))
    got = ordering.rank_within(df, ["g"], ["a"], "r", partitions=5).select("g", "a", "r")
    ref = df.select("g", "a", F.row_number().over(Window.partitionBy("g").orderBy("a")).alias("r"))
    assert sorted(got.collect()) == sorted(ref.collect())


def _ratings(spark):
    return spark.range(0, 4000).select((F.col("id") % 97).alias("user_id"), F.floor(F.col("id") / 97).alias("item_id"),
                                       (F.col("id") * 13 % 5 + 1).cast("int").alias("rating"),
                                       F.col("id").cast("timestamp").cast("timestamp_ntz").alias("rated_at"))


def test_stratified_split_exact(spark):
    r = _ratings(spark)
    sp = splits.stratified_split(r, 0.2, 42)
    counts = {(x.rating, x.is_test): x.c for x in sp.groupBy("rating", "is_test").agg(F.count("*").alias("c")).collect()}
    sizes = {x.rating: x.c for x in r.groupBy("rating").agg(F.count("*").alias("c")).collect()}
    for rating, n in sizes.items():
        assert counts[(rating, True)] == int(0.2 * n + 0.5)
        assert counts[(rating, True)] + counts[(rating, False)] == n
    assert sp.count() == r.count() and sp.select("user_id", "item_id").distinct().count() == r.count()
    again = splits.stratified_split(r, 0.2, 42)
    assert sorted(sp.collect()) == sorted(again.collect())


def test_kfold_and_leave_n_out(spark):
    r = _ratings(spark)
    folds = splits.kfold_assign(r, 5)
    assert sorted(x.c for x in folds.groupBy("fold").agg(F.count("*").alias("c")).collect()) == [800] * 5
    base, test = splits.fold_sets(folds, 2)
    assert base.count() + test.count() == 4000 and base.join(test, ["user_id", "item_id"]).count() == 0
    lno = splits.leave_n_out(r, 1, 10, 0)
    per_user = lno.filter("is_test").groupBy("user_id").count().collect()
    assert all(x["count"] == 10 for x in per_user)
    capped = splits.leave_n_out(r, 1, 10, 123)
    assert capped.filter("is_test").count() == 123
