"""Descriptive views over ratings / users / items.

Pattern used throughout: aggregate the big fact table (ratings) first, with
map-side partial aggregation, and only then join the one-row-per-key result to
the dimension table.  A hot item or user is therefore combined before any
shuffle, and the join never sees more than one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.functions.columns import histogram_bin, r6


def _rating_aggs(prefix_count: str = "total_ratings"):
    return [F.count("rating").alias(prefix_count),
            F.avg("rating").alias("avg_rating"),
            F.min("rating").alias("min_rating"),
            F.max("rating").alias("max_rating")]


def item_stats(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Per item count, mean, min, max, sample stddev; unrated items kept."""
    per_item = ratings.groupBy("item_id").agg(*_rating_aggs(), F.stddev_samp("rating").alias("stddev_rating"))
    return (items.select("item_id", "title").join(per_item, "item_id", "left")
            .select("item_id", "title",
                    F.coalesce("total_ratings", F.lit(0)).cast("bigint").alias("total_ratings"),
                    r6("avg_rating").alias("avg_rating"), "min_rating", "max_rating",
                    r6("stddev_rating").alias("stddev_rating")))


def user_stats(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """Per user count, mean, min, max with demographics; inactive users kept."""
    per_user = ratings.groupBy("user_id").agg(*_rating_aggs())
    return (users.select("user_id", "age", "gender", "occupation").join(per_user, "user_id", "left")
            .select("user_id", "age", "gender", "occupation",
                    F.coalesce("total_ratings", F.lit(0)).cast("bigint").alias("total_ratings"),
                    r6("avg_rating").alias("avg_rating"), "min_rating", "max_rating"))


def top_items(ratings: DataFrame, items: DataFrame, min_ratings: int = 50, limit: int = 100) -> DataFrame:
    """Items with >= min_ratings, best mean first.

    Ties: mean desc, count desc, then item_id asc so the cut at ``limit`` is
    deterministic.  The HAVING filter runs on the per-item aggregate before the
    join, and the final sort+limit is a TakeOrderedAndProject (per-partition
    top-k, no global sort)."""
    agg = (ratings.groupBy("item_id")
           .agg(F.count("rating").alias("total_ratings"), F.avg("rating").alias("avg_exact"))
           .filter(F.col("total_ratings") >= min_ratings))
    return (agg.join(items.select("item_id", "title"), "item_id")
            .orderBy(F.desc("avg_exact"), F.desc("total_ratings"), F.asc("item_id"))
            .limit(limit)
            .select("item_id", "title", "total_ratings",
                    r6("avg_exact").alias("avg_rating"),
                    F.round("avg_exact", 2).alias("avg_rating_rounded")))


def global_summary(ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """A5: one row of counts, rating and age moments, date range.

    Each figure is a scalar subquery over its own table (single partial
    aggregate each); no cross join of one-row frames."""
    spark = ratings.sparkSession
    r = ratings.agg(F.count(F.lit(1)).alias("n"), F.avg("rating").alias("m"), F.min("rating").alias("lo"),
                    F.max("rating").alias("hi"), F.min("rated_at").alias("first"), F.max("rated_at").alias("last"),
                    F.countDistinct("user_id").alias("nu"), F.countDistinct("item_id").alias("ni"))
    u = users.agg(F.count(F.lit(1)).alias("n"), F.avg("age").alias("m"), F.min("age").alias("lo"),
                  F.max("age").alias("hi"))
    i = items.agg(F.count(F.lit(1)).alias("n"))
    rs = r.select(F.struct("*")).scalar()
    us = u.select(F.struct("*")).scalar()
    return spark.range(1).select(
        rs["n"].alias("n_ratings"), us["n"].alias("n_users"), i.scalar().alias("n_items"),
        rs["nu"].alias("n_rating_users"), rs["ni"].alias("n_rated_items"),
        F.round(rs["m"], 6).alias("mean_rating"), rs["lo"].alias("min_rating"), rs["hi"].alias("max_rating"),
        F.round(us["m"], 6).alias("mean_age"), us["lo"].alias("min_age"), us["hi"].alias("max_age"),
        rs["first"].alias("first_rated_at"), rs["last"].alias("last_rated_at"))


def value_distribution(df: DataFrame, col: str) -> DataFrame:
    """Value counts and share of total in percent.

    The total is a scalar subquery, so there is no single-partition
    ``sum() over ()`` window."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .select(col, "count", F.round(F.col("count") * 100.0 / total, 6).alias("pct")))


def genre_counts(items: DataFrame, genres: list[str], top: int = 10) -> DataFrame:
    """Number of items per genre flag, top ``top``.

    One partial aggregate with one sum per flag (single scan, one row out),
    then ``stack`` turns the row into (genre, count)."""
    sums = items.agg(*[F.sum(F.col(g).cast("int")).cast("bigint").alias(g) for g in genres])
    stack = "stack({}, {}) as (genre, count)".format(
        len(genres), ", ".join(f"'{g}', `{g}`" for g in genres))
    return (sums.selectExpr(stack)
            .orderBy(F.desc("count"), F.asc("genre")).limit(top))


def avg_rating_by(ratings: DataFrame, users: DataFrame, attr: str = "gender") -> DataFrame:
    """Mean rating by a user attribute.

    Ratings are reduced to (sum, count) per user before the join, so the join
    carries one row per user instead of one per rating."""
    per_user = ratings.groupBy("user_id").agg(F.sum("rating").alias("s"), F.count("rating").alias("c"))
    return (per_user.join(users.select("user_id", attr), "user_id")
            .groupBy(attr)
            .agg((F.sum("s") / F.sum("c")).alias("avg_rating"), F.sum("c").cast("bigint").alias("n_ratings"))
            .select(attr, r6("avg_rating").alias("avg_rating"), "n_ratings"))


def activity(ratings: DataFrame, key: str) -> DataFrame:
    """Per-user or per-item number of ratings and mean (rated keys only)."""
    return (ratings.groupBy(key)
            .agg(F.count(F.lit(1)).alias("num_ratings"), F.avg("rating").alias("avg_rating"))
            .select(key, "num_ratings", r6("avg_rating").alias("avg_rating")))


def correlations(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """A10: Pearson r of (count, mean) per user and per item, and (age, mean) per user."""
    spark = ratings.sparkSession
    pu_raw = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.avg("rating").alias("m"))
    pi_raw = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.avg("rating").alias("m"))
    age = pu_raw.join(users.select("user_id", "age"), "user_id")
    return spark.range(1).select(
        F.round(pu_raw.agg(F.corr("n", "m")).scalar(), 6).alias("corr_user_count_avg"),
        F.round(pi_raw.agg(F.corr("n", "m")).scalar(), 6).alias("corr_item_count_avg"),
        F.round(age.agg(F.corr("age", "m")).scalar(), 6).alias("corr_age_avg"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram over [min, max] with empty bins kept.

    min/max are scalar subqueries; the bin ids come from ``range(bins)`` (size
    fixed by the parameter) left-joined to the per-bin counts."""
    spark = df.sparkSession
    bounds = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))
    b = bounds.select(F.struct("lo", "hi")).scalar()
    lo, hi = b["lo"], b["hi"]
    counts = (df.filter(F.col(col).isNotNull())
              .select(histogram_bin(F.col(col), lo, hi, bins).alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    width = (hi - lo) / bins
    return (spark.range(bins).select(F.col("id").cast("int").alias("bin"))
            .join(counts, "bin", "left")
            .select("bin",
                    F.round(lo + F.col("bin") * width, 6).alias("lower"),
                    F.round(lo + (F.col("bin") + 1) * width, 6).alias("upper"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def non_null_share(df: DataFrame, cols: list[str]) -> DataFrame:
    """Share of non-null values per column, in percent, as (column, pct) rows."""
    one = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in cols])
    stack = "stack({}, {}) as (column_name, non_null)".format(
        len(cols), ", ".join(f"'{c}', `{c}`" for c in cols))
    return (one.selectExpr("__n", stack)
            .select("column_name", F.col("non_null").cast("bigint").alias("non_null"),
                    F.round(F.col("non_null") * 100.0 / F.col("__n"), 6).alias("pct")))


def drop_missing(df: DataFrame, subset: list[str]) -> DataFrame:
    """Rows with all of ``subset`` present."""
    return df.na.drop(subset=subset)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """COUNT(*) per named table as (table_name, row_count)."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def nunique(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """Number of distinct values (exact)."""
    return df.agg(F.countDistinct(col).cast("bigint").alias(alias or f"n_{col}"))
