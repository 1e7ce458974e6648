"""Evaluation over prediction rows.

Prediction frames carry ``rating`` (actual) and ``predicted``; everything is a
single partial aggregate or a global top-K, never a collect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankwell.functions.columns import improvement_pct
from rankwell.operators.ordering import exact_percentiles


def error_columns(pred: DataFrame) -> DataFrame:
    """P10: signed error (actual − predicted) and absolute error."""
    e = F.col("rating") - F.col("predicted")
    return pred.withColumn("error", e).withColumn("abs_error", F.abs(e))


def rmse_mae(pred: DataFrame) -> DataFrame:
    """One row (n, rmse, mae)."""
    e = F.col("rating") - F.col("predicted")
    return pred.agg(F.count(F.lit(1)).alias("n"),
                    F.round(F.sqrt(F.avg(e * e)), 6).alias("rmse"),
                    F.round(F.avg(F.abs(e)), 6).alias("mae"))


def rmse_mae_many(pred: DataFrame, ns: list[int]) -> DataFrame:
    """E1 / E2 of every ``predicted_{n}`` column in one pass: rows (n, rmse, mae)."""
    aggs = []
    for n in ns:
        e = F.col("rating") - F.col(f"predicted_{n}")
        aggs += [F.round(F.sqrt(F.avg(e * e)), 6).alias(f"r{n}"), F.round(F.avg(F.abs(e)), 6).alias(f"m{n}")]
    rows = ", ".join(f"{n}, r{n}, m{n}" for n in ns)
    return pred.agg(*aggs).selectExpr(f"stack({len(ns)}, {rows}) as (n, rmse, mae)")


def error_summary(pred: DataFrame, keys: list[str] = ("user_id", "item_id")) -> DataFrame:
    """Mean error, population std of the error, median and p90 of the
    absolute error (linear interpolation, exact rank-based percentiles)."""
    p = error_columns(pred)
    med, p90 = exact_percentiles(p, "abs_error", [0.5, 0.9], list(keys))
    return p.agg(F.round(F.avg("error"), 6).alias("mean_error"),
                 F.round(F.stddev_pop("error"), 6).alias("std_error")).select(
        "mean_error", "std_error", F.round(med, 6).alias("median_abs_error"), F.round(p90, 6).alias("p90_abs_error"))


def error_bands(pred: DataFrame) -> DataFrame:
    """Cumulative shares (<0.5, <1.0, <1.5, ≥2.0) and five disjoint bands, in percent."""
    p = error_columns(pred)
    a = F.col("abs_error")

    def share(cond):
        return F.round(F.avg(F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0))) * 100, 6)

    return p.agg(share(a < 0.5).alias("lt_0_5"), share(a < 1.0).alias("lt_1_0"),
                 share(a < 1.5).alias("lt_1_5"), share(a >= 2.0).alias("ge_2_0"),
                 share((a >= 0.5) & (a < 1.0)).alias("band_0_5_1_0"),
                 share((a >= 1.0) & (a < 1.5)).alias("band_1_0_1_5"),
                 share((a >= 1.5) & (a < 2.0)).alias("band_1_5_2_0"),
                 share(a >= 2.0).alias("band_ge_2_0"),
                 share(a < 0.5).alias("band_lt_0_5"))


def ranking_metrics(pred: DataFrame, ks=(5, 10, 20), threshold: float = 4.0) -> DataFrame:
    """Global Precision@K and Recall@K — one ranking of all prediction
    rows by predicted desc (ties by user, item), relevant = actual ≥ threshold;
    precision divides by K.  The ranking is a top-max(K) (TakeOrderedAndProject),
    the relevant total a scalar subquery."""
    kmax = max(ks)
    top = pred.orderBy(F.desc("predicted"), F.asc("user_id"), F.asc("item_id")).limit(kmax)
    top = top.select("predicted", "rating", "user_id", "item_id")
    total_rel = pred.agg(F.count_if(F.col("rating") >= threshold)).scalar()
    # Window over the ≤ max(K) rows of the top-K only.
    ranked = top.withColumn("pos", F.row_number().over(
        Window.orderBy(F.desc("predicted"), F.asc("user_id"), F.asc("item_id"))))
    rows = None
    for k in ks:
        hit = ranked.filter(F.col("pos") <= k).agg(F.count_if(F.col("rating") >= threshold).alias("h"))
        row = hit.select(F.lit(k).alias("k"), F.round(F.col("h") / F.lit(float(k)), 6).alias("precision_at_k"),
                         F.round(F.when(total_rel > 0, F.col("h") / total_rel).otherwise(F.lit(0.0)), 6)
                         .alias("recall_at_k"))
        rows = row if rows is None else rows.unionByName(row)
    return rows


def ranking_metrics_per_user(pred: DataFrame, ks=(5, 10, 20), threshold: float = 4.0) -> DataFrame:
    """E4 variant: Precision@K / Recall@K per user, averaged over users with at
    least one relevant item.  The per-user top-max(K) is a ``row_number``
    filter (partial + final WindowGroupLimit, so a heavy user is cut map-side)."""
    kmax = max(ks)
    w = Window.partitionBy("user_id").orderBy(F.desc("predicted"), F.asc("item_id"))
    top = pred.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= kmax)
    rel = pred.groupBy("user_id").agg(F.count_if(F.col("rating") >= threshold).alias("rel"))
    hits = top.groupBy("user_id").agg(*[F.count_if((F.col("pos") <= k) & (F.col("rating") >= threshold))
                                        .alias(f"h{k}") for k in ks])
    per_user = hits.join(rel, "user_id").filter(F.col("rel") > 0)
    rows = None
    for k in ks:
        row = per_user.agg(F.round(F.avg(F.col(f"h{k}") / F.lit(float(k))), 6).alias("precision_at_k"),
                           F.round(F.avg(F.col(f"h{k}") / F.col("rel")), 6).alias("recall_at_k")) \
            .select(F.lit(k).alias("k"), "precision_at_k", "recall_at_k")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def coverage(test: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct test items over catalogue size, in percent."""
    n_test = test.agg(F.countDistinct("item_id")).scalar()
    return items.agg(F.count(F.lit(1)).alias("catalogue")).select(
        n_test.alias("n_test_items"), "catalogue",
        F.round(n_test * 100.0 / F.col("catalogue"), 6).alias("coverage_pct"))


def compare(models: dict[str, DataFrame]) -> DataFrame:
    """Rmse, mae per model and improvement over the first one."""
    rows = None
    for name, pred in models.items():
        r = rmse_mae(pred).select(F.lit(name).alias("model"), "rmse", "mae")
        rows = r if rows is None else rows.unionByName(r)
    first = list(models)[0]
    base = rows.filter(F.col("model") == first).select(F.col("rmse").alias("base")).scalar()
    return rows.withColumn("improvement_pct", F.round(improvement_pct(base, F.col("rmse")), 6))
