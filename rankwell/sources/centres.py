"""Saved clusterings (S11): versioned K-Means centres in long form, and the assignment of new points to them.

A version is one folder, written beside the table and published by one rename: ``sums`` (cluster, dim_id, s) without zeros and
``sizes`` (cluster, n, q).  A version is never overwritten; saving it again is an error.

Nothing is pivoted or collected but the k sizes, so a model with any number of dimensions is read and joined by the executors.

Defined cases: a new point without a known dimension is compared by its norm alone; an empty cluster is never assigned; rows
without a point or a value are left out, rows without a dimension count for the norm only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwell.operators.cluster import DIST_DEC, LloydResult, _s, distance, nearest

from rankwell.sources.sinks import _publish, table_exists


def _folder(path: str, version: str) -> str:
    return f"{path.rstrip('/')}/version={version}"


def save(res: LloydResult, k: int, path: str, version: str) -> None:
    """Write the centres of ``k`` as ``version``; nothing can be read of it before all is written."""
    spark = res.sums.sparkSession
    done = _folder(path, version)
    if table_exists(spark, done):
        raise ValueError(f"version {version} is saved already")
    staged = f"{path.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    (res.sums.select("dim_id", F.posexplode(F.array(*[_s(k, c) for c in range(k)])).alias("cluster", "s")).filter("s <> 0")
     .write.parquet(f"{staged}/sums"))
    rows = [(c, int(res.sizes[k, c]), float(res.sq[k, c])) for c in range(k)]
    spark.createDataFrame(rows, "cluster int, n bigint, q double").coalesce(1).write.parquet(f"{staged}/sizes")
    _publish(spark, staged, done)


def load(spark: SparkSession, path: str, version: str) -> tuple[DataFrame, DataFrame]:
    """The sums and sizes of a version."""
    where = _folder(path, version)
    return spark.read.parquet(f"{where}/sums"), spark.read.parquet(f"{where}/sizes")


def assign(centres: tuple[DataFrame, DataFrame], cells: DataFrame, point: str = "item_id", dim: str = "user_id",
           value: str = "rating") -> DataFrame:
    """Per point of ``cells``: the point, cluster and distance (Euclidean) of the nearest saved centre."""
    sums, sizes = centres
    k = sizes.count()
    by_dim = (sums.groupBy("dim_id").agg(F.map_from_entries(F.collect_list(F.struct("cluster", "s"))).alias("m"))   # at most k entries
              .select("dim_id", F.array(*[F.coalesce(F.col("m")[c], F.lit(0)) for c in range(k)]).alias("s")))
    t = (cells.select(F.col(point).alias("__point"), F.col(dim).alias("__dim"), F.col(value).alias("__v"))
         .filter("__point IS NOT NULL AND __v IS NOT NULL"))
    # By shuffle: the centres have an array for each dimension, and a broadcast would bring them all to the driver.
    wide = (t.join(by_dim.hint("merge"), F.col("__dim") == F.col("dim_id"), "left").groupBy("__point")
            .agg(F.sum(F.col("__v") * F.col("__v")).alias("nrm"),
                 *[F.sum(F.col("__v") * F.coalesce(F.get("s", F.lit(c)), F.lit(0))).alias(f"d{c}") for c in range(k)]))
    known = sizes.agg(F.array_sort(F.collect_list(F.struct("cluster", F.col("n").cast("double").alias("n"), "q")))).scalar()
    far = F.zip_with(F.array(*[f"d{c}" for c in range(k)]), F.col("__known"),
                     lambda dot, c: distance(F.col("nrm"), dot, c["n"], c["q"]))
    best = wide.withColumn("__known", known).select("__point", nearest(far).alias("b")) if k else None
    if best is None:
        raise ValueError("a clustering without clusters")
    return best.select(F.col("__point").alias(point), F.col("b.j").alias("cluster"),
                       F.sqrt(F.greatest(F.lit(0.0), F.col("b.d") / F.lit(float(10 ** DIST_DEC)))).alias("distance"))
