"""Cluster-profile KNN rating prediction.

For a pair (u, i) the prediction is the similarity-weighted mean of the
ratings given to i by the N raters most similar to u, where similarity is the
cosine of the centred per-cluster taste profiles:

    pred = clamp(Σ s·r / Σ |s|, 1, 5)

The exact top-N search is the heavy part: item i's queries × item i's raters.
Emitting those pairs as rows would make a popular item quadratic in rows, so
it runs as a tiled Pandas cogroup:

* per item, queries are dealt into A = ceil(q / TILE) chunks and raters into
  B = ceil(r / TILE) chunks (hash of user id); tile (a, b) of a hot item is
  its own group, small items share hash buckets;
* inside a tile the q×r similarity block is computed with NumPy, in the same
  left-to-right order as the SQL oracle, quantized to 9 decimals, and only
  the best N raters per query leave the tile;
* the ≤ B·N survivors per query are merged with ``row_number() ≤ N``
  (Spark plans it as a partial + final WindowGroupLimit).

Everything else — joins with profiles and fallback means, the weighted sums,
metrics — is plain DataFrame code.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankwell.functions.columns import clamp
from rankwell.session import cut_lineage

TILE = 2048
SIM_SCALE = 1e9
NB_FACTOR = 4
# Target rows (queries + raters) per hash bucket of small items.
GROUP_ROWS = 200_000


def quantize_sim(x):
    """Similarity rounded half-up to 9 decimals (NumPy and SQL use the same formula)."""
    return np.floor(x * SIM_SCALE + 0.5) / SIM_SCALE


def _topn_tile(keys, qdf: pd.DataFrame, rdf: pd.DataFrame, n: int, k: int) -> pd.DataFrame:
    out = []
    if len(qdf) == 0 or len(rdf) == 0:
        return pd.DataFrame({"user_id": [], "item_id": [], "neighbour_id": [], "sim": [], "rating": []})
    zq_all = qdf[[f"z{c}" for c in range(k)]].to_numpy(dtype=np.float64)
    zr_all = rdf[[f"w{c}" for c in range(k)]].to_numpy(dtype=np.float64)
    q_items = qdf["item_id"].to_numpy()
    r_items = rdf["item_id"].to_numpy()
    r_order = np.lexsort((rdf["neighbour_id"].to_numpy(), r_items))
    r_items_sorted = r_items[r_order]
    q_order = np.argsort(q_items, kind="stable")
    q_items_sorted = q_items[q_order]
    items = np.unique(q_items_sorted)
    r_lo = np.searchsorted(r_items_sorted, items, "left")
    r_hi = np.searchsorted(r_items_sorted, items, "right")
    q_lo = np.searchsorted(q_items_sorted, items, "left")
    q_hi = np.searchsorted(q_items_sorted, items, "right")
    nb_all = rdf["neighbour_id"].to_numpy()
    rating_all = rdf["rating"].to_numpy()
    users_all = qdf["user_id"].to_numpy()
    for it, a0, a1, b0, b1 in zip(items, q_lo, q_hi, r_lo, r_hi):
        if b1 <= b0:
            continue
        qi = q_order[a0:a1]
        ri = r_order[b0:b1]          # raters sorted by neighbour id
        zq, zr = zq_all[qi], zr_all[ri]
        # Same accumulation order as the SQL oracle: ((q0·r0 + q1·r1) + q2·r2) ...
        sim = np.multiply.outer(zq[:, 0], zr[:, 0])
        for c in range(1, k):
            sim = sim + np.multiply.outer(zq[:, c], zr[:, c])
        sim = quantize_sim(sim)
        m = min(n, sim.shape[1])
        # The m-th best similarity of each query by partition, then only what reaches it is sorted: by query,
        # similarity (descending) and place, which is the order of neighbour ids.
        least = -np.partition(-sim, m - 1, axis=1)[:, m - 1]
        rows, cols = np.nonzero(sim >= least[:, None])
        order = np.lexsort((cols, -sim[rows, cols], rows))
        rows, cols = rows[order], cols[order]
        keep = np.arange(len(rows)) - np.searchsorted(rows, rows, "left") < m
        rows, cols = rows[keep], cols[keep]
        out.append(pd.DataFrame({
            "user_id": users_all[qi][rows],
            "item_id": np.full(len(rows), it),
            "neighbour_id": nb_all[ri][cols],
            "sim": sim[rows, cols],
            "rating": rating_all[ri][cols],
        }))
    if not out:
        return pd.DataFrame({"user_id": [], "item_id": [], "neighbour_id": [], "sim": [], "rating": []})
    return pd.concat(out, ignore_index=True)


TOPN_SCHEMA = "user_id long, item_id long, neighbour_id long, sim double, rating int"


def top_neighbours(pairs: DataFrame, train: DataFrame, unit: DataFrame, k: int, n: int,
                   tile: int = TILE) -> DataFrame:
    """For every (user_id, item_id) in ``pairs`` whose user has a
    profile and whose item has raters, the ``n`` raters of the item most
    similar to the user (sim desc, neighbour id asc), with rank 1..n."""
    spark = pairs.sparkSession
    zcols = [f"z{c}" for c in range(k)]
    q = (pairs.select("user_id", "item_id").join(unit, "user_id"))
    wcols = [f"w{c}" for c in range(k)]
    r = (train.select(F.col("user_id").alias("neighbour_id"), "item_id", "rating")
         .join(unit.select(F.col("user_id").alias("neighbour_id"),
                           *[F.col(z).alias(w) for z, w in zip(zcols, wcols)]), "neighbour_id"))
    # Counted before the profiles are joined: users without one can only make a tile smaller.
    tiles = cut_lineage(train.groupBy("item_id").agg(F.count(F.lit(1)).alias("nr"))
                        .join(pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("nq")), "item_id")
                        .select("item_id", F.ceil(F.col("nq") / tile).cast("int").alias("A"),
                                F.ceil(F.col("nr") / tile).cast("int").alias("B"),
                                (F.col("nq") * F.ceil(F.col("nr") / tile)).alias("nq_rows"),
                                (F.col("nr") * F.ceil(F.col("nq") / tile)).alias("nr_rows")))
    # A few buckets of small items for each core, and enough that one stays around GROUP_ROWS rows
    # whatever the data size (one scalar: the total number of rows to tile).
    total = tiles.agg(F.sum(F.col("nq_rows") + F.col("nr_rows"))).first()[0] or 0
    nb = max(spark.sparkContext.defaultParallelism * NB_FACTOR, -(-int(total) // GROUP_ROWS))
    tiles = tiles.drop("nq_rows", "nr_rows")
    bucket = F.pmod(F.xxhash64("item_id"), F.lit(nb)).cast("int")
    qt = (q.join(tiles, "item_id")
          .select("user_id", "item_id", *zcols, bucket.alias("bucket"),
                  F.pmod(F.xxhash64("user_id"), F.col("A")).cast("int").alias("a"),
                  F.explode(F.sequence(F.lit(0), F.col("B") - 1)).alias("b")))
    rt = (r.join(tiles, "item_id")
          .select("neighbour_id", "item_id", "rating", *wcols, bucket.alias("bucket"),
                  F.explode(F.sequence(F.lit(0), F.col("A") - 1)).alias("a"),
                  F.pmod(F.xxhash64("neighbour_id"), F.col("B")).cast("int").alias("b")))

    def tile_fn(key, qdf, rdf):
        return _topn_tile(key, qdf, rdf, n, k)

    partial = (qt.groupBy("bucket", "a", "b").cogroup(rt.groupBy("bucket", "a", "b"))
               .applyInPandas(tile_fn, TOPN_SCHEMA))
    w = Window.partitionBy("user_id", "item_id").orderBy(F.desc("sim"), F.asc("neighbour_id"))
    return partial.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def similarity_block(unit: DataFrame, k: int, n: int = 10) -> DataFrame:
    """The n × n corner of the user similarity matrix: user_id and ``s1`` ... ``sn``, the similarities with the n users of
    the smallest ids, in their order (the limit is the report; n users form one array)."""
    first = unit.orderBy("user_id").limit(n)
    zs = F.array(*[f"z{c}" for c in range(k)])
    others = first.agg(F.sort_array(F.collect_list(F.struct("user_id", zs.alias("z")))).alias("u")).select("u").scalar()
    rows = first.withColumn("__u", others)

    def sim(j: int) -> F.Column:
        other = F.get(F.col("__u"), F.lit(j))["z"]
        dot = F.col("z0") * other[0]
        for c in range(1, k):
            dot = dot + F.col(f"z{c}") * other[c]
        return F.floor(dot * SIM_SCALE + 0.5) / SIM_SCALE
    return rows.select("user_id", *[sim(j).alias(f"s{j + 1}") for j in range(n)])


def fallback_means(train: DataFrame, mode: str = "observed") -> tuple[DataFrame, DataFrame, F.Column]:
    """R2: per-item and per-user fallback means and the global constant.

    observed   : mean of the ratings actually given;
    zero_filled: mean over the zero-filled user × item matrix (the reference's
                 first predictor): Σ r / #users for an item, Σ r / #items for a user."""
    if mode == "observed":
        im = train.groupBy("item_id").agg(F.avg("rating").alias("item_mean"))
        um = train.groupBy("user_id").agg(F.avg("rating").alias("user_mean"))
    elif mode == "zero_filled":
        n_users = train.agg(F.countDistinct("user_id")).scalar()
        n_items = train.agg(F.countDistinct("item_id")).scalar()
        im = train.groupBy("item_id").agg((F.sum("rating") / n_users).alias("item_mean"))
        um = train.groupBy("user_id").agg((F.sum("rating") / n_items).alias("user_mean"))
    else:
        raise ValueError(mode)
    return im, um, F.lit(3.0)


def _source_and_value(ss: F.Column, ws: F.Column, const: F.Column) -> tuple[F.Column, F.Column]:
    """The fallback rules of ``predict``, from the sums and the joined means."""
    source = (F.when(F.col("user_mean").isNull(), F.lit("cold_user"))
              .when(F.col("item_mean").isNull(), F.lit("cold_item"))
              .when(F.coalesce(ss, F.lit(0.0)) == 0, F.lit("zero_similarity"))
              .otherwise(F.lit("knn")))
    value = (F.when(F.col("user_mean").isNull(), F.coalesce(F.col("item_mean"), const))
             .when(F.col("item_mean").isNull(), F.col("user_mean"))
             .when(F.coalesce(ss, F.lit(0.0)) == 0, F.col("item_mean"))
             .otherwise(clamp(ws / ss)))
    return source, value


def predict(pairs: DataFrame, train: DataFrame, unit: DataFrame, k: int, n: int = 10,
            fallback: str = "observed", neighbours: DataFrame | None = None) -> DataFrame:
    """R1 + R2: one prediction per pair with its ``source``:

    cold_user       user has no training rating (no mean) -> item mean (3.0 if the item is cold too)
    cold_item       item has no training rating  -> user mean
    zero_similarity Σ|s| = 0 over the neighbours -> item mean
    knn             clamp(Σ s·r / Σ|s|, 1, 5)
    """
    nb = neighbours if neighbours is not None else top_neighbours(pairs, train, unit, k, n)
    agg = (nb.filter(F.col("rank") <= n).groupBy("user_id", "item_id")
           .agg(F.sum(F.col("sim") * F.col("rating")).alias("ws"), F.sum(F.abs("sim")).alias("ss")))
    im, um, const = fallback_means(train, fallback)
    base = pairs.join(agg, ["user_id", "item_id"], "left").join(im, "item_id", "left").join(um, "user_id", "left")
    source, value = _source_and_value(F.col("ss"), F.col("ws"), const)
    return base.withColumn("source", source).withColumn("predicted", value).drop("ws", "ss", "item_mean", "user_mean")


def predict_many(pairs: DataFrame, train: DataFrame, neighbours: DataFrame, ns: list[int], fallback: str = "observed") -> DataFrame:
    """``predict`` for several numbers of neighbours at once: columns ``predicted_{n}``.

    One pass over the neighbours (conditional sums) and one join of the fallback means for all of them."""
    sums = []
    for n in ns:
        near = F.col("rank") <= n
        sums += [F.sum(F.when(near, F.col("sim") * F.col("rating"))).alias(f"ws{n}"), F.sum(F.when(near, F.abs("sim"))).alias(f"ss{n}")]
    im, um, const = fallback_means(train, fallback)
    base = (pairs.join(neighbours.groupBy("user_id", "item_id").agg(*sums), ["user_id", "item_id"], "left")
            .join(im, "item_id", "left").join(um, "user_id", "left"))
    return base.select("user_id", "item_id", "rating",
                       *[_source_and_value(F.col(f"ss{n}"), F.col(f"ws{n}"), const)[1].alias(f"predicted_{n}") for n in ns])


def baseline_predict(pairs: DataFrame, train: DataFrame) -> DataFrame:
    """Global training mean for every pair (a scalar subquery, no cross join)."""
    mean = train.agg(F.avg("rating")).scalar()
    return pairs.withColumn("predicted", mean).withColumn("source", F.lit("global_mean"))
