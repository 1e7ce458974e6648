"""Deterministic K-Means over long-form ratings.

Items are the points, users the dimensions, absent cells are 0.  Nothing is
pivoted to a dense matrix: a centre is stored as integer sums S[j,u] (sum of
the ratings user u gave to the items of cluster j) plus the cluster size n[j],
so for integer ratings every distance needs only three floating-point steps:

    dist²(i, j) = ‖i‖² − 2·Σ_u r[u,i]·S[j,u] / n[j] + Σ_u S[j,u]² / n[j]²

The two sums over u are exact BIGINT aggregates, so Spark and any SQL engine
agree to the last bit, and WCSS collapses to Σ_j (N[j] − Q[j]/n[j]) with
N[j] = Σ_{i∈j} ‖i‖² and Q[j] = Σ_u S[j,u]².

One Lloyd step is two sums over the ratings:

    clusters of the items → S[j,u] of each user → Σ r·S of each item, argmin

on packed tiles of users and blocks of items (``lloyd_tiles``).  Several k run
side by side in the same passes (one assignment column per k); a k whose
assignment is stable leaves the passes and keeps its column.  A few steps are one job, whose state
is written to the shared checkpoint folder to cut lineage; older ones are deleted.

Initialisation is the deterministic partition rule: cluster(i) = i mod k.
Ties in the argmin go to the lowest cluster index after rounding distances to
6 decimals; an emptied cluster keeps its previous centre.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.operators.lloyd_tiles import Passes
from rankwell.session import cut_lineage, release

DIST_DEC = 6
#: Runs of one k from several starts are numbered start · RUNS + k; a plain k is start 0.
RUNS = 1_000_000


def run(start: int, k: int) -> int:
    return start * RUNS + k


def _n(k: int) -> int:
    """The number of clusters of a run."""
    return k % RUNS


def _a(k):
    return f"a{k}"


def _s(k, j):
    return f"s{k}_{j}"


@dataclass
class LloydResult:
    ks: list[int]
    assign: DataFrame                    # point_id, a{k}...
    sizes: dict = field(default_factory=dict)     # (k, j) -> n
    sq: dict = field(default_factory=dict)        # (k, j) -> Q, in the cells' numeric type
    iterations: dict = field(default_factory=dict)  # k -> steps until stable
    converged: dict = field(default_factory=dict)

    @cached_property
    def sums(self) -> DataFrame:
        """dim_id, s{k}_{j}...: the centres of the final assignment, written when they are asked for."""
        return cut_lineage(_centre_sums(self.rows, self.assign, self.ks))


def _centre_sums(t: DataFrame, assign: DataFrame, ks: list[int]) -> DataFrame:
    dtype = dict(t.dtypes)["v"]
    aggs = [F.sum(F.when(F.col(_a(k)) == c, F.col("v")).otherwise(F.lit(0))).cast(dtype).alias(_s(k, c))
            for k in ks for c in range(_n(k))]
    return t.join(assign, "point_id").groupBy("dim_id").agg(*aggs)


def quantize(x: F.Column, dec: int = DIST_DEC) -> F.Column:
    """floor(x·10^dec + 0.5) as an integer: the distance rounded half-up to
    ``dec`` decimals, with the same arithmetic in Spark and in SQL."""
    return F.floor(x * F.lit(float(10 ** dec)) + F.lit(0.5))


def distance(nrm: F.Column, dot: F.Column, n: F.Column, q: F.Column) -> F.Column:
    """Squared distance of a point to a centre given the exact sums, quantized.

    n and q (cluster size, Σ_u S²) are columns of a small joined table, not
    driver literals, so the generated code is the same in every iteration."""
    return F.when(n > 0, quantize(nrm.cast("double") - F.lit(2.0) * dot.cast("double") / n + q / (n * n))
                  ).cast("bigint")


def nearest(distances: F.Column) -> F.Column:
    """(d, j): the smallest of an array of quantized distances and its index, lowest index on ties; a null distance
    (empty cluster) never wins.  Any number of clusters."""
    least = F.array_min(distances)
    return F.struct(least.alias("d"), (F.array_position(distances, least) - 1).cast("int").alias("j"))


def _nearest(t: DataFrame, sums: DataFrame, norms: DataFrame, ks: list[int], sizes: dict, sq: dict) -> DataFrame:
    """point_id and, for each k, the struct ``b{k}`` (d, j) of its nearest centre.

    Σ_u r·S per (point, centre) is one wide partial aggregate, compared with the centres' sizes and Σ S² inside the
    row.  These are a one-row scalar subquery, so the generated code stays the same from step to step, and the
    comparison is a function of arrays, so its code does not grow with the number of centres."""
    dtype = dict(t.dtypes)["v"]
    dots = (t.join(sums, "dim_id").groupBy("point_id")
            .agg(*[F.sum(F.col("v") * F.col(_s(k, c))).cast(dtype).alias(_s(k, c)) for k in ks for c in range(_n(k))])
            .select("point_id", *[F.array(*[_s(k, c) for c in range(_n(k))]).alias(f"dots{k}") for k in ks]))
    one = t.sparkSession.createDataFrame(
        [tuple([(float(sizes[k, c]), float(sq[k, c])) for c in range(_n(k))] for k in ks)],
        ", ".join(f"s{k} array<struct<n:double,q:double>>" for k in ks))
    wide = dots.join(norms, "point_id").withColumn("__s", one.select(F.struct("*")).scalar())
    far = wide.select("point_id", *[F.zip_with(f"dots{k}", F.col(f"__s.s{k}"), lambda dot, c: distance(F.col("nrm"), dot, c["n"], c["q"])).alias(f"b{k}")
                                    for k in ks])
    return far.select("point_id", *[nearest(F.col(f"b{k}")).alias(f"b{k}") for k in ks])


def _sizes(assign: DataFrame, ks: list[int]) -> dict:
    row = assign.agg(*[F.count_if(F.col(_a(k)) == c).alias(_s(k, c)) for k in ks for c in range(_n(k))]).first()
    return {(k, c): int(row[_s(k, c)]) for k in ks for c in range(_n(k))}


def lloyd(cells: DataFrame, ks: list[int], max_iter: int = 300, point: str = "item_id",
          dim: str = "user_id", value: str = "rating", start: DataFrame | None = None) -> LloydResult:
    """Run Lloyd's algorithm for every k in ``ks`` side by side until each
    assignment stops changing (or ``max_iter`` steps; ``converged`` says which).
    ``start`` has the first assignment (point_id, a{k}...) if it is not the modulo rule.

    Steps run over packed tiles of ratings, several in a job (``lloyd_tiles``); the driver
    sees only its sizes, Σ S² and numbers of changes."""
    ks = list(ks)
    dtype = "bigint" if dict(cells.dtypes)[value] in ("tinyint", "smallint", "int", "bigint") else "double"
    t = cells.select(F.col(point).alias("point_id"), F.col(dim).alias("dim_id"),
                     F.col(value).cast(dtype).alias("v"))
    kept = t.persist()
    known = F.col("dim_id").isNotNull()
    base = cut_lineage(kept.groupBy("point_id").agg(F.sum(F.col("v") * F.col("v")).cast(dtype).alias("nrm"),
                                                    F.when(F.count_if(known) > 0, F.count(F.when(known, F.col("v")))).alias("values")))
    norms = base.select("point_id", "nrm")
    if start is not None:
        assign = cut_lineage(start.select("point_id", *[_a(k) for k in ks]))
        first, begun = _sizes(assign, ks), assign.join(base, "point_id")
    else:
        first, begun = None, base.select("*", *[F.pmod(F.col("point_id"), F.lit(_n(k))).cast("int").alias(_a(k)) for k in ks])
        assign = begun.select("point_id", *[_a(k) for k in ks])
    res = LloydResult(ks=ks, assign=assign)
    passes = Passes(kept, begun, ks, _n)
    active, state, step = list(ks), None, 0
    while active and (state is None or step < max_iter):
        last = state
        state, sizes, _, sq = passes.step(last, active, first, steps=min(passes.steps, max_iter - step))
        if last is not None:
            release(last)
        res.sizes.update(sizes)
        res.sq.update(sq)
        for i, changes in enumerate(passes.trail, step + 1):
            for k in [k for k in active if changes[k] == 0]:
                res.iterations[k], res.converged[k] = i, True
                active.remove(k)
        step += len(passes.trail)
    for k in active:
        res.iterations[k], res.converged[k] = max_iter, False
    if max_iter > 0 and state is not None:
        res.assign = cut_lineage(passes.assignment(state))
    passes.close()
    kept.unpersist()
    res.norms = norms
    res.cells = (point, dim, value)
    res.rows = t
    return res


def nearest_with_distance(res: LloydResult, cells: DataFrame, k: int) -> DataFrame:
    """(point_id, cluster, distance): Euclidean distance of every point to
    its final centre (from the quantized squared distance)."""
    point, dim, value = res.cells
    dtype = dict(res.norms.dtypes)["nrm"]
    t = cells.select(F.col(point).alias("point_id"), F.col(dim).alias("dim_id"), F.col(value).cast(dtype).alias("v"))
    sums = res.sums.select("dim_id", *[_s(k, c) for c in range(k)])
    best = _nearest(t, sums, res.norms, [k], res.sizes, res.sq)
    return best.select("point_id", F.col(f"b{k}.j").alias("cluster"),
                       F.sqrt(F.greatest(F.lit(0.0), F.col(f"b{k}.d") / F.lit(float(10 ** DIST_DEC)))).alias("distance"))


def dense_lloyd(points: DataFrame, dims: list[str], k: int, max_iter: int = 300) -> tuple[DataFrame, int, bool]:
    """K-Means for points with few integer columns (``point_id`` and ``dims``): (point_id, cluster, d), the steps, and
    whether the assignment is stable.  The same rules as ``lloyd``; ``d`` is the quantized squared distance.

    The k × dims centre sums are exact and known to the driver, so a step is one aggregate over the cached points:
    an assignment is a function of the centres before it, the last two sets give the changes, nothing is written."""
    points = points.select("point_id", *[F.col(d).cast("bigint").alias(d) for d in dims]).persist()
    norm = sum((F.col(d) * F.col(d) for d in dims[1:]), F.col(dims[0]) * F.col(dims[0]))

    def best(df: DataFrame, name: str, centres: list[tuple[int, list[int]]]) -> DataFrame:
        one = df.sparkSession.createDataFrame(
            [([float(n) for n, _ in centres], [float(sum(x * x for x in s)) for _, s in centres], [s for _, s in centres])],
            "n array<double>, q array<double>, s array<array<bigint>>")
        df = df.withColumn(f"__{name}", one.select(F.struct("n", "q", "s")).scalar())

        def to(j: int) -> F.Column:
            s = F.get(f"__{name}.s", F.lit(j))
            dot = sum((F.col(d) * F.get(s, F.lit(i)) for i, d in enumerate(dims[1:], 1)), F.col(dims[0]) * F.get(s, F.lit(0)))
            return distance(norm, dot, F.get(f"__{name}.n", F.lit(j)), F.get(f"__{name}.q", F.lit(j)))
        return df.withColumn(f"__{name}_far", F.array(*[to(j) for j in range(k)])).withColumn(name, nearest(F.col(f"__{name}_far")))

    def centres_of(df: DataFrame, cluster: F.Column, kept: list) -> tuple[list[tuple[int, list[int]]], int]:
        rows = df.groupBy(cluster.alias("j")).agg(F.count(F.lit(1)).alias("n"), F.count_if("changed").alias("changed"),
                                                  *[F.sum(d).alias(d) for d in dims]).collect()
        out = list(kept) if kept else [(0, [0] * len(dims))] * k
        for r in rows:
            out[r["j"]] = (r["n"], [r[d] for d in dims])
        return out, sum(r["changed"] for r in rows)

    start = F.pmod(F.col("point_id"), F.lit(k)).cast("int")
    centres, _ = centres_of(points.withColumn("changed", F.lit(False)), start, [])
    before, steps, stable = None, 0, False
    while steps < max_iter and not stable:
        steps += 1
        now = best(points, "now", centres)
        now = now.withColumn("old", start) if before is None else best(now, "last", before).withColumn("old", F.col("last.j"))
        before, (centres, changed) = centres, centres_of(now.withColumn("changed", F.col("now.j") != F.col("old")), F.col("now.j"), centres)
        stable = changed == 0
    out = cut_lineage(best(points, "now", before).select("point_id", F.col("now.j").alias("cluster"), F.col("now.d").alias("d")))
    points.unpersist()
    return out, steps, stable


def wcss(res: LloydResult) -> DataFrame:
    """M2: k, iterations, WCSS = Σ_j (N_j − Q_j / n_j) and whether the run converged, per k.

    N_j is a distributed aggregate of the final assignment; Q_j and n_j are
    the k-sized scalars of the final centres."""
    a = res.assign.join(res.norms, "point_id")
    spark = a.sparkSession
    # A row per run and cluster, not a column: one small aggregate, whose plan does not grow with the number of clusters.
    of_run = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(_a(k)).alias("c")) for k in res.ks]))
    norms = {(r["k"], r["c"]): r["n"] for r in a.select("nrm", of_run.alias("x")).groupBy("x.k", "x.c").agg(F.sum("nrm").alias("n")).collect()}
    rows = []
    for k in res.ks:
        met, total = {c for of, c in norms if of == k}, 0.0
        for c in range(_n(k)):
            n, own = res.sizes[(k, c)], norms.get((k, c))
            # Without points, or if they all are in one cluster and have no norm, the sum is unknown.
            if own is None and met - {c}:
                own = 0
            total = None if total is None or own is None else total + (float(own) - (float(res.sq[(k, c)]) / float(n) if n else 0.0))
        rows.append((k, res.iterations[k], total, res.converged[k]))
    return spark.createDataFrame(rows, "k int, iterations int, wcss double, converged boolean").select(
        "k", "iterations", F.round("wcss", 2).alias("wcss"), "converged")


def elbow(sweep: DataFrame, method: str = "argmin") -> DataFrame:
    """Second difference x[k+1] − 2·x[k] + x[k−1] over the k series;
    the reference rule picks the k with the smallest value (``argmax`` for the
    textbook elbow).  The series has one row per k (tiny) so a global window is fine."""
    from pyspark.sql import Window
    w = Window.orderBy("k")
    d2 = (sweep.select("k", "wcss",
                       (F.lead("wcss", 1).over(w) - 2 * F.col("wcss") + F.lag("wcss", 1).over(w)).alias("d2"))
          .filter(F.col("d2").isNotNull()))
    pick = F.min_by("k", F.col("d2")) if method == "argmin" else F.max_by("k", F.col("d2"))
    return d2.agg(pick.alias("elbow_k"))


def cluster_sizes(assign: DataFrame, k: int) -> DataFrame:
    """Items per cluster and share in percent."""
    total = assign.agg(F.count(F.lit(1))).scalar()
    return (assign.groupBy(F.col(_a(k)).alias("cluster")).agg(F.count(F.lit(1)).alias("n_items"))
            .select("cluster", "n_items", F.round(F.col("n_items") * 100.0 / total, 6).alias("pct")))


def item_clusters(res: LloydResult, k: int, point: str = "item_id") -> DataFrame:
    return res.assign.select(F.col("point_id").alias(point), F.col(_a(k)).alias("cluster"))


def utility_summary(train: DataFrame) -> DataFrame:
    """Users, items, stored cells and sparsity (% empty cells) of the
    user × item matrix, without building it."""
    agg = train.agg(F.countDistinct("user_id").alias("n_users"), F.countDistinct("item_id").alias("n_items"),
                    F.count(F.lit(1)).alias("n_cells"))
    return agg.select("n_users", "n_items", "n_cells",
                      F.round((F.lit(1.0) - F.col("n_cells") / (F.col("n_users") * F.col("n_items"))) * 100, 6)
                      .alias("sparsity_pct"))


def user_cluster_profile(train: DataFrame, clusters: DataFrame, k: int) -> DataFrame:
    """Mean rating each user gives to each item cluster, 0 where the
    user rated nothing in it.  Pivot on the cluster id only (k columns)."""
    j = train.join(clusters, "item_id")
    return (j.groupBy("user_id").pivot("cluster", list(range(k))).agg(F.avg("rating"))
            .select("user_id", *[F.coalesce(F.col(str(c)), F.lit(0.0)).alias(f"p{c}") for c in range(k)]))


def unit_centred(profile: DataFrame, k: int) -> DataFrame:
    """M6 + normalisation for M7: subtract the row mean over all k cells
    (zeros included), divide by the Euclidean norm; a zero-norm row becomes
    the zero vector so every similarity with it is 0."""
    mean = None
    for c in range(k):
        mean = F.col(f"p{c}") if mean is None else mean + F.col(f"p{c}")
    mean = mean / F.lit(float(k))
    cen = profile.select("user_id", *[(F.col(f"p{c}") - mean).alias(f"x{c}") for c in range(k)])
    sq = None
    for c in range(k):
        term = F.col(f"x{c}") * F.col(f"x{c}")
        sq = term if sq is None else sq + term
    norm = F.sqrt(sq)
    return cen.select("user_id", *[F.when(norm > F.lit(1e-12), F.col(f"x{c}") / norm).otherwise(F.lit(0.0))
                                   .alias(f"z{c}") for c in range(k)])
