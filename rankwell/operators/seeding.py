"""K-Means from several starts side by side, seeded by oversampling (M1).

Seeds of a start: the first candidate is the point with the smallest hash; in each of a few rounds every point joins the
candidates with probability ``OVERSAMPLE · k · d² / Σ d²``, d² being its squared distance to the nearest candidate.  A round is one
pass whatever k is, and the draw is a hash of (seed, start, round, point), so a lost task draws the same again.  Each candidate
weighs as many points as are nearest to it, and the heaviest one, then always the one with the largest weight · d² to the seeds
so far, become the k seeds (ties: the smaller id).

The driver sees the candidates only: about ``1 + rounds · OVERSAMPLE · k`` a start, and the distances between those of a start.
Distances of all points to the candidates that are new in a round come from the ratings of the users who rated one of them:
no other rating is shuffled.

Start 0 is the modulo rule of ``cluster.lloyd``, so the best start is never worse than it.  Every start is a run of the same
Lloyd passes, numbered ``cluster.run(start, k)``.

Defined cases: fewer than k different points leave the other clusters empty; repeated (point, dim) cells add up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.operators import cluster
from rankwell.operators.cluster import _a, run
from rankwell.session import cut_lineage, release

ROUNDS = 4
OVERSAMPLE = 2


def _hash(seed: int, start: int, rnd: int) -> F.Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(str(start)), F.lit(str(rnd)), F.col("point_id").cast("string")))


def _closest(t: DataFrame, norms: DataFrame, picks: dict[int, list]) -> DataFrame:
    """point_id and, per start, the struct ``b{start}`` (d, i): the quantized squared distance to the nearest picked point of the
    start and its place in the list."""
    dtype = dict(t.dtypes)["v"]
    wanted = sorted({p for ids in picks.values() for p in ids})
    square = {r["point_id"]: r["nrm"] for r in norms.filter(F.col("point_id").isin(wanted)).collect()}
    # Only ratings of users who rated a picked point are joined and shuffled; a point that shares no user with it has the product 0.
    # They are written first: where they are few, their size lets all other ratings stay where they are.
    picked = cut_lineage(t.filter(F.col("point_id").isin(wanted) & F.col("dim_id").isNotNull()).groupBy("dim_id", F.col("point_id").alias("pick")).agg(
        F.coalesce(F.sum("v"), F.lit(0)).cast(dtype).alias("x")))
    # A point has at most one product for each of the few picked points.
    dots = (t.join(picked, "dim_id").groupBy("point_id", "pick").agg(F.sum(F.col("v") * F.col("x")).cast(dtype).alias("dot"))
            .filter("point_id is not null and dot is not null").groupBy("point_id").agg(F.map_from_entries(F.collect_list(F.struct("pick", "dot"))).alias("dots")))
    wide = norms.filter("met").join(dots, "point_id", "left")
    one = t.sparkSession.createDataFrame(
        [tuple([(p, None if square[p] is None else float(square[p])) for p in ids] for ids in picks.values())],
        ", ".join(f"s{s} array<struct<p:{dict(t.dtypes)['point_id']},q:double>>" for s in picks))
    wide = wide.withColumn("__s", one.select(F.struct("*")).scalar())

    def to(c: F.Column) -> F.Column:
        dot = F.when(F.col("valued"), F.coalesce(F.try_element_at("dots", c["p"]), F.lit(0).cast(dtype)))
        return cluster.distance(F.col("nrm"), dot, F.lit(1.0), c["q"])
    far = wide.select("point_id", *[F.transform(F.col(f"__s.s{s}"), to).alias(f"b{s}") for s in picks])
    best = far.select("point_id", *[cluster.nearest(F.col(f"b{s}")).alias(f"b{s}") for s in picks])
    return best.select("point_id", *[F.struct(F.col(f"b{s}.d").alias("d"), F.col(f"b{s}.j").alias("i")).alias(f"b{s}") for s in picks])


def _named(near: DataFrame, picks: dict[int, list]) -> DataFrame:
    """``near`` with the id of the nearest picked point (c) in the place of its number."""
    return near.select("point_id", *[
        F.struct(F.col(f"b{s}.d").alias("d"), F.element_at(F.array(*[F.lit(p) for p in ids]), F.col(f"b{s}.i") + 1).cast("bigint").alias("c"))
        .alias(f"b{s}") for s, ids in picks.items()])


def _candidates(t: DataFrame, norms: DataFrame, k: int, starts: list[int], rounds: int, seed: int) -> dict[int, dict]:
    """Per start: the candidates and their weights."""
    first = norms.agg(*[F.min_by("point_id", F.struct(_hash(seed, s, 0), "point_id")).alias(f"p{s}") for s in starts]).first()
    if first is None or first[f"p{starts[0]}"] is None:
        return {s: {} for s in starts}
    picks = {s: [first[f"p{s}"]] for s in starts}
    state = cut_lineage(_named(_closest(t, norms, picks), picks))
    for rnd in range(1, rounds + 1):
        cost = state.agg(*[F.sum(F.col(f"b{s}.d").cast("decimal(38,0)")).cast("double").alias(f"c{s}") for s in starts]).first()

        def joins(s: int) -> F.Column:
            draw = F.conv(F.substring(_hash(seed, s, rnd), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
            return draw * F.lit(cost[f"c{s}"]) < F.lit(float(OVERSAMPLE * k)) * F.col(f"b{s}.d").cast("double")
        drawn = state.select("point_id", F.explode(F.array(*[F.when(joins(s), F.lit(s)) for s in starts])).alias("start"))
        picks = {}
        for r in drawn.filter("start IS NOT NULL").collect():
            picks.setdefault(r["start"], []).append(r["point_id"])
        if not picks:
            continue
        picks = {s: sorted(ids) for s, ids in sorted(picks.items())}
        new = _named(_closest(t, norms, picks), picks).select("point_id", *[F.col(f"b{s}").alias(f"n{s}") for s in picks])
        old, state = state, cut_lineage(state.join(new, "point_id").select(
            "point_id", *[(F.least(f"b{s}", f"n{s}") if s in picks else F.col(f"b{s}")).alias(f"b{s}") for s in starts]))
        release(old)
    weights = (state.select(F.explode(F.array(*[F.struct(F.lit(s).alias("start"), F.col(f"b{s}.c").alias("c")) for s in starts])).alias("x"))
               .groupBy("x.start", "x.c").agg(F.count(F.lit(1)).alias("w")).collect())
    release(state)
    out: dict[int, dict] = {s: {} for s in starts}
    for r in weights:
        out[r["start"]][r["c"]] = r["w"]
    return out


def _reduce(t: DataFrame, norms: DataFrame, weights: dict[int, dict], k: int) -> dict[int, list]:
    """k of the weighted candidates of each start."""
    spark = t.sparkSession
    rows = [(s, c) for s, found in weights.items() for c in found]
    if not rows:
        return {s: [] for s in weights}
    named = spark.createDataFrame(rows, "start int, c bigint")
    cells = t.join(F.broadcast(named), F.col("point_id") == F.col("c")).groupBy("start", "dim_id", "c").agg(F.sum("v").alias("v"))
    other = cells.select("start", "dim_id", F.col("c").alias("o"), F.col("v").alias("x"))
    dots = cells.join(other, ["start", "dim_id"]).filter("c < o").groupBy("start", "c", "o").agg(F.sum(F.col("v") * F.col("x")).alias("dot"))
    dot = {(r["start"], r["c"], r["o"]): r["dot"] for r in dots.collect()}
    square = {r["point_id"]: r["nrm"] for r in norms.filter(F.col("point_id").isin(sorted({c for _, c in rows}))).collect()}
    out = {}
    for s, found in weights.items():
        chosen = [min(found, key=lambda c: (-found[c], c))] if found else []
        far = dict.fromkeys(found)
        while chosen and len(chosen) < k:
            last = chosen[-1]
            for c in found:
                d = square[c] + square[last] - 2 * dot.get((s, min(c, last), max(c, last)), 0) if c != last else 0
                far[c] = d if far[c] is None else min(far[c], d)
            best = min(found, key=lambda c: (-found[c] * far[c], c))
            if found[best] * far[best] <= 0:
                break
            chosen.append(best)
        out[s] = chosen
    return out


def _cells(cells: DataFrame, point: str, dim: str, value: str) -> tuple[DataFrame, DataFrame]:
    dtype = "bigint" if dict(cells.dtypes)[value] in ("tinyint", "smallint", "int", "bigint") else "double"
    t = cells.select(F.col(point).alias("point_id"), F.col(dim).alias("dim_id"), F.col(value).cast(dtype).alias("v")).persist()
    known = F.col("dim_id").isNotNull()
    # met: the point has a dimension; valued: it has a value there.
    return t, cut_lineage(t.groupBy("point_id").agg(F.sum(F.col("v") * F.col("v")).cast(dtype).alias("nrm"), (F.count_if(known) > 0).alias("met"),
                                                    (F.count(F.when(known, F.col("v"))) > 0).alias("valued")).withColumn("met", F.col("met") & F.col("point_id").isNotNull()))


def seeds(cells: DataFrame, k: int, starts: int = 3, rounds: int = ROUNDS, seed: int = 42, point: str = "item_id",
          dim: str = "user_id", value: str = "rating") -> tuple[dict[int, list], DataFrame]:
    """Per start (from 1) the ids of its seeds, and the assignment of all starts and of the modulo rule (start 0):
    point_id and the column ``a{run}`` of each."""
    t, norms = _cells(cells, point, dim, value)
    weights = _candidates(t, norms, k, list(range(1, starts + 1)), rounds, seed)
    chosen = _reduce(t, norms, weights, k)
    modulo = F.pmod(F.col("point_id"), F.lit(k)).cast("int").alias(_a(run(0, k)))
    if any(chosen.values()):
        near = _closest(t, norms, chosen)
        assign = cut_lineage(near.select("point_id", modulo, *[F.col(f"b{s}.i").alias(_a(run(s, k))) for s in chosen]))
    else:
        assign = norms.select("point_id", modulo, *[F.lit(0).alias(_a(run(s, k))) for s in chosen])
    t.unpersist()
    return chosen, assign


def fit(cells: DataFrame, k: int, starts: int = 3, rounds: int = ROUNDS, seed: int = 42, max_iter: int = 300,
        point: str = "item_id", dim: str = "user_id", value: str = "rating") -> tuple[cluster.LloydResult, DataFrame]:
    """All starts, and their table: start, k, iterations, wcss, converged, best (the smallest WCSS, the first start of equals)."""
    _, assign = seeds(cells, k, starts, rounds, seed, point, dim, value)
    res = cluster.lloyd(cells, [run(s, k) for s in range(starts + 1)], max_iter, point, dim, value, start=assign)
    found = cluster.wcss(res).select(F.expr(f"k DIV {cluster.RUNS}").cast("int").alias("start"), F.lit(k).alias("k"),
                                     "iterations", "wcss", "converged")
    least = found.agg(F.min_by("start", F.struct("wcss", "start"))).scalar()
    return res, found.withColumn("best", F.col("start") == least)
