"""K-Means, recommendations, runs and sessions on small fixtures of their own."""

import itertools
import pickle

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankwell import session
from rankwell.operators import cluster, experiments, lloyd_tiles, ordering, recommend


def plain_lloyd(cells, k, max_iter=300):
    """The same rules on a dense matrix: start item mod k, ties to the lowest cluster, emptied clusters keep their centre."""
    points = sorted({p for _, p, _ in cells})
    dims = sorted({d for d, _, _ in cells})
    x = np.zeros((len(points), len(dims)))
    for d, p, v in cells:
        x[points.index(p), dims.index(d)] = v
    label = np.array([p % k for p in points])
    centres = np.full((k, len(dims)), np.inf)
    for step in range(1, max_iter + 1):
        for j in range(k):
            if (label == j).any():
                centres[j] = x[label == j].mean(axis=0)
        far = np.array([[np.floor(((row - c) ** 2).sum() * 1e6 + 0.5) if np.isfinite(c).all() else np.inf for c in centres] for row in x])
        new = far.argmin(axis=1)
        if (new == label).all():
            break
        label = new
    wcss = sum(((x[label == j] - x[label == j].mean(axis=0)) ** 2).sum() for j in range(k) if (label == j).any())
    return dict(zip(points, label.tolist())), step, wcss


def run(spark, cells, ks, kind="int", **kw):
    df = spark.createDataFrame(cells, f"user_id long, item_id long, rating {kind}")
    res = cluster.lloyd(df, ks, **kw)
    return res, {k: {r.item_id: r.cluster for r in cluster.item_clusters(res, k).collect()} for k in ks}


def test_lloyd_matches_the_plain_algorithm(spark):
    rng = np.random.default_rng(1)
    cells = [(u, i, int(rng.integers(1, 6))) for u in range(25) for i in range(40) if rng.random() < 0.4]
    ks = [2, 3, 5]
    res, got = run(spark, cells, ks)
    sums = {r.k: r for r in cluster.wcss(res).collect()}
    for k in ks:
        label, steps, wcss = plain_lloyd(cells, k)
        assert got[k] == label and res.iterations[k] == steps
        assert abs(sums[k].wcss - round(wcss, 2)) < 0.011 and sums[k].converged


def test_more_than_64_clusters(spark):
    cells = [(u, i, 1 + (i * 7 + u) % 5) for i in range(70) for u in range(i % 9 + 1)] + [(100 + i, i, 5) for i in range(70)]
    res, got = run(spark, cells, [70])
    assert len(set(got[70].values())) == 70 and max(got[70].values()) == 69 and res.converged[70]


def test_cells_that_are_not_integers(spark):
    cells = [(0, 0, 1.4), (0, 2, 1.6), (0, 1, 9.3), (0, 3, 9.9)]
    res, got = run(spark, cells, [2], "double")
    assert got[2] == {0: 0, 2: 0, 1: 1, 3: 1}
    assert cluster.wcss(res).first().wcss == pytest.approx(0.2)


def test_an_emptied_cluster_keeps_its_centre(spark):
    found = None
    for seed in range(400):
        rng = np.random.default_rng(seed)
        cells = [(u, i, int(rng.integers(1, 6))) for u, i in itertools.product(range(2), range(7))]
        label, _, _ = plain_lloyd(cells, 4)
        if len(set(label.values())) < 4:
            found = cells, label
            break
    assert found
    _, got = run(spark, found[0], [4])
    assert got[4] == found[1]


def test_an_unfinished_run_says_so(spark):
    rng = np.random.default_rng(1)
    cells = [(u, i, int(rng.integers(1, 6))) for u in range(25) for i in range(40) if rng.random() < 0.4]
    res, _ = run(spark, cells, [3], max_iter=1)
    assert cluster.wcss(res).first().converged is False and res.converged[3] is False


def test_lloyd_on_many_tiles_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(lloyd_tiles, "LEAST", 1000)
    monkeypatch.setattr(lloyd_tiles, "TILE_RATINGS", 120)
    monkeypatch.setattr(lloyd_tiles, "BLOCK_CELLS", 60)
    rng = np.random.default_rng(5)
    cells = [(u, i, int(rng.integers(1, 6))) for u in range(30) for i in range(35) if rng.random() < 0.3]
    _, got = run(spark, cells, [2, 4])
    assert all(got[k] == plain_lloyd(cells, k)[0] for k in (2, 4))


def test_lloyd_with_null_keys_and_values(spark):
    """Cells without a point count nowhere, null values are absent, a point that meets no user has no cluster."""
    rng = np.random.default_rng(2)
    cells = [(u, i, int(rng.integers(1, 6))) for u in range(20) for i in range(24) if rng.random() < 0.4]
    odd = [(3, None, 5), (None, None, 4), (0, 1, None), (50, 2, None)]
    res, got = run(spark, cells + odd, [3])
    assert got[3] == plain_lloyd(cells, 3)[0] and res.converged[3]
    _, got = run(spark, cells + [(None, 99, 3), (7, 98, None)], [3])
    assert sorted(got[3]) == sorted({p for _, p, _ in cells}) + [98] and got[3][98] is None


def test_a_step_sends_no_rating_through_a_shuffle(spark, monkeypatch):
    """The rows that the jobs of a step shuffle are one for each pair of a tile and a block, not one for each rating."""
    cells = spark.range(4000).selectExpr("id % 200 as dim_id", "id div 10 as point_id", "1 + id % 5 as v")
    start = cells.groupBy("point_id").agg(F.sum("v").alias("nrm")).withColumn("a2", (F.col("point_id") % 2).cast("int"))
    passes = lloyd_tiles.Passes(cells, start, [2], cluster._n)
    state, sizes, _, sq = passes.step(None, [2], {}, {}, {})
    assert sum(sizes.values()) == 400 and state.count() == passes.n_blocks and passes.tiles.count() == passes.n_tiles == 1
    new, sizes, changes, _ = passes.step(state, [2], sizes, sq, {})
    assert sum(sizes.values()) == 400 and set(changes) == {2} and new.count() == passes.n_blocks
    passes.close()


def test_no_two_tiles_wait_in_one_task(spark, monkeypatch):
    """Tiles and blocks lie in partitions of their own, and there are no others."""
    monkeypatch.setattr(lloyd_tiles, "LEAST", 100)
    cells = spark.range(4000).selectExpr("id % 200 as dim_id", "id div 10 as point_id", "1 + id % 5 as v")
    start = cells.groupBy("point_id").agg(F.sum("v").alias("nrm")).withColumn("a2", (F.col("point_id") % 2).cast("int"))
    passes = lloyd_tiles.Passes(cells, start, [2], cluster._n)
    for df, n in ((passes.tiles, passes.n_tiles), (passes.blocks, passes.n_blocks)):
        held = df.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert n > 1 and df.rdd.getNumPartitions() == n == len(held) and {r["count"] for r in held} == {1}
    passes.close()


def test_user_clusters_keep_empty_profiles(spark):
    profile = spark.createDataFrame([(1, 0.0, 0.0), (2, 4.5, 1.0), (3, 4.0, 1.2), (4, 0.0, 0.1)], "user_id long, p0 double, p1 double")
    rows, steps, stable = recommend.user_clusters(profile, 2, 2)
    got = {r.user_id: r.cluster_number for r in rows.collect()}
    assert stable and steps > 0 and got[1] == got[4] != got[2] == got[3]


def test_recommendations_go_on_in_the_next_cluster(spark):
    """Every user with n unseen items gets n, also one who has rated all of the preferred cluster."""
    items = {i: i % 2 for i in range(12)}
    rated = [(1, i, 5) for i in range(0, 12, 2)] + [(1, 1, 2), (2, 0, 5), (2, 3, 1), (3, 1, 4), (3, 5, 4), (3, 7, 3)]
    rated += [(9, i, 1 + i % 5) for i in range(12)]
    train = spark.createDataFrame(rated, "user_id long, item_id long, rating int")
    clusters = spark.createDataFrame(list(items.items()), "item_id long, cluster int")
    profile = cluster.user_cluster_profile(train, clusters, 2)
    stats = {i: (np.mean([r for _, x, r in rated if x == i]), sum(x == i for _, x, _ in rated)) for i in items}
    for n in (2, 4, 20):
        got = {}
        for r in recommend.recommend_top_n(train, clusters, profile, 2, n).orderBy("user_id", "rank").collect():
            got.setdefault(r.user_id, []).append(r.item_id)
        for user in (1, 2, 3, 9):
            seen = {i for u, i, _ in rated if u == user}
            mean = {c: np.mean([r for u, i, r in rated if u == user and items[i] == c] or [0.0]) for c in (0, 1)}
            order = sorted(set(items) - seen, key=lambda i: (-mean[items[i]], items[i], -stats[i][0], -stats[i][1], i))
            assert got.get(user, []) == order[:n]


def test_best_run_ranks_missing_metrics_last(spark, tmp_path):
    one = spark.createDataFrame([(0.9,)], "rmse double")
    two = spark.createDataFrame([(0.1,)], "mae double")
    for row, params in ((one, {"v": 1}), (two, {"v": 2}), (spark.createDataFrame([(0.8,)], "rmse double"), {"v": 3})):
        experiments.log_runs(experiments.run_row(row, "e", "a", params), str(tmp_path / "runs"))
    runs = experiments.search_runs(spark, str(tmp_path / "runs"), "e")
    assert [r.params["v"] for r in runs.collect()] == ["3", "1", "2"]
    best = experiments.best_per_name(runs).collect()
    assert len(best) == 1 and best[0].params["v"] == "3"


def test_rank_within_sizes_and_hot_groups(spark):
    df = spark.range(0, 4000).select((F.when(F.col("id") % 3 > 0, -1).otherwise(F.col("id") % 7)).alias("g"), (F.col("id") * 31 % 4001).alias("a"))
    rows = ordering.rank_within(df, ["g"], ["a"], "r", partitions=6, size="n").collect()
    groups = {}
    for r in sorted(rows, key=lambda r: (r.g, r.a)):
        groups.setdefault(r.g, []).append(r)
    assert len(rows) == 4000
    for g in groups.values():
        assert [r.r for r in g] == list(range(1, len(g) + 1)) and {r.n for r in g} == {len(g)}


def test_released_tables_are_gone(spark):
    df = session.cut_lineage(spark.range(5).toDF("id"))
    assert df.count() == 5
    session.release(df)
    with pytest.raises(Exception):
        spark.read.parquet(df._lineage_path).count()


def test_checkpoint_folder_is_required_off_local_masters():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_several_steps_are_one_job(spark):
    """A chain of steps gives what single steps give, one after the other."""
    rng = np.random.default_rng(7)
    rows = [(int(u), int(p), int(rng.integers(1, 6))) for u in range(30) for p in range(40) if rng.random() < 0.3]
    cells = spark.createDataFrame(rows, "dim_id long, point_id long, v long")
    start = cells.groupBy("point_id").agg(F.sum(F.col("v") * F.col("v")).alias("nrm")).withColumn("a3", (F.col("point_id") % 3).cast("int"))
    passes = lloyd_tiles.Passes(cells, start, [3], cluster._n)
    chain, sizes, changes, sq = passes.step(None, [3], steps=3)
    trail = passes.trail
    state, single = passes.step(None, [3])[0], []
    for _ in range(3):
        state, one_sizes, one_changes, one_sq = passes.step(state, [3])
        single.append(one_changes)
    assert trail == single and (sizes, changes, sq) == (one_sizes, one_changes, one_sq)
    assert sorted(passes.assignment(chain).collect()) == sorted(passes.assignment(state).collect())
    passes.close()


def test_ranks_in_few_groups_move_no_row_twice(spark):
    """The rows are sorted once; the few pieces of groups come to them."""
    df = spark.range(3000).selectExpr("id % 3 as g", "id as x")
    ranked = ordering.rank_within(df, ["g"], ["x"], "r")
    assert "SortMergeJoin" not in ranked._jdf.queryExecution().toString()
    assert {(r.g, r.x): r.r for r in ranked.collect()} == {(i % 3, i): i // 3 + 1 for i in range(3000)}


def test_sums_carried_on_are_those_of_a_whole_pass(spark, monkeypatch):
    rnd = np.random.default_rng(11)
    seen = {(int(u), int(i)): int(r) for u, i, r in zip(rnd.integers(0, 60, 900), rnd.integers(0, 80, 900), rnd.integers(1, 6, 900))}
    rows = [(u, i, r) for (u, i), r in seen.items()] + [(None, 3, 4), (None, 500, 2), (7, 501, None)]
    cells = spark.createDataFrame(rows, "user_id long, item_id long, rating int")
    got = []
    for calm in (0, 1, 10**9):
        monkeypatch.setattr(lloyd_tiles, "CALM", calm)
        monkeypatch.setattr(lloyd_tiles, "LEAST", 400)
        res = cluster.lloyd(cells, [2, 5, 9])
        got.append((sorted(map(tuple, res.assign.collect())), res.sizes, res.sq, res.iterations, res.converged, cluster.wcss(res).collect()))
    assert got[0] == got[1] == got[2]


def test_moved_points_change_only_what_their_dimensions_have():
    rnd = np.random.default_rng(5)
    cells = sorted({(int(d), int(p)) for d, p in zip(rnd.integers(0, 20, 150), rnd.integers(0, 30, 150))})
    v = rnd.integers(1, 6, len(cells))
    points = sorted({p for _, p in cells})
    table = pa.table({"tile": [0] * len(cells), "block": [0] * len(cells), "point": [p for _, p in cells], "dim": [d for d, _ in cells], "v": v})
    own = pickle.loads(lloyd_tiles._build_tile(table, np.int64).column("payload")[0].as_py())

    def whole(label):
        s = np.zeros((20, 3), np.int64)
        for (d, p), x in zip(cells, v):
            s[d, label[points.index(p)]] += x
        dots = np.zeros((len(points), 3), np.int64)
        for (d, p), x in zip(cells, v):
            dots[points.index(p)] += x * s[d]
        return (s * s).sum(axis=0), dots

    old = rnd.integers(0, 3, len(points)).astype(np.int32)
    new = old.copy()
    new[[2, 9]] = (new[[2, 9]] + 1) % 3
    squares, hit, change = lloyd_tiles._moved(own, own["v"].astype(np.int64), new, np.array([2, 9]), old[[2, 9]], 3)
    (q_old, dots_old), (q_new, dots_new) = whole(old), whole(new)
    assert squares == (q_new - q_old).tolist() and len(hit) < len(points)
    dots_old[hit] += change
    assert (dots_old == dots_new).all()


def test_salted_copies_are_not_broadcast(spark):
    """A table that looks small before its copies are made must not go through the driver with all of them."""
    train = spark.createDataFrame([(u, i, 1 + (u + i) % 5) for u in range(6) for i in range(20) if (u * i) % 3], "user_id long, item_id long, rating int")
    clusters = spark.createDataFrame([(i, i % 2) for i in range(20)], "item_id long, cluster int")
    found = recommend.recommend_top_n(train, clusters, cluster.user_cluster_profile(train, clusters, 2), 2, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join" in line and "slot#" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)
