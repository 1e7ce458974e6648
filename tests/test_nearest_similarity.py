"""Nearest users, the knn and hybrid lists, item similarities and null groups against brute force."""

import random
import re

import numpy as np
import pytest

from rankwell.operators import experiments, nearest, ordering, similarity, splits
from rankwell.sources import sinks


def _unit(rng, k):
    z = rng.normal(size=k)
    z -= z.mean()
    return (z / np.linalg.norm(z)).tolist()


def _profiles(k):
    rng = np.random.default_rng(k)
    rows = [(i, *_unit(rng, k)) for i in range(150)]
    common = _unit(rng, k)
    rows += [(1000 + i, *common) for i in range(80)]           # a profile that many users share
    rows += [(2000 + i, *[0.0] * k) for i in range(5)]         # and profiles without a direction
    return rows


def brute_nearest(rows, k, n):
    out = {}
    for u, *a in rows:
        near = []
        for v, *b in rows:
            dot = a[0] * b[0]
            for c in range(1, k):
                dot = dot + a[c] * b[c]
            sim = np.floor(dot * 1e9 + 0.5) / 1e9
            if u != v and sim > 0:
                near.append((-sim, v))
        for rank, (sim, v) in enumerate(sorted(near)[:n], 1):
            out[u, rank] = (v, -sim)
    return out


@pytest.mark.parametrize("k, n, cell, tile", [(5, 10, 20, 2048), (3, 4, 7, 16), (2, 3, 1024, 2048)])
def test_nearest_users_equal_brute_force(spark, monkeypatch, k, n, cell, tile):
    monkeypatch.setattr(nearest, "CELL", cell)
    monkeypatch.setattr(nearest, "TILE", tile)
    rows = _profiles(k)
    unit = spark.createDataFrame(rows, "user_id long, " + ", ".join(f"z{c} double" for c in range(k))).repartition(5)
    got = {(r.user_id, r["rank"]): (r.neighbour_id, r.sim) for r in nearest.nearest_users(unit, k, n).collect()}
    assert got == brute_nearest(rows, k, n)


def test_nearest_users_skip_cells(spark, monkeypatch):
    """Far fewer members are searched than there are pairs."""
    monkeypatch.setattr(nearest, "CELL", 20)
    asked = []
    search = nearest._search
    monkeypatch.setattr(nearest, "_search", lambda q, m, s, d, n: asked.append(q.join(s, "cell").agg({"members": "sum"}).first()[0] or 0) or search(q, m, s, d, n))
    rng = np.random.default_rng(9)
    rows = [(i, *_unit(rng, 4)) for i in range(1500)]
    unit = spark.createDataFrame(rows, "user_id long, z0 double, z1 double, z2 double, z3 double")
    assert nearest.nearest_users(unit, 4, 3).count() == 4500
    assert sum(asked) < 1500 * 1500 / 4


def test_nobody_has_neighbours(spark):
    schema = "user_id long, z0 double, z1 double, z2 double"
    assert nearest.nearest_users(spark.createDataFrame([], schema), 3, 2).count() == 0
    assert nearest.nearest_users(spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 0.0, 0.0, 0.0)], schema), 3, 2).count() == 0


def test_knn_and_hybrid_lists(spark):
    train = spark.createDataFrame([(1, 10, 5), (2, 10, 4), (2, 11, 5), (2, 12, 1), (3, 11, 3), (3, 13, 5), (4, 14, 5)], "user_id long, item_id long, rating int")
    near = spark.createDataFrame([(1, 2, 0.9, 1), (1, 3, 0.5, 2)], "user_id long, neighbour_id long, sim double, rank int")
    got = nearest.recommend_knn(train, near, 2).collect()
    assert [(r.user_id, r.item_id, r.predicted_rating, r.recommendation_score, r["rank"]) for r in sorted(got, key=lambda r: r["rank"])] == [
        (1, 11, round((0.9 * 5 + 0.5 * 3) / 1.4, 6), 6.0, 1), (1, 13, 5.0, 2.5, 2)]
    other = spark.createDataFrame([(1, 13, 4.0, 4.0, 1, "v1", "kmeans"), (1, 15, 3.0, 3.0, 2, "v1", "kmeans")], nearest.recommend_knn(train, near, 2).schema)
    both = sorted(nearest.recommend_hybrid(nearest.recommend_knn(train, near, 2), other, 3).collect(), key=lambda r: r["rank"])
    assert [(r.item_id, r.predicted_rating) for r in both] == [(13, 4.5), (11, round((0.9 * 5 + 0.5 * 3) / 1.4, 6)), (15, 3.0)]


def test_knn_lists_equal_brute_force_and_travel_as_lists(spark, monkeypatch):
    monkeypatch.setattr(nearest, "PIECE", 7)
    rng = random.Random(5)
    rows = [(u, i, rng.randint(1, 5)) for u in range(12) for i in rng.sample(range(60), 3 * u + 1)] + [(None, 1, 5), (3, None, 4), (5, None, 2)]
    pairs = [(u, v, round(rng.random(), 3), k + 1) for u in [*range(11), None] for k, v in enumerate(rng.sample([*range(12), 99], 4)) if u != v]
    train = spark.createDataFrame(rows, "user_id long, item_id long, rating int").repartition(3)
    near = spark.createDataFrame(pairs, "user_id long, neighbour_id long, sim double, rank int")
    out = nearest.recommend_knn(train, near, 5)
    seen = {(u, i) for u, i, _ in rows if u is not None and i is not None}
    sums = {}
    for u, v, sim, _ in pairs:
        for w, i, r in rows:
            if w == v and (u, i) not in seen:
                s = sums.setdefault(u, {}).setdefault(i, [0, 0])
                s[0] += int(np.floor(sim * 1e9 + 0.5)) * r
                s[1] += int(np.floor(sim * 1e9 + 0.5))
    want = {(u, k): (i, round(s / n, 6)) for u, items in sums.items()
            for k, (i, (s, n)) in enumerate(sorted(items.items(), key=lambda x: (-x[1][0], -1 if x[0] is None else x[0]))[:5], 1)}
    assert {(r.user_id, r["rank"]): (r.item_id, r.predicted_rating) for r in out.collect()} == want
    assert not re.search(r"hashpartitioning\(user_id#\w+, item_id#", out._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.7, 1.0])
def test_item_similarity_equals_brute_force(spark, threshold):
    rng = random.Random(3)
    vectors = {i: {rng.randrange(60): rng.randint(1, 5) for _ in range(rng.randint(1, 12))} for i in range(70)}
    for i in range(0, 70, 2):
        vectors[i][999] = rng.randint(1, 5)     # one user who rated half of the items
    vectors[70], vectors[71] = dict(vectors[3]), {u: 2 * r for u, r in vectors[3].items()}
    rows = [(u, i, r) for i, v in vectors.items() for u, r in v.items()]
    got = {(r.item_id_1, r.item_id_2): r.similarity_score for r in similarity.item_similarity(
        spark.createDataFrame(rows, "user_id long, item_id long, rating int").repartition(4), threshold).collect()}
    want = {}
    for i in vectors:
        for j in vectors:
            if i < j:
                dot = sum(r * vectors[j].get(u, 0) for u, r in vectors[i].items())
                score = dot / np.sqrt(float(sum(r * r for r in vectors[i].values())) * sum(r * r for r in vectors[j].values()))
                if score >= threshold:
                    want[i, j] = round(float(score), 6)
    assert got == want and (3, 70) in got
    with pytest.raises(ValueError):
        similarity.item_similarity(spark.createDataFrame(rows, "user_id long, item_id long, rating int"), 0.0)


def _heavy_rows(n_items=120):
    """Three users who rated all items, and many who rated a few."""
    rng = random.Random(11)
    rows = {(u, i): rng.randint(1, 2) for u in range(3) for i in range(n_items)}
    for u in range(10, 210):
        rows.update({(u, i): rng.randint(1, 5) for i in rng.sample(range(n_items), 6)})
    return [(u, i, r) for (u, i), r in rows.items()]


def _brute(rows, threshold):
    vectors = {}
    for u, i, r in rows:
        vectors.setdefault(i, {})[u] = r
    out = {}
    for i, v in vectors.items():
        for j, w in vectors.items():
            if i < j:
                score = sum(r * w.get(u, 0) for u, r in v.items()) / np.sqrt(float(sum(r * r for r in v.values())) * sum(r * r for r in w.values()))
                if score >= threshold:
                    out[i, j] = round(float(score), 6)
    return out


def test_item_similarity_in_rounds_is_the_same(spark, monkeypatch):
    rows = _heavy_rows()
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating int")
    monkeypatch.setattr(similarity, "LEAST_PAIRS", 500)
    monkeypatch.setattr(similarity, "ROUND_PAIRS", 1)
    shares = []
    monkeypatch.setattr(similarity, "sweep", lambda s: shares.append(1))
    got = {(r.item_id_1, r.item_id_2): r.similarity_score for r in similarity.item_similarity(df, 0.4).collect()}
    assert got == _brute(rows, 0.4) and got and len(shares) > 2


def test_similarities_are_written_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, 10, 5), (1, 11, 4), (2, 10, 3), (2, 11, 3), (2, 12, 1)], "user_id long, item_id long, rating int")
    found = similarity.item_similarity(rows, 0.1)
    assert sinks.write_result_table(found, str(tmp_path), "item_similarities").count() == 3
    assert sinks.write_result_table(found, str(tmp_path), "item_similarities").count() == 0
    assert sinks.read_table(spark, str(tmp_path / "item_similarities")).count() == 3


def test_an_unfinished_write_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([(1, "a")], "id long, v string")
    sinks.write_unique(first, path, ["id"])
    monkeypatch.setattr(sinks, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    more = spark.createDataFrame([(1, "b"), (2, "c")], "id long, v string")
    with pytest.raises(RuntimeError):
        sinks.write_unique(more, path, ["id"])
    assert [tuple(r) for r in sinks.read_table(spark, path).collect()] == [(1, "a")]
    monkeypatch.undo()
    assert [tuple(r) for r in sinks.write_unique(more, path, ["id"]).collect()] == [(2, "c")]
    assert sorted(tuple(r) for r in sinks.read_table(spark, path).collect()) == [(1, "a"), (2, "c")]


def test_null_groups_keep_their_ranks(spark):
    rows = [(None, i) for i in range(40)] + [(1, i) for i in range(30)] + [(2, 5)]
    df = spark.createDataFrame(rows, "g int, x int").repartition(6)
    out = ordering.rank_within(df, ["g"], ["x"], out="r", size="n", partitions=7).collect()
    assert sorted((str(r.g), r.x, r.r, r.n) for r in out) == sorted((str(g), x, x + 1 if g != 2 else 1, {None: 40, 1: 30, 2: 1}[g]) for g, x in rows)


def test_split_keeps_rows_without_a_rating(spark):
    rows = [(u, i, None if (u + i) % 3 == 0 else 1 + (u * i) % 5) for u in range(10) for i in range(10)]
    out = splits.stratified_split(spark.createDataFrame(rows, "user_id long, item_id long, rating int"), 0.2, 42)
    assert out.count() == 100


def test_runs_are_logged_once(spark, tmp_path):
    path = str(tmp_path / "runs")
    rows = spark.createDataFrame([(0.5, 0.4)], "rmse double, mae double")
    run = experiments.run_row(rows, "e", "knn", {"K": 5, "N": 10}, {"a": "b"})
    assert experiments.log_runs(run, path).count() == 1 and experiments.log_runs(run, path).count() == 0
    assert experiments.log_runs(experiments.run_row(rows, "e", "knn", {"N": 10, "K": 5}, {"a": "b"}), path).count() == 0
    assert experiments.log_runs(experiments.run_row(rows, "e", "knn", {"K": 8, "N": 10}, {"a": "b"}), path).count() == 1
    assert experiments.search_runs(spark, path, "e").count() == 2
    one, two = (experiments.get_or_create_experiment(spark, str(tmp_path), n) for n in ("e", "f"))
    assert one != two and experiments.get_or_create_experiment(spark, str(tmp_path), "e") == one
    assert sinks.read_table(spark, str(tmp_path / "experiments")).count() == 2


def test_similarity_block_is_the_corner_of_the_matrix(spark):
    from rankwell.operators import predict
    z = {5: (1.0, 0.0), 2: (0.0, 1.0), 9: (0.6, 0.8), 7: (0.0, 0.0), 11: (1.0, 0.0)}
    unit = spark.createDataFrame([(u, *v) for u, v in z.items()], "user_id long, z0 double, z1 double")
    first = sorted(z)[:4]
    got = {r.user_id: r for r in predict.similarity_block(unit, 2, 4).collect()}
    assert sorted(got) == first
    for u in first:
        assert [got[u][f"s{j + 1}"] for j in range(4)] == [round(z[u][0] * z[v][0] + z[u][1] * z[v][1], 9) for v in first]
    # Fewer users than the block has columns: the rest is null.
    few = predict.similarity_block(unit.filter("user_id < 6"), 2, 4).collect()
    assert len(few) == 2 and all(r.s3 is None and r.s4 is None for r in few)
