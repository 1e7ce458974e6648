"""Seeds, restarts and saved centres against plain Python."""

from __future__ import annotations

import hashlib
import math
import random

import pytest

from rankwell.operators import cluster, seeding
from rankwell.sources import centres

CELLS = "user_id bigint, item_id bigint, rating int"


def _rows(n_items=40, n_users=12, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n_items):
        kind = i % 4
        for u in range(n_users):
            if rng.random() < 0.6:
                out.append((u, i, 5 - abs(kind - u % 4) if rng.random() < 0.8 else rng.randint(1, 5)))
    return out


def _vectors(rows):
    out = {}
    for u, i, r in rows:
        out.setdefault(i, {})[u] = r
    return out


def _d2(a, b):
    return sum((a.get(u, 0) - b.get(u, 0)) ** 2 for u in a.keys() | b.keys())


def _plain_seeds(vec, k, start, rounds, seed):
    def key(rnd, p):
        return hashlib.md5(f"{seed}|{start}|{rnd}|{p}".encode()).hexdigest()

    found = [min(vec, key=lambda p: (key(0, p), p))]
    near = {p: (_d2(vec[p], vec[found[0]]), found[0]) for p in vec}
    for rnd in range(1, rounds + 1):
        cost = float(sum(d for d, _ in near.values()) * 10 ** 6)
        new = [p for p in vec if int(key(rnd, p)[:8], 16) / 2 ** 32 * cost < seeding.OVERSAMPLE * k * float(near[p][0] * 10 ** 6)]
        for p in vec:
            near[p] = min([near[p], *((_d2(vec[p], vec[c]), c) for c in new)])
    weight = {}
    for _, c in near.values():
        weight[c] = weight.get(c, 0) + 1
    chosen = [min(weight, key=lambda c: (-weight[c], c))]
    while len(chosen) < k:
        score = {c: weight[c] * min(_d2(vec[c], vec[x]) for x in chosen) for c in weight}
        best = min(score, key=lambda c: (-score[c], c))
        if not score[best]:
            break
        chosen.append(best)
    return chosen


def test_seeds_equal_the_plain_rule(spark):
    rows = _rows()
    chosen, assign = seeding.seeds(spark.createDataFrame(rows, CELLS), 4, starts=3, seed=7)
    vec = _vectors(rows)
    assert chosen == {s: _plain_seeds(vec, 4, s, seeding.ROUNDS, 7) for s in (1, 2, 3)}
    for r in assign.collect():
        assert r["a4"] == r["point_id"] % 4
        for s, ids in chosen.items():
            d = [_d2(vec[r["point_id"]], vec[p]) for p in ids]
            assert r[f"a{cluster.run(s, 4)}"] == d.index(min(d))


def test_best_start_is_not_above_the_modulo_start(spark):
    cells = spark.createDataFrame(_rows(), CELLS)
    res, table = seeding.fit(cells, 4, starts=3, seed=7)
    rows = {r["start"]: r for r in table.collect()}
    assert sorted(rows) == [0, 1, 2, 3] and all(r["converged"] for r in rows.values())
    best = [r for r in rows.values() if r["best"]]
    assert len(best) == 1 and best[0]["wcss"] == min(r["wcss"] for r in rows.values()) <= rows[0]["wcss"]
    alone = cluster.wcss(cluster.lloyd(cells, [4])).first()
    assert (rows[0]["wcss"], rows[0]["iterations"]) == (alone["wcss"], alone["iterations"])


def test_fewer_points_than_clusters_and_equal_points(spark):
    same = spark.createDataFrame([(u, i, 3) for u in range(3) for i in range(6)], CELLS)
    chosen, _ = seeding.seeds(same, 4, starts=2)
    assert all(len(ids) == 1 for ids in chosen.values())
    res, table = seeding.fit(same, 4, starts=1)
    assert all(r["wcss"] == 0 for r in table.collect())
    two = spark.createDataFrame([(0, 0, 1), (1, 1, 5)], CELLS)
    assert {s: sorted(ids) for s, ids in seeding.seeds(two, 5, starts=2)[0].items()} == {1: [0, 1], 2: [0, 1]}
    chosen, assign = seeding.seeds(spark.createDataFrame([], CELLS), 3, starts=2)
    assert chosen == {1: [], 2: []} and assign.count() == 0


def test_saved_centres_give_the_same_clusters_and_take_new_items(spark, tmp_path):
    rows = _rows()
    cells = spark.createDataFrame(rows, CELLS)
    res = cluster.lloyd(cells, [4])
    path = str(tmp_path / "centres")
    centres.save(res, 4, path, "a")
    with pytest.raises(ValueError):
        centres.save(res, 4, path, "a")
    saved = centres.load(spark, path, "a")
    fitted = {r["item_id"]: r["cluster"] for r in cluster.item_clusters(res, 4).collect()}
    assert {r["item_id"]: r["cluster"] for r in centres.assign(saved, cells).collect()} == fitted

    vec = _vectors(rows)
    middle = {c: {} for c in range(4)}
    for i, c in fitted.items():
        for u, r in vec[i].items():
            middle[c][u] = middle[c].get(u, 0) + r / sum(x == c for x in fitted.values())
    new = [(0, 900, 5), (3, 900, 2), (77, 901, 4), (1, 902, None), (None, 903, 2), (2, None, 3)]
    got = {r["item_id"]: r for r in centres.assign(saved, spark.createDataFrame(new, CELLS)).collect()}
    assert sorted(got) == [900, 901, 903]
    for i, v in {900: {0: 5, 3: 2}, 901: {77: 4}, 903: {-1: 2}}.items():
        far = {c: _d2(v, middle[c]) for c in middle if middle[c]}
        assert math.isclose(got[i]["distance"], math.sqrt(min(far.values())), abs_tol=1e-3)
        assert math.isclose(far[got[i]["cluster"]], min(far.values()), abs_tol=1e-6)
    assert centres.assign(saved, spark.createDataFrame([], CELLS)).count() == 0


def test_only_ratings_that_meet_a_pick_are_shuffled(spark):
    """The ratings are not dealt by user; points without a common user, null users and null values keep their distances."""
    rows = [(1, 10, 4), (2, 10, 3), (2, 11, 5), (3, 12, 2), (None, 13, 5), (4, 14, None), (None, 15, 2), (5, 15, 1)]
    t, norms = seeding._cells(spark.createDataFrame(rows, CELLS), "item_id", "user_id", "rating")
    assert "Exchange" not in t._jdf.queryExecution().executedPlan().toString()
    near = {r.point_id: (r.b1, r.b2) for r in seeding._closest(t, norms, {1: [10, 12], 2: [15]}).collect()}
    t.unpersist()
    d = lambda x: x * 10**6
    assert sorted(near) == [10, 11, 12, 14, 15]
    assert near[10] == ((0, 0), (d(30), 0)) and near[11] == ((d(20), 0), (d(30), 0)) and near[12] == ((0, 1), (d(9), 0))
    assert near[14][0].d is None and near[15] == ((d(9), 1), (d(8), 0))
