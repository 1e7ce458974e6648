"""The tiled neighbour search equals a brute-force top-N for any tile size."""

import random

import numpy as np
import pytest

from rankwell.operators import predict


def _brute(pairs, train, unit, n):
    out = {}
    by_item = {}
    for u, i, r in train:
        by_item.setdefault(i, []).append((u, r))
    for u, i in pairs:
        if u not in unit or i not in by_item:
            continue
        cands = []
        for v, r in by_item[i]:
            if v not in unit:
                continue
            acc = unit[u][0] * unit[v][0]
            for c in range(1, len(unit[u])):
                acc = acc + unit[u][c] * unit[v][c]
            cands.append((-float(predict.quantize_sim(np.float64(acc))), v))
        cands.sort()
        out[(u, i)] = [v for _, v in cands[:n]]
    return out


@pytest.mark.parametrize("seed,tile", [(1, 1), (2, 2), (3, 3), (4, 2048)])
def test_tiles_match_brute_force(spark, seed, tile):
    rnd = random.Random(seed)
    k, n = 3, 4
    users, items = list(range(1, 16)), list(range(1, 6))
    train = [(u, i, rnd.randint(1, 5)) for u in users for i in items if rnd.random() < 0.6]
    pairs = [(u, i) for u in users for i in items if rnd.random() < 0.3]
    unit = {}
    for u in users[:-1]:        # the last user has no profile
        x = [rnd.choice([-1.0, -0.5, 0.0, 0.5, 1.0]) for _ in range(k)]  # many exact ties
        norm = sum(a * a for a in x) ** 0.5
        unit[u] = [a / norm if norm > 1e-12 else 0.0 for a in x]
    tr = spark.createDataFrame(train, "user_id long, item_id long, rating int")
    pr = spark.createDataFrame(pairs, "user_id long, item_id long")
    un = spark.createDataFrame([(u, *z) for u, z in unit.items()], "user_id long, z0 double, z1 double, z2 double")
    got = {}
    for row in predict.top_neighbours(pr, tr, un, k, n, tile=tile).orderBy("user_id", "item_id", "rank").collect():
        got.setdefault((row.user_id, row.item_id), []).append(row.neighbour_id)
    assert got == _brute(pairs, train, unit, n)
