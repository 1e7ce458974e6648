"""Worked example of FIXTURES.md §4: profiles, similarities, predictions, elbow."""

import pytest
from pyspark.sql import functions as F

from rankwell.operators import cluster, predict

TRAIN = [(1, 1, 5), (1, 2, 3), (1, 3, 1), (2, 1, 4), (2, 2, 2), (2, 4, 5),
         (3, 3, 4), (3, 4, 2), (4, 1, 1), (4, 3, 5), (4, 4, 3)]
CLUSTERS = [(1, 0), (2, 1), (3, 2), (4, 2)]


@pytest.fixture(scope="module")
def frames(spark):
    train = spark.createDataFrame(TRAIN, "user_id long, item_id long, rating int")
    clusters = spark.createDataFrame(CLUSTERS, "item_id long, cluster int")
    prof = cluster.user_cluster_profile(train, clusters, 3)
    unit = cluster.unit_centred(prof, 3)
    return train, prof, unit


def test_sparsity(frames):
    train, _, _ = frames
    row = cluster.utility_summary(train).first()
    assert row.n_cells == 11 and row.sparsity_pct == pytest.approx(31.25)


def test_profiles(frames):
    _, prof, _ = frames
    got = {r.user_id: (r.p0, r.p1, r.p2) for r in prof.collect()}
    assert got == {1: (5.0, 3.0, 1.0), 2: (4.0, 2.0, 5.0), 3: (0.0, 0.0, 3.0), 4: (1.0, 0.0, 4.0)}


def test_similarities(frames):
    _, _, unit = frames
    z = {r.user_id: (r.z0, r.z1, r.z2) for r in unit.collect()}

    def s(a, b):
        return sum(x * y for x, y in zip(z[a], z[b]))

    expect = {(1, 2): -0.327327, (1, 3): -0.866025, (1, 4): -0.720577,
              (2, 3): 0.755929, (2, 4): 0.891042, (3, 4): 0.970725}
    for (a, b), v in expect.items():
        assert s(a, b) == pytest.approx(v, abs=1e-6)
        assert s(a, b) == pytest.approx(s(b, a))
        assert abs(s(a, b)) <= 1 + 1e-12


@pytest.mark.parametrize("user,item,n,expect", [
    (1, 4, 2, 1.0), (2, 3, 2, 4.541019), (3, 1, 2, 2.313399),
    (4, 2, 1, 2.0), (4, 2, 2, 1.0), (3, 2, 2, 1.0)])
def test_predictions(spark, frames, user, item, n, expect):
    train, _, unit = frames
    pairs = spark.createDataFrame([(user, item, 0)], "user_id long, item_id long, rating int")
    row = predict.predict(pairs, train, unit, 3, n).first()
    assert row.source == "knn"
    assert row.predicted == pytest.approx(expect, abs=1e-6)


def test_tiny_tiles_match_single_tile(spark, frames):
    """Splitting every item into 1-row tiles must give the same neighbours."""
    train, _, unit = frames
    pairs = spark.createDataFrame([(u, i, 0) for u in range(1, 5) for i in range(1, 5)],
                                  "user_id long, item_id long, rating int")
    a = predict.top_neighbours(pairs, train, unit, 3, 3).select(
        "user_id", "item_id", "neighbour_id", "rank").collect()
    b = predict.top_neighbours(pairs, train, unit, 3, 3, tile=1).select(
        "user_id", "item_id", "neighbour_id", "rank").collect()
    assert sorted(a) == sorted(b) and len(a) > 0


def test_elbow(spark):
    wcss = [880, 850, 825, 818, 800, 795, 784, 780, 777]
    sweep = spark.createDataFrame([(k, float(w)) for k, w in zip(range(2, 11), wcss)], "k int, wcss double")
    assert cluster.elbow(sweep).first().elbow_k == 5
    assert cluster.elbow(sweep, "argmax").first().elbow_k == 4


def test_fallbacks(spark, frames):
    train, _, unit = frames
    pairs = spark.createDataFrame([(9, 1, 0), (9, 99, 0), (1, 99, 0)], "user_id long, item_id long, rating int")
    got = {(r.user_id, r.item_id): (r.source, r.predicted) for r in predict.predict(pairs, train, unit, 3, 2).collect()}
    assert got[(9, 1)] == ("cold_user", pytest.approx(10 / 3))
    assert got[(9, 99)] == ("cold_user", 3.0)
    assert got[(1, 99)] == ("cold_item", pytest.approx(3.0))
    zf = {(r.user_id, r.item_id): r.predicted
          for r in predict.predict(pairs, train, unit, 3, 2, "zero_filled").collect()}
    assert zf[(9, 1)] == pytest.approx(10 / 4) and zf[(1, 99)] == pytest.approx(9 / 4)
