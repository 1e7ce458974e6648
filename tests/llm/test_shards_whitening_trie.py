"""Best-fit shards, whitening and the prefix trie against brute force, with their defined cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from rankwell.llm import best_fit_shards, prefix_trie, whitening

# --- shards


def test_best_fit_is_the_tightest_bin():
    for trial in range(100):
        rng = random.Random(trial)
        sizes = sorted((rng.randint(1, 1000) for _ in range(rng.randint(0, 200))), reverse=True)
        room = [rng.randint(0, 4000) for _ in range(rng.randint(1, 20))]
        got, left = best_fit_shards.best_fit(sizes, room)
        for size, bin_ in zip(sizes, got):
            fits = [(r, b) for b, r in enumerate(room) if r >= size]
            assert bin_ == (min(fits)[1] if fits else None)
            if fits:
                room[bin_] -= size
        assert left == room


def test_capacities_add_up():
    rng = random.Random(1)
    for _ in range(200):
        loads, total = [rng.randint(0, 90) for _ in range(rng.randint(1, 9))], rng.randint(0, 500)
        room = best_fit_shards.level_room(loads, total)
        assert sum(room) == total
        assert max([x + r for x, r in zip(loads, room) if r], default=0) - min(x + r for x, r in zip(loads, room)) <= 1
        assert sum(best_fit_shards.split_evenly(total, loads)) == (total if sum(loads) else 0)
    assert best_fit_shards.even_capacities(100, [70, 20, 2], 4) == [70, 20, 5, 5]


def _texts(rng, n):
    rows = [(i, "x" * int(rng.paretovariate(1.2) * 20 % 5000) + str(i)) for i in range(n)]
    rows += [(n + i, "the same text") for i in range(n // 2)]
    return rows + [(-1, None), (None, ""), (3, "again"), (3, "again"), (None, None), (-2, "é😀")]


def _rows_of(found):
    return [r.asDict() for r in found.collect()]


@pytest.mark.parametrize("cell", [65536, 50])
def test_shards_are_whole_gapless_and_even(spark, monkeypatch, cell):
    monkeypatch.setattr(best_fit_shards, "CELL", cell)
    monkeypatch.setattr(best_fit_shards, "FAN", 3)
    rows = _texts(random.Random(2), 3000)
    docs = spark.createDataFrame([(*r, "a", 1) for r in rows], "doc_id long, text string, SHARD string, size int").repartition(5)
    got = _rows_of(best_fit_shards.best_fit_shards(docs, shards=7))
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    of = {}
    for r in got:
        of.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert all(len(s) == 1 for s in of.values())
    loads = [0] * 7
    for s in range(7):
        here = [r for r in got if r["shard"] == s]
        assert sorted(r["slot"] for r in here) == list(range(len(here)))
        loads[s] = sum(r["size"] for r in here)
    assert max(loads) - min(loads) <= sum(loads) / 7 / 100


def test_a_group_above_an_even_share_is_alone(spark):
    rows = [(i, "copy" * 50) for i in range(100)] + [(100 + i, f"text {i}") for i in range(400)]
    got = _rows_of(best_fit_shards.best_fit_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards=4))
    hot = {r["shard"] for r in got if r["doc_id"] < 100}
    assert len(hot) == 1 and not any(r["shard"] in hot for r in got if r["doc_id"] >= 100)
    loads = {s: sum(r["size"] for r in got if r["shard"] == s) for s in range(4) if s not in hot}
    assert max(loads.values()) - min(loads.values()) <= 10


def test_fixed_capacity_needs_few_shards(spark):
    rng = random.Random(4)
    rows = [(i, "y" * rng.randint(1, 400) + str(i)) for i in range(500)] + [(900, "z" * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = _rows_of(best_fit_shards.best_fit_shards(docs, capacity=1000))
    loads = {}
    for r in got:
        loads[r["shard"]] = loads.get(r["shard"], 0) + r["size"]
    large = next(r["shard"] for r in got if r["doc_id"] == 900)
    assert loads.pop(large) == 3001 and max(loads.values()) <= 1000
    assert len(loads) <= -(-sum(loads.values()) // 1000) + 1
    named = best_fit_shards.with_shard(docs.withColumn("shard", docs.doc_id), capacity=1000)
    assert set(named.columns) == {"doc_id", "text", "shard", "shard_"}
    assert {(r.doc_id, r.shard_) for r in named.collect()} == {(r["doc_id"], r["shard"]) for r in got}


def test_no_documents_no_shards(spark):
    assert best_fit_shards.best_fit_shards(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# --- whitening

def _matrices():
    rng = np.random.default_rng(3)
    eye = np.eye(12)
    yield rng.normal(size=(400, 24))
    yield rng.normal(size=(300, 30)) * np.logspace(0, -11, 30)
    yield rng.normal(size=(200, 3)) @ rng.normal(size=(3, 20))
    yield rng.normal(size=(4, 30))
    yield np.ones((9, 5))
    yield rng.normal(size=(60, 1))
    yield np.vstack([eye, -eye])
    yield np.repeat(np.vstack([eye, -eye]) * np.repeat([3, 2, 2, 1], 3), 2, axis=0)


def test_solver_equals_a_dense_one():
    for x in _matrices():
        rows = x - x.mean(axis=0)
        factor = None
        for at in range(0, len(rows), 50):
            factor = whitening.fold(factor, rows[at:at + 50])
        values, vectors, trace = whitening.solve(factor, len(rows), 8)
        v = rows.T @ rows / len(rows)
        want = np.linalg.eigvalsh(v)[::-1]
        assert len(values) == min(8, np.linalg.matrix_rank(rows, tol=1e-12 * max(1, np.abs(rows).max()) * 30))
        top = max(want[0], 1e-300)
        assert np.allclose(values, want[:len(values)], rtol=0, atol=1e-13 * top)
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
        assert np.abs(v @ vectors - vectors * values).max(initial=0) <= 1e-12 * top
        assert abs(trace - np.trace(v)) <= 1e-12 * top * len(v)


def test_singular_values_have_high_relative_accuracy():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 17, 80):
        d, u = rng.normal(size=n) * np.logspace(0, -9, n), rng.normal(size=n - 1) * 1e-3 * np.logspace(0, -9, n)[1:]
        d, u = np.where(np.abs(d) < 1e-10, 1e-10, d), u
        got = whitening.squared_singular_values(d, u)
        want = np.linalg.svd(np.diag(d) + np.diag(u, 1))[1] ** 2
        assert np.allclose(got[:n // 2 + 1], want[:n // 2 + 1], rtol=1e-11)
    # A graded matrix whose small singular value is known: diag(1, t) with a coupling has the determinant's value.
    got = whitening.squared_singular_values(np.array([1.0, 1e-9]), np.array([1.0]))
    assert abs(got[0] * got[1] / 1e-18 - 1) < 1e-12


def test_whitened_rows_and_defined_cases(spark):
    rng = np.random.default_rng(6)
    good = [(i, rng.normal(size=10).tolist()) for i in range(300)]
    good += [(5, good[0][1]), (None, good[1][1])]
    bad = [(400, None), (401, [float("nan")] * 10), (402, [1.0] * 9 + [None]), (403, [float("inf")] + [0.0] * 9), (404, [1.0, 2.0]), (405, []), (406, [1e300] * 10)]
    rows = spark.createDataFrame([(*r, 0.5, 1) for r in good + bad], "vec_id long, embedding array<double>, whitened double, n int").repartition(5)
    got = [r.asDict() for r in whitening.whiten(rows).collect()]
    assert len(got) == 8 * len(good) and {str(r["vec_id"]) for r in got} == {str(i) for i, _ in good}
    x = np.floor(np.array([v for _, v in good]) * 1024).astype(int) + 100000
    n, sums = len(x), x.sum(axis=0)
    want = {}
    for (i, _), dev in zip(good, ((n * x - sums) ** 2).sum(axis=1).tolist()):
        want.setdefault(i, set()).add(dev)
    assert all(r["n"] == n and r["deviation"] in want[r["vec_id"]] for r in got)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    white = (x - x.mean(axis=0)) @ vectors[:, :8] / np.sqrt(values[:8])
    for c in range(8):
        mine = sorted(r["whitened"] for r in got if r["component"] == c + 1)
        assert min(np.abs(np.array(mine) - np.sort(white[:, c])).max(), np.abs(np.array(mine) - np.sort(-white[:, c])).max()) < 1e-10
        assert abs(next(r["explained"] for r in got if r["component"] == c + 1) - values[c] / values.sum()) < 1e-12
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-10


def test_whitening_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 2.0])], schema)).count() == 2


def test_deviations_are_exact_beyond_a_long():
    x = np.array([[2**50, 1], [0, 0]])
    assert whitening.deviations(x, 2, [2**50, 1]) == [None, None]
    assert whitening.deviations(np.array([[2**32, 0], [2**30, 0]]), 2, [2**31 - 5, 0]) == [None, 25]
    assert whitening.deviations(np.array([[2**31, 0]]), 2, [2**31 - 5, 0]) == [(2**31 + 5) ** 2]


# --- trie

def brute_trie(rows, rebuild):
    conv = {}
    for c, t, r, x in rows:
        if c is not None:
            conv.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    conv = {c: [(r, x) for _, _, r, x in sorted(v, key=lambda y: y[:2])] for c, v in conv.items()}
    if rebuild:
        cut = {c: zlib.crc32(str(c).encode()) % 9 for c in conv}
        conv = {c: conv.get(c - c % 5, [])[:cut[c]] + v[cut[c]:] for c, v in conv.items()}
    members, ends, kids = {}, {}, {}
    for c, v in conv.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
        ends.setdefault(tuple(v), []).append(c)
    for p in members:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, m in members.items()), key=lambda r: r[:2])


def _talks():
    rng = random.Random(8)
    rows = []
    for c in range(120):
        if c % 10 == 5:
            continue  # some bases are missing
        for t in range(rng.randint(1, 14)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "é😀", "", None, "a longer turn"])))
    rows += [(500 + c, t, "user", f"turn {t}") for c in range(40) for t in range(3)]     # one common conversation
    rows += [(900, t, "user", "same again") for t in range(700)] + [(901, t, "user", "same again") for t in range(650)]  # very long ones
    return rows + [(None, 0, "user", "nobody's"), (950, None, "user", "no number"), (950, 1, "user", "then"), (951, 2, "x", ""), (10**15, 0, "u", "t")]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("band", [2, 8])
@pytest.mark.parametrize("rebuild", [True, False])
def test_trie_equals_brute_force(spark, tmp_path, monkeypatch, band, rebuild):
    rows = _talks()
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", key string, depth int").repartition(6)
    if rebuild:
        table.write.parquet(str(tmp_path / "conversations.parquet"))
        got = prefix_trie.op13_prefix_trie(spark, str(tmp_path), band)
    else:
        got = prefix_trie.conversation_trie(table, band=band)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[:2]) == brute_trie(rows, rebuild)


def test_trie_of_ties_and_nothing(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
    tied = [(c, 0, "user", x) for c in (1, 2) for x in ("one", "two", "two")]
    both = [prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect() for rows in (tied, tied[::-1])]
    assert sorted(map(tuple, both[0]), key=lambda r: r[:2]) == sorted(map(tuple, both[1]), key=lambda r: r[:2])
    assert [(r.depth, r.n_convs) for r in sorted(both[0], key=lambda r: r.depth)] == [(0, 2), (1, 2), (2, 2), (3, 2)]


def test_long_lists_of_ids_are_hashed_in_order(spark, monkeypatch):
    n = 5000
    ends = spark.range(n).selectExpr("X'00' AS key", "id * 7 AS conv").repartition(9)
    got = prefix_trie.end_digests(ends).collect()
    assert [r.digest for r in got] == [hashlib.sha256(",".join(str(7 * i) for i in range(n)).encode()).hexdigest()]
