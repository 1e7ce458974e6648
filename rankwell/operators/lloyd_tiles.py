"""The passes of ``cluster.lloyd`` on packed blocks of ratings.

Dimensions (users) are dealt into tiles, points (items) into blocks, both by hash.  A tile holds its ratings as a few
arrays and is cached once; a block holds its points' norms and their places in each tile.  A step is two stages:

    tile:  centre sums S of its dimensions, Σ r·S of its points            -> to each block
    block: Σ r·S added up over the tiles, distances, new clusters of its points -> to each tile

so a step shuffles one array per (tile, block) in place of a row per rating, and joins nothing that has to be sorted
or broadcast.  What all blocks must know (sizes, changes and Σ S², O(Σk) numbers) travels in the same messages, so several
steps are one job; a run that is stable leaves the messages inside it.  The driver sees the same numbers once a job.

All sums of integers are exact 64-bit ones; messages hold the smallest integers that fit.  Being exact, Σ r·S and Σ S² may be
carried on: once few points of a run move, a tile sends only what the moved points change (their dimensions, and the points
that these have), and a block adds that to the sums it had.  Sums of floating-point values are computed anew in each step.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.session import cut_lineage

#: Ratings of a tile and cells (points · clusters) of a block, on average; fewer where that leaves cores idle.
TILE_RATINGS = 2_000_000
BLOCK_CELLS = 2_000_000
#: Ratings · clusters below which a further tile is not worth its task.
LEAST = 2_500_000
EMPTY = np.iinfo(np.int64).max
#: Steps of a job, and the cells · runs above which a job has fewer, so that its messages do not pile up on disk.
STEPS, FEW_STEPS = 6, 2
MANY_CELLS = 40_000_000

MESSAGE = "tile int, block int, kind int, payload binary"
#: Kinds of messages: what a (tile, block) needs of the other side; what a block needs again, on its way round.
PART, OWN = 0, 1
#: Sums of numbers below this are exact in floating point.
EXACT = 1 << 53
#: A run's sums are carried on in a step that moves at most one of so many points.
CALM = 40


def _small(x: np.ndarray) -> np.ndarray:
    """The array in the smallest integer type that holds it (floating-point arrays as they are)."""
    if x.dtype.kind == "f" or not x.size:
        return x
    low, high = x.min(), x.max()
    for t in (np.int8, np.int16, np.int32):
        if np.iinfo(t).min <= low and high <= np.iinfo(t).max:
            return x.astype(t)
    return x


def _table(rows: list[tuple], schema: list[tuple]) -> pa.Table:
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(schema)})


_MESSAGE = [("tile", pa.int32()), ("block", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())]


def _add(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, starts) if len(x) else x


def _spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The whole numbers of all ranges [start, end), one range after the other."""
    sizes = ends - starts
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _moved(own: dict, v: np.ndarray, label: np.ndarray, points: np.ndarray, was: np.ndarray, n: int) -> tuple[list, np.ndarray, np.ndarray]:
    """What the points that left the clusters ``was`` change in a tile of whole numbers: Σ S² of each of the ``n`` clusters, and
    the points (in order) whose Σ r·S changes, with the change."""
    point, starts = own["point"].astype(np.int64), own["starts"].astype(np.int64)
    each = own["each"].astype(np.int64)
    ends, last = np.r_[each[1:], len(point)], np.r_[starts[1:], len(point)]
    cells = own["by_point"][_spans(each[points], ends[points])]
    dims, at = np.unique(np.searchsorted(starts, cells, side="right") - 1, return_inverse=True)
    sizes = ends[points] - each[points]
    change = np.zeros((len(dims), n + 1), np.int64)
    np.add.at(change, (at, np.repeat(label[points].astype(np.int64) + 1, sizes)), v[cells])
    np.subtract.at(change, (at, np.repeat(was.astype(np.int64) + 1, sizes)), v[cells])
    change = change[:, 1:]
    # All cells of the dimensions that the moved points have.
    cells = _spans(starts[dims], last[dims])
    at = np.repeat(np.arange(len(dims)), last[dims] - starts[dims])
    s = np.zeros((len(dims), n + 1), np.int64)
    np.add.at(s, (at, label[point[cells]].astype(np.int64) + 1), v[cells])
    squares = (change * (2 * s[:, 1:] - change)).sum(axis=0)
    if own["nowhere"] >= 0:
        change[dims == own["nowhere"]] = 0
    order = np.argsort(point[cells], kind="stable")
    cells, at = cells[order], at[order]
    hit, first = np.unique(point[cells], return_index=True)
    dots = np.zeros((len(hit), n), np.int64)
    for c in np.flatnonzero(change.any(axis=0)):
        dots[:, c] = _add(v[cells] * change[at, c], first)
    return [int(x) for x in squares], hit, dots


def _build_tile(table: pa.Table, dtype) -> pa.Table:
    """A tile's cells (tile, block, point, dim, v) as one row of arrays, and the points that it has of each block."""
    tile = table.column("tile")[0].as_py()
    block = table.column("block").to_numpy()
    ids, code = np.unique(table.column("point").to_numpy(), return_inverse=True)
    # Local points in order of (block, id).
    home = np.zeros(len(ids), np.int32)
    home[code] = block
    order = np.lexsort((ids, home))
    place = np.empty(len(ids), np.int32)
    place[order] = np.arange(len(ids), dtype=np.int32)
    ids, home, code = ids[order], home[order], place[code]
    dim = table.column("dim")
    nowhere = dim.is_null().to_numpy()
    # Cells without a dimension count in Σ S² only, as one dimension after all others.
    d = np.full(len(code), len(code))
    d[~nowhere] = np.unique(dim.drop_null().to_numpy(), return_inverse=True)[1]
    v = table.column("v").fill_null(0).to_numpy().astype(dtype)
    by_dim = np.argsort(d, kind="stable")
    d, code, v = d[by_dim], code[by_dim], v[by_dim]
    starts = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
    blocks, first = np.unique(home, return_index=True)
    last = np.r_[first[1:], len(ids)]
    by_point = np.argsort(code, kind="stable")
    packed = {"point": code.astype(np.int32), "starts": starts.astype(np.int32), "v": _small(v), "points": len(ids),
              "nowhere": len(starts) - 1 if nowhere.any() else -1,
              "by_point": by_point.astype(np.int32), "each": np.searchsorted(code[by_point], np.arange(len(ids))).astype(np.int32),
              "exact": dtype is np.int64 and int(np.abs(v.astype(np.float64)).sum()) < EXACT,
              "blocks": [(int(b), int(lo), int(hi)) for b, lo, hi in zip(blocks, first, last)]}
    rows = [(tile, None, None, pickle.dumps(packed))]
    rows += [(tile, b, pickle.dumps(ids[lo:hi]), None) for b, lo, hi in packed["blocks"]]
    return _table(rows, [("tile", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()), ("payload", pa.binary())])


def _build_block(points: pa.Table, pairs: pa.Table, names: list[str]) -> pa.Table:
    """A block's points in order of id: norms, first clusters and, per tile, the places of the tile's points."""
    if not points.num_rows:
        return _table([], [("block", pa.int32()), ("payload", pa.binary())])
    ids = points.column("point").to_numpy()
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    column = lambda c, t: points.column(c).to_numpy()[order].astype(t)
    packed = {"ids": ids, "nrm": points.column("nrm").fill_null(0).to_numpy()[order].astype(np.float64), "met": column("met", bool),
              "valued": column("valued", bool), "a": np.stack([column(c, np.int32) for c in names], axis=1), "tiles": []}
    for t, own in zip(pairs.column("tile").to_pylist(), map(pickle.loads, pairs.column("ids").to_pylist())):
        at = np.searchsorted(ids, own)
        # A tile may have points that the first assignment lacks: their place is that of no point.
        known = ids[np.minimum(at, len(ids) - 1)] == own
        packed["tiles"].append((t, np.where(known, at, len(ids)).astype(np.int32)))
    return _table([(points.column("block")[0].as_py(), pickle.dumps(packed))], [("block", pa.int32()), ("payload", pa.binary())])


def _nearest(nrm, dots, n, q) -> np.ndarray:
    """The nearest of the centres with the sizes n and Σ S² q: ``cluster.distance`` and ``cluster.nearest`` on arrays."""
    best, at = np.full(len(nrm), EMPTY), np.full(len(nrm), -1, np.int32)
    for j in range(len(n)):
        if n[j] > 0:
            d = np.floor((nrm - 2.0 * dots[:, j].astype(np.float64) / n[j] + q[j] / (n[j] * n[j])) * 1e6 + 0.5).astype(np.int64)
            nearer = d < best
            best[nearer], at[nearer] = d[nearer], j
    return at


def _labels(spark, n: int) -> list[int]:
    """n whole numbers that ``repartition(n, label)`` deals to n different partitions: no two of them wait for each other in one task."""
    if n < 2:
        return list(range(n))
    found, tried = {}, 0
    while len(found) < n:
        more = spark.range(tried, tried + 16 * n, 1, 1).select(F.col("id").cast("int").alias("id"))
        for r in more.select("id", F.pmod(F.hash("id"), F.lit(n)).alias("at")).collect():
            found.setdefault(r["at"], r["id"])
        tried += 16 * n
    return sorted(found.values())


def _dealt(key: str, labels: list[int]) -> F.Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), F.pmod(F.xxhash64(key), F.lit(len(labels))).cast("int") + 1)


class Passes:
    """The blocks and tiles of one run; ``step`` gives a later state (per block: clusters, Σ r·S and the centres' sizes and Σ S²)."""

    def __init__(self, t: DataFrame, start: DataFrame, ks: list[int], n_of):
        """``t``: point_id, dim_id, v; ``start``: point_id, nrm and a{k} for each of ``ks``, and, if it is known, ``values``, how
        many values with a dimension the point has (null: it has no dimension); ``n_of(k)``: the number of clusters of a run."""
        spark = t.sparkSession
        self.spark, self.ks, self.n_of = spark, ks, n_of
        self.point = dict(t.dtypes)["point_id"]
        self.dtype = np.float64 if dict(t.dtypes)["v"] == "double" else np.int64
        self.total = "double" if self.dtype is np.float64 else "bigint"
        cores = spark.sparkContext.defaultParallelism
        cells = t.filter("point_id is not null")
        n_cells, n_points = cells.count(), start.count()
        self.steps = STEPS if n_cells * len(ks) < MANY_CELLS else FEW_STEPS
        wide = sum(n_of(k) for k in ks)
        spread = max(1, min(cores, n_cells * wide // LEAST))
        self.n_tiles = max(spread, -(-n_cells // TILE_RATINGS))
        self.n_blocks = max(min(spread, n_points), -(-n_points * wide // BLOCK_CELLS), 1)
        self.tile_ids, self.block_ids = _labels(spark, self.n_tiles), _labels(spark, self.n_blocks)
        block = _dealt("point_id", self.block_ids).alias("block")
        dealt = cells.select(_dealt("dim_id", self.tile_ids).alias("tile"), block,
                             F.col("point_id").alias("point"), F.col("dim_id").alias("dim"), "v")
        dtype, names = self.dtype, [f"a{k}" for k in ks]
        built = cut_lineage(dealt.repartition(self.n_tiles, "tile").groupBy("tile").applyInArrow(
            lambda table: _build_tile(table, dtype), "tile int, block int, ids binary, payload binary"))
        self.tiles = built.filter("block is null").select("tile", "payload").repartition(self.n_tiles, "tile").persist()
        if "values" not in start.columns:
            met = cells.filter("dim_id is not null").groupBy("point_id").agg(F.count("v").alias("values"))
            start = start.join(met, "point_id", "left")
        points = (start.filter("point_id is not null")
                  .select(block, F.col("point_id").alias("point"), "nrm", F.col("values").isNotNull().alias("met"),
                          (F.coalesce("values", F.lit(0)) > 0).alias("valued"), *[F.coalesce(a, F.lit(-1)).alias(a) for a in names]))
        pairs = built.filter("block is not null").select("block", "tile", "ids")
        self.blocks = (points.groupBy("block").cogroup(pairs.groupBy("block"))
                       .applyInArrow(lambda p, q: _build_block(p, q, names), "block int, payload binary")
                       .repartition(self.n_blocks, "block").persist())

    def close(self) -> None:
        self.tiles.unpersist()
        self.blocks.unpersist()

    def step(self, state: DataFrame | None, active: list[int], sizes: dict | None = None, *_, steps: int | None = None) -> tuple[DataFrame, dict, dict, dict]:
        """The state after ``steps`` more steps (one, if not given) of the ``active`` runs: (state, sizes, changes of the last step, Σ S²).

        ``state`` None: from the first assignment, if ``steps`` is not given only its Σ r·S and Σ S²; ``sizes`` has its sizes where
        they are not those of the points.  Otherwise a state has all that its next step needs.  ``trail`` has the changes of each step."""
        ks, n_of, dtype, tile_ids, block_ids = self.ks, self.n_of, self.dtype, self.tile_ids, self.block_ids
        first = state is None
        steps = (0 if first else 1) if steps is None else steps

        def send(b: int, own: dict, a: np.ndarray, active: list[int], changes: dict, going: dict, before: np.ndarray | None = None) -> list[tuple]:
            """A block's messages to all tiles: its clusters, their sizes and numbers of changes, and, where the sums may be carried on,
            the numbers of points that left the clusters of ``before``, their places and what they left."""
            local = {k: np.bincount(a[:, ks.index(k)].astype(np.int64) + 1, minlength=n_of(k) + 1)[1:] for k in active}
            at = [ks.index(k) for k in active]
            sent = np.vstack([a[:, at], np.full((1, len(at)), -1, a.dtype)])
            places = dict(own["tiles"])
            moved, left, dots_of = {}, lambda t: None, {}
            if before is not None and dtype is np.int64:
                was = np.vstack([before[:, at], np.full((1, len(at)), -1, a.dtype)])
                differ = was != sent
                moved = {k: int(x) for k, x in zip(active, differ.sum(axis=0))}
                any_of = differ.any(axis=1)

                def left(t: int):
                    i = np.flatnonzero(any_of[places[t]])
                    return _small(i), _small(was[places[t][i]])
                # Σ r·S of the clusters as they were: an empty cluster has none, whatever centre it keeps.
                for k in active:
                    n = np.array(going["totals"][k][0])
                    dots_of[k] = _small(np.where(n > 0, going["centres"][k][2], 0))
            rows = [(t, b, PART, pickle.dumps((active, local, changes, _small(sent[places[t]]) if t in places else None,
                                               moved, left(t) if t in places else None))) for t in tile_ids]
            # A centre that may be that of an emptied cluster goes on with the block.
            held = {k: {c: (n[c], q[c], _small(dots[:, c])) for c in np.flatnonzero(local[k] == 0).tolist()}
                    for k, (n, q, dots) in going["centres"].items() if k in local}
            rows.append((tile_ids[b % len(tile_ids)], b, OWN, pickle.dumps({"a": _small(a), "held": held, "dots": dots_of, "totals": going["totals"], "changes": going["changes"]})))
            return rows

        def onward(b: int, own: dict, now: dict, active: list[int]) -> list[tuple]:
            """New clusters of a block's points from the centres of ``now``, sent to the tiles."""
            a, changes = now["a"].astype(np.int32), {}
            before = a.copy()
            for k in active:
                n, q, dots = now["centres"][k]
                new = np.where(own["valued"], _nearest(own["nrm"], dots, n, q), -1)
                old = a[:, ks.index(k)]
                changes[k] = int(((new != old) & (new >= 0) & (old >= 0)).sum())
                a[:, ks.index(k)] = new
            now = dict(now, changes=[*now["changes"], [changes.get(k, 0) for k in given]])
            return send(b, own, a, active, changes, now, before)

        given = list(active)

        def begin(block: pa.Table, states: pa.Table) -> pa.Table:
            if not block.num_rows:
                return _table([], _MESSAGE)
            b, own = block.column("block")[0].as_py(), pickle.loads(block.column("payload")[0].as_py())
            if first:
                return _table(send(b, own, own["a"], given, {}, {"centres": {}, "totals": {}, "changes": []}), _MESSAGE)
            return _table(onward(b, own, dict(pickle.loads(states.column("payload")[0].as_py()), changes=[]), given), _MESSAGE)

        def sums(fixed: dict | None):
            def of_tile(tile: pa.Table, messages: pa.Table) -> pa.Table:
                rows = [r for r in zip(*(messages.column(n).to_pylist() for n, _ in _MESSAGE))]
                if not rows:
                    return _table([], _MESSAGE)
                t, out = rows[0][0], [r for r in rows if r[2] != PART]
                parts = {r[1]: pickle.loads(r[3]) for r in rows if r[2] == PART}
                active = next(iter(parts.values()))[0]
                total = {k: sum(p[1][k] for p in parts.values()) for k in active} if fixed is None else {k: np.array([fixed[k, c] for c in range(n_of(k))]) for k in active}
                changes = {k: sum(p[2][k] for p in parts.values()) for k in active if k in next(iter(parts.values()))[2]}
                moved = {k: sum(p[4][k] for p in parts.values()) for k in active if k in next(iter(parts.values()))[4]}
                calm = [k for k in moved if moved[k] * CALM <= int(total[k].sum())]
                dots, squares, spans, carried = {}, {k: [0] * n_of(k) for k in active}, {}, {}
                if tile.num_rows and active:
                    own = pickle.loads(tile.column("payload")[0].as_py())
                    spans = {b: (lo, hi) for b, lo, hi in own["blocks"]}
                    a = np.full((own["points"], len(active)), -1, np.int32)
                    gone, was = [np.zeros(0, np.int64)], [np.zeros((0, len(active)), np.int32)]
                    for b, (lo, hi) in spans.items():
                        if b in parts:
                            a[lo:hi] = parts[b][3]
                            if calm:
                                gone.append(parts[b][5][0].astype(np.int64) + lo)
                                was.append(parts[b][5][1].reshape(-1, len(active)).astype(np.int32))
                    gone, was = np.concatenate(gone), np.concatenate(was)
                    point, starts, v, each = own["point"], own["starts"], own["v"].astype(dtype), own["each"]
                    if len(calm) < len(active):
                        dim = np.repeat(np.arange(len(starts), dtype=np.int64), np.diff(np.r_[starts, len(point)]))
                        dim_of, v_of = dim[own["by_point"]], v[own["by_point"]]
                    for i, k in enumerate(active):
                        if k in calm:
                            these = was[:, i] != a[gone, i]
                            squares[k], hit, change = _moved(own, v, a[:, i], gone[these], was[these, i], n_of(k))
                            carried[k] = hit, change
                            continue
                        width = n_of(k) + 1
                        label = a[:, i][point]
                        if own["exact"]:
                            s = np.bincount(dim * width + (label + 1), weights=v, minlength=len(starts) * width).astype(dtype).reshape(-1, width)[:, 1:]
                        else:
                            s = np.stack([_add(np.where(label == c, v, 0), starts) for c in range(n_of(k))], axis=1)
                        squares[k] = [float(x) if dtype is np.float64 else int(x) for x in (s * s).sum(axis=0)]
                        if own["nowhere"] >= 0:
                            s[own["nowhere"]] = 0
                        dots[k] = np.stack([_add(v_of * np.ascontiguousarray(s[:, c])[dim_of], each) for c in range(n_of(k))], axis=1)

                def of_block(b: int, k: int):
                    lo, hi = spans[b]
                    if k not in calm:
                        return _small(dots[k][lo:hi])
                    hit, change = carried[k]
                    i, j = np.searchsorted(hit, (lo, hi))
                    return _small(hit[i:j] - lo), _small(change[i:j])
                out += [(t, b, PART, pickle.dumps((active, total, changes, squares, [of_block(b, k) for k in active] if b in spans else None, calm)))
                        for b in block_ids]
                return _table(out, _MESSAGE)
            return of_tile

        schema = [("block", pa.int32()), ("payload", pa.binary()), ("sizes", pa.list_(pa.int64())), ("changes", pa.list_(pa.int64())),
                  ("squares", pa.list_(pa.float64() if dtype is np.float64 else pa.int64()))]

        def settle(last: bool):
            def of_block(block: pa.Table, messages: pa.Table) -> pa.Table:
                # Points that the first assignment lacks may fill a block of their own, which has no clusters.
                if not block.num_rows:
                    return _table([], schema if last else _MESSAGE)
                b, own = block.column("block")[0].as_py(), pickle.loads(block.column("payload")[0].as_py())
                places, around, parts = dict(own["tiles"]), None, {}
                for t, kind, payload in zip(*(messages.column(n).to_pylist() for n in ("tile", "kind", "payload"))):
                    if kind == OWN:
                        around = pickle.loads(payload)
                    else:
                        parts[t] = pickle.loads(payload)
                active, total, changes = next(iter(parts.values()))[:3]
                calm = next(iter(parts.values()))[5]
                dots = {k: np.zeros((len(own["ids"]) + 1, n_of(k)), dtype) for k in active}
                for k in calm:
                    dots[k][:-1] = around["dots"][k]
                for t, part in parts.items():
                    # A tile has a point once, so its places are different ones (but for the place of no point).
                    for k, x in zip(active, part[4] or []):
                        if k in calm:
                            dots[k][places[t][x[0]]] += x[1].reshape(-1, n_of(k))
                        else:
                            dots[k][places[t]] += x
                centres, totals = {}, dict(around["totals"])
                for k in active:
                    n, q = [float(x) for x in total[k]], [sum(parts[t][3][k][c] for t in sorted(parts)) for c in range(n_of(k))]
                    if k in calm:
                        q = [x + y for x, y in zip(around["totals"][k][1], q)]
                    totals[k] = ([int(x) for x in total[k]], list(q))
                    # A cluster that a step empties keeps the centre it had.
                    for c, kept in around["held"].get(k, {}).items():
                        if n[c] == 0:
                            n[c], q[c], dots[k][:-1, c] = kept
                    centres[k] = (n, [float(x) for x in q], dots[k][:-1])
                now = {"a": around["a"], "centres": centres, "totals": totals, "changes": around["changes"]}
                if not last:
                    return _table(onward(b, own, now, [k for k in active if changes.get(k, 1) > 0]), _MESSAGE)
                now["centres"] = {k: (n, q, _small(d)) for k, (n, q, d) in centres.items()}
                return _table([(b, pickle.dumps(now), [x for k in given for x in totals[k][0]], [x for of_step in now["changes"] for x in of_step],
                                [x for k in given for x in totals[k][1]])], schema)
            return of_block

        if first:
            state = self.spark.range(0).selectExpr("cast(id AS int) AS block", "cast('' AS binary) AS payload")
        new = self.blocks.groupBy("block").cogroup(state.select("block", "payload").groupBy("block")).applyInArrow(begin, MESSAGE)
        rounds = steps + 1 if first else steps
        row = f"block int, payload binary, sizes array<bigint>, changes array<bigint>, squares array<{self.total}>"
        for i in range(rounds):
            new = self.tiles.groupBy("tile").cogroup(new.groupBy("tile")).applyInArrow(sums(sizes if first and i == 0 and sizes else None), MESSAGE)
            new = self.blocks.groupBy("block").cogroup(new.groupBy("block")).applyInArrow(settle(i == rounds - 1), row if i == rounds - 1 else MESSAGE)
        new = cut_lineage(new, row)
        rows = new.select("sizes", "changes", "squares").collect()
        places = [(k, c) for k in given for c in range(n_of(k))]
        each = [[sum(r["changes"][i * len(given) + j] for r in rows) for j in range(len(given))] for i in range(steps)]
        self.trail = [dict(zip(given, x)) for x in each]
        # All blocks have the same sizes and Σ S².
        return (new, {kc: rows[0]["sizes"][i] if rows else 0 for i, kc in enumerate(places)}, self.trail[-1] if steps else dict.fromkeys(given, 0),
                {kc: rows[0]["squares"][i] if rows else 0 for i, kc in enumerate(places)})

    def assignment(self, state: DataFrame) -> DataFrame:
        """point_id and a{k} of each run; points that meet no dimension have no row."""
        names = [f"a{k}" for k in self.ks]
        kind, ids = self.point, {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[self.point]

        def rows(block: pa.Table, states: pa.Table) -> pa.Table:
            if not block.num_rows:
                return pa.table({"point_id": pa.array([], ids), **{n: pa.array([], pa.int32()) for n in names}})
            own = pickle.loads(block.column("payload")[0].as_py())
            a = pickle.loads(states.column("payload")[0].as_py())["a"].astype(np.int32)
            met = own["met"]
            return pa.table({"point_id": pa.array(own["ids"][met], ids),
                             **{n: pa.array(a[met, i], mask=a[met, i] < 0) for i, n in enumerate(names)}})

        return self.blocks.groupBy("block").cogroup(state.select("block", "payload").groupBy("block")).applyInArrow(
            rows, f"point_id {kind}, " + ", ".join(f"{n} int" for n in names))
