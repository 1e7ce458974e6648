"""Whitening of embeddings through the singular values of their centred rows.

Entries become whole numbers ``floor(scale * c) + offset``, so counts and sums are exact. Then

1. blockwise QR: each task folds its centred rows, a block at a time, into one triangular factor; factors are folded
   ``FAN`` at a time until one R (dimension x dimension) is left, which has the covariance ``R'R / n``;
2. Householder reflections turn R into an upper bidiagonal matrix;
3. the differential quotient-difference transform with shifts (dqds) finds its squared singular values to high relative
   accuracy, deflating from the end and splitting where an off-diagonal entry vanishes;
4. a twisted factorisation of ``B'B - lambda`` gives each direction: of the stationary and the progressive transform the
   index with the smallest pivot is the twist, and two short recurrences from there give the vector. One Rayleigh
   correction follows. Directions of (nearly) equal singular values are made orthogonal, if need be by inverse iteration.

Steps 2 to 4 see one triangular factor, whose size is that of the dimension alone. Rows are read once for the sums, once for
the factors and once for the projection; nothing is shuffled but sums and factors.

Defined cases: a vector that is null, or has null or non-finite entries or entries whose whole number exceeds 2**53, is
dropped; so are vectors whose length is not the most frequent one (the longer one of equally frequent). Repeated rows and rows
with a null id are vectors of their own. Directions without variance (all vectors equal, fewer rows or entries than
components) are no components, so there may be fewer rows per vector, or none. A deviation beyond a long is null. Empty
tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.llm.frames import cut_lineage, read

COMPONENTS = 8
SCALE, OFFSET = 1024, 100000
BLOCK = 2048
FAN = 32
_EPS = np.finfo(float).eps
_LOW = 26
_MOST = 2.0**53


# --- the triangular factor

def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """The vectors of an Arrow list column as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def whole_numbers(values: np.ndarray, scale: int, offset: int) -> np.ndarray:
    return np.floor(values * scale).astype(np.int64) + offset


def fold(factor: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if factor is None else np.vstack((factor, rows)), mode="r")


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with ``r = U B V'`` by Householder reflections; B is square."""
    a = r.astype(float).copy()
    n = a.shape[1]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        w = x.copy()
        size = np.linalg.norm(x)
        w[0] += np.copysign(size, x[0])
        length = w @ w
        return w, (2 / length if length > 0 else 0.0)

    for k in range(n):
        w, f = reflector(a[k:, k])
        a[k:, k:] -= f * np.outer(w, w @ a[k:, k:])
        if k + 2 < n:
            w, f = reflector(a[k, k + 1:])
            a[k:, k + 1:] -= f * np.outer(a[k:, k + 1:] @ w, w)
            v[:, k + 1:] -= f * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


# --- singular values

def _dqds(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """One transform; None if the shift is above the smallest eigenvalue. The last value is the smallest d."""
    n = len(q)
    out_q, out_e = np.empty(n), np.empty(max(0, n - 1))
    d = q[0] - shift
    least = d
    for i in range(n - 1):
        out_q[i] = d + e[i]
        if not out_q[i] > 0:
            return None
        ratio = q[i + 1] / out_q[i]
        out_e[i] = e[i] * ratio
        d = d * ratio - shift
        least = min(least, d)
        if d < 0:
            return None
    out_q[n - 1] = d
    return out_q, out_e, least


def _smaller_root(a: float, b: float, c: float) -> float:
    """The smaller eigenvalue of [[a, sqrt(b)], [sqrt(b), c]]."""
    half = (a + c) / 2
    root = half + np.sqrt(((a - c) / 2) ** 2 + b)
    return (a * c - b) / root if root > 0 else 0.0


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling."""
    top = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if top == 0:
        return np.zeros(len(diagonal))
    # A zero on the diagonal becomes a value far below the rounding of the largest.
    q = np.maximum(np.abs(diagonal) / top, 1e-3 * _EPS) ** 2
    e = (above / top) ** 2
    blocks = [(q, e, 0.0)]
    found: list[float] = []
    while blocks:
        q, e, sigma = blocks.pop()
        guess = 0.0
        while len(q):
            if len(q) == 1:
                found.append(sigma + q[0])
                break
            small = e <= (10 * _EPS) ** 2 * (sigma + np.minimum(q[:-1], q[1:])) + 1e-300
            if small[-1]:
                found.append(sigma + q[-1])
                q, e = q[:-1], e[:-1]
                guess = 0.0
                continue
            cut = np.flatnonzero(small)
            if len(cut):
                at = cut[-1] + 1
                blocks.append((q[:at], e[:at - 1], sigma))
                q, e = q[at:], e[at:]
                continue
            before = e[-2] if len(e) > 1 else 0.0
            shift = min(guess, _smaller_root(q[-2] + before, q[-2] * e[-1], q[-1] + e[-1]))
            step = None
            for part in (1 - 4 * _EPS, 0.9, 0.5, 0.1, 0.0):
                step = _dqds(q, e, shift * part)
                if step is not None:
                    sigma += shift * part
                    break
            if step is None:  # a pivot underflowed: the value is zero
                q = np.maximum(q, 1e-300)
                found.append(sigma)
                q, e = q[:-1], e[:-1]
                continue
            q, e, guess = step
    return np.sort(np.array(found))[::-1] * top**2


# --- directions

def _twisted(d: np.ndarray, u: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """(vector, pivot) of ``B'B - value`` by its twisted factorisation; B has diagonal d and superdiagonal u."""
    n = len(d)
    tiny = _EPS * max(value, np.max(d * d, initial=0)) * 1e-3 + 1e-300

    def safe(x: float) -> float:
        return x if abs(x) > tiny else (tiny if x >= 0 else -tiny)

    q, e = d * d, u * u          # B'B = L D L' with D = q and l = u / d
    s, p = np.empty(n), np.empty(n)
    lower, upper = np.empty(max(0, n - 1)), np.empty(max(0, n - 1))
    s[0] = -value
    for i in range(n - 1):       # stationary: L+ D+ L+'
        pivot = safe(q[i] + s[i])
        lower[i] = d[i] * u[i] / pivot
        s[i + 1] = lower[i] * (u[i] / d[i]) * s[i] - value if d[i] else e[i] - lower[i] * d[i] * u[i] - value
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):  # progressive: U- D- U-'
        pivot = safe(e[i] + p[i + 1])
        upper[i] = d[i] * u[i] / pivot
        p[i] = p[i + 1] * (q[i] / pivot) - value
    gamma = s + p + value
    r = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[r] = 1
    for i in range(r - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -upper[i] * z[i]
    return z, float(gamma[r])


def _times(d: np.ndarray, u: np.ndarray, z: np.ndarray) -> np.ndarray:
    """``B'B z``"""
    y = d * z
    y[:-1] += u * z[1:]
    out = d * y
    out[1:] += u * y[:-1]
    return out


def directions(d: np.ndarray, u: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors (columns) of ``B'B`` to the given eigenvalues, which fall."""
    n = len(d)
    out = np.zeros((n, 0))
    for value in values:
        z, pivot = _twisted(d, u, value)
        better, _ = _twisted(d, u, value + pivot / (z @ z)) if np.isfinite(pivot / (z @ z)) else (z, 0.0)
        if np.all(np.isfinite(better)):
            z = better
        z = z / np.linalg.norm(z)
        bound = 64 * n * _EPS * values[0]
        alone = z - out @ (out.T @ z)
        size = np.linalg.norm(alone)
        good = np.all(np.isfinite(z)) and size > 0.9 and np.linalg.norm(_times(d, u, alone / size) - value * alone / size) <= bound
        if not good:
            # Equal or nearly equal values: inverse iteration in what is orthogonal to the directions found.
            b = np.diag(d) + np.diag(u, 1)
            shifted = b.T @ b - (value + 64 * _EPS * values[0]) * np.eye(n)
            alone = np.random.default_rng(n + out.shape[1]).standard_normal(n)
            for _ in range(4):
                alone -= out @ (out.T @ alone)
                alone = np.linalg.solve(shifted, alone / np.linalg.norm(alone))
        alone -= out @ (out.T @ alone)
        out = np.column_stack((out, alone / np.linalg.norm(alone)))
    return out


def solve(factor: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, unit directions as columns, trace) of the covariance ``factor' factor / n``."""
    size = factor.shape[1]
    square = np.zeros((size, size))
    square[:min(size, len(factor))] = factor[:size]
    trace = float((square * square).sum()) / n
    d, u, v = bidiagonal(square)
    values = squared_singular_values(d, u)
    values = values[:components]
    values = values[values > (8 * size * _EPS) ** 2 * max(values.max(initial=0), 1e-300)]
    if not len(values):
        return values, np.zeros((size, 0)), trace
    return values / n, v @ directions(d, u, values), trace


# --- the operator

def _fit_rows(rows: DataFrame, id_col: str, vec_col: str, scale: int) -> tuple[DataFrame, int]:
    """(vec_id, v) of the vectors that count, and their dimension."""
    base = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    base = base.filter("v is not null").filter(F.forall("v", lambda c: F.coalesce(F.abs(c * F.lit(float(scale))) < F.lit(_MOST), F.lit(False))))
    common = base.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    dimension = common["d"] if common else 0
    return base.filter(F.size("v") == dimension), dimension


def _sums(dimension: int, scale: int, offset: int):
    def run(batches):
        n, high, low = 0, np.zeros(dimension, np.int64), np.zeros(dimension, np.int64)
        for batch in batches:
            x = whole_numbers(matrix(batch.column(0), dimension), scale, offset)
            n += len(x)
            high += (x >> _LOW).sum(axis=0)
            low += (x & ((1 << _LOW) - 1)).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimension)), pa.array(np.full(dimension, n)), pa.array(high), pa.array(low)],
                                             names=["i", "n", "high", "low"])
    return run


def _factors(dimension: int, mean: np.ndarray, scale: int, offset: int):
    def run(batches):
        factor = None
        for batch in batches:
            x = whole_numbers(matrix(batch.column(0), dimension), scale, offset) - mean
            for at in range(0, len(x), BLOCK):
                factor = fold(factor, x[at:at + BLOCK])
        if factor is not None:
            yield pa.RecordBatch.from_arrays([pa.array([factor.ravel()], pa.list_(pa.float64()))], names=["r"])
    return run


def _folded(dimension: int):
    def run(batches):
        factor = None
        for batch in batches:
            for r in batch.column(0):
                factor = fold(factor, r.values.to_numpy().reshape(-1, dimension))
        if factor is not None:
            yield pa.RecordBatch.from_arrays([pa.array([factor.ravel()], pa.list_(pa.float64()))], names=["r"])
    return run


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of ``(n * x - S)**2``, exact."""
    most = max((abs(s) for s in sums), default=0)
    if n * int(np.abs(x).max(initial=0)) + most < 2**62:
        y = n * x - np.array(sums, dtype=np.int64)
        if float(np.abs(y).max(initial=0)) ** 2 * max(1, y.shape[1]) < 2**62:
            return (y * y).sum(axis=1).tolist()
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 2**63 else None for v in exact]


def _project(dimension: int, n: int, sums: list[int], mean: np.ndarray, w: np.ndarray, scale: int, offset: int):
    def run(batches):
        for batch in batches:
            x = whole_numbers(matrix(batch.column(1), dimension), scale, offset)
            y = (x - mean) @ w
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1]), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviations(x, n, sums), pa.int64()), lists], names=["vec_id", "deviation", "w"])
    return run


def _products(k: int, mean: list[float]):
    """Sums of the products of whitened components, centred first."""
    def run(batches):
        total = np.zeros((k, k))
        for batch in batches:
            y = matrix(batch.column(0), k) - np.array(mean)
            total += y.T @ y
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "total"])
    return run


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Per remaining vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = rows.sparkSession
    fit, dimension = _fit_rows(rows, id_col, vec_col, scale)
    if not dimension:
        return spark.createDataFrame([], OUT)
    sums_of = (fit.select("v").mapInArrow(_sums(dimension, scale, offset), "i long, n long, high long, low long")
               .groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
                                 F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).orderBy("i").collect())  # one row per dimension
    n = sums_of[0]["n"]
    sums = [(int(r["high"]) << _LOW) + int(r["low"]) for r in sums_of]
    mean = np.array([s / n for s in sums])
    factors = cut_lineage(fit.select("v").mapInArrow(_factors(dimension, mean, scale, offset), "r array<double>"))
    left = factors.count()
    while left > 1:
        parts = -(-left // FAN)
        factors = cut_lineage(factors.repartition(parts).mapInArrow(_folded(dimension), "r array<double>"))
        left = factors.count()
    factor = np.array(factors.first()["r"]).reshape(-1, dimension)
    values, vectors, trace = solve(factor, n, components)
    k = len(values)
    if not k:
        return spark.createDataFrame([], OUT)
    done = cut_lineage(fit.mapInArrow(_project(dimension, n, sums, mean, vectors / np.sqrt(values), scale, offset),
                                      "vec_id long, deviation long, w array<double>"))
    centre = list(done.agg(*[F.avg(F.get("w", F.lit(j))).alias(f"m{j}") for j in range(k)]).first())
    products = done.select("w").mapInArrow(_products(k, centre), "i long, j long, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    error = max(abs(r["total"] / n - (r["i"] == r["j"])) for r in products)
    explained = F.array(*[F.lit(float(v / trace)) for v in values])
    out = done.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      F.get(explained, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"))


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
