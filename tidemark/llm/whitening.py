"""Whitening of embeddings from a covariance that is summed without rounding errors.

Vectors become integers x = floor(64 c) + 1000000; each distinct x vector counts once for the fit. Three passes, each of
which sends a task's partial result of fixed size only:

* n and the sums S of each dimension, exact;
* the centred outer products. x - S/n is held as a high and a low double. A block of rows is cut into slices of 20 bits
  a value, so that every product of two slices is summed over the block without error (an error-free transformation of
  the matrix product), and these sums enter a double-double by TwoSum. High and low parts travel and are merged across
  tasks as such;
* the same sums of the whitened fit list, with a constant column for its mean, which measure ``identity_error``.

The covariance (dimensions squared) is solved on the driver: Householder reduction to a tridiagonal matrix, then
divide and conquer (rank-one tearing, deflation, roots of the secular equation by bisection from the nearer pole, and
weights recomputed from the roots, which keeps eigenvectors orthogonal).

Defined results: a row whose vector is null, or holds null or non-finite entries, is left out; so is one whose length
isn't the most frequent (of equally frequent the largest), as no covariance has both. Null or repeated vec_ids are rows
like others. A component whose eigenvalue is 0 but for rounding has null ``whitened`` and counts for nothing in
``identity_error``, which is null if no other is left; ``explained`` is null if all vectors are equal. ``deviation`` is
null where it passes 64 bits. 64 c counts as 2^61 at most, in size. Empty tables give an empty table. Only vec_id and embedding are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stash, stash, table

SHIFT, SCALE = 1_000_000, 64
_BITS, _BLOCK, _SLICES = 20, 4096, 5  # 2 * 20 bits and 4096 = 2^12 rows: sums below 2^53 are exact
_SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
_EPS = float(np.finfo(float).eps)


def whole(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): the rows that remain, as vectors of integers."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    finite = F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform("e", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(2.0**61)), F.lit(-(2.0**61)))) + SHIFT)
    return rows.where(F.col("e").isNotNull() & (F.size("e") > 0) & finite).select("vec_id", x.alias("x"))


def two_sum(a, b):
    """a + b as a rounded sum and its error."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


class DoubleDouble:
    """A matrix of sums, each a high and a low double."""

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.high, self.low = high, low

    def add(self, high: np.ndarray, low=0.0) -> None:
        s, e = two_sum(self.high, high)
        t, f = two_sum(self.low, low)
        s, e = two_sum(s, e + t)
        self.high, self.low = two_sum(s, e + f)


def outer_products(total: DoubleDouble, high: np.ndarray, low: np.ndarray) -> None:
    """Adds the products of all columns of rows ``high + low`` to ``total``."""
    for k in range(0, len(high), _BLOCK):
        h, e = high[k : k + _BLOCK], low[k : k + _BLOCK]
        top = np.abs(h).max(0) if len(h) else np.zeros(h.shape[1])
        unit = np.exp2(np.where(top > 0, np.frexp(top)[1], 0).astype(float))
        slices = []
        for _ in range(_SLICES):
            unit = unit / 2.0**_BITS
            cut = np.rint(h / unit) * unit
            slices.append(cut)
            h, e = two_sum(h - cut, e)
        for size in range(2 * _SLICES - 1, -1, -1):  # the smallest products first
            for i in range(min(size, _SLICES - 1) + 1):
                if size <= _SLICES and size - i < _SLICES:
                    total.add(slices[i].T @ slices[size - i])


def _arrays(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), pa.array(rows.ravel()))


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def sums(x: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sums of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for b in batches:
            m = _matrix(b["x"])
            if len(m):
                n += len(m)
                high, low = (m >> 32).sum(0), (m & 0xFFFFFFFF).sum(0)
                total = [t + (int(h) << 32) + int(w) for t, h, w in zip(total, high, low, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d + 1), pa.int32()), pa.array([*total, n], pa.decimal128(38, 0))], names=["i", "s"]
        )

    rows = x.select("x").mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()  # a row for each dimension
    by = {r["i"]: int(r["s"]) for r in rows}
    return by.get(d, 0), [by.get(i, 0) for i in range(d)]


def scatter(x: DataFrame, width: int, columns: Callable) -> DoubleDouble:
    """The summed outer products of ``columns(x)``, a high and a low matrix of ``width`` columns, over all rows."""
    schema = "i int, high array<double>, low array<double>"

    def emit(total: DoubleDouble, at) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), _arrays(total.high), _arrays(total.low)], names=["i", "high", "low"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = DoubleDouble(np.zeros((width, width)), np.zeros((width, width)))
        for b in batches:
            if b.num_rows:
                outer_products(total, *columns(_matrix(b["x"])))
        yield emit(total, range(width))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, DoubleDouble] = {}
        for b in batches:
            for i, h, w in zip(b["i"].to_pylist(), _matrix(b["high"]), _matrix(b["low"]), strict=True):
                held.setdefault(i, DoubleDouble(np.zeros(width), np.zeros(width))).add(h, w)
        if held:
            yield emit(DoubleDouble(np.array([t.high for t in held.values()]), np.array([t.low for t in held.values()])), list(held))

    out = DoubleDouble(np.zeros((width, width)), np.zeros((width, width)))
    for r in x.select("x").mapInArrow(run, schema).repartition("i").mapInArrow(merge, schema).collect():  # one matrix
        out.high[r["i"]], out.low[r["i"]] = r["high"], r["low"]
    return out


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, q) with a = q t q^T, by Householder reflections."""
    a, d = a.copy(), len(a)
    q = np.eye(d)
    for k in range(d - 2):
        v = a[k + 1 :, k].copy()
        size = float(np.linalg.norm(v))
        if np.linalg.norm(v[1:]) == 0.0:
            continue
        v[0] += np.copysign(size, v[0])
        v /= np.linalg.norm(v)
        p = a[k + 1 :, k + 1 :] @ v
        w = p - v * (v @ p)
        a[k + 1 :, k + 1 :] -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def _roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + rho sum z^2 / (d - root), as differences d[i] - root[j] (row j), and the roots."""
    k, z2 = len(d), z * z
    gap = np.append(np.diff(d), rho * z2.sum())
    value = lambda pole, mu: 1 + rho * (z2 / ((d[None, :] - d[pole][:, None]) - mu[:, None])).sum(1)
    near = np.arange(k)
    right = (value(near, gap / 2) < 0) & (near < k - 1)  # the root lies beyond the middle: count from the next pole
    pole = near + right
    lo, hi = np.where(right, -gap / 2, 0.0), np.where(right, 0.0, np.where(near < k - 1, gap / 2, gap))
    with np.errstate(divide="ignore", over="ignore"):
        for _ in range(260):
            mid = (lo + hi) / 2
            up = value(pole, mid) > 0
            lo, hi = np.where(up, lo, mid), np.where(up, mid, hi)
    mu = np.where(right, lo, hi)
    return (d[None, :] - d[pole][:, None]) - mu[:, None], d[pole] + mu


def _merged(d: np.ndarray, z: np.ndarray, rho: float, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eigenpairs of q (diag(d) + rho z z^T) q^T, rho > 0."""
    order = np.argsort(d, kind="stable")
    d, z, q = d[order], z[order], q[:, order]
    size = float(z @ z)
    z, rho = z / np.sqrt(size), rho * size
    tol = 8 * _EPS * max(float(np.abs(d).max()), rho)
    kept: list[int] = []
    for j in range(len(d)):
        if rho * abs(z[j]) <= tol:
            z[j] = 0.0
            continue
        if kept:
            i = kept[-1]
            r = float(np.hypot(z[i], z[j]))
            c, s = z[j] / r, -z[i] / r
            if abs((d[j] - d[i]) * c * s) <= tol:  # two poles as good as equal: a rotation leaves the weight to one
                q[:, [i, j]] = np.column_stack([c * q[:, i] + s * q[:, j], c * q[:, j] - s * q[:, i]])
                d[i], d[j] = d[i] * c * c + d[j] * s * s, d[i] * s * s + d[j] * c * c
                z[i], z[j] = 0.0, r
                kept.pop()
        kept.append(j)
    if not kept:
        return d, q
    values, vectors = d.copy(), q.copy()
    k = np.array(kept)
    apart, roots = _roots(d[k], z[k], rho)  # apart[j, i] = d[i] - root[j]
    poles = d[k][None, :] - d[k][:, None]  # poles[j, i] = d[i] - d[j]
    np.fill_diagonal(poles, 1.0)
    weight = np.sqrt(np.abs(np.prod(apart / poles, axis=0) / rho)) * np.sign(z[k])
    u = (weight[None, :] / apart).T
    u /= np.linalg.norm(u, axis=0)
    values[k], vectors[:, k] = roots, q[:, k] @ u
    return values, vectors


def divide_and_conquer(d: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of the tridiagonal matrix with diagonal d and off-diagonal e."""
    n = len(d)
    if n == 1:
        return d.copy(), np.eye(1)
    m = n // 2
    if e[m - 1] == 0.0:
        parts = [divide_and_conquer(d[:m], e[: m - 1]), divide_and_conquer(d[m:], e[m:])]
        rho = 0.0
    else:
        rho, sign = abs(float(e[m - 1])), float(np.sign(e[m - 1]))
        left, right = d[:m].copy(), d[m:].copy()
        left[-1] -= rho
        right[0] -= rho
        parts = [divide_and_conquer(left, e[: m - 1]), divide_and_conquer(right, e[m:])]
    q = np.zeros((n, n))
    q[:m, :m], q[m:, m:] = parts[0][1], parts[1][1]
    d = np.concatenate([parts[0][0], parts[1][0]])
    return (d, q) if rho == 0.0 else _merged(d, np.concatenate([q[m - 1, :m], sign * q[m, m:]]), rho, q)


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns whose largest entry is positive."""
    d, e, q = tridiagonal((a + a.T) / 2)
    values, vectors = divide_and_conquer(d, e)
    order = np.argsort(-values, kind="stable")
    vectors = (q @ vectors)[:, order]
    at = np.abs(vectors).argmax(0)
    return values[order], vectors * np.where(vectors[at, np.arange(len(a))] < 0, -1.0, 1.0)


def whiten(embeddings: DataFrame, most: int = 16) -> DataFrame:
    """A row for each remaining vector and component: (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    spark, rows = embeddings.sparkSession, whole(embeddings)
    length = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    if length is None:
        return spark.createDataFrame([], _SCHEMA)
    d = length["d"]
    rows = rows.where(F.size("x") == d)
    fit = stash(rows.select("x").distinct(), "fit", "zstd")
    n, total = sums(fit, d)
    mean = [Fraction(s, n) for s in total]
    high = np.array([float(m) for m in mean])
    low = np.array([float(m - Fraction(float(m))) for m in mean])

    def centred(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, e = two_sum(x.astype(float), -high)
        return two_sum(a, e - low)

    v = scatter(fit, d, centred)
    cov = v.high / n + v.low / n
    values, vectors = eigen(cov)
    k, trace = min(most, d), float(np.trace(cov))
    live = values[:k] > 16 * d * _EPS * max(float(values[0]), 0.0)
    with np.errstate(invalid="ignore", divide="ignore"):
        axes = np.where(live, vectors[:, :k] / np.sqrt(np.where(live, values[:k], 1.0)), 0.0)

    def whitened(x: np.ndarray) -> np.ndarray:
        a, e = centred(x)
        return a @ axes + e @ axes

    def with_one(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = np.column_stack([whitened(x), np.ones(len(x))])
        return w, np.zeros_like(w)

    w = scatter(fit, k + 1, with_one)
    drop_stash(fit)
    w = w.high / n + w.low / n
    error = np.abs(w[:k, :k] - np.outer(w[k, :k], w[k, :k]) - np.eye(k))[np.ix_(live, live)]
    error = float(error.max()) if live.any() else None
    explained = [float(e) / trace if trace > 0 else None for e in values[:k]]
    limit = (1 << 63) - 1

    def deviation(x: np.ndarray) -> list[int | None]:
        s = np.array(total, object)
        if max(abs(int(x.max())), abs(int(x.min())), 1) * n + max(map(abs, total)) < 1 << 62:
            t = x * n - s.astype(np.int64)
            if len(t) and int(np.abs(t).max()) ** 2 * d <= limit:
                return (t * t).sum(1).tolist()
        else:
            t = x.astype(object) * n - s
        exact = (t.astype(object) ** 2).sum(1)
        return [int(t) if t <= limit else None for t in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, _BLOCK):
                b = whole_batch.slice(at, _BLOCK)
                x, m = _matrix(b["x"]), b.num_rows
                each = np.repeat(np.arange(m), k)
                values_ = pa.array(whitened(x).ravel(), mask=np.tile(~live, m))
                yield pa.RecordBatch.from_arrays(
                    [
                        b["vec_id"].take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                        pa.array(deviation(x), pa.int64()).take(pa.array(each)), values_, pa.array(explained * m, pa.float64()), pa.array([error] * (m * k), pa.float64()),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, _SCHEMA)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {"op12_whitening": op12_whitening}
SQL: dict[str, str] = {}
