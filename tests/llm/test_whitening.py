"""The solver against LAPACK, sums against exact fractions, the whole query against numpy on a whole table."""

from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import whitening as m

rng = np.random.default_rng(5)


def matrices():
    for n in (1, 2, 3, 7, 33, 64):
        a = rng.normal(size=(n, n))
        q, _ = np.linalg.qr(a)
        u = rng.normal(size=(n, 1))
        yield from (a + a.T, a @ a.T, np.eye(n), np.zeros((n, n)), u @ u.T, np.eye(n) + u @ u.T)
        yield q @ np.diag(10.0 ** (-np.arange(n) / 4)) @ q.T
        yield q @ np.diag(np.where(np.arange(n) % 2, 1.0, 1 + 1e-13 * np.arange(n))) @ q.T
        yield np.diag(np.abs(np.arange(n) - n // 2) * 1.0) + np.diag(np.ones(n - 1), 1) + np.diag(np.ones(n - 1), -1)


def test_eigen_pairs():
    for a in matrices():
        values, q = m.eigen(a)
        size = max(float(np.abs(a).max()), 1e-300)
        assert np.abs(q.T @ q - np.eye(len(a))).max() < 1e-13
        assert np.abs(a @ q - q * values).max() < 1e-12 * size * max(1, len(a) / 8)
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() < 1e-12 * size * max(1, len(a) / 8)
        assert (np.diff(values) <= 0).all()


def test_outer_products_keep_what_doubles_lose():
    x = rng.integers(-50, 50, size=(9000, 5)) + np.array([0, 1, 10**9, 3, 10**12])
    x[:, 3] *= 10**7
    n, s = len(x), [int(v) for v in x.astype(object).sum(0)]
    mean = [Fraction(v, n) for v in s]
    high = np.array([float(v) for v in mean])
    low = np.array([float(v - Fraction(float(v))) for v in mean])
    halves = [m.DoubleDouble(np.zeros((5, 5)), np.zeros((5, 5))) for _ in range(2)]
    for total, rows in zip(halves, (x[:4000], x[4000:]), strict=True):
        a, e = m.two_sum(rows.astype(float), -high)
        m.outer_products(total, *m.two_sum(a, e - low))
    halves[0].add(halves[1].high, halves[1].low)
    exact = [[sum((int(r[i]) - mean[i]) * (int(r[j]) - mean[j]) for r in x) for j in range(5)] for i in range(5)]
    for i in range(5):
        for j in range(5):
            got = Fraction(float(halves[0].high[i, j])) + Fraction(float(halves[0].low[i, j]))
            scale = (exact[i][i] * exact[j][j]) ** 0.5
            assert abs(float(got - exact[i][j])) <= 1e-27 * float(scale), (i, j)


def check(rows, out, most=16):
    """Every value of the query's result against numpy on the same rows."""
    d = len(rows[0][1])
    xs = [(v, tuple(int(np.floor(float(np.float32(c)) * 64)) + 10**6 for c in e)) for v, e in rows]
    fit = np.array(sorted({x for _, x in xs}), object)
    n, s = len(fit), fit.sum(0)
    t = fit * n - s
    cov = np.array([[float(Fraction(int((t[:, i] * t[:, j]).sum()), n**3)) for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, d)
    by = {}
    for r in out:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    signs = {}
    assert len(out) == len(rows) * k
    for v, x in xs:
        y = np.array([int(a) * n - int(b) for a, b in zip(x, s, strict=True)], object)
        one = by[v, int((y * y).sum())]
        for c in range(1, k + 1):
            for r in one[c]:
                assert r.n == n and abs(r.explained - values[c - 1] / values.sum()) <= 1e-9
                want = float((y / n).astype(float) @ vectors[:, c - 1]) / np.sqrt(values[c - 1])
                sign = signs.setdefault(c, np.sign(want * r.whitened)) if abs(want) > 1e-3 else signs.get(c, np.sign(want * r.whitened))
                assert abs(r.whitened - sign * want) < 1e-6, (v, c)
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-9


def test_whole_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    good = [(v, e) for v, e in rows if e is not None and all(c is not None and np.isfinite(c) for c in e)]
    check(good, m.op12_whitening(spark, d).collect())


SCHEMA = "vec_id long, embedding array<float>, component string, n string, x string"


def test_odd_rows(spark):
    base = rng.normal(size=(40, 3)).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [rows[3], (None, rows[4][1]), (99, rows[5][1])]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [1.0, float("inf"), 2.0]), (104, []), (105, [1.0, 2.0])]
    out = m.whiten(spark.createDataFrame([(*r, "c", "n", "x") for r in rows + bad], SCHEMA).repartition(7)).collect()
    check(rows, out)
    assert len({r.vec_id for r in out if r.vec_id and r.vec_id >= 100}) == 0
    assert m.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    same = m.whiten(spark.createDataFrame([(i, [1.0, 2.0], "c", "n", "x") for i in range(3)], SCHEMA)).collect()
    assert len(same) == 6 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.explained is None and r.identity_error is None for r in same)
    line = m.whiten(spark.createDataFrame([(i, [float(i), 1.0], "c", "n", "x") for i in range(4)], SCHEMA)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in line) and line[0].identity_error < 1e-12
    huge = m.whiten(spark.createDataFrame([(i, [1e30 * i, float(i)], "c", "n", "x") for i in range(4)], SCHEMA)).collect()
    assert len(huge) == 8 and {r.deviation for r in huge if r.vec_id != 0} == {None}
