"""Sliding order statistics, drift, fills and sequences against direct computation."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import conformal, drift, evaluate, sequences


def test_sliding_equals_sorting():
    rng = np.random.default_rng(3)
    s, days = conformal.Sliding(), []
    for i in range(200):
        days.append(rng.integers(0, 9, rng.integers(0, 6)).astype(float))
        s.enter(days[-1])
        if i >= 14:
            s.leave(days[i - 14])
        held = np.sort(np.concatenate(days[max(0, i - 13) :]))
        assert (s.held == held).all()
        if len(held):
            assert s.quantile(0.2) == held[min(len(held), int(np.ceil((len(held) + 1) * 0.8))) - 1]
        else:
            assert s.quantile(0.2) is None


def test_calibration_equals_a_sort_of_each_window(spark):
    rng = random.Random(5)
    rows = [("a", "m", d, d * 24 + k, 10.0, 12.0, 9.0, 13.0) for d in range(60) if d % 13 for k in range(3)]
    actual = {(r[0], r[3]): rng.choice([None, rng.gauss(11, 2)]) for r in rows if r[2] % 9}
    f = spark.createDataFrame(rows, "entity string, model string, day long, h long, q10 double, q90 double, q025 double, q975 double").repartition(4)
    y = spark.createDataFrame([(e, h, v) for (e, h), v in actual.items()], "entity string, h long, y double")
    scores = {}
    for r in rows:
        if actual.get((r[0], r[3])) is not None:
            v = actual[r[0], r[3]]
            scores.setdefault(r[2], []).append((max(r[4] - v, v - r[5]), max(r[6] - v, v - r[7])))
    for chunk in (3, 28):
        got = {r.day: r for r in conformal.moves(f, y, window=20, gap=2, least=9, chunk=chunk).collect()}
        assert len(got) == len({r[2] for r in rows})
        for d, r in got.items():
            inside = [scores[x] for x in range(d - 21, d - 1) if x in scores]
            assert r.days == len(inside)
            for i, (a, c) in enumerate(((0.2, r.c_q10), (0.05, r.c_q025))):
                v = sorted(s[i] for x in inside for s in x)
                assert c == (None if len(inside) < 9 else v[min(len(v), int(np.ceil((len(v) + 1) * (1 - a)))) - 1])
    out = conformal.conformalize(f, y, window=20, gap=2, least=9)
    assert out.count() == len(rows) and {r.model for r in out.collect()} == {"m+cqr"}
    assert all(r.q025 <= r.q10 and r.q975 >= r.q90 for r in out.collect())
    first = out.where("day = 1").first()
    assert not first.calibrated and (first.q10, first.q975) == (10.0, 13.0)


def test_drift_equals_direct_distances(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 300).round(1), rng.normal(0.4, 1.2, 400).round(1)
    rows = [(True, float(v), 1.0, None) for v in a] + [(False, float(v), 1.0, 2.0 if i < 9 else None) for i, v in enumerate(b)] + [(True, None, 1.0, None)]
    df = spark.createDataFrame(rows, "now boolean, x double, one double, gone double").repartition(5)
    assert drift.filled_columns(df, ["x", "one", "gone"]) == ["x", "one"]
    for ranges in (1, 7):
        got = {r.feature: r for r in drift.two_sample(df, ["x", "one"], ranges).collect()}
        grid = np.unique(np.concatenate([a, b]))
        fa, fb = np.searchsorted(np.sort(a), grid, "right") / len(a), np.searchsorted(np.sort(b), grid, "right") / len(b)
        x = got["x"]
        assert (x.n_now, x.n_ref) == (300, 400) and abs(x.ks - np.abs(fa - fb).max()) < 1e-12
        assert abs(x.wasserstein - (np.abs(fa - fb)[:-1] * np.diff(grid)).sum() / b.std()) < 1e-9
        z = x.ks * np.sqrt(300 * 400 / 700)
        assert abs(x.p - 2 * sum((-1) ** (j - 1) * np.exp(-2 * j * j * z * z) for j in range(1, 60))) < 1e-12 and x.drifted
        assert got["one"].ks == 0 and got["one"].p == 1 and not got["one"].drifted
    with pytest.raises(ValueError):
        drift.two_sample(df, [])


def test_seasonal_windows(spark):
    days = spark.range(0, 800).select(F.col("id").alias("day"))
    got = drift.seasonal_windows(days, 799).groupBy("now").agg(F.min("day"), F.max("day"), F.count("*")).collect()
    assert {tuple(r) for r in got} == {(True, 772, 799, 28), (False, 408, 435, 28)}


def test_fills_do_not_depend_on_blocks(spark):
    rng = random.Random(2)
    rows = [(e, h, rng.choice([None, float(h)]), rng.choice([None, None, -float(h)])) for e in "ab" for h in range(30, 90) if rng.random() < 0.7]
    panel = spark.createDataFrame(rows, "entity string, h long, u double, v double")
    want = {}
    for e in "ab":
        at = {r[1]: r for r in rows if r[0] == e}
        for c in (2, 3):
            last = None
            for h in range(min(at), max(at) + 1):
                last = at[h][c] if h in at and at[h][c] is not None else last
                want[e, h, c] = last
        nxt = None
        for h in range(max(at), min(at) - 1, -1):
            nxt = want[e, h, 3] if want[e, h, 3] is not None else nxt
            want[e, h, 3] = nxt
    for block in (1, 7, 1000):
        got = sequences.filled(sequences.regular(panel), ["u", "v"], ["v"], block).collect()
        assert {(r.entity, r.h, c): r[n] for r in got for c, n in ((2, "u"), (3, "v"))} == want


def test_histories_end_at_their_own_cutoff(spark):
    grid = spark.range(0, 500).select(F.lit("a").alias("entity"), F.col("id").alias("h"), F.col("id").cast("double").alias("value")).where("h % 17 <> 0")
    origins = spark.createDataFrame([("a", d, 24 * d + 6 + d % 3) for d in range(1, 25)] + [("b", 3, 78)], "entity string, day int, cutoff long")
    for length in (5, 24, 100):
        got = {r.day: r for r in sequences.histories(grid, origins, "value", length).collect()}
        assert len(got) == len([d for d in range(1, 25) if 24 * d + 6 + d % 3 - length < 500])
        for d, r in got.items():
            want = [float(h) for h in range(max(0, r.cutoff - length + 1), min(499, r.cutoff) + 1) if h % 17]
            assert r["values"] == want and r.last == want[-1] and r.n == len(want)
        assert sequences.past_cutoff(sequences.histories(grid, origins, "value", length)).count() == 0
    h = sequences.horizon(sequences.histories(grid, origins, "value").where("day = 2"), grid.withColumn("t", F.col("value")), ["t"], 20).orderBy("step").collect()
    assert [r.h for r in h] == [h[0].h + k for k in range(20)] and h[0].h == 57 and [r.t for r in h if r.h == 68] == [67.0]


def test_abstention(spark):
    f = spark.createDataFrame([("m", 29.0, 1.0), ("m", 31.0, 1.0), ("m", None, None)], "model string, yhat double, q10 double")
    out = sequences.abstained(f, spark.createDataFrame([(10.0,), (None,)], "value double"), ["yhat", "q10"]).collect()
    assert sorted((r.abstained, r.yhat, r.q10) for r in out if r.yhat or r.abstained) == [(False, 29.0, 1.0), (True, None, None)] and len(out) == 3


def test_extremes_are_nearest_quantiles(spark):
    rng = random.Random(8)
    rows = [(k, rng.choice([None, *map(float, range(12))])) for k in "xy" for _ in range(rng.randrange(30, 90))]
    got = {r.k: r for r in evaluate.extremes(spark.createDataFrame(rows, "k string, t double"), ["k"], "t").collect()}
    for k in "xy":
        v = sorted(t for e, t in rows if e == k and t is not None)
        assert (got[k].lo, got[k].hi) == tuple(v[int(np.floor(q * (len(v) - 1) + 0.5))] for q in (0.05, 0.95))
