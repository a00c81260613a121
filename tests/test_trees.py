"""Splits of one tree against brute force, leaves, importance, quantiles that never cross."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import trees

P = trees.Params(rounds=1, depth=2, rate=1.0, bins=8, least=5, quantiles={"lo": 0.1, "hi": 0.9})


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    n = 600
    a, b, c = rng.integers(0, 6, n).astype(float), rng.normal(size=n).round(2), rng.choice(["u", "v", "w", "x"], n)
    y = np.where(a > 3, 5.0, 0.0) + 2 * np.isin(c, ["u", "x"]) + rng.normal(0, 0.3, n) + 0.3 * b
    rows = [(None if i % 17 == 0 else float(a[i]), float(b[i]), str(c[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "a double, b double, c string, y double").repartition(5), rows


def brute(forest, rows, members, g, node_bins):
    """The best split of some rows by all splits of all features."""
    best = None
    x = node_bins[members]
    total = g[members].sum() ** 2 / (len(members) + P.l2)
    for f, name in enumerate(forest.names):
        bins = sorted(set(x[:, f]))
        if name in forest.categories:
            bins.sort(key=lambda v: (g[members][x[:, f] == v].mean(), v))
        for k in range(1, len(bins)):
            left = np.isin(x[:, f], bins[:k])
            nl, nr = left.sum(), (~left).sum()
            if min(nl, nr) >= P.least:
                gain = g[members][left].sum() ** 2 / (nl + P.l2) + g[members][~left].sum() ** 2 / (nr + P.l2) - total
                if best is None or gain > best[0] + 1e-9:
                    best = (gain, f, set(bins[k:]))
    return best


def test_one_tree_equals_brute_force(spark, data):
    df, rows = data
    forest = trees.fit(df, "y", ["a", "b"], ["c"], P)
    got = df.select(forest.binned().alias("x"), "y").collect()
    x, y = np.array([r.x for r in got]), np.array([r.y for r in got])
    start = forest.start
    assert abs(start[0] - y.mean()) < 1e-9 and (y < start[1]).mean() <= 0.1 <= (y <= start[1]).mean()
    for head, tau in enumerate([None, 0.1, 0.9]):
        g = y - start[0] if tau is None else np.where(y < start[head], tau - 1, tau)
        tree, at = forest.trees[0][head], np.zeros(len(y), int)
        for level in range(P.depth):
            for node in range(2**level):
                members = np.flatnonzero(at == node)
                best = brute(forest, rows, members, g, x)
                inner = 2**level - 1 + node
                if best is None or best[0] <= 1e-12:
                    assert tree.feature[inner] == -1
                    continue
                assert tree.feature[inner] == best[1], (head, level, node)
                assert set(np.flatnonzero(tree.right[inner])) == best[2]
            at = tree.node(x, level + 1)
        for leaf in range(2**P.depth):
            r = np.sort(y[at == leaf] - start[head])
            if len(r):
                want = r.sum() / (len(r) + P.l2) if tau is None else r[max(0, int(np.ceil(tau * len(r))) - 1)]
                assert abs(tree.leaf[leaf] - want) < 1e-9


def test_forecasts_learn_and_quantiles_never_cross(spark, data):
    df, _ = data
    p = trees.Params(rounds=12, depth=3, rate=0.3, bins=16, least=8, keep_every=5, quantiles={"q10": 0.1, "q50": 0.5, "q90": 0.9})
    forest = trees.fit(df.withColumn("s", F.lit(2.0)), "y", ["a", "b"], ["c"], p)
    out = trees.predict(forest, df.withColumn("s", F.lit(2.0)), "s").collect()
    y, yhat = np.array([r.y for r in out]), np.array([r.yhat for r in out]) / 2
    assert np.abs(y - yhat).mean() < 0.25 * np.abs(y - y.mean()).mean()
    assert all(r.q10 <= r.q50 <= r.q90 for r in out)
    inside = np.mean([r.q10 / 2 <= r.y <= r.q90 / 2 for r in out])
    assert 0.7 < inside < 0.95
    share = forest.importance()
    assert abs(sum(share.values()) - 1) < 1e-9 and share["a"] > share["c"] > share["b"]


def test_odd_rows(spark):
    schema = "a double, c string, y double"
    with pytest.raises(ValueError, match="no row"):
        trees.fit(spark.createDataFrame([(1.0, "x", None)], schema), "y", ["a"], ["c"], P)
    rows = [(None, None, 1.0), (float("nan"), "x", 1.0), (2.0, "z", 1.0)] * 5
    forest = trees.fit(spark.createDataFrame(rows, schema), "y", ["a"], ["c"], P)
    out = trees.predict(forest, spark.createDataFrame([*rows, (9.0, "new", None)], schema)).collect()
    assert len(out) == 16 and all(abs(r.yhat - 1) < 1e-9 and r.lo == r.hi == 1.0 for r in out)
    assert trees.predict(forest, spark.createDataFrame([], schema)).count() == 0
