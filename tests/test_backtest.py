"""Backtests: coefficients against direct solves, refits against loops, run directories."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import backtest, models, ridge, trees
from tidemark.sources import runs

D0 = (dt.date(2020, 1, 1) - dt.date(1970, 1, 1)).days


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    out = []
    for entity in "ab":
        y = 100 + 20 * np.sin(np.arange(500) / 9) + rng.normal(0, 3, 500) + (50 if entity == "b" else 0)
        for i in range(10, 500):
            day = D0 + i
            temp = None if rng.random() < 0.05 else float(rng.normal(15, 8))
            out.append((entity, day, float(y[i]), float(y[i - 7]), float(y[i - 2]), float(y[i - 8 : i - 1].mean()), float(y[i - 2] / y[i - 8 : i - 1].mean()) if i % 31 else None, float(y[i - 7] / y[i - 8 : i - 1].mean()), (day + 3) % 7 + 1, temp))
    return out


SCHEMA = "entity string, day long, y double, lag7 double, lag2 double, level double, lag_recent_ratio double, lag7_ratio double, weekday int, temp double"
PLAN = backtest.Plan(dt.date(2020, 9, 1), dt.date(2021, 1, 20))
DESIGN = ridge.Design({"weekday": (1, 2, 3, 4, 5, 6, 7)}, ("temp",), ("lag_recent_ratio", "lag7_ratio"), knots=5)


@pytest.fixture(scope="module")
def matrix(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def test_plan():
    p = backtest.Plan(dt.date(2020, 2, 10), dt.date(2020, 4, 1))
    day = lambda y, m, d: (dt.date(y, m, d) - dt.date(1970, 1, 1)).days
    assert p.months() == [(day(2020, 2, 10), day(2020, 2, 29)), (day(2020, 3, 1), day(2020, 3, 31)), (day(2020, 4, 1), day(2020, 4, 1))]
    with pytest.raises(ValueError):
        backtest.Plan(dt.date(2020, 2, 2), dt.date(2020, 2, 1))
    with pytest.raises(ValueError):
        backtest.Plan(dt.date(2020, 2, 1), dt.date(2020, 2, 2), gap=0)


def test_too_little_history_raises(matrix):
    with pytest.raises(ValueError, match="training days before 2020-02-01"):
        backtest.seasonal_naive()(matrix, backtest.Plan(dt.date(2020, 2, 1), dt.date(2020, 3, 1)))


def trained(rows, first, gap=2):
    return [r for r in rows if r[1] <= first - gap]


def nearest(values, q):
    v = sorted(values)
    return v[int(np.floor(q * (len(v) - 1) + 0.5))]


def test_set_based_models_equal_loops(matrix, rows):
    made = {(r.model, r.entity, r.day): r for r in backtest.forecasts(matrix, {"n": backtest.seasonal_naive(), "c": backtest.climatology(), "p": backtest.published("lag2"), "d": backtest.debiased("lag2")}, PLAN).collect()}
    err = {(r[0], r[1]): r[4] - r[2] for r in rows}
    n = 0
    for first, last in PLAN.months():
        train = trained(rows, first)
        newest = max(r[1] for r in train)
        for r in rows:
            if not first <= r[1] <= last:
                continue
            n += 4
            mine = [x for x in train if x[0] == r[0] and x[8] == r[8]]
            a = made["n", r[0], r[1]]
            assert a.yhat == r[3]
            for name, q in backtest.QUANTILES.items():
                want = r[3] * nearest([x[2] / x[3] for x in mine if x[1] >= newest - 365], q)
                assert abs(a[name] - want) < 1e-9 * abs(want)
            assert abs(made["c", r[0], r[1]].yhat - np.mean([x[2] for x in mine])) < 1e-9
            assert made["p", r[0], r[1]].yhat == r[4] and made["p", r[0], r[1]].q10 is None
            past = [err[r[0], d] for d in range(r[1] - 29, r[1] - 1) if (r[0], d) in err]
            assert abs(made["d", r[0], r[1]].yhat - (r[4] - np.mean(past))) < 1e-9
    assert n == len(made)


def direct(train, knots=5, alpha=1.0):
    """A fit on the imputed, expanded, scaled rows of one entity; knots and medians from the first refit's rows."""
    first = [r for r in train if r[1] <= PLAN.months()[0][0] - 2]
    temps = np.array([r[9] for r in first if r[9] is not None])
    lo, hi = temps.min(), temps.max()
    middle = lambda v: float(np.sort(v)[int(np.ceil(0.5 * len(v))) - 1])
    fill = {k: middle(np.array([r[k] for r in first if r[k] is not None])) for k in (6, 7, 9)}

    def design(rs):
        hot = np.array([[float(r[8] == w) for w in range(1, 8)] for r in rs])
        t = np.array([fill[9] if r[9] is None else r[9] for r in rs])
        bumps = ridge_bumps((np.clip(t, lo, hi) - lo) / (hi - lo) * (knots - 1), knots)
        nums = np.array([[fill[k] if r[k] is None else r[k] for k in (6, 7)] for r in rs])
        return hot, bumps, nums

    hot, bumps, nums = design(train)
    mean, std = nums.mean(0), nums.std(0)
    x = np.hstack([hot, bumps, (nums - mean) / std])
    y = np.array([r[2] / r[5] for r in train])
    xm, ym = x.mean(0), y.mean()
    w = np.linalg.solve((x - xm).T @ (x - xm) + alpha * np.eye(x.shape[1]), (x - xm).T @ (y - ym))

    def predict(rs):
        hot, bumps, nums = design(rs)
        return (np.hstack([hot, bumps, (nums - mean) / std]) - xm) @ w + ym

    return predict


def ridge_bumps(t, knots):
    """Cubic B-splines by the recursion of their definition, on the knots -3, -2, ..., knots + 2."""
    k = np.arange(-3, knots + 3)
    last = t >= knots - 1
    u = np.where(last, knots - 1 - 1e-13, t)
    b = [((u >= k[i]) & (u < k[i + 1])).astype(float) for i in range(len(k) - 1)]
    for d in range(1, 4):
        b = [(u - k[i]) / d * b[i] + (k[i + d + 1] - u) / d * b[i + 1] for i in range(len(b) - 1)]
    return np.array(b[: knots + 2]).T


def test_ridge_equals_direct_solves(matrix, rows):
    made = {(r.entity, r.day): r for r in backtest.as_batch(backtest.ridge_model(DESIGN)(matrix, PLAN), "r").collect()}
    n = 0
    for first, last in PLAN.months():
        for entity in "ab":
            train = [r for r in trained(rows, first) if r[0] == entity]
            test = [r for r in rows if first <= r[1] <= last and r[0] == entity]
            predict = direct(train)
            newest = max(r[1] for r in trained(rows, first))
            recent = [r for r in train if r[1] >= newest - 365]
            ratio = [r[2] / (f * r[5]) for r, f in zip(recent, predict(recent), strict=True)]
            for r, f in zip(test, predict(test), strict=True):
                n += 1
                got = made[entity, r[1]]
                assert abs(got.yhat - f * r[5]) < 1e-6, (entity, r[1])
                for name, q in backtest.QUANTILES.items():
                    want = f * r[5] * nearest([x for x, s in zip(ratio, recent, strict=True) if s[8] == r[8]], q)
                    assert abs(got[name] - want) < 1e-5
    assert n == len(made)


def test_ridge_keeps_rows_without_a_model(spark, matrix, rows):
    late = [("z", d, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1, 1.0) for d in range(PLAN.months()[1][0], PLAN.months()[1][0] + 3)]
    out = backtest.as_batch(backtest.ridge_model(DESIGN)(matrix.unionByName(spark.createDataFrame(late, SCHEMA)), PLAN), "r")
    assert out.where("entity = 'z'").count() == 3 and out.where("entity = 'z' and yhat is null").count() == 3
    assert out.count() == len([r for r in rows if PLAN.months()[0][0] <= r[1] <= PLAN.months()[-1][1]]) + 3


def test_report_and_trees_in_a_backtest(matrix):
    plan = backtest.Plan(dt.date(2020, 12, 1), dt.date(2021, 1, 31))
    small = trees.Params(rounds=3, depth=2, rate=0.5, bins=8)
    made = backtest.forecasts(matrix, {"g": backtest.boosted(["lag_recent_ratio", "lag7_ratio", "temp"], ["entity", "weekday"], params=small), "c": backtest.climatology()}, plan)
    r = {x.refit: x for x in backtest.report(matrix, made, plan).collect()}
    assert set(r) == {0, 1} and all(x.too_new == 0 and x.null_forecasts == 0 and x.newest == x.first_test - 2 for x in r.values())
    assert r[0].train_rows == 2 * (plan.months()[0][0] - 1 - D0 - 10) and r[1].train_rows == r[0].train_rows + 62
    g = made.where("model = 'g'").collect()
    assert len(g) == 124 and all(x.q025 <= x.q10 <= x.q90 <= x.q975 for x in g)


def test_run_directories(spark, matrix, tmp_path):
    root = f"file://{tmp_path}/runs"
    f = backtest.forecasts(matrix, {"c": backtest.climatology(), "p": backtest.published("lag2")}, PLAN)
    config = {"window": ["2020-09-01", "2021-01-20"], "models": ["c", "p"], "gap": 2}
    path = runs.write_run(spark, root, config, {"forecasts": f})
    assert runs.read_config(spark, path) == config and path.endswith(runs.config_hash({"gap": 2, "models": ["c", "p"], "window": config["window"]})[:16])
    with pytest.raises(runs.RunExists):
        runs.write_run(spark, root, dict(reversed(config.items())), {"forecasts": f})
    score = lambda x, c: {"n": x.groupBy("model").agg(F.count("*").alias("n"), F.sum("yhat").alias("s"))}
    once = runs.rescore(spark, path, score, "1")["n"].orderBy("model").collect()
    assert once == runs.rescore(spark, path, score, "2")["n"].orderBy("model").collect()
    assert [(r.model, r.n, round(r.s, 6)) for r in once] == [(r.model, r.n, round(r.s, 6)) for r in score(f, {})["n"].orderBy("model").collect()]
    with pytest.raises(runs.RunExists):
        runs.rescore(spark, path, score, "1")
    other = runs.write_run(spark, root, config | {"models": ["p", "x"]}, {"forecasts": f.where("model = 'p'").unionByName(f.where("model = 'p'").withColumn("model", F.lit("x")))})
    both = runs.combine(spark, root, [path, other], ["window", "gap"], "both")
    assert {r.model: r["count"] for r in runs.read_table(spark, both, "forecasts").groupBy("model").count().collect()} == {m: f.count() // 2 for m in "cpx"}
    with pytest.raises(ValueError, match="differ in models"):
        runs.combine(spark, root, [path, other], ["models"], "no")
    file = tmp_path / "runs" / path.rsplit("/", 1)[1] / "config.json"
    held = json.loads(file.read_text())
    held["config"]["gap"] = 1
    file.write_text(json.dumps(held))
    for crc in file.parent.glob(".config.json.crc"):
        crc.unlink()
    with pytest.raises(runs.RunChanged):
        runs.read_table(spark, path, "forecasts")
    assert not list((tmp_path / "runs").glob("_*"))


def test_failed_write_leaves_no_run(spark, matrix, tmp_path):
    broken = matrix.select(F.raise_error(F.lit("stop")).alias("yhat"))
    with pytest.raises(Exception, match="stop"):
        runs.write_run(spark, f"file://{tmp_path}/r", {"a": 1}, {"forecasts": broken})
    assert runs.write_run(spark, f"file://{tmp_path}/r", {"a": 1}, {"forecasts": matrix.limit(1)})


def test_test_split_is_locked_after_one_evaluation(spark, tmp_path):
    root = f"file://{tmp_path}"
    runs.guard_test_split(spark, root, "validation")
    runs.guard_test_split(spark, root, "test")
    with pytest.raises(runs.TestSplitLocked):
        runs.guard_test_split(spark, root, "test")
    runs.guard_test_split(spark, root, "test", confirmed=True)


def test_a_true_bias_of_zero_counts_as_known(spark):
    rows = spark.createDataFrame([("a", d, 5.0, 5.0) for d in range(40)], "entity string, day long, value double, benchmark double")
    got = {r.day: r.bias for r in models.bias(rows).collect()}
    assert got[14] is None and got[15] == 0.0 and len([v for v in got.values() if v is not None]) == 27
