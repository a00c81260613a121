"""Queries of backtests and models: refits as groups, run directories, ridge and boosted trees."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..operators import ablation, backtest, evaluate, ridge, trees
from ..sources import runs, staging
from . import panels as p
from .catalog import query, rounded

PLAN = backtest.Plan(dt.date(1999, 6, 1), dt.date(2000, 5, 31))
DESIGN = ridge.Design({"weekday": tuple(range(1, 8))}, ("temp",), ("doy_sin", "doy_cos", "lag_recent_ratio", "lag7_ratio"))
SET_BASED = {"naive": backtest.seasonal_naive(), "climatology": backtest.climatology(), "benchmark": backtest.published("lag2"), "debiased": backtest.debiased("lag2")}

_Q = {"q025": 0.025, "q10": 0.1, "q90": 0.9, "q975": 0.975}
_BT = f"""{p.DM}, rf AS (SELECT row_number() OVER (ORDER BY m) - 1 AS refit, CAST(date_diff('day', DATE '1970-01-01', CAST(m AS DATE)) AS BIGINT) AS first, CAST(date_diff('day', DATE '1970-01-01', CAST(m + INTERVAL 1 MONTH AS DATE)) AS BIGINT) - 1 AS last
  FROM (SELECT unnest(generate_series(DATE '1999-06-01', DATE '2000-05-01', INTERVAL 1 MONTH)) AS m)),
ts AS (SELECT dm.*, refit FROM dm JOIN rf ON day BETWEEN first AND last),
nw AS (SELECT refit, max(day) AS newest FROM dm JOIN rf ON day <= first - 2 GROUP BY 1),
bn AS (SELECT entity, refit, weekday, list_sort(list(y / lag7)) AS v, count(*) AS n FROM dm JOIN rf ON day <= first - 2 JOIN nw USING (refit) WHERE day >= newest - 365 AND lag7 <> 0 GROUP BY ALL),
bq AS (SELECT entity, refit, weekday, {', '.join(f"v[CAST(round({q} * (n - 1)) AS INT) + 1] AS {c}" for c, q in _Q.items())} FROM bn),
cl AS (SELECT entity, weekday, refit, avg(y) AS yhat FROM dm JOIN rf ON day <= first - 2 GROUP BY ALL),
be AS (SELECT entity, day, avg(lag2 - y) OVER x AS m, count(*) OVER x AS n FROM dm WHERE lag2 IS NOT NULL WINDOW x AS (PARTITION BY entity ORDER BY day RANGE BETWEEN 27 PRECEDING AND CURRENT ROW)),
bt AS (SELECT ts.entity, day, ts.refit, 'naive' AS model, lag7 AS yhat, {', '.join(f"lag7 * {c} AS {c}" for c in _Q)} FROM ts LEFT JOIN bq ON bq.entity = ts.entity AND bq.refit = ts.refit AND bq.weekday = ts.weekday
UNION ALL SELECT ts.entity, day, ts.refit, 'climatology', cl.yhat, NULL, NULL, NULL, NULL FROM ts LEFT JOIN cl ON cl.entity = ts.entity AND cl.weekday = ts.weekday AND cl.refit = ts.refit
UNION ALL SELECT entity, day, refit, 'benchmark', lag2, NULL, NULL, NULL, NULL FROM ts
UNION ALL SELECT ts.entity, ts.day, refit, 'debiased', lag2 - coalesce(CASE WHEN n >= 14 THEN m END, 0), NULL, NULL, NULL, NULL FROM ts LEFT JOIN be ON be.entity = ts.entity AND be.day = ts.day - 2)"""


#: Means of cents often end in a 5 at the last digit kept; this shift, in both forms, keeps them from being ties.
_OFF = 0.0000001


def _matrix(s, d):
    return staging.written(p.daily_matrix(s, d), "matrix")


@query(f"WITH {_BT} SELECT entity, day, CAST(refit AS BIGINT) AS refit, model, {', '.join(f'round({c} + {_OFF}, 4) AS {c}' for c in ('yhat', *_Q))} FROM bt")
def backtest_forecasts(s, d):
    out = backtest.forecasts(_matrix(s, d), SET_BASED, PLAN)
    return rounded(out.withColumns({c: F.col(c) + _OFF for c in ("yhat", *_Q)}), 4)


_SCORED = f"""{_BT}, ok AS (SELECT bt.entity, bt.day, model, yhat, y, count(*) OVER (PARTITION BY bt.entity, bt.day) AS nm FROM bt JOIN dm ON dm.entity = bt.entity AND dm.day = bt.day WHERE yhat IS NOT NULL),
sm AS (SELECT *, yhat - y AS err, abs(yhat - y) AS abs_err FROM ok WHERE nm = 4)"""
_METRICS = "SELECT entity, model, count(*) AS hours, round(avg(abs_err), 4) AS mae, round(sqrt(avg(err * err)), 4) AS rmse, round(avg(abs_err / nullif(abs(y), 0)) * 100, 4) AS mape, round(avg(err / nullif(y, 0)) * 100, 4) AS bias FROM sm GROUP BY entity, model"


def _metrics(forecasts, matrix):
    scored = evaluate.common_support(forecasts, matrix.select("entity", "day", "y"), ["entity", "day"])
    return evaluate.point_metrics(scored, ["entity", "model"])


@query(f"WITH {_SCORED} {_METRICS}")
def backtest_metrics(s, d):
    m = _matrix(s, d)
    return rounded(_metrics(backtest.forecasts(m, SET_BASED, PLAN), m), 4)


@query(f"WITH {_SCORED} {_METRICS}")
def backtest_run_rescored(s, d):
    """The same scores by way of a run directory: forecasts are written once and rescored from there."""
    m = _matrix(s, d)
    config = {"window": [PLAN.start, PLAN.end], "models": list(SET_BASED), "gap": PLAN.gap, "input": d}
    path = runs.write_run(s, f"{staging.folder(s)}/runs-{uuid.uuid4().hex}", config, {"forecasts": backtest.forecasts(m, SET_BASED, PLAN)})
    return rounded(runs.rescore(s, path, lambda f, c: {"metrics": _metrics(f, m)}, "all")["metrics"], 4)


@query(f"""WITH {_BT}, e AS (SELECT entity, refit, count(*) AS n, max(day) AS newest FROM dm JOIN rf ON day <= first - 2 GROUP BY ALL), f AS (SELECT entity, refit, min(day) AS first_test FROM ts GROUP BY ALL),
g AS (SELECT refit, CAST(sum(n) AS BIGINT) AS train_rows, max(newest) AS newest, min(first_test) AS first_test, count(*) FILTER (WHERE newest > first_test - 2) AS too_new FROM e JOIN f USING (entity, refit) GROUP BY 1)
SELECT CAST(g.refit AS BIGINT) AS refit, train_rows, (SELECT count(DISTINCT day) FROM dm WHERE day <= first - 2) AS train_days, newest, first_test, too_new, forecasts, null_forecasts
FROM g JOIN rf ON rf.refit = g.refit JOIN (SELECT refit, count(*) AS forecasts, count(*) FILTER (WHERE yhat IS NULL) AS null_forecasts FROM bt GROUP BY 1) b ON b.refit = g.refit""")
def backtest_report(s, d):
    m = _matrix(s, d)
    return backtest.report(m, backtest.forecasts(m, SET_BASED, PLAN), PLAN)


@query()
def ridge_forecasts(s, d):
    """Ridge refitted each month by prefix sums, with bands; no SQL (a linear solve). Held to direct solves in the tests."""
    return rounded(backtest.as_batch(backtest.ridge_model(DESIGN)(_matrix(s, d), PLAN), "ridge"), 4)


_FEATURES = ["lag_recent_ratio", "lag7_ratio", "partial_mean_ratio", "last_known_ratio", "local_hour", "weekday", "is_weekend", "doy_sin", "doy_cos"]
TREES = trees.Params(rounds=12, depth=3, rate=0.2, least=20)


def _forest(s, d):
    from .catalog import _matrix as hourly_matrix

    m = staging.written(hourly_matrix(s, d).withColumn("target", F.try_divide(F.col("y"), F.col("level_7d"))), "hourly")
    edge = m.agg(F.date_sub(F.max("day"), 6)).first()[0]
    train = m.where(F.col("day") <= F.date_sub(F.lit(edge), 2))
    return m, edge, trees.fit(train, "target", _FEATURES, ["entity"], TREES)





@query()
def gbt_quantile_forecast(s, d):
    """Boosted trees with quantile heads for the last week of the hourly panel; no SQL. Splits, leaves and order are tested."""
    m, edge, forest = _forest(s, d)
    out = trees.predict(forest, m.where(F.col("day") >= F.lit(edge)), "level_7d")
    return rounded(out.select("entity", F.col("day").cast("string"), "h", "y", *forest.heads), 4)


@query()
def gbt_importance(s, d):
    """Share of each feature in the gain of the point head."""
    _, _, forest = _forest(s, d)
    return rounded(s.createDataFrame(sorted(forest.importance().items()), "feature string, share double"))


def _pairs(s, d):
    """Daily losses of each model of the backtest beside those of the two benchmarks, one after the other, also pooled."""
    m = _matrix(s, d)
    scored = staging.written(evaluate.common_support(backtest.forecasts(m, SET_BASED, PLAN), m.select("entity", "day", "y"), ["entity", "day"]), "scored")
    losses = evaluate.daily_losses(scored)
    return {ref: evaluate.with_pooled(evaluate.paired(losses.where(~F.col("model").isin([r for r in ("naive", "benchmark") if r != ref])), ref)) for ref in ("naive", "benchmark")}


@query()
def bootstrap_skill_ci(s, d):
    """Skill, its interval and the Diebold-Mariano test of each model against each benchmark, 30 days at least, by entity and pooled."""
    out = None
    for ref, pairs in _pairs(s, d).items():
        one = evaluate.compare(pairs, ref).withColumn("reference", F.lit(ref))
        out = one if out is None else out.unionByName(one)
    return out


@query()
def significance_tally(s, d):
    return evaluate.significance(bootstrap_skill_ci(s, d).where("entity <> 'ALL'"))


@query(f"""{"WITH " + _SCORED}, ls AS (SELECT entity, model, day, sum(abs_err) AS loss, count(*) AS n FROM sm GROUP BY ALL),
pr AS (SELECT r.model AS reference, a.entity, a.model, a.day, a.loss, r.loss AS ref_loss FROM ls a JOIN ls r ON r.entity = a.entity AND r.day = a.day AND r.n = a.n AND r.model IN ('naive', 'benchmark') WHERE a.model NOT IN ('naive', 'benchmark')),
al AS (SELECT * FROM pr UNION ALL SELECT reference, 'ALL', model, day, sum(loss), sum(ref_loss) FROM pr GROUP BY ALL)
SELECT reference, entity, model, count(*) AS days, round(1 - sum(loss) / sum(ref_loss), 6) AS skill FROM al GROUP BY ALL HAVING count(*) >= 30""")
def comparison_skill(s, d):
    """The estimates of ``bootstrap_skill_ci`` alone, which SQL can say."""
    out = None
    for ref, pairs in _pairs(s, d).items():
        g = pairs.groupBy("entity", "model").agg(F.count("*").alias("days"), (1 - F.sum("loss") / F.sum("ref_loss")).alias("skill")).where("days >= 30")
        one = g.select(F.lit(ref).alias("reference"), "entity", "model", "days", "skill")
        out = one if out is None else out.unionByName(one)
    return rounded(out)


@query()
def ablation_comparisons(s, d):
    """The ridge without its spline, without its ratios, and both of them against the whole; no SQL (a linear solve)."""
    kept = lambda **k: backtest.ridge_model(ridge.Design(**{"onehot": DESIGN.onehot, "splines": DESIGN.splines, "numbers": DESIGN.numbers} | k))
    season = ("doy_sin", "doy_cos")
    variants = {"whole": kept(), "no_weather": kept(splines=()), "no_lags": kept(numbers=season), "season_only": kept(splines=(), numbers=season)}
    return rounded(ablation.ablate(_matrix(s, d), variants, PLAN)[1])


@query(f"""{"WITH " + _BT}, ok AS (SELECT b.model, b.entity, b.day, abs(b.yhat - dm.y) AS e, b.yhat - dm.y AS d, y FROM bt b JOIN dm ON dm.entity = b.entity AND dm.day = b.day WHERE b.yhat IS NOT NULL AND model IN ('climatology', 'debiased'))
SELECT model, count(*) AS hours, round(avg(e), 4) AS mae, round(sqrt(avg(d * d)), 4) AS rmse, round(avg(e / y) * 100, 4) AS mape, round(avg(d / y) * 100, 4) AS bias FROM ok GROUP BY 1""")
def ablation_overall(s, d):
    """Metrics of two variants of one model, each over its own rows."""
    return rounded(ablation.ablate(_matrix(s, d), {k: SET_BASED[k] for k in ("climatology", "debiased")}, PLAN)[0], 4)
