"""Queries of sequences, calibrated bands, drift and slices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import holidays
from ..operators import conformal, drift, evaluate, features, sequences
from ..sources import staging
from . import panels as p
from .catalog import _LOCAL, query, rounded

_GRID = """gb AS (SELECT entity, min(h) AS a, max(h) AS z FROM h GROUP BY 1), gr AS (SELECT entity, unnest(generate_series(a, z)) AS h FROM gb),
fg AS (SELECT gr.entity, gr.h, last_value(h.value IGNORE NULLS) OVER x AS value, last_value(h.temp IGNORE NULLS) OVER x AS temp FROM gr LEFT JOIN h ON h.entity = gr.entity AND h.h = gr.h WINDOW x AS (PARTITION BY gr.entity ORDER BY gr.h))"""
_HIST = f"""{_LOCAL}, {_GRID}, hs AS (SELECT o.entity, o.day, cutoff, max(fg.h) AS last, count(*) AS n, arg_min(value, fg.h) AS first_value, arg_max(value, fg.h) AS last_value, sum(value) AS total
  FROM o JOIN fg ON fg.entity = o.entity AND fg.h BETWEEN cutoff - 167 AND cutoff GROUP BY ALL)"""


def _histories(s, d):
    grid = sequences.filled(sequences.regular(p.hourly(s, d)), ["value", "temp"], ["temp"])
    origins = features.origins(p.days_of(s, d), p.zones(s, d), features.Protocol())
    return sequences.histories(grid, origins, "value")


@query(f"WITH {_HIST} SELECT entity, day::VARCHAR AS day, cutoff, last, CAST(n AS INT) AS n, round(first_value, 6) AS first_value, round(last_value, 6) AS last_value, round(total, 4) AS total FROM hs")
def origin_sequences(s, d):
    x = _histories(s, d)
    total = F.round(F.aggregate("values", F.lit(0.0), lambda a, b: a + b), 4).alias("total")
    return rounded(x.select("entity", F.col("day").cast("string"), "cutoff", "last", "n", F.get("values", F.lit(0)).alias("first_value"), F.element_at("values", -1).alias("last_value"), total))


@query(f"""WITH {_HIST}, hz AS (SELECT entity, day, step, last + step AS at FROM hs, (SELECT unnest(range(1, 45)) AS step))
SELECT hz.entity, hz.day::VARCHAR AS day, CAST(step AS INT) AS step, hz.at AS h, round(last_value(h.temp IGNORE NULLS) OVER (PARTITION BY hz.entity, hz.day ORDER BY step), 6) AS temp FROM hz LEFT JOIN h ON h.entity = hz.entity AND h.h = hz.at""")
def horizon_grid(s, d):
    return rounded(sequences.horizon(_histories(s, d), p.hourly(s, d), ["temp"]).select("entity", F.col("day").cast("string"), "step", "h", "temp"))


@query(f"""WITH {p.H}, v AS (SELECT entity, h, CASE WHEN n % 3 <> 0 THEN value END AS value, CASE WHEN n % 2 = 0 THEN temp END AS temp FROM h), b AS (SELECT entity, min(h) AS a, max(h) AS z FROM h GROUP BY 1), g AS (SELECT entity, unnest(generate_series(a, z)) AS h FROM b),
f AS (SELECT g.entity, g.h, last_value(v.value IGNORE NULLS) OVER x AS value, last_value(v.temp IGNORE NULLS) OVER x AS temp FROM g LEFT JOIN v ON v.entity = g.entity AND v.h = g.h WINDOW x AS (PARTITION BY g.entity ORDER BY g.h))
SELECT entity, h, round(value, 6) AS value, round(coalesce(temp, first_value(temp IGNORE NULLS) OVER (PARTITION BY entity ORDER BY h ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS temp FROM f""")
def fill_both_ways(s, d):
    v = p.hourly(s, d).select("entity", "h", F.when(F.col("n") % 3 != 0, F.col("value")).alias("value"), F.when(F.col("n") % 2 == 0, F.col("temp")).alias("temp"))
    return rounded(sequences.filled(sequences.regular(v), ["value", "temp"], ["temp"], block=100))


@query(f"""WITH {p.H}, {p.FC}, a AS (SELECT entity, min(h) AS a FROM h GROUP BY 1), t AS (SELECT max(value) AS top FROM h JOIN a ON a.entity = h.entity WHERE h.h < a + 150)
SELECT model, count(*) AS n, count(*) FILTER (WHERE yhat > 1.1 * top) AS abstained, count(CASE WHEN NOT yhat > 1.1 * top THEN lo80 END) AS bands FROM sc, t GROUP BY model""")
def abstention_counts(s, d):
    h = p.hourly(s, d)
    train = h.join(h.groupBy("entity").agg(F.min("h").alias("a")), "entity").where("h < a + 150")
    out = sequences.abstained(p.scored(s, d), train, ["yhat", "lo80", "hi80", "lo95", "hi95"], times=1.1)
    return out.groupBy("model").agg(F.count("*").alias("n"), F.count_if("abstained").alias("abstained"), F.count("lo80").alias("bands"))


_CQR = f"""{p.H}, {p.FC}, fb AS (SELECT entity, h, model, (h - 1) // 24 AS day, yhat * 0.8 AS q10, yhat * 1.2 AS q90, yhat * 0.6 AS q025, yhat * 1.4 AS q975 FROM fc),
dl AS (SELECT fb.entity, model, day, list(greatest(q10 - h.value, h.value - q90)) AS s80, list(greatest(q025 - h.value, h.value - q975)) AS s95 FROM fb JOIN h ON h.entity = fb.entity AND h.h = fb.h WHERE h.value IS NOT NULL GROUP BY ALL),
tg AS (SELECT DISTINCT entity, model, day FROM fb),
wn AS (SELECT tg.entity, tg.model, tg.day, count(dl.day) AS days, list_sort(flatten(list(s80))) AS v80, list_sort(flatten(list(s95))) AS v95 FROM tg LEFT JOIN dl ON dl.entity = tg.entity AND dl.model = tg.model AND dl.day BETWEEN tg.day - 11 AND tg.day - 2 GROUP BY ALL),
mv AS (SELECT entity, model, day, days, CASE WHEN days >= 5 THEN v80[least(len(v80), CAST(ceil((len(v80) + 1) * (1 - 0.2)) AS BIGINT))] END AS c80, CASE WHEN days >= 5 THEN v95[least(len(v95), CAST(ceil((len(v95) + 1) * (1 - 0.05)) AS BIGINT))] END AS c95 FROM wn)"""


def _calibrated(s, d):
    f = p.forecasts(s, d).withColumns({"day": F.floor((F.col("h") - 1) / 24).cast("long"), **{c: F.col("yhat") * x for c, x in (("q10", 0.8), ("q90", 1.2), ("q025", 0.6), ("q975", 1.4))}})
    return conformal.conformalize(f, p.hourly(s, d).select("entity", "h", F.col("value").alias("y")), window=10, least=5, chunk=7)


@query(f"""WITH {_CQR}, x AS (SELECT fb.entity, h, fb.model, q10 - coalesce(c80, 0) AS q10, q90 + coalesce(c80, 0) AS q90, q025 - coalesce(c95, 0) AS q025, q975 + coalesce(c95, 0) AS q975, days FROM fb JOIN mv ON mv.entity = fb.entity AND mv.model = fb.model AND mv.day = fb.day)
SELECT entity, h, model || '+cqr' AS model, round(q10, 6) AS q10, round(q90, 6) AS q90, round(least(q025, q10), 6) AS q025, round(greatest(q975, q90), 6) AS q975, days >= 5 AS calibrated FROM x""")
def cqr_bands(s, d):
    return rounded(_calibrated(s, d).select("entity", "h", "model", "q10", "q90", "q025", "q975", "calibrated"))


@query(f"WITH {_CQR} SELECT model || '+cqr' AS model, count(*) FILTER (WHERE days >= 5) AS days_calibrated, count(*) FILTER (WHERE days < 5) AS days_uncalibrated FROM mv GROUP BY 1")
def cqr_days(s, d):
    return conformal.calibration(_calibrated(s, d))


_MONITORED = ["lag_recent_ratio", "lag7_ratio", "level", "temp", "mostly_null"]
#: Whether a column has values in more than half of either window's rows, and rows without nulls in such columns.
_KEPT = ", ".join(f"2 * count({c}) FILTER (WHERE now) > count(*) FILTER (WHERE now) AND 2 * count({c}) FILTER (WHERE NOT now) > count(*) FILTER (WHERE NOT now) AS k_{c}" for c in _MONITORED)
_WHOLE = " AND ".join(f"(NOT k_{c} OR {c} IS NOT NULL)" for c in _MONITORED)
_LONG = " UNION ALL ".join(f"SELECT now, '{c}' AS feature, {c} AS value FROM ok WHERE k_{c}" for c in _MONITORED)


@query(f"""WITH {p.DM}, mx AS (SELECT max(day) AS m FROM dm), wn AS (SELECT day > m - 60 AS now, lag_recent_ratio, lag7_ratio, level, temp, CASE WHEN weekday = 1 THEN y END AS mostly_null FROM dm, mx WHERE day > m - 60 OR day BETWEEN m - 423 AND m - 364),
kp AS (SELECT {_KEPT} FROM wn), ok AS (SELECT * FROM wn, kp WHERE {_WHOLE}), me AS ({_LONG}),
ct AS (SELECT feature, value, count(*) FILTER (WHERE now) AS a, count(*) FILTER (WHERE NOT now) AS b FROM me GROUP BY ALL),
tt AS (SELECT feature, CAST(sum(a) AS BIGINT) AS n_now, CAST(sum(b) AS BIGINT) AS n_ref FROM ct GROUP BY 1), sd AS (SELECT feature, stddev_pop(value) AS std FROM me WHERE NOT now GROUP BY 1),
rn AS (SELECT ct.feature, n_now, n_ref, abs(sum(a) OVER x / n_now - sum(b) OVER x / n_ref) AS gap, coalesce(lead(value) OVER x - value, 0) AS step FROM ct JOIN tt ON tt.feature = ct.feature WINDOW x AS (PARTITION BY ct.feature ORDER BY value)),
ks AS (SELECT feature, n_now, n_ref, max(gap) AS ks, sum(gap * step) AS moved FROM rn GROUP BY ALL),
pv AS (SELECT ks.*, moved / std AS w, ks * sqrt(n_now * n_ref / (n_now + n_ref)) AS x FROM ks JOIN sd ON sd.feature = ks.feature),
pp AS (SELECT *, CASE WHEN x < 0.2 THEN 1.0 ELSE least(greatest(list_sum(list_transform(range(1, 101), lambda j: (CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * j * j * x * x))), 0.0), 1.0) END AS p FROM pv)
SELECT feature, n_now, n_ref, round(ks, 6) AS ks, round(CAST(p AS DOUBLE), 6) AS p, round(w, 6) AS wasserstein, CASE WHEN greatest(n_now, n_ref) <= 1000 THEN p < 0.05 ELSE w >= 0.1 END AS drifted FROM pp""")
def drift_ks(s, d):
    """The last 60 days against the same dates 364 days earlier; the half-null column is left out."""
    m = staging.written(p.daily_matrix(s, d).withColumn("mostly_null", F.when(F.col("weekday") == 1, F.col("y"))), "matrix")
    rows = drift.seasonal_windows(m, m.agg(F.max("day")).first()[0], days=60)
    return rounded(drift.two_sample(rows, drift.filled_columns(rows, _MONITORED)))


_DAY = holidays.sql("day")


@query(f"""WITH {_LOCAL}, {p.FC}, tm AS (SELECT entity, day, avg(temp) AS temp_mean FROM l GROUP BY ALL),
k AS (SELECT sc.model, sc.entity, abs_err, y, l.day, local_hour, temp_mean FROM sc LEFT JOIN l ON l.entity = sc.entity AND l.h = sc.h LEFT JOIN tm ON tm.entity = l.entity AND tm.day = l.day),
q AS (SELECT entity, model, list_sort(list(temp_mean)) AS v, count(temp_mean) AS n FROM k WHERE temp_mean IS NOT NULL GROUP BY ALL),
t AS (SELECT k.model, abs_err, y, CASE WHEN month(day) IN (12, 1, 2) THEN 'winter' WHEN month(day) <= 5 THEN 'spring' WHEN month(day) <= 8 THEN 'summer' ELSE 'autumn' END AS season,
  lpad(CAST(local_hour // 6 * 6 AS VARCHAR), 2, '0') AS hour_block, CASE WHEN {_DAY} IS NOT NULL THEN 'holiday' WHEN isodow(day) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_type,
  CASE WHEN temp_mean IS NULL THEN 'no weather' WHEN temp_mean >= v[CAST(round(0.95 * (n - 1)) AS INT) + 1] THEN 'hot 5%' WHEN temp_mean <= v[CAST(round(0.05 * (n - 1)) AS INT) + 1] THEN 'cold 5%' ELSE 'normal' END AS temperature
  FROM k LEFT JOIN q ON q.entity = k.entity AND q.model = k.model)
""" + " UNION ALL ".join(f"SELECT '{c}' AS slice, {c} AS value, model, count(*) AS hours, round(avg(abs_err / y) * 100, 6) AS mape FROM t GROUP BY ALL" for c in ("season", "hour_block", "day_type", "temperature")))
def slice_metrics_all(s, d):
    local = p.local(s, d)
    mean = local.groupBy("entity", "day").agg(F.avg("temp").alias("temp_mean"))
    keys = local.select("entity", "h", "day", "local_hour").join(mean, ["entity", "day"])
    return rounded(evaluate.all_slices(p.scored(s, d), keys))


@query(f"WITH {p.H}, {p.FC} SELECT entity, model, day, round(sum(abs_err), 6) AS loss, round(sum(abs_err / nullif(abs(y), 0)), 6) AS ape, count(*) AS n FROM sc GROUP BY ALL")
def daily_losses_all(s, d):
    """Daily sums of errors of all models."""
    return rounded(evaluate.daily_losses(p.scored(s, d)))
