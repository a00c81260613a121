"""Queries of issuance, live scores, the build graph and the matrix with weather."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..functions import holidays
from ..operators import build, features, leaderboard, live
from ..sources import issuance, staging
from . import panels as p
from .catalog import _LOCAL, query, rounded
from .panels import table


def _place(s, what):
    return f"{staging.folder(s)}/{what}-{uuid.uuid4().hex}"


_ISSUED = f"""{p.H}, {p.FC}, fd AS (SELECT entity, h, model, yhat, CAST(to_timestamp((h - 1) * 3600) AS DATE) AS target_day FROM fc), mx AS (SELECT max(target_day) AS m FROM fd),
st AS (SELECT entity, h, target_day, model, yhat, CAST(target_day AS TIMESTAMP) - INTERVAL 1 DAY + (CASE model WHEN 'day' THEN INTERVAL 9 HOUR ELSE INTERVAL 11 HOUR END) AS created_at, model = 'week' AS late FROM fd, mx WHERE target_day >= m - 1)"""


@query(f"WITH {_ISSUED} SELECT entity, h, target_day::VARCHAR AS target_day, model, round(yhat, 6) AS yhat, late FROM st, mx WHERE created_at <= CAST(m AS TIMESTAMP) - INTERVAL 14 HOUR")
def store_asof(s, d):
    """The last two days of both models, issued by day and model; what had been created at 10:00 of the day before the last."""
    f = staging.written(p.forecasts(s, d).withColumn("target_day", F.to_date(F.timestamp_seconds((F.col("h") - 1) * 3600))), "forecasts")
    last, root = f.agg(F.max("target_day")).first()[0], _place(s, "store")
    clock = lambda day, hour: dt.datetime(day.year, day.month, day.day, hour) - dt.timedelta(days=1)
    rows = f.withColumns({"ts": F.timestamp_seconds(F.col("h") * 3600), "issued_at": F.col("target_day").cast("timestamp") - F.expr("interval 14 hours")})
    for day in (last - dt.timedelta(days=1), last):
        for model, hour in (("day", 9), ("week", 11)):
            if not (batch := rows.where((F.col("target_day") == F.lit(day)) & (F.col("model") == model))).isEmpty():
                issuance.issue(batch, root, clock(day, hour), "morning", "1")
    out = issuance.asof(s, root, clock(last, 10))
    return rounded(out.select("entity", F.floor(F.unix_timestamp("ts") / 3600).alias("h"), F.col("target_day").cast("string"), "model", "yhat", "late"))


_BOARD = f"""WITH {p.H}, {p.FC}, lv AS (SELECT *, h % 7 = 0 AS late FROM sc WHERE day > 19731)
SELECT entity, model, count(*) AS hours, count(DISTINCT day) AS days, round(avg(abs_err), 6) AS mae, round(sqrt(avg(err * err)), 6) AS rmse, round(avg(abs_err / nullif(abs(y), 0)) * 100, 6) AS mape,
round(avg(err / nullif(abs(y), 0)) * 100, 6) AS bias, count(*) FILTER (WHERE late) AS late_hours FROM lv GROUP BY entity, model"""


def _live(s, d):
    return leaderboard.scorable(p.scored(s, d).withColumn("late", F.col("h") % 7 == 0), 19731)


@query(_BOARD)
def leaderboard_rescan(s, d):
    """The leaderboard from all scored hours at once."""
    return rounded(leaderboard.leaderboard(leaderboard.daily_states(_live(s, d))))


@query(_BOARD)
def leaderboard_incremental(s, d):
    """The same from daily states, some of which are written twice."""
    path, states = _place(s, "states"), staging.written(leaderboard.daily_states(_live(s, d)), "daily")
    leaderboard.write_states(states.withColumn("abs_sum", F.col("abs_sum") * 2), path, list(range(19732, 19742)))
    leaderboard.write_states(states, path, list(range(19740, 19760)))
    leaderboard.write_states(states, path, list(range(19732, 19740)))
    return rounded(leaderboard.leaderboard(leaderboard.read_states(s, path)))


@query("""WITH b AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_discount > 0.08) AS bad FROM lineitem)
SELECT 'dim_customer' AS name, 'built' AS status, count(*) AS n_rows, CAST(0 AS BIGINT) AS failing FROM customer JOIN nation ON n_nationkey = c_nationkey
UNION ALL SELECT 'stg_orders', 'built', count(*), count(*) FILTER (WHERE o_totalprice > 400000) FROM orders
UNION ALL SELECT 'fct_orders', 'built', count(*), 0 FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
UNION ALL SELECT 'stg_lines', CASE WHEN bad > 0 THEN 'failed' ELSE 'built' END, n, bad FROM b
UNION ALL SELECT 'fct_lines', CASE WHEN bad > 0 THEN 'skipped' ELSE 'built' END, CASE WHEN bad = 0 THEN n END, 0 FROM b""")
def build_counts(s, d):
    """A graph of five tables: one fails its gate, and what reads it is skipped."""
    src = {n: table(s, d, n) for n in ("orders", "customer", "nation", "lineitem")}
    once = build.Check("unique", table=lambda t, _: t.groupBy("o_orderkey").count().where("count > 1"))
    tables = [
        build.Table("fct_lines", ("stg_lines",), lambda t: t["stg_lines"].select("l_orderkey", "l_extendedprice")),
        build.Table("fct_orders", ("stg_orders", "dim_customer"), lambda t: t["stg_orders"].join(t["dim_customer"], F.col("o_custkey") == F.col("c_custkey")), (once,)),
        build.Table("dim_customer", ("customer", "nation"), lambda t: t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")),
        build.Table("stg_orders", ("orders",), lambda t: t["orders"].select("o_orderkey", "o_custkey", "o_totalprice"), (build.Check("price", rows=F.col("o_totalprice") > 400000, severity="warn"),)),
        build.Table("stg_lines", ("lineitem",), lambda t: t["lineitem"], (build.Check("discount", rows=F.col("l_discount") > 0.08),)),
    ]
    done = build.build(s, _place(s, "warehouse"), tables, src)
    return s.createDataFrame([(b.name, b.status, b.rows, sum(b.failing.values())) for b in done], "name string, status string, n_rows long, failing long")


@query("""SELECT o_orderpriority, max(o_orderdate)::VARCHAR AS newest, CAST(date_diff('hour', max(o_orderdate), TIMESTAMP '2001-08-02 06:00:00') AS DOUBLE) AS age_hours,
date_diff('hour', max(o_orderdate), TIMESTAMP '2001-08-02 06:00:00') < 36 AS fresh FROM orders GROUP BY 1""")
def freshness(s, d):
    out = build.freshness(table(s, d, "orders"), ["o_orderpriority"], "o_orderdate", dt.datetime(2001, 8, 2, 6), 36)
    return out.select("o_orderpriority", F.date_format("newest", "yyyy-MM-dd HH:mm:ss").alias("newest"), F.round("age_hours", 6).alias("age_hours"), "fresh")


_WX = """wc AS (SELECT event_type AS entity, user_id % 4 AS place, CAST(floor(epoch(ts) / 3600) AS BIGINT) + 1 AS h, CASE WHEN avg(value) < 60 THEN avg(value) END AS temp FROM events GROUP BY ALL),
wp AS (SELECT event_type AS entity, user_id % 4 AS place, count(DISTINCT user_id) AS weight FROM events WHERE NOT (event_type = 'click' AND user_id % 4 = 3) GROUP BY ALL),
wx AS (SELECT wc.entity, h, sum(temp * weight) / nullif(sum(CASE WHEN temp IS NOT NULL THEN weight END), 0) AS temp, avg(temp) AS temp_unweighted, max(temp) - min(temp) AS temp_spread, count(temp) AS n_places FROM wc JOIN wp ON wp.entity = wc.entity AND wp.place = wc.place GROUP BY ALL)"""


def _weather(s, d):
    e = table(s, d, "events").select(F.col("event_type").alias("entity"), (F.col("user_id") % 4).alias("place"), "user_id", (F.floor(F.unix_timestamp("ts") / 3600) + 1).cast("long").alias("h"), "value")
    temp = F.avg("value")
    hours = e.groupBy("entity", "place", "h").agg(F.when(temp < 60, temp).alias("temp"))
    places = e.where("not (entity = 'click' and place = 3)").groupBy("entity", "place").agg(F.count_distinct("user_id").alias("weight"))
    return features.places_weather(hours, places)


@query(f"WITH {_WX} SELECT entity, h, round(temp, 6) AS temp, round(temp_unweighted, 6) AS temp_unweighted, round(temp_spread, 6) AS temp_spread, n_places FROM wx")
def places_weather(s, d):
    return rounded(_weather(s, d))


_WM = f"""{_LOCAL}, {_WX}, w AS (SELECT * FROM wx WHERE temp IS NOT NULL),
wf AS (SELECT x.entity, x.day, x.h, t.temp, t.temp_spread, t.h - 42 AS t_at, k.temp AS wk, k.h - 42 AS wk_at, r.temp AS rc, r.h - 42 AS rc_at, avg(t.temp) OVER y AS temp_mean, max(t.temp) OVER y AS temp_max, min(t.temp) OVER y AS temp_min, max(t.h - 42) OVER y AS day_at
  FROM x LEFT JOIN w t ON t.entity = x.entity AND t.h = x.h LEFT JOIN w k ON k.entity = x.entity AND k.h = x.h - 168 LEFT JOIN w r ON r.entity = x.entity AND r.h = x.h - 48 WINDOW y AS (PARTITION BY x.entity, x.day)),
wq AS (SELECT wf.entity, wf.h, avg(q.temp) AS prev, max(q.h - 42) AS prev_at FROM wf JOIN w q ON q.entity = wf.entity AND q.h BETWEEN wf.h - 3 AND wf.h - 1 GROUP BY ALL),
wa AS (SELECT wf.*, prev, prev_at, CASE WHEN temp IS NOT NULL AND wk IS NOT NULL THEN greatest(t_at, wk_at) END AS d7_at, CASE WHEN temp IS NOT NULL AND rc IS NOT NULL THEN greatest(t_at, rc_at) END AS dr_at FROM wf LEFT JOIN wq ON wq.entity = wf.entity AND wq.h = wf.h)"""


def _whole_matrix(s, d):
    panel = staging.written(p.hourly(s, d), "panel")
    return features.build_all(panel.select("entity", "h", "value"), *p.clocks_and_days(panel), staging.written(_weather(s, d), "weather"))


@query(f"""WITH {_WM} SELECT entity, day::VARCHAR AS day, h, round(temp, 6) AS temp, round(temp_spread, 6) AS temp_spread, round(CASE WHEN temp IS NOT NULL THEN greatest(temp - 18, 0) END, 6) AS cdd, round(CASE WHEN temp IS NOT NULL THEN greatest(18 - temp, 0) END, 6) AS hdd,
round(temp_mean, 6) AS temp_mean, temp_max, temp_min, round(temp - wk, 6) AS temp_delta_7d, round(prev, 6) AS temp_prev3h, round(rc, 6) AS temp_recent, round(temp - rc, 6) AS temp_delta_recent,
t_at AS avail_temp, CASE WHEN temp_spread IS NOT NULL THEN t_at END AS avail_spread, day_at AS avail_mean, d7_at AS avail_delta_7d, prev_at AS avail_prev3h, rc_at AS avail_recent, dr_at AS avail_delta_recent,
{holidays.sql("day")} IS NOT NULL AS is_holiday, {holidays.sql("CAST(day - 1 AS DATE)")} IS NOT NULL AS is_day_after_holiday, count(*) OVER (PARTITION BY entity, day) AS hours_in_day
FROM (SELECT entity, day, h, temp, temp_spread, round(temp_max, 6) AS temp_max, round(temp_min, 6) AS temp_min, temp_mean, wk, prev, rc, t_at, day_at, d7_at, prev_at, rc_at, dr_at FROM wa)""")
def feature_matrix_weather(s, d):
    """All weather and holiday columns of the matrix, with when each became available."""
    m = _whole_matrix(s, d)
    at = {"avail_temp": "temp", "avail_spread": "temp_spread", "avail_mean": "temp_mean", "avail_delta_7d": "temp_delta_7d", "avail_prev3h": "temp_prev3h", "avail_recent": "temp_recent", "avail_delta_recent": "temp_delta_recent"}
    return rounded(m.select("entity", F.col("day").cast("string"), "h", *features.WEATHER, *[F.col(f"avail__{c}").alias(a) for a, c in at.items()], "is_holiday", "is_day_after_holiday", "hours_in_day"))


@query(f"""WITH {_WM}, k AS (SELECT CAST(count(t_at) * 3 + count(CASE WHEN temp_spread IS NOT NULL THEN t_at END) + 3 * count(day_at) + count(d7_at) + count(prev_at) + count(rc_at) + count(dr_at) AS BIGINT) AS cells,
  CAST(count(*) FILTER (WHERE h > issued) AS BIGINT) AS late FROM (SELECT wa.*, o.issued FROM wa JOIN o ON o.entity = wa.entity AND o.day = wa.day))
SELECT cells AS weather_cells, CAST(0 AS BIGINT) AS violations, late AS violations_if_observed, CASE WHEN late > 0 THEN 'temp' ELSE '' END AS features_if_observed FROM k""")
def leakage_report_weather(s, d):
    """Cells of weather features that were checked, and what the check says if the temperature were the observed one."""
    m = staging.written(_whole_matrix(s, d), "matrix")
    only = m.select("entity", "day", "h", "issued", *[c for c in m.columns if c.startswith("avail__") and c.removeprefix("avail__") in features.WEATHER])
    a = features.check_point_in_time(only).select(F.col("cells").alias("weather_cells"), "violations")
    b = features.check_point_in_time(m.select("entity", "day", "h", "issued", F.col("h").alias("avail__temp"))).select(F.col("violations").alias("violations_if_observed"), F.col("features").alias("features_if_observed"))
    return a.join(F.broadcast(b))  # one row each


@query(f"""WITH {_LOCAL}, mx AS (SELECT max(day) AS m FROM x), r AS (SELECT x.entity, x.h, b.v AS yhat FROM x JOIN mx ON x.day = m LEFT JOIN sh b ON b.entity = x.entity AND b.day = x.day - 7 AND b.local_hour = x.local_hour)
SELECT m::VARCHAR AS target_day, 'naive' AS model, count(*) AS n_rows, count(DISTINCT entity) AS entities, CAST(0 AS BIGINT) AS late_rows, count(*) FILTER (WHERE yhat IS NULL) AS null_forecasts, 'again: 0' AS rerun FROM r, mx GROUP BY m""")
def issue_last_day(s, d):
    """The naive forecast of the last day, issued twice: the second time adds nothing."""
    m = staging.written(_whole_matrix(s, d), "matrix")
    day, root = m.agg(F.max("day")).first()[0], _place(s, "store")
    now = dt.datetime(day.year, day.month, day.day) - dt.timedelta(days=2)
    one, two = (live.issue_day(m, lambda r: r.select("entity", "h", F.col("lag7").alias("yhat")), root, day, "naive", now, "morning", "1", skip_existing=True) for _ in range(2))
    return s.createDataFrame([(one.target_day, one.model, one.rows, one.entities, one.late_rows, one.null_forecasts, f"again: {two.rows}")], "target_day string, model string, n_rows long, entities long, late_rows long, null_forecasts long, rerun string")
