"""All named queries of the library, each with the DuckDB SQL that checks it where SQL can say it.

Doubles are rounded in both forms, since sums depend on their order: values of a few thousands to 6 digits, larger ones to 4.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import holidays
from ..operators import clean, evaluate, features, models, quality
from ..sources import staging
from . import panels as p
from .panels import CLEAN, D, DAYS, FC, H, Z, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
FLAGSHIP = "feature_matrix"


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def load() -> None:
    """Import the modules that register the other queries."""
    from . import backtests, live, monitoring, reading  # noqa: F401


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- panels, cleaning -------------------------------------------------------------------------------------------------


@query(f"WITH {H} SELECT entity, h, round(value, 6) AS value, n, round(temp, 6) AS temp FROM h")
def panel_hourly_events(s, d):
    return rounded(p.hourly(s, d))


@query("""SELECT o_custkey, o_orderstatus, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1""")
def dedup_latest_file(s, d):
    o = table(s, d, "orders").select("o_custkey", "o_orderstatus", "o_orderkey")
    return clean.keep_latest(o, ["o_custkey"], [F.col("o_orderstatus").desc(), F.col("o_orderkey").desc()])


@query(f"WITH {CLEAN} SELECT entity, h, round(median, 6) AS median, is_missing, is_nonpositive, is_outlier, bad_benchmark FROM fl")
def clean_range_median_flags(s, d):
    f = clean.flag(p.flagged_panel(s, d))
    return rounded(f.select("entity", "h", "median", "is_missing", "is_nonpositive", "is_outlier", "bad_benchmark"))


@query(f"""WITH {CLEAN} SELECT entity, h, round(CASE WHEN ok THEN value END, 6) AS clean,
round(CASE WHEN ok THEN value WHEN fallback >= 0.2 * median AND fallback <= 5 * median THEN fallback END, 6) AS filled,
round(CASE WHEN NOT bad_benchmark THEN benchmark END, 6) AS benchmark_ok
FROM (SELECT *, NOT (is_missing OR is_nonpositive OR is_outlier) AS ok FROM fl)""")
def clean_repair(s, d):
    return rounded(clean.repair(clean.flag(p.flagged_panel(s, d))).select("entity", "h", "clean", "filled", "benchmark_ok"))


@query(f"""WITH {CLEAN}, g AS (SELECT entity, 2 * count(*) AS n_staged, count(*) AS n_kept, count(*) FILTER (WHERE is_missing) AS r1_missing,
count(*) FILTER (WHERE is_nonpositive) AS r2_nonpositive, count(*) FILTER (WHERE is_outlier) AS r3_outlier, count(*) FILTER (WHERE bad_benchmark) AS r4_benchmark FROM fl GROUP BY entity)
SELECT *, n_staged - n_kept AS r0_duplicates FROM g""")
def dq_cleaning_log(s, d):
    rows = p.flagged_panel(s, d)
    staged = rows.withColumn("file", F.explode(F.array(F.lit("a"), F.lit("b"))))
    kept = clean.keep_latest(staged, ["entity", "h"], [F.col("file").desc()]).drop("file")
    return clean.cleaning_log(staged, clean.flag(kept))


@query("""SELECT CAST(date_trunc('month', l_shipdate) AS DATE)::VARCHAR AS month, l_returnflag, count(*) AS n,
round(sum(l_extendedprice * l_quantity) / nullif(sum(l_quantity), 0), 4) AS weighted, round(avg(l_extendedprice), 4) AS plain, round(max(l_extendedprice) - min(l_extendedprice), 4) AS spread
FROM lineitem GROUP BY 1, 2""")
def weighted_mean_spread(s, d):
    t = table(s, d, "lineitem")
    price = F.col("l_extendedprice")
    g = t.groupBy(F.date_format(F.date_trunc("month", "l_shipdate"), "yyyy-MM-dd").alias("month"), "l_returnflag")
    return rounded(g.agg(F.count("*").alias("n"), clean.weighted_mean(price, F.col("l_quantity")).alias("weighted"), F.avg(price).alias("plain"), (F.max(price) - F.min(price)).alias("spread")), 4)


@query("SELECT l_orderkey, l_linenumber, greatest(least(l_quantity - 10, 25), 0) AS q FROM lineitem")
def clamp_values(s, d):
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", clean.clamp(F.col("l_quantity") - 10, 0.0, 25.0).alias("q"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN x IS NOT NULL THEN greatest(least(x, 25), 0) END AS kept, CASE WHEN x IS NULL THEN 0 ELSE greatest(least(x, 25), 0) END AS low
FROM (SELECT *, CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity - 10 END AS x FROM lineitem)""")
def clamp_nulls(s, d):
    x = F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity") - 10)
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", clean.clamp(x, 0.0, 25.0).alias("kept"), clean.clamp(x, 0.0, 25.0, null_to_low=True).alias("low"))


# --- clocks and calendars ---------------------------------------------------------------------------------------------


_SPAN = "c AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders))"


def _span(s, d):
    """Every day between the first and the last order."""
    ends = table(s, d, "orders").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("z"))
    return ends.select(F.explode(F.sequence("a", "z")).alias("day"))


@query(f"""WITH {_SPAN}, o AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1)
SELECT c.day::VARCHAR AS day, CAST(year(c.day) AS INT) AS year, CAST(month(c.day) AS INT) AS month, CAST(isodow(c.day) AS INT) AS weekday, CAST(dayofyear(c.day) AS INT) AS doy,
CASE WHEN {holidays.sql("c.day")} IS NOT NULL THEN 'holiday' WHEN isodow(c.day) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_type,
CASE WHEN month(c.day) IN (12, 1, 2) THEN 'winter' WHEN month(c.day) <= 5 THEN 'spring' WHEN month(c.day) <= 8 THEN 'summer' ELSE 'autumn' END AS season, coalesce(orders, 0) AS orders
FROM c LEFT JOIN o ON o.day = c.day""")
def dim_calendar_daytype(s, d):
    o = table(s, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("orders"))
    m = F.month("day")
    season = F.when(m.isin(12, 1, 2), "winter").when(m <= 5, "spring").when(m <= 8, "summer").otherwise("autumn")
    out = _span(s, d).join(o, "day", "left")
    return out.select(F.col("day").cast("string"), F.year("day").alias("year"), m.alias("month"), (F.weekday("day") + 1).alias("weekday"), F.dayofyear("day").alias("doy"), holidays.day_type(F.col("day")).alias("day_type"), season.alias("season"), F.coalesce("orders", F.lit(0)).alias("orders"))


@query(f"""WITH {_SPAN}, n AS (SELECT day, {holidays.sql("day")} AS name FROM c)
SELECT n.day::VARCHAR AS day, n.name, b.name IS NOT NULL AS is_day_after_holiday FROM n LEFT JOIN n b ON b.day = n.day - 1 WHERE n.name IS NOT NULL OR b.name IS NOT NULL""")
def holiday_calendar(s, d):
    n = _span(s, d).select("day", holidays.holiday_name(F.col("day")).alias("name"))
    after = n.where("name is not null").select(F.date_add("day", 1).alias("day"), F.lit(True).alias("after"))
    out = n.join(after, "day", "left").where("name is not null or after")
    return out.select(F.col("day").cast("string"), "name", F.coalesce("after", F.lit(False)).alias("is_day_after_holiday"))


_DST = "dz AS (SELECT r_name AS entity, CASE r_regionkey WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago' WHEN 2 THEN 'America/Los_Angeles' WHEN 3 THEN 'Etc/GMT+5' ELSE 'America/Denver' END AS zone FROM region), dd AS (SELECT entity, zone, CAST(unnest(list_concat(generate_series(DATE '2024-03-08', DATE '2024-03-12', INTERVAL 1 DAY), generate_series(DATE '2024-11-01', DATE '2024-11-05', INTERVAL 1 DAY))) AS DATE) AS day FROM dz), sp AS (SELECT entity, zone, day, unnest(generate_series(CAST(epoch(timezone(zone, CAST(day AS TIMESTAMP))) AS BIGINT) // 3600 + 1, CAST(epoch(timezone(zone, CAST(day + 1 AS TIMESTAMP))) AS BIGINT) // 3600)) AS h, CAST(epoch(timezone(zone, CAST(day AS TIMESTAMP))) AS BIGINT) // 3600 AS h0 FROM dd)"


def _dst(s, d):
    from ..functions import localtime as lt

    names = F.array(*[F.lit(z) for z in ("America/New_York", "America/Chicago", "America/Los_Angeles", "Etc/GMT+5", "America/Denver")])
    z = table(s, d, "region").select(F.col("r_name").alias("entity"), F.get(names, F.col("r_regionkey")).alias("zone"))
    date = lambda x: F.lit(x).cast("date")
    span = F.concat(F.sequence(date("2024-03-08"), date("2024-03-12")), F.sequence(date("2024-11-01"), date("2024-11-05")))
    return lt, z, z.select("entity", F.explode(span).alias("day"))


@query(f"WITH {_DST} SELECT entity, day::VARCHAR AS day, h, CAST(h - h0 AS INT) AS hour_number, CAST(hour(timezone(zone, to_timestamp((h - 1) * 3600))) AS INT) AS local_hour FROM sp")
def target_hour_spine_dst(s, d):
    _, z, days = _dst(s, d)
    return features.spine(days, z).select("entity", F.col("day").cast("string"), "h", "hour_number", "local_hour")


@query(f"WITH {_DST} SELECT entity, day::VARCHAR AS day, count(*) AS hours, max(CAST(timezone(zone, to_timestamp((h - 1) * 3600)) AS DATE))::VARCHAR AS last_local_day, sum(h - h0) AS numbers FROM sp GROUP BY entity, day")
def local_hour_fields(s, d):
    lt, z, days = _dst(s, d)
    sp = features.spine(days, z)
    ts = F.timestamp_seconds(F.col("h") * 3600)
    g = sp.groupBy("entity", "zone", "day").agg(F.max(lt.local_day_of(ts, F.col("zone"))).alias("last"), F.sum(lt.local_hour_number(ts, F.col("zone"))).alias("numbers"))
    return g.select("entity", F.col("day").cast("string"), lt.hours_in_local_day(F.col("day"), F.col("zone")).alias("hours"), F.col("last").cast("string").alias("last_local_day"), "numbers")


@query(f"WITH {_DST} SELECT entity, day::VARCHAR AS day, CAST(epoch(timezone(zone, CAST(day - 1 AS TIMESTAMP) + INTERVAL 10 HOUR)) AS BIGINT) // 3600 AS issued, CAST(epoch(timezone(zone, CAST(day - 1 AS TIMESTAMP) + INTERVAL 6 HOUR)) AS BIGINT) // 3600 AS cutoff FROM dd")
def origins_protocol(s, d):
    _, z, days = _dst(s, d)
    return features.origins(days, z, features.Protocol()).select("entity", F.col("day").cast("string"), "issued", "cutoff")


# --- features ---------------------------------------------------------------------------------------------------------

_LOCAL = f"""{H}, {Z}, {DAYS}, l AS (SELECT h.entity, h.h, value, temp, CAST(timezone(zone, to_timestamp((h.h - 1) * 3600)) AS DATE) AS day, CAST(hour(timezone(zone, to_timestamp((h.h - 1) * 3600))) AS INT) AS local_hour FROM h JOIN z ON z.entity = h.entity),
o AS (SELECT days.entity, day, zone, CAST(epoch(timezone(zone, CAST(day - 1 AS TIMESTAMP) + INTERVAL 10 HOUR)) AS BIGINT) // 3600 AS issued, CAST(epoch(timezone(zone, CAST(day - 1 AS TIMESTAMP) + INTERVAL 6 HOUR)) AS BIGINT) // 3600 AS cutoff FROM days JOIN z ON z.entity = days.entity),
sp AS (SELECT entity, day, zone, issued, cutoff, unnest(generate_series(CAST(epoch(timezone(zone, CAST(day AS TIMESTAMP))) AS BIGINT) // 3600 + 1, CAST(epoch(timezone(zone, CAST(day + 1 AS TIMESTAMP))) AS BIGINT) // 3600)) AS h FROM o),
x AS (SELECT *, CAST(hour(timezone(zone, to_timestamp((h - 1) * 3600))) AS INT) AS local_hour FROM sp),
sh AS (SELECT entity, day, local_hour, avg(value) AS v, max(h) AS src FROM l GROUP BY ALL),
pr AS (SELECT entity, day, avg(value) AS mean, max(value) AS peak, max(h) AS last FROM l GROUP BY ALL),
lv AS (SELECT o.entity, o.day, avg(mean) AS level_7d, max(last) AS src FROM o JOIN pr ON pr.entity = o.entity AND pr.day BETWEEN o.day - 8 AND o.day - 2 GROUP BY ALL HAVING count(*) >= 5),
pt AS (SELECT o.entity, o.day, avg(value) AS partial_mean, max(h) AS src FROM o JOIN l ON l.entity = o.entity AND l.day = o.day - 1 AND h <= cutoff GROUP BY ALL),
lk AS (SELECT o.entity, o.day, arg_max(value, h) AS last_known, max(h) AS src FROM o JOIN h ON h.entity = o.entity AND h.h BETWEEN cutoff - 5 AND cutoff GROUP BY ALL)"""


def _matrix(s, d, protocol=features.Protocol()):
    """The panel is written once and feeds all branches of the matrix; it is far smaller than the events."""
    panel = staging.written(p.hourly(s, d), "panel")
    return features.build(panel.select("entity", "h", "value"), *p.clocks_and_days(panel), protocol)


@query(f"""WITH {_LOCAL} SELECT x.entity, x.day::VARCHAR AS day, x.h, round(a.v, 6) AS lag_recent, a.src + issued - cutoff AS avail_recent, round(b.v, 6) AS lag7, b.src + issued - cutoff AS avail7
FROM x LEFT JOIN sh a ON a.entity = x.entity AND a.day = x.day - 2 AND a.local_hour = x.local_hour LEFT JOIN sh b ON b.entity = x.entity AND b.day = x.day - 7 AND b.local_hour = x.local_hour""")
def same_period_lag(s, d):
    m = _matrix(s, d)
    return rounded(m.select("entity", F.col("day").cast("string"), "h", "lag_recent", F.col("avail__lag_recent").alias("avail_recent"), "lag7", F.col("avail__lag7").alias("avail7")))


@query(f"WITH {_LOCAL} SELECT entity, day::VARCHAR AS day, round(level_7d, 6) AS level_7d, src AS src FROM lv")
def level_7d(s, d):
    local = features.localised(p.hourly(s, d), p.zones(s, d))
    out = features.level(features.day_profile(local), 2).join(p.days_of(s, d), ["entity", "day"], "left_semi")
    return rounded(out.select("entity", F.col("day").cast("string"), "level_7d", F.col("src__level_7d").alias("src")))


@query(f"WITH {_LOCAL} SELECT o.entity, o.day::VARCHAR AS day, round(peak, 6) AS recent_peak, last AS src FROM o JOIN pr ON pr.entity = o.entity AND pr.day = o.day - 2")
def recent_peak(s, d):
    local = features.localised(p.hourly(s, d), p.zones(s, d))
    out = features.recent_peak(features.day_profile(local), 2).join(p.days_of(s, d), ["entity", "day"], "left_semi")
    return rounded(out.select("entity", F.col("day").cast("string"), "recent_peak", F.col("src__recent_peak").alias("src")))


@query(f"""WITH {_LOCAL} SELECT lk.entity, lk.day::VARCHAR AS day, round(last_known, 6) AS last_known, lk.src AS src_last, round(partial_mean, 6) AS partial_mean, pt.src AS src_partial
FROM lk LEFT JOIN pt ON pt.entity = lk.entity AND pt.day = lk.day""")
def partial_day_last_known(s, d):
    z = p.zones(s, d)
    local = features.localised(p.hourly(s, d), z)
    out = features.partial_and_last(local, features.origins(p.days_of(s, d), z, features.Protocol()), features.Protocol())
    return rounded(out.select("entity", F.col("day").cast("string"), "last_known", F.col("src__last_known").alias("src_last"), "partial_mean", F.col("src__partial_mean").alias("src_partial")))


_FM = f"""{_LOCAL}, fm AS (SELECT x.entity, x.day, x.h, x.local_hour, x.issued, a.v AS lag_recent, a.src + issued - cutoff AS av_recent, b.v AS lag7, level_7d, lv.src + issued - cutoff AS av_level, pr.peak AS recent_peak, partial_mean, last_known, lk.src + issued - cutoff AS av_last, h.value AS y
FROM x LEFT JOIN sh a ON a.entity = x.entity AND a.day = x.day - 2 AND a.local_hour = x.local_hour LEFT JOIN sh b ON b.entity = x.entity AND b.day = x.day - 7 AND b.local_hour = x.local_hour
LEFT JOIN lv ON lv.entity = x.entity AND lv.day = x.day LEFT JOIN pr ON pr.entity = x.entity AND pr.day = x.day - 2 LEFT JOIN lk ON lk.entity = x.entity AND lk.day = x.day LEFT JOIN pt ON pt.entity = x.entity AND pt.day = x.day
LEFT JOIN h ON h.entity = x.entity AND h.h = x.h)"""


@query(f"""WITH {_FM} SELECT entity, day::VARCHAR AS day, h, local_hour, round(lag_recent, 6) AS lag_recent, round(lag7, 6) AS lag7, round(level_7d, 6) AS level_7d, round(recent_peak, 6) AS recent_peak,
round(CASE WHEN lk_ok THEN partial_mean END, 6) AS partial_mean, round(last_known, 6) AS last_known, round(lag_recent / nullif(level_7d, 0), 6) AS lag_recent_ratio, greatest(av_recent, av_level) AS avail_lag_recent_ratio,
CAST(isodow(day) AS INT) AS weekday, round(sin(dayofyear(day) * (2 * 3.141592653589793 / 365.25)), 6) AS doy_sin, round(y, 6) AS y FROM (SELECT *, last_known IS NOT NULL OR av_last IS NOT NULL AS lk_ok FROM fm)""")
def feature_matrix(s, d):
    m = _matrix(s, d)
    return rounded(m.select("entity", F.col("day").cast("string"), "h", "local_hour", "lag_recent", "lag7", "level_7d", "recent_peak", "partial_mean", "last_known", "lag_recent_ratio", F.col("avail__lag_recent_ratio").alias("avail_lag_recent_ratio"), "weekday", "doy_sin", "y"))


@query(f"WITH {_FM} SELECT count(*) AS n_rows, count(DISTINCT (entity, day)) AS origins, CAST(0 AS BIGINT) AS violations FROM fm")
def leakage_report(s, d):
    return features.check_point_in_time(_matrix(s, d)).select("n_rows", "origins", "violations")


@query(f"""WITH {_LOCAL} SELECT count(*) AS n_rows, count(*) FILTER (WHERE a.src + issued - cutoff > issued) AS violations, 'lag1' AS features
FROM x LEFT JOIN sh a ON a.entity = x.entity AND a.day = x.day - 1 AND a.local_hour = x.local_hour""")
def leaky_control(s, d):
    z = p.zones(s, d)
    local, days = features.localised(p.hourly(s, d), z), p.days_of(s, d)
    m = features.spine(days, z).join(features.origins(days, z, features.Protocol()), ["entity", "day"])
    m = m.join(features.same_hour(local, 1, "lag1"), ["entity", "day", "local_hour"], "left").withColumn("avail__lag1", F.col("src__lag1") + F.col("issued") - F.col("cutoff"))
    return features.check_point_in_time(m).select("n_rows", "violations", "features")


@query(f"""WITH {_LOCAL}, w AS (SELECT x.entity, x.day, x.h, t.temp, greatest(t.temp - 18, 0) AS cdd, greatest(18 - t.temp, 0) AS hdd, avg(t.temp) OVER (PARTITION BY x.entity, x.day) AS temp_mean, t.temp - k.temp AS temp_delta_7d, r.temp AS temp_recent
FROM x LEFT JOIN h t ON t.entity = x.entity AND t.h = x.h LEFT JOIN h k ON k.entity = x.entity AND k.h = x.h - 168 LEFT JOIN h r ON r.entity = x.entity AND r.h = x.h - 48)
SELECT w.entity, w.day::VARCHAR AS day, w.h, round(temp, 7) AS temp, round(CASE WHEN temp IS NOT NULL THEN cdd END, 7) AS cdd, round(CASE WHEN temp IS NOT NULL THEN hdd END, 7) AS hdd, round(temp_mean, 7) AS temp_mean, round(temp_delta_7d, 7) AS temp_delta_7d, round(temp_recent, 7) AS temp_recent,
round((SELECT avg(q.temp) FROM h q WHERE q.entity = w.entity AND q.h BETWEEN w.h - 3 AND w.h - 1), 7) AS temp_prev3h FROM w""")
def weather_shift_features(s, d):
    panel = p.hourly(s, d)
    out = features.temperature(features.spine(p.days_of(s, d), p.zones(s, d)), panel, 2)
    return rounded(out.select("entity", F.col("day").cast("string"), "h", "temp", "cdd", "hdd", "temp_mean", "temp_delta_7d", "temp_recent", "temp_prev3h"), 7)


# --- models and scores ------------------------------------------------------------------------------------------------


@query(f"WITH {D} SELECT a.entity, a.day, round(b.value, 4) AS yhat FROM d a JOIN d b ON b.entity = a.entity AND b.day = a.day - 7")
def seasonal_naive(s, d):
    return rounded(models.seasonal_naive(p.daily(s, d), 7), 4)


@query(f"""WITH {D}, r AS (SELECT a.entity, a.value / nullif(b.value, 0) AS r FROM d a JOIN d b ON b.entity = a.entity AND b.day = a.day - 7)
SELECT entity, count(r) AS n, round(list_sort(list(r))[CAST(round(0.1 * (count(r) - 1)) AS INT) + 1], 4) AS q10, round(list_sort(list(r))[CAST(round(0.9 * (count(r) - 1)) AS INT) + 1], 4) AS q90 FROM r WHERE r IS NOT NULL GROUP BY entity""")
def residual_quantiles_nearest(s, d):
    return rounded(models.residual_quantiles(p.daily(s, d), 7, {"q10": 0.1, "q90": 0.9}), 4)


@query(f"""WITH {D}, e AS (SELECT a.entity, a.day, b.value - a.value AS err, b.value AS bench FROM d a JOIN d b ON b.entity = a.entity AND b.day = a.day - 7),
w AS (SELECT entity, day, bench, avg(err) OVER x AS m, count(err) OVER x AS n FROM e WINDOW x AS (PARTITION BY entity ORDER BY day RANGE BETWEEN 27 PRECEDING AND CURRENT ROW))
SELECT a.entity, a.day, round(a.bench - coalesce(CASE WHEN b.n >= 14 THEN b.m END, 0), 4) AS yhat FROM w a LEFT JOIN w b ON b.entity = a.entity AND b.day = a.day - 2""")
def benchmark_debiased(s, d):
    panel = p.daily(s, d)
    bench = models.seasonal_naive(panel, 7).withColumnRenamed("yhat", "benchmark")
    return rounded(models.debias(panel.join(bench, ["entity", "day"])), 4)


@query(f"WITH {H}, {FC} SELECT entity, h, model, round(yhat, 6) AS yhat, round(err, 6) AS err FROM sc")
def score_common_support(s, d):
    return rounded(p.scored(s, d).select("entity", "h", "model", "yhat", "err"))


_PM = "count(*) AS hours, round(avg(abs_err), 6) AS mae, round(sqrt(avg(err * err)), 6) AS rmse, round(avg(abs_err / nullif(abs(y), 0)) * 100, 6) AS mape, round(avg(err / nullif(y, 0)) * 100, 6) AS bias"


@query(f"WITH {H}, {FC} SELECT entity, model, {_PM} FROM sc GROUP BY entity, model")
def point_metrics(s, d):
    return rounded(evaluate.point_metrics(p.scored(s, d), ["entity", "model"]))


@query(f"""WITH {H}, {FC}, g AS (SELECT entity, model, day, count(*) AS n, max(y) AS top, max(yhat) AS said, arg_min(h, (-y, -h)) AS peak_at, arg_min(h, (-yhat, -h)) AS said_at FROM sc GROUP BY ALL)
SELECT entity, model, count(*) AS days, round(avg(abs(said - top) / top) * 100, 6) AS peak_ape, round(avg(CAST(abs(said_at - peak_at) > 1 AS INT)) * 100, 6) AS peak_miss FROM g WHERE n >= 20 GROUP BY entity, model""")
def peak_metrics(s, d):
    return rounded(evaluate.peak_metrics(p.scored(s, d), 20))


@query(f"""WITH {H}, {FC} SELECT entity, model, count(*) AS n, round(avg(CAST(y BETWEEN lo80 AND hi80 AS INT)) * 100, 6) AS cover80, round(avg(CAST(y BETWEEN lo95 AND hi95 AS INT)) * 100, 6) AS cover95,
round(avg((hi80 - lo80) / y) * 100, 6) AS width80, round(avg((hi95 - lo95) / y) * 100, 6) AS width95, round(avg((greatest(0.1 * (y - lo80), (0.1 - 1) * (y - lo80)) + greatest(0.9 * (y - hi80), (0.9 - 1) * (y - hi80))) / 2), 6) AS pinball80
FROM sc WHERE lo80 IS NOT NULL AND hi95 IS NOT NULL GROUP BY entity, model""")
def interval_metrics(s, d):
    return rounded(evaluate.interval_metrics(p.scored(s, d), ["entity", "model"]))


_SLICE = "CASE WHEN (h - 1) % 24 < 6 THEN 'night' WHEN (h - 1) % 24 < 12 THEN 'morning' WHEN (h - 1) % 24 < 18 THEN 'afternoon' ELSE 'evening' END"


@query(f"""WITH {H}, {FC}, t AS (SELECT *, {_SLICE} AS block, CASE WHEN (day + 3) % 7 >= 5 THEN 'weekend' ELSE 'weekday' END AS day_type FROM sc)
SELECT model, 'block' AS slice, block AS level, {_PM} FROM t GROUP BY ALL UNION ALL SELECT model, 'day_type' AS slice, day_type AS level, {_PM} FROM t GROUP BY ALL""")
def slice_metrics(s, d):
    k = (F.col("h") - 1) % 24
    block = F.when(k < 6, "night").when(k < 12, "morning").when(k < 18, "afternoon").otherwise("evening")
    t = p.scored(s, d).withColumns({"block": block, "day_type": F.when((F.col("day") + 3) % 7 >= 5, "weekend").otherwise("weekday")})
    return rounded(evaluate.slice_metrics(t, ["block", "day_type"]))


@query(f"""WITH {H}, {FC}, m AS (SELECT entity, model, avg(abs_err) AS mae FROM sc GROUP BY ALL)
SELECT m.entity, m.model, round(m.mae, 6) AS mae, round(1 - m.mae / nullif(r.mae, 0), 6) AS skill FROM m LEFT JOIN m r ON r.entity = m.entity AND r.model = 'week'""")
def skill(s, d):
    m = evaluate.point_metrics(p.scored(s, d), ["entity", "model"])
    return rounded(evaluate.skill(m, "week", ["entity"]).select("entity", "model", "mae", "skill"))


def _band(s, d):
    panel = p.daily(s, d)
    naive = models.seasonal_naive(panel, 7)
    return panel.join(naive, ["entity", "day"]).select("entity", "day", F.lit("naive").alias("model"), F.col("value").alias("y"), (F.col("yhat") * 0.9).alias("lo"), (F.col("yhat") * 1.1).alias("hi"))


@query(f"""WITH {D}, b AS (SELECT a.entity, a.day, a.value AS y, b.value * 0.9 AS lo, b.value * 1.1 AS hi, greatest(b.value * 0.9 - a.value, a.value - b.value * 1.1) AS s FROM d a JOIN d b ON b.entity = a.entity AND b.day = a.day - 7),
w AS (SELECT entity, day, list_sort(list(s) OVER x) AS v, count(*) OVER x AS n FROM b WINDOW x AS (PARTITION BY entity ORDER BY day RANGE BETWEEN 57 PRECEDING AND 2 PRECEDING))
SELECT entity, day, round(CASE WHEN n >= 21 THEN v[least(n, CAST(ceil((n + 1) * (1 - 0.2)) AS BIGINT))] END, 4) AS move FROM w""")
def cqr_adjustment(s, d):
    return rounded(evaluate.conformal(_band(s, d)).select("entity", "day", "move"), 4)


@query(f"""WITH {H}, {FC} SELECT entity, model, count(*) AS n,
round(avg((greatest(0.025 * (y - lo95), (0.025 - 1) * (y - lo95)) + greatest(0.975 * (y - hi95), (0.975 - 1) * (y - hi95))) / 2), 6) AS pinball95
FROM sc WHERE lo95 IS NOT NULL AND hi95 IS NOT NULL GROUP BY entity, model""")
def interval_pinball95(s, d):
    return rounded(evaluate.pinball95(p.scored(s, d), ["entity", "model"]))


@query(f"""WITH {H}, {FC}, l AS (SELECT entity, model, day, sum(abs_err) AS loss, count(*) AS n FROM sc GROUP BY ALL)
SELECT a.model, a.day, count(*) AS entities, round(sum(a.loss), 6) AS loss, round(sum(b.loss), 6) AS ref_loss, CAST(sum(a.n) AS BIGINT) AS n
FROM l a JOIN l b ON b.entity = a.entity AND b.day = a.day AND b.model = 'week' AND a.model <> 'week' AND a.n = b.n GROUP BY a.model, a.day""")
def pooled_losses(s, d):
    return rounded(evaluate.pooled(evaluate.paired(evaluate.daily_losses(p.scored(s, d)), "week")))


@query(f"""WITH {H}, {FC}, l AS (SELECT entity, model, day, sum(abs_err) AS loss, count(*) AS n FROM sc GROUP BY ALL)
SELECT a.entity, a.model, a.day, round(a.loss, 6) AS loss, a.n, round(b.loss, 6) AS ref_loss FROM l a JOIN l b ON b.entity = a.entity AND b.day = a.day AND b.model = 'week' AND a.model <> 'week' AND a.n = b.n""")
def daily_losses_paired(s, d):
    return rounded(evaluate.paired(evaluate.daily_losses(p.scored(s, d)), "week").select("entity", "model", "day", "loss", "n", "ref_loss"))


_DM = f"""WITH {H}, {FC}, l AS (SELECT entity, model, day, sum(abs_err) AS loss, count(*) AS n FROM sc GROUP BY ALL),
q AS (SELECT a.entity, a.model, a.day, a.loss - b.loss AS x FROM l a JOIN l b ON b.entity = a.entity AND b.day = a.day AND b.model = 'week' AND a.model <> 'week' AND a.n = b.n),
c AS (SELECT *, x - avg(x) OVER (PARTITION BY entity, model) AS e, row_number() OVER (PARTITION BY entity, model ORDER BY day) AS i FROM q),
v AS (SELECT a.entity, a.model, sum(CASE WHEN b.i = a.i THEN 1 ELSE 2 * (1 - (a.i - b.i) / 8.0) END * a.e * b.e) / max(n) AS lrv FROM c a JOIN c b ON b.entity = a.entity AND b.model = a.model AND b.i BETWEEN a.i - 7 AND a.i JOIN (SELECT entity, model, count(*) AS n FROM c GROUP BY ALL) k ON k.entity = a.entity AND k.model = a.model GROUP BY ALL)"""


@query(f"{_DM} SELECT q.entity, q.model, count(*) AS days, round(CASE WHEN max(lrv) > 0 THEN avg(x) / sqrt(max(lrv) / count(*)) * sqrt((count(*) - 15.0 + 56.0 / count(*)) / count(*)) ELSE 0 END, 3) AS dm FROM q JOIN v ON v.entity = q.entity AND v.model = q.model GROUP BY ALL HAVING count(*) >= 10")
def dm_statistic(s, d):
    pairs = evaluate.paired(evaluate.daily_losses(p.scored(s, d)), "week")
    return rounded(evaluate.compare(pairs, "week", least=10).select("entity", "model", "days", "dm"), 3)


@query(f"WITH {H} SELECT entity, CAST((h - 1) % 24 AS INT) AS hour, round(avg(value), 6) AS mean FROM h GROUP BY 1, 2")
def climatology(s, d):
    return rounded(models.climatology(p.hourly(s, d)))


@query(f"""WITH {H}, b AS (SELECT entity, min(h) AS a, max(h) AS z FROM h GROUP BY 1), g AS (SELECT entity, unnest(generate_series(a, z)) AS h FROM b)
SELECT g.entity, g.h, round(last_value(h.value IGNORE NULLS) OVER (PARTITION BY g.entity ORDER BY g.h), 6) AS value FROM g LEFT JOIN h ON h.entity = g.entity AND h.h = g.h""")
def ffill_grid(s, d):
    return rounded(models.fill_grid(p.hourly(s, d)))


@query()
def ridge_backtest(s, d):
    return models.ridge_backtest(p.daily(s, d))


@query()
def drift_psi(s, d):
    panel = p.daily(s, d)
    edge = panel.agg((F.max("day") - 180).alias("edge"))
    rows = panel.join(F.broadcast(edge)).withColumn("now", F.col("day") > F.col("edge"))
    return models.population_stability(rows, ["value"])


# --- data quality, reshaping, subqueries ------------------------------------------------------------------------------


@query(f"WITH {H}, g AS (SELECT entity, h, lag(h) OVER (PARTITION BY entity ORDER BY h) AS prev FROM h) SELECT entity, prev, h, h - prev - 1 AS missing FROM g WHERE h - prev > 1")
def gap_report(s, d):
    return quality.gaps(p.hourly(s, d))


@query(f"WITH {H}, g AS (SELECT entity, unnest(generate_series(a, z)) AS h FROM (SELECT entity, min(h) AS a, max(h) AS z FROM h GROUP BY 1)) SELECT g.entity, count(*) AS expected, count(h.value) AS present FROM g LEFT JOIN h ON h.entity = g.entity AND h.h = g.h GROUP BY 1")
def gap_audit(s, d):
    return quality.coverage(p.hourly(s, d))


@query(f"""WITH {_LOCAL}, c AS (SELECT entity, day, count(*) AS n FROM l GROUP BY ALL), b AS (SELECT entity, min(day) AS a, max(day) AS z FROM c GROUP BY 1)
SELECT c.entity, day::VARCHAR AS day, n FROM c JOIN b ON b.entity = c.entity WHERE day > a AND day < z AND n NOT IN (23, 24, 25)""")
def hours_per_local_day(s, d):
    return quality.wrong_day_lengths(p.local(s, d)).select("entity", F.col("day").cast("string"), "n")


@query(f"""WITH {H}, v AS (SELECT entity, h, CASE WHEN n % 3 <> 0 THEN value END AS value FROM h), t AS (SELECT *, max(CASE WHEN value IS NOT NULL THEN h END) OVER (PARTITION BY entity) AS last FROM v)
SELECT entity, round(avg(CASE WHEN value IS NULL THEN 0 ELSE 1 END), 6) AS share FROM t WHERE h <= last GROUP BY 1 HAVING avg(CASE WHEN value IS NULL THEN 0 ELSE 1 END) < 0.73""")
def min_coverage(s, d):
    panel = p.hourly(s, d).withColumn("value", F.when(F.col("n") % 3 != 0, F.col("value")))
    return rounded(quality.low_coverage(panel, "value", ["entity"], 0.73, "h"))


@query("SELECT l_returnflag AS value, count(*) AS n FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') GROUP BY 1")
def accepted_values(s, d):
    return quality.not_accepted(table(s, d, "lineitem"), "l_returnflag", ["A", "N"])


@query(f"""WITH {_LOCAL}, c AS (SELECT entity, min(cutoff) AS cutoff FROM o GROUP BY 1), a AS (SELECT entity, min(h) AS a FROM l GROUP BY 1),
n AS (SELECT l.entity, max(h) AS newest FROM l JOIN a ON a.entity = l.entity WHERE h < a + 150 OR l.entity = 'view' GROUP BY 1)
SELECT c.entity, newest, cutoff FROM c JOIN n ON n.entity = c.entity WHERE newest > cutoff""")
def training_precedes_issue(s, d):
    test = features.origins(p.days_of(s, d), p.zones(s, d), features.Protocol())
    rows = p.hourly(s, d)
    train = rows.join(rows.groupBy("entity").agg(F.min("h").alias("a")), "entity").where("h < a + 150 or entity = 'view'")
    return quality.trained_after_cutoff(train, test)


@query(f"""WITH {_LOCAL}, e AS (SELECT a.entity, a.local_hour, a.day, b.value - a.value AS err, b.value AS bench FROM l a JOIN l b ON b.entity = a.entity AND b.h = a.h - 168),
g AS (SELECT entity, local_hour, day, avg(err) AS err FROM e GROUP BY ALL),
w AS (SELECT entity, local_hour, day, avg(err) OVER x AS m, count(*) OVER x AS n FROM g WINDOW x AS (PARTITION BY entity, local_hour ORDER BY day RANGE BETWEEN INTERVAL 27 DAY PRECEDING AND CURRENT ROW))
SELECT g.entity, g.local_hour, g.day::VARCHAR AS day, round(b.m, 6) AS bias FROM g JOIN w b ON b.entity = g.entity AND b.local_hour = g.local_hour AND b.day = g.day - 2 WHERE b.n >= 14""")
def hourly_debias_offsets(s, d):
    rows = p.local(s, d).where("yhat is not null").groupBy("entity", "local_hour", F.unix_date("day").cast("long").alias("day"))
    rows = rows.agg(F.avg(F.col("yhat") - F.col("value")).alias("benchmark")).withColumn("value", F.lit(0.0))
    out = models.bias(rows, by=("entity", "local_hour")).where("bias is not null").join(rows.select("entity", "local_hour", "day"), ["entity", "local_hour", "day"], "left_semi")
    return rounded(out.select("entity", "local_hour", F.date_from_unix_date(F.col("day").cast("int")).cast("string").alias("day"), "bias"), 6)


@query(f"WITH {_LOCAL} SELECT entity, CAST(month(day) AS INT) AS month, local_hour, count(value) AS n, round(avg(value), 6) AS mean FROM l GROUP BY ALL")
def climatology_local(s, d):
    return rounded(models.local_climatology(p.local(s, d)))


@query(f"""WITH {_LOCAL}, r AS (SELECT a.entity, a.local_hour, a.value / nullif(b.value, 0) AS r FROM l a JOIN l b ON b.entity = a.entity AND b.h = a.h - 168),
s AS (SELECT entity, local_hour, list_sort(list(r)) AS v, count(*) AS n FROM r WHERE r IS NOT NULL GROUP BY ALL)
SELECT entity, local_hour, n, """ + ", ".join(f"round(v[CAST(round({q} * (n - 1)) AS INT) + 1], 6) AS {c}" for c, q in (("q025", 0.025), ("q10", 0.1), ("q90", 0.9), ("q975", 0.975))) + " FROM s")
def residual_quantiles_hourly(s, d):
    return rounded(models.hourly_residual_quantiles(p.local(s, d), {"q025": 0.025, "q10": 0.1, "q90": 0.9, "q975": 0.975}))


@query("SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_combination(s, d):
    return quality.repeated(table(s, d, "lineitem"), ["l_orderkey", "l_partkey"])


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount < 0.02 OR l_discount > 0.08")
def accepted_range(s, d):
    return quality.outside(table(s, d, "lineitem"), "l_discount", 0.02, 0.08).select("l_orderkey", "l_linenumber", "l_discount")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag IS DISTINCT FROM l_linestatus")
def equal_to_column(s, d):
    return quality.unequal(table(s, d, "lineitem"), "l_returnflag", "l_linestatus").select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)")
def relationships(s, d):
    return quality.orphans(table(s, d, "orders"), "o_orderkey", table(s, d, "lineitem"), "l_orderkey").select("o_orderkey")


@query("SELECT 'o_totalprice' AS field, 'range' AS rule, count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 400000) AS failing FROM orders UNION ALL SELECT 'o_custkey', 'null', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders UNION ALL SELECT 'o_custkey', 'unique', count(*) - count(DISTINCT o_custkey) FROM orders")
def contract_violations(s, d):
    return quality.violations(table(s, d, "orders"), ranges={"o_totalprice": (1000, 400000)}, required=["o_custkey"], unique=[["o_custkey"]])


@query(f"WITH {H}, {FC} SELECT entity, h, round(max(yhat) FILTER (WHERE model = 'day'), 6) AS day, round(max(yhat) FILTER (WHERE model = 'week'), 6) AS week FROM sc GROUP BY 1, 2")
def pivot_models_wide(s, d):
    return rounded(p.scored(s, d).groupBy("entity", "h").pivot("model", ["day", "week"]).agg(F.max("yhat")))


@query("SELECT o_custkey, o_orderkey, o_orderdate::VARCHAR AS at FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS m FROM orders) WHERE o_orderdate = m")
def latest_issue(s, d):
    m = F.max("o_orderdate").over(W.partitionBy("o_custkey"))
    o = table(s, d, "orders").withColumn("m", m).where("o_orderdate = m")
    return o.select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(f"WITH {H}, {FC}, u AS (SELECT entity, h, model, yhat, 0 AS rank FROM fc WHERE model = 'day' UNION ALL SELECT entity, h, 'day', yhat, 1 FROM fc WHERE model = 'week') SELECT entity, h, round(yhat, 6) AS yhat, rank FROM (SELECT *, row_number() OVER (PARTITION BY entity, h, model ORDER BY rank) AS r FROM u) WHERE r = 1")
def combine_dedup(s, d):
    f = p.forecasts(s, d)
    runs = f.where("model = 'day'").withColumn("rank", F.lit(0)).unionByName(f.where("model = 'week'").withColumn("model", F.lit("day")).withColumn("rank", F.lit(1)))
    return rounded(clean.keep_latest(runs, ["entity", "h", "model"], [F.col("rank")]).select("entity", "h", "yhat", "rank"))


@query(f"WITH {H}, {FC}, m AS (SELECT entity, model, avg(abs_err / nullif(abs(y), 0)) * 100 AS mape FROM sc GROUP BY ALL) SELECT entity, arg_min(model, mape) AS model, round(min(mape), 6) AS mape FROM m GROUP BY entity")
def best_model(s, d):
    m = evaluate.point_metrics(p.scored(s, d), ["entity", "model"])
    return rounded(m.groupBy("entity").agg(F.min_by("model", "mape").alias("model"), F.min("mape").alias("mape")))


@query("SELECT n_name, round(avg(CAST(c_acctbal > (SELECT avg(s_acctbal) FROM supplier s WHERE s.s_nationkey = c.c_nationkey) AS INT)), 6) AS share FROM customer c JOIN nation n ON n_nationkey = c_nationkey GROUP BY n_name")
def corr_scalar_subquery(s, d):
    mean = table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.avg("s_acctbal").alias("m"))
    c = table(s, d, "customer").join(mean, "c_nationkey", "left").join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rounded(c.groupBy("n_name").agg(F.avg((F.col("c_acctbal") > F.col("m")).cast("int")).alias("share")))


@query("SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) AND c_acctbal < (SELECT max(s_acctbal) / 2 FROM supplier)")
def semi_join_in(s, d):
    n = table(s, d, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))
    top = table(s, d, "supplier").agg((F.max("s_acctbal") / 2).alias("m"))
    c = table(s, d, "customer").join(n, "c_nationkey", "left_semi").join(F.broadcast(top))  # one row
    return c.where("c_acctbal < m").select("c_custkey", "c_name")


@query("SELECT event_type, CAST(props->>'k' AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1, 2")
def json_field_counts(s, d):
    k = F.from_json("props", "k long")["k"].alias("k")
    return table(s, d, "events").groupBy("event_type", k).agg(F.count("*").alias("n"))


@query("SELECT c_nationkey, CAST(m AS DATE)::VARCHAR AS month FROM (SELECT DISTINCT c_nationkey, unnest(generate_series(DATE '2024-01-01', DATE '2024-12-01', INTERVAL 1 MONTH)) AS m FROM customer)")
def month_chunks(s, d):
    span = F.sequence(F.lit("2024-01-01").cast("date"), F.lit("2024-12-01").cast("date"), F.expr("interval 1 month"))
    return table(s, d, "customer").select("c_nationkey").distinct().select("c_nationkey", F.explode(span).alias("month")).select("c_nationkey", F.col("month").cast("string"))


@query(f"WITH {D} SELECT entity, CAST(year(DATE '1970-01-01' + CAST(a.day AS INT)) AS INT) AS year, round(avg(abs(b.value - a.value) / a.value) * 100, 4) AS mape, round(avg((b.value - a.value) / a.value) * 100, 4) AS bias FROM d a JOIN d b USING (entity) WHERE b.day = a.day - 7 GROUP BY 1, 2")
def benchmark_accuracy(s, d):
    panel = p.daily(s, d)
    rows = panel.join(models.seasonal_naive(panel, 7), ["entity", "day"])
    err = F.col("yhat") - F.col("value")
    g = rows.groupBy("entity", F.year(F.date_from_unix_date(F.col("day").cast("int"))).alias("year"))
    return rounded(g.agg((F.avg(F.abs(err) / F.col("value")) * 100).alias("mape"), (F.avg(err / F.col("value")) * 100).alias("bias")), 4)
