"""Panels of the driver tables, as DataFrames and as the same definitions in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, h, value, n, temp): events by type and hour; h is the hour number at which the hour ends."""
    e = table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    h = (F.floor(F.unix_timestamp("ts") / 3600) + 1).cast("long").alias("h")
    return e.groupBy(F.col("event_type").alias("entity"), h).agg(F.sum("value").alias("value"), F.count("*").alias("n"), F.avg("value").alias("temp"))


H = """h AS (SELECT event_type AS entity, CAST(floor(epoch(ts) / 3600) AS BIGINT) + 1 AS h, sum(value) AS value, count(*) AS n, avg(value) AS temp
  FROM events GROUP BY 1, 2)"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, day, value): orders by priority and day; day is a day number."""
    o = table(spark, sf_dir, "orders").select("o_orderpriority", F.unix_date(F.to_date("o_orderdate")).cast("long").alias("day"), "o_totalprice")
    return o.groupBy(F.col("o_orderpriority").alias("entity"), "day").agg(F.sum("o_totalprice").alias("value"))


D = """d AS (SELECT o_orderpriority AS entity, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS day, sum(o_totalprice) AS value
  FROM orders GROUP BY 1, 2)"""

def local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly panel with the local day and hour of each row, and the value of the local hour a week before as yhat."""
    from ..functions import localtime

    at = F.timestamp_seconds(F.col("h") * 3600)
    rows = hourly(spark, sf_dir).join(zones(spark, sf_dir), "entity")
    rows = rows.select("entity", "h", "value", "temp", localtime.local_day_of(at, F.col("zone")).alias("day"), localtime.local_hour_of(at, F.col("zone")).alias("local_hour"))
    return rows.join(rows.select("entity", (F.col("h") + 168).alias("h"), F.col("value").alias("yhat")), ["entity", "h"], "left")


#: A clock for each entity of the hourly panel. Fixed values.
ZONES = {
    "click": "America/New_York", "error": "America/Chicago", "purchase": "America/Los_Angeles",
    "signup": "Etc/GMT+5", "view": "America/Denver",
}


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each entity of the hourly panel; a type without a zone of its own keeps UTC."""
    known = F.create_map(*[F.lit(x) for kv in ZONES.items() for x in kv])
    types = table(spark, sf_dir, "events").select(F.col("event_type").alias("entity")).distinct()
    return types.select("entity", F.coalesce(F.try_element_at(known, F.col("entity")), F.lit("UTC")).alias("zone"))


Z = "z AS (SELECT DISTINCT event_type AS entity, CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ZONES.items()) + " ELSE 'UTC' END AS zone FROM events)"


def days_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, day): the inner dates of the hourly panel, for each entity."""
    e = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("entity")).agg(
        F.date_add(F.to_date(F.min("ts")), 9).alias("a"), F.date_sub(F.to_date(F.max("ts")), 1).alias("b")
    )
    return e.select("entity", F.explode(F.sequence("a", "b")).alias("day"))


def clocks_and_days(panel: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``zones`` and ``days_of`` of an hourly panel that is at hand: the events aren't read again."""
    known = F.create_map(*[F.lit(x) for kv in ZONES.items() for x in kv])
    ends = panel.groupBy("entity").agg(F.min("h").alias("a"), F.max("h").alias("z"))
    day = lambda h: F.to_date(F.timestamp_seconds((F.col(h) - 1) * 3600))
    zone = F.coalesce(F.try_element_at(known, F.col("entity")), F.lit("UTC")).alias("zone")
    return ends.select("entity", zone), ends.select("entity", F.explode(F.sequence(F.date_add(day("a"), 9), F.date_sub(day("z"), 1))).alias("day"))


DAYS = """days AS (SELECT entity, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM (
  SELECT event_type AS entity, CAST(min(ts) AS DATE) + 9 AS a, CAST(max(ts) AS DATE) - 1 AS b FROM events GROUP BY 1))"""


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, h, model, yhat): the hour of a day and of a week before, as two models of the hourly panel."""
    p = hourly(spark, sf_dir)
    shift = F.explode(F.array(F.struct(F.lit("day").alias("model"), F.lit(24).alias("s")), F.struct(F.lit("week").alias("model"), F.lit(168).alias("s"))))
    return p.select("entity", "h", "value", shift.alias("m")).select("entity", (F.col("h") + F.col("m.s")).alias("h"), "m.model", F.col("value").alias("yhat"))


FC = """fc AS (SELECT entity, h + s AS h, model, value AS yhat FROM h, (VALUES ('day', 24), ('week', 168)) m(model, s)),
sup AS (SELECT fc.entity, fc.h, model, yhat, h.value AS y, count(*) OVER (PARTITION BY fc.entity, fc.h) AS nm
  FROM fc JOIN h ON h.entity = fc.entity AND h.h = fc.h WHERE yhat IS NOT NULL AND h.value IS NOT NULL),
sc AS (SELECT entity, h, (h - 1) // 24 AS day, model, yhat, y, yhat - y AS err, abs(yhat - y) AS abs_err, yhat * 0.8 AS lo80, yhat * 1.2 AS hi80, yhat * 0.6 AS lo95, yhat * 1.4 AS hi95
  FROM sup WHERE nm = 2)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.evaluate import common_support

    out = common_support(forecasts(spark, sf_dir), hourly(spark, sf_dir).select("entity", "h", F.col("value").alias("y")), ["entity", "h"])
    out = out.withColumn("day", F.floor((F.col("h") - 1) / 24).cast("long"))
    return out.withColumns({"lo80": F.col("yhat") * 0.8, "hi80": F.col("yhat") * 1.2, "lo95": F.col("yhat") * 0.6, "hi95": F.col("yhat") * 1.4})


def flagged_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rows for cleaning: the hourly panel with a benchmark (the hour before) and a fallback (the day before)."""
    p = hourly(spark, sf_dir)
    at = lambda s, name: p.select("entity", (F.col("h") + s).alias("h"), F.col("value").alias(name))
    value = F.when(F.col("n") % 11 == 0, F.lit(None)).when(F.col("n") % 13 == 0, -F.col("value")).otherwise(F.col("value"))
    rows = p.join(at(1, "benchmark"), ["entity", "h"], "left").join(at(24, "fallback"), ["entity", "h"], "left")
    return rows.select("entity", "h", value.alias("value"), "benchmark", "fallback")


CLEAN = H + """, st AS (SELECT entity, h, CASE WHEN n % 11 = 0 THEN NULL WHEN n % 13 = 0 THEN -value ELSE value END AS value,
  max(value) OVER (PARTITION BY entity ORDER BY h RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS benchmark,
  max(value) OVER (PARTITION BY entity ORDER BY h RANGE BETWEEN 24 PRECEDING AND 24 PRECEDING) AS fallback FROM h),
md AS (SELECT *, median(CASE WHEN value > 0 THEN value END) OVER (PARTITION BY entity ORDER BY h RANGE BETWEEN 84 PRECEDING AND 84 FOLLOWING) AS median FROM st),
fl AS (SELECT *, value IS NULL AS is_missing, coalesce(value <= 0, false) AS is_nonpositive,
  coalesce(value > 0 AND (value < 0.2 * median OR value > 5 * median), false) AS is_outlier,
  coalesce(benchmark <= 0 OR benchmark > 5 * median, false) AS bad_benchmark FROM md)"""


def daily_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, day, y, lag7, lag2, level, lag_recent_ratio, lag7_ratio, weekday, doy_sin, doy_cos, temp): the daily panel with lags.

    ``level`` is the mean of the days from 8 to 2 before, five of them at least; ``temp`` the mean quantity shipped that day.
    """
    d = daily(spark, sf_dir)
    ship = F.unix_date(F.to_date("l_shipdate")).cast("long").alias("day")
    temp = table(spark, sf_dir, "lineitem").select(ship, "l_quantity").groupBy("day").agg(F.avg("l_quantity").alias("temp"))
    # Each value goes to the days that use it, so a group is one entity's day.
    use = F.explode(F.sequence(F.lit(2), F.lit(8))).alias("back")
    past = d.select("entity", "day", "value", use).select("entity", (F.col("day") + F.col("back")).alias("day"), "value", "back").groupBy("entity", "day").agg(
        F.avg("value").alias("level"), F.count("*").alias("n"), F.max(F.when(F.col("back") == 7, F.col("value"))).alias("lag7"), F.max(F.when(F.col("back") == 2, F.col("value"))).alias("lag2")
    )
    m = d.withColumnRenamed("value", "y").join(past, ["entity", "day"], "left").join(temp, "day", "left")
    m = m.withColumn("level", F.when(F.col("n") >= 5, F.col("level"))).drop("n")
    angle = F.dayofyear(F.date_from_unix_date(F.col("day").cast("int"))) * (2 * 3.141592653589793 / 365.25)
    ratio = lambda c: F.try_divide(F.col(c), F.col("level"))
    return m.select("entity", "day", "y", "lag7", "lag2", "level", ratio("lag2").alias("lag_recent_ratio"), ratio("lag7").alias("lag7_ratio"), ((F.col("day") + 3) % 7 + 1).cast("int").alias("weekday"), F.sin(angle).alias("doy_sin"), F.cos(angle).alias("doy_cos"), "temp")


DM = D + """, lq AS (SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS day, avg(l_quantity) AS temp FROM lineitem GROUP BY 1),
lw AS (SELECT a.entity, a.day, avg(b.value) AS level FROM d a JOIN d b ON b.entity = a.entity AND b.day BETWEEN a.day - 8 AND a.day - 2 GROUP BY ALL HAVING count(*) >= 5),
dm AS (SELECT d.entity, d.day, d.value AS y, b.value AS lag7, c.value AS lag2, level, c.value / nullif(level, 0) AS lag_recent_ratio, b.value / nullif(level, 0) AS lag7_ratio, CAST((d.day + 3) % 7 + 1 AS INT) AS weekday, temp
  FROM d LEFT JOIN d b ON b.entity = d.entity AND b.day = d.day - 7 LEFT JOIN d c ON c.entity = d.entity AND c.day = d.day - 2 LEFT JOIN lw ON lw.entity = d.entity AND lw.day = d.day LEFT JOIN lq ON lq.day = d.day)"""
