"""Queries of readers, stores and streams over files that Spark writes from the given tables; clocks, registry, profiles."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..functions import localtime, registry
from ..operators import quality
from ..sources import readers, staging, store
from ..streaming import pickup
from . import panels as p
from .catalog import query, rounded
from .panels import table


def _place(s, what):
    return f"{staging.folder(s)}/{what}-{uuid.uuid4().hex}"


# --- readers ----------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS note FROM orders")
def csv_united(s, d):
    """Two sets of CSV files with columns in different order, one of which lacks a column and pads its texts."""
    o, root = table(s, d, "orders"), _place(s, "csv")
    key, price = F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_totalprice").cast("string").alias("o_totalprice")
    o.where("o_orderkey % 2 = 0").select(key, F.concat(F.lit(" "), "o_orderstatus", F.lit("  ")).alias("note"), price).write.option("header", True).csv(f"{root}/a")
    o.where("o_orderkey % 2 = 1").select(price, key).write.option("header", True).csv(f"{root}/b")
    t = readers.csv_by_name(s, [f"{root}/a", f"{root}/b"])
    return t.select(F.col("o_orderkey").cast("long"), F.col("o_totalprice").cast("double"), readers.text_or_null("note").alias("note"))


@query("""SELECT event_type AS entity, CAST(user_id % 3 AS VARCHAR) AS place, CAST(date_trunc('hour', ts) AS VARCHAR) AS ts, round(sum(value), 6) AS value, round(CASE WHEN count(*) > 1 THEN avg(value) END, 6) AS mean FROM events GROUP BY 1, 2, 3""")
def json_series_rows(s, d):
    """One JSON file for each entity and place with parallel arrays, read back as rows; names come from the path."""
    e = table(s, d, "events").groupBy(F.col("event_type").alias("entity"), (F.col("user_id") % 3).alias("place"), F.date_trunc("hour", "ts").alias("at"))
    e = e.agg(F.sum("value").alias("value"), F.when(F.count("*") > 1, F.avg("value")).alias("mean"))
    row = F.sort_array(F.collect_list(F.struct(F.date_format("at", "yyyy-MM-dd'T'HH:mm").alias("t"), "value", "mean")))
    root = _place(s, "json")
    docs = e.groupBy("entity", "place").agg(row.alias("r"))  # a file's rows: the hours of one entity and place
    hourly = F.struct(F.col("r.t").alias("time"), F.col("r.value").alias("value"), F.col("r.mean").alias("mean"))
    docs.select("entity", "place", hourly.alias("hourly")).write.option("ignoreNullFields", False).partitionBy("entity", "place").json(root)
    t = readers.json_series(s, f"{root}/entity=*/place=*", ["value", "mean"], r"/entity=([^/]+)/place=([^/]+)/")
    return rounded(t.select("entity", "place", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "value", "mean"))


@query("SELECT o_custkey AS k, max(o_orderkey) AS n, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1")
def ledger_latest(s, d):
    """The last entry of each customer in an append-only JSON-lines ledger of orders."""
    root = _place(s, "ledger")
    table(s, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("n"), F.col("o_orderstatus").alias("status")).write.json(root)
    return readers.jsonl_latest(s, root, "k", "n", "k long, n long, status string")


@query(f"WITH {p.H} SELECT entity, h, round(value, 6) AS value FROM h WHERE entity IN ('click', 'view') AND h > 473500 AND h <= 473700")
def typed_range_read(s, d):
    """Two entities and a half-open range of a mart, filtered in the scan, under its contract."""
    root = _place(s, "mart")
    p.hourly(s, d).select("entity", F.timestamp_seconds(F.col("h") * 3600).alias("ts"), "value").write.parquet(root)
    t = readers.typed_range(s, root, ["click", "view"], dt.datetime.fromtimestamp(473501 * 3600, dt.timezone.utc), dt.datetime.fromtimestamp(473701 * 3600, dt.timezone.utc))
    if (bad := quality.contract(t, {"entity": "string", "ts": "timestamp", "value": "double"}).collect()):
        raise ValueError(f"the mart breaks its contract: {bad}")
    return rounded(localtime.require_instants(t, "ts").select("entity", localtime.hours(F.col("ts")).alias("h"), "value"))


@query(f"WITH {p.H}, {p.FC}, mx AS (SELECT max((h - 1) // 24) AS m FROM fc) SELECT model, count(*) AS n, round(sum(yhat), 4) AS total, count(*) FILTER (WHERE model = 'week') AS late FROM fc, mx WHERE (h - 1) // 24 >= m - 1 GROUP BY model")
def stream_pickup(s, d):
    """Forecast files picked up by a stream, twice over: the second pass and a second stream add nothing."""
    root = _place(s, "stream")
    f = p.forecasts(s, d).withColumn("target_day", F.date_from_unix_date(F.floor((F.col("h") - 1) / 24).cast("int")))
    f = f.join(F.broadcast(f.agg(F.date_sub(F.max("target_day"), 1).alias("from"))), F.col("target_day") >= F.col("from"))  # one row
    issued = F.col("target_day").cast("timestamp") - F.expr("interval 14 hours")
    rows = f.select("entity", F.timestamp_seconds(F.col("h") * 3600).alias("ts"), "model", issued.alias("issued_at"), "yhat", "target_day")
    hour = F.when(F.col("model") == "day", F.expr("interval 1 hour")).otherwise(-F.expr("interval 1 hour"))
    rows = rows.withColumns({"created_at": F.col("issued_at") - hour}).withColumn("late", F.col("created_at") > F.col("issued_at"))
    rows.write.parquet(f"{root}/inbox")
    ddl = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    for checkpoint in ("a", "a", "b"):
        pickup.follow(s, f"{root}/inbox", ddl, f"{root}/store", f"{root}/{checkpoint}").awaitTermination()
    g = store.stored(s, f"{root}/store").groupBy("model")
    return rounded(g.agg(F.count("*").alias("n"), F.sum("yhat").alias("total"), F.count_if("late").alias("late")), 4)


# --- clocks, registry, contracts --------------------------------------------------------------------------------------


@query(f"""WITH {p.Z} SELECT event_id, CAST(date_trunc('hour', ts) AS VARCHAR) AS hour, CAST(date_trunc('second', ts) AS VARCHAR) AS stamp, CAST(date_trunc('second', timezone(zone, timezone('UTC', ts))) AS VARCHAR) AS local,
CAST(CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) + 1 AS VARCHAR) AS target FROM events JOIN z ON entity = event_type""")
def clock_conversions(s, d):
    """An instant's hour, its portal stamp parsed back, its wall clock in its entity's zone, and the day to forecast then."""
    e = table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp")).join(p.zones(s, d), F.col("event_type") == F.col("entity"))
    text = F.concat(F.lit(" "), F.date_format("ts", "MM/dd/yyyy h:mm:ss a"), F.lit(" "))
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return localtime.require_instants(e, "ts").select(
        "event_id", at(localtime.floor_hour(F.col("ts"))).alias("hour"), at(localtime.portal_stamp(text)).alias("stamp"),
        at(localtime.to_local(F.col("ts"), F.col("zone"))).alias("local"), localtime.default_target_day(F.col("ts")).cast("string").alias("target"),
    )


SPANS = {"train": registry.Span(dt.date(1995, 1, 1), dt.date(1998, 12, 31)), "validation": registry.Span(dt.date(1999, 1, 1), dt.date(1999, 12, 31)), "test": registry.Span(dt.date(2000, 2, 1), dt.date(2000, 12, 31))}


@query("SELECT CASE WHEN o_orderdate < DATE '1999-01-01' THEN 'train' WHEN o_orderdate < DATE '2000-01-01' THEN 'validation' WHEN o_orderdate >= DATE '2000-02-01' AND o_orderdate < DATE '2001-01-01' THEN 'test' END AS split, count(*) AS n FROM orders GROUP BY 1")
def split_counts(s, d):
    return table(s, d, "orders").groupBy(registry.split(F.to_date("o_orderdate"), SPANS).alias("split")).agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) SELECT n_nationkey, trim(regexp_replace(lower(n_name || ' (' || r_name || ')'), '[^a-z0-9]+', '-', 'g'), '-') AS slug, round(n / sum(n) OVER (PARTITION BY n_regionkey), 6) AS share
FROM nation JOIN region ON r_regionkey = n_regionkey JOIN c ON c_nationkey = n_nationkey WHERE r_name IN ('ASIA', 'EUROPE')""")
def registry_shares(s, d):
    """Slugs of nations and their share of their region's customers, for two registered regions."""
    regions = registry.registered(table(s, d, "region"), "r_name", ["ASIA", "EUROPE"])
    n = table(s, d, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    n = n.join(table(s, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n")), "n_nationkey")
    named = n.withColumn("slug", registry.slug(F.concat("n_name", F.lit(" ("), "r_name", F.lit(")"))))
    return rounded(registry.shares(named, "n_regionkey", "n").select("n_nationkey", "slug", "share"))


@query("""WITH g AS (SELECT DISTINCT c_nationkey FROM customer), o AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders),
m AS (SELECT CAST(unnest(generate_series(date_trunc('month', a), z, INTERVAL 1 MONTH)) AS DATE) AS m, a, z FROM o), c AS (SELECT c_nationkey, greatest(m, a) AS first, least(last_day(m), z) AS last, z FROM g, m)
SELECT c_nationkey, first::VARCHAR AS first, last::VARCHAR AS last, last + 5 < z AS closed, CAST(ceil((last - first + 1) / 14) * 2 AS INT) AS weight, row_number() OVER (ORDER BY first DESC, c_nationkey) AS position FROM c""")
def month_chunk_plan(s, d):
    """Downloads by nation and month over the span of the orders, newest first; months of the last five days are open."""
    a, z = table(s, d, "orders").agg(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    c = registry.month_chunks(table(s, d, "customer").select("c_nationkey").distinct(), a, z, z, settle=5, columns=17)
    return c.select("c_nationkey", F.col("first").cast("string"), F.col("last").cast("string"), "closed", "weight", "position")


_EXPECTED = {"o_orderkey": "bigint", "o_custkey": "int", "o_orderdate": "timestamp", "o_note": "string"}


@query("""WITH f AS (SELECT column_name AS field, lower(column_type) AS found FROM (DESCRIBE orders)), e(field, want) AS (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'int'), ('o_orderdate', 'timestamp'), ('o_note', 'string'))
SELECT e.field, CASE WHEN f.field IS NULL THEN 'missing' ELSE 'type' END AS rule, found FROM e LEFT JOIN f ON f.field = e.field WHERE found IS DISTINCT FROM want
UNION ALL SELECT f.field, 'unexpected', CASE found WHEN 'varchar' THEN 'string' ELSE found END FROM f WHERE field NOT IN (SELECT field FROM e)""")
def contract_columns(s, d):
    """Columns that break a contract: one missing, one of another type, and those it doesn't name."""
    o = table(s, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    return quality.contract(o, _EXPECTED)


@query("""SELECT 'price' AS "check", 'warn' AS severity, count(*) AS failing, true AS passed FROM orders WHERE o_totalprice > 400000 UNION ALL SELECT 'flag', 'error', count(*), count(*) = 0 FROM lineitem WHERE l_returnflag IS NOT DISTINCT FROM l_linestatus
UNION ALL SELECT 'orphans', 'error', count(*), count(*) = 0 FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def check_severities(s, d):
    o, l = table(s, d, "orders"), table(s, d, "lineitem")
    checks = quality.judged("price", o.where("o_totalprice > 400000"), "warn")
    checks = checks.unionByName(quality.judged("flag", l.where("l_returnflag <=> l_linestatus")))
    return checks.unionByName(quality.judged("orphans", quality.orphans(l, "l_orderkey", o, "o_orderkey")))


# --- profile ----------------------------------------------------------------------------------------------------------


@query(f"""WITH {p.CLEAN} SELECT entity, count(*) AS hours, (SELECT CAST(CAST(to_timestamp((min(f.h) - 1) * 3600) AS DATE) AS VARCHAR) FROM fl f WHERE f.entity = fl.entity) AS first_day, CAST(CAST(to_timestamp((max(h) - 1) * 3600) AS DATE) AS VARCHAR) AS last_day,
round(100 * avg(CASE WHEN is_missing OR is_nonpositive OR is_outlier THEN 0 ELSE 1 END), 6) AS target_pct, round(100 * avg(CASE WHEN benchmark IS NOT NULL AND NOT bad_benchmark THEN 1 ELSE 0 END), 6) AS benchmark_pct FROM fl GROUP BY entity""")
def profile_panel(s, d):
    """Hours, first and last day, and shares of usable targets and benchmarks by entity."""
    from ..operators import clean

    r = clean.repair(clean.flag(p.flagged_panel(s, d)))
    day = lambda h: F.to_date(F.timestamp_seconds((h - 1) * 3600)).cast("string")
    share = lambda c: F.avg(F.col(c).isNotNull().cast("int")) * 100
    g = r.groupBy("entity").agg(F.count("*").alias("hours"), day(F.min("h")).alias("first_day"), day(F.max("h")).alias("last_day"), share("clean").alias("target_pct"), share("benchmark_ok").alias("benchmark_pct"))
    return rounded(g)


@query(f"""WITH {p.D}, sp AS (SELECT min(day) AS a, max(day) AS z FROM d), g AS (SELECT entity, unnest(generate_series(a, z)) AS day FROM (SELECT DISTINCT entity FROM d), sp)
SELECT g.entity, CAST(year(DATE '1970-01-01' + CAST(g.day AS INT)) AS INT) AS year, round(100 * avg(CASE WHEN d.value IS NULL THEN 0 ELSE 1 END), 6) AS pct FROM g LEFT JOIN d ON d.entity = g.entity AND d.day = g.day GROUP BY 1, 2""")
def profile_coverage_by_year(s, d):
    """Share of days with a value by entity and year, over the span of all."""
    panel = p.daily(s, d)
    span = panel.agg(F.min("day").alias("a"), F.max("day").alias("z"))
    grid = panel.select("entity").distinct().join(F.broadcast(span)).select("entity", F.explode(F.sequence("a", "z")).alias("day"))  # one row
    rows = grid.join(panel, ["entity", "day"], "left")
    return rounded(rows.groupBy("entity", F.year(F.date_from_unix_date(F.col("day").cast("int"))).alias("year")).agg((F.avg(F.col("value").isNotNull().cast("int")) * 100).alias("pct")))


_LAGGED = f"{p.D}, e AS (SELECT a.entity, a.day, a.value AS y, b.value AS f, DATE '1970-01-01' + CAST(a.day AS INT) AS date FROM d a JOIN d b ON b.entity = a.entity AND b.day = a.day - 7 WHERE a.value > 0)"


def _lagged(s, d):
    from ..operators import models

    panel = p.daily(s, d)
    rows = panel.join(models.seasonal_naive(panel, 7), ["entity", "day"]).where("value > 0")
    return rows.withColumns({"date": F.date_from_unix_date(F.col("day").cast("int")), "pe": (F.col("yhat") - F.col("value")) / F.col("value")})


@query(f"WITH {_LAGGED} SELECT entity, CAST(isodow(date) AS INT) AS weekday, round(100 * avg((f - y) / y), 4) AS bias_pct, round(avg(y), 2) AS mean_value, round(avg(f), 2) AS mean_forecast FROM e GROUP BY 1, 2")
def profile_bias_by_slot(s, d):
    g = _lagged(s, d).groupBy("entity", (F.weekday("date") + 1).alias("weekday")).agg((F.avg("pe") * 100).alias("bias_pct"), F.round(F.avg("value"), 2).alias("mean_value"), F.round(F.avg("yhat"), 2).alias("mean_forecast"))
    return rounded(g, 4)


@query(f"WITH {_LAGGED} SELECT entity, strftime(date, '%Y-%m') AS month, round(100 * avg((f - y) / y), 4) AS bias_pct, round(100 * avg(abs(f - y) / y), 4) AS mape FROM e WHERE date BETWEEN DATE '1999-01-01' AND DATE '2000-06-30' GROUP BY 1, 2")
def profile_bias_by_month(s, d):
    """Monthly bias of the benchmark over a span, where a step change would show."""
    r = _lagged(s, d).where(F.col("date").between(dt.date(1999, 1, 1), dt.date(2000, 6, 30)))
    return rounded(r.groupBy("entity", F.date_format("date", "yyyy-MM").alias("month")).agg((F.avg("pe") * 100).alias("bias_pct"), (F.avg(F.abs("pe")) * 100).alias("mape")), 4)


@query(f"""WITH {p.H}, w AS (SELECT entity, h FROM h WHERE n % 4 <> 0), t AS (SELECT entity, h, lag(h) OVER (PARTITION BY entity ORDER BY h) AS prev FROM w)
SELECT prev + 1 AS gap_start, h - 1 AS gap_end, h - prev - 1 AS missing_hours, count(DISTINCT entity) AS entities FROM t WHERE h - prev > 3 GROUP BY prev, h""")
def profile_long_gaps(s, d):
    """Gaps of more than two hours, and how many entities share each."""
    gaps = quality.gaps(p.hourly(s, d).where("n % 4 <> 0"), longest=3)
    return gaps.groupBy((F.col("prev") + 1).alias("gap_start"), (F.col("h") - 1).alias("gap_end"), F.col("missing").alias("missing_hours")).agg(F.count_distinct("entity").alias("entities"))


@query(f"WITH {p.H} SELECT entity, h, round(value, 6) AS value, n FROM h WHERE entity = 'view' AND h > 19730 * 24 AND h <= 19735 * 24")
def series_read(s, d):
    """Five days of one entity's panel."""
    from ..sources import api

    day = lambda n: dt.date(1970, 1, 1) + dt.timedelta(days=n)
    return rounded(api.series(p.hourly(s, d).select("entity", "h", "value", "n"), "view", day(19730), day(19734)))
