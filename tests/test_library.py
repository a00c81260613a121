import datetime as dt
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import localtime as lt
from tidemark.operators import clean, evaluate, features, models, quality
from tidemark.sources import readers, store
from tidemark.streaming import pickup

UTC = dt.timezone.utc


def test_local_days_tile_and_have_23_to_25_hours(spark):
    zones = [("a", "America/New_York"), ("b", "Etc/GMT+5"), ("c", "Australia/Lord_Howe"), ("d", "America/Los_Angeles")]
    z = spark.createDataFrame(zones[:2] + zones[3:], "entity string, zone string")
    days = z.select("entity", F.explode(F.sequence(F.lit("2025-03-07").cast("date"), F.lit("2025-03-11").cast("date"))).alias("day"))
    sp = features.spine(days, z)
    n = {(r.entity, str(r.day)): r["count"] for r in sp.groupBy("entity", "day").count().collect()}
    assert n["a", "2025-03-09"] == 23 and n["b", "2025-03-09"] == 24 and n["a", "2025-03-10"] == 24
    for e in "abd":
        h = sorted(r.h for r in sp.where(f"entity = '{e}'").collect())
        assert h == list(range(h[0], h[0] + len(h)))


def test_wall_times_that_never_or_twice_exist_raise(spark):
    def at(day, minutes):
        return spark.sql(f"select date'{day}' as d, 'America/New_York' as z").select(lt.local_wall_time(F.col("d"), F.lit(minutes), F.col("z")).alias("t")).first().t

    assert at("2025-07-14", 600) == dt.datetime(2025, 7, 14, 14)
    for day, minutes in (("2025-03-09", 150), ("2025-11-02", 90)):
        with pytest.raises(Exception, match="no single instant"):
            at(day, minutes)


def test_protocol_and_leaks(spark):
    with pytest.raises(ValueError):
        features.Protocol(issue_minutes=60, cutoff_minutes=120)
    assert features.Protocol().recent == 2 and features.Protocol(cutoff_days=2).recent == 3
    panel = spark.range(24 * 40).select(F.lit("a").alias("entity"), (F.col("id") + 480_000).alias("h"), (F.col("id") % 24 + 1.0).alias("value"))
    z = spark.createDataFrame([("a", "America/Chicago")], "entity string, zone string")
    local = features.localised(panel, z)
    days = local.select("entity", "day").distinct().orderBy("day").limit(30)
    for protocol in (features.Protocol(), features.Protocol(cutoff_days=2)):
        m = features.build(panel, z, days, protocol)
        r = features.check_point_in_time(m).first()
        assert r.violations == 0 and r.cells > 0 and r.features == ""
    leaky = features.build(panel, z, days).withColumn("avail__y", F.col("h"))
    r = features.check_point_in_time(leaky).first()
    assert r.violations > 0 and r.features == "y"
    # Changing what is measured after the cutoff changes no feature of that origin.
    o = features.origins(days, z, features.Protocol()).orderBy(F.col("day").desc()).first()
    other = panel.withColumn("value", F.when(F.col("h") > o.cutoff, -1.0).otherwise(F.col("value")))
    pick = lambda p: [r.asDict() for r in features.build(p, z, days).where(F.col("day") == F.lit(o.day)).drop("y").orderBy("h").collect()]
    assert pick(panel) == pick(other)


def test_cleaning_rules(spark):
    rows = [("a", h, v, 10.0, 12.0) for h, v in enumerate([10.0, 11.0, 0.0, -3.0, None, 500.0, 9.0, 10.0, 12.0])] + [("a", 500, 7.0, 900.0, 1.0)]
    f = clean.flag(spark.createDataFrame(rows, "entity string, h long, value double, benchmark double, fallback double"))
    r = {x.h: x for x in clean.repair(f).collect()}
    assert r[4].is_missing and r[2].is_nonpositive and r[3].is_nonpositive and r[5].is_outlier and r[500].bad_benchmark
    assert r[0].clean == 10 and r[5].clean is None and r[5].filled == 12 and r[500].median == 7
    c = clean.clamp(F.col("x"), 0.0, 100.0)
    assert [x[0] for x in spark.createDataFrame([(-5.0,), (50.0,), (101.0,), (None,)], "x double").select(c).collect()] == [0, 50, 100, None]


def test_scores_closed_forms(spark):
    y = [(("a"), h, 100.0 + h) for h in range(24)]
    actual = spark.createDataFrame(y, "entity string, h long, y double")
    fc = spark.createDataFrame([("a", h, m, v + d) for _, h, v in y for m, d in (("x", 10.0), ("z", -5.0))], "entity string, h long, model string, yhat double")
    s = evaluate.common_support(fc, actual, ["entity", "h"])
    m = {r.model: r for r in evaluate.skill(evaluate.point_metrics(s, ["entity", "model"]), "x", ["entity"]).collect()}
    assert m["x"].mae == m["x"].rmse == 10 and m["z"].skill == 0.5
    some = fc.withColumn("yhat", F.when((F.col("model") == "x") & (F.col("h") < 5), None).otherwise(F.col("yhat")))
    assert evaluate.common_support(some, actual, ["entity", "h"]).count() == 38
    q = spark.range(11).agg(evaluate.nearest_quantile(F.col("id").cast("double"), 0.25).alias("q")).first().q
    assert q == 3.0


def test_statistics():
    rng = np.random.default_rng(0)
    a, b = np.abs(rng.normal(10, 1, 60)), np.abs(rng.normal(30, 3, 60))
    s, low, high = evaluate.bootstrap_skill(a, b, 17)
    assert low > 0.5 and low <= s <= high and evaluate.bootstrap_skill(a, b, 17) == (s, low, high)
    t, p = evaluate.diebold_mariano(a - b)
    assert t < 0 and p < 1e-6
    assert evaluate.diebold_mariano(np.ones(20)) == (0.0, 1.0) and math.isnan(evaluate.diebold_mariano(np.ones(5))[0])


def test_conformal_coverage(spark):
    rng = np.random.default_rng(1)
    rows = [("a", "m", d, float(1000 + rng.normal(0, 30)), 990.0, 1010.0) for d in range(400)]
    out = evaluate.conformal(spark.createDataFrame(rows, "entity string, model string, day long, y double, lo double, hi double")).collect()
    done = [r for r in out if r.move is not None]
    assert len(out) - len(done) == 22 and abs(np.mean([r.lo_cal <= r.y <= r.hi_cal for r in done]) - 0.8) < 0.06


def test_models_and_quality(spark):
    panel = spark.range(900).select(F.lit("a").alias("entity"), F.col("id").alias("day"), (100 + 10 * (F.col("id") % 7) + F.col("id") * 0.01).cast("double").alias("value"))
    back = models.ridge_backtest(panel).collect()
    assert back and all(r.mae / 130 < 0.05 for r in back)
    assert models.debias(panel.withColumn("benchmark", F.col("value") + 5)).where("day > 40").agg(F.max("yhat")).first()[0] < 180
    t = spark.createDataFrame([(1, 1), (1, 1), (2, None)], "k int, v int")
    assert quality.repeated(t, ["k"]).count() == 1 and quality.unequal(t, "k", "v").count() == 1 and quality.outside(t, "v", 5, 9).count() == 2
    assert quality.gaps(spark.createDataFrame([("a", 1), ("a", 5)], "entity string, h long")).first().missing == 3


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x,z\n3,4, \n")
    t = readers.csv_by_name(spark, [f"file://{tmp_path}/a.csv", f"file://{tmp_path}/b.csv"])
    got = {(r.x, r.y, r.z, r.source_file) for r in t.withColumn("z", readers.text_or_null("z")).collect()}
    assert got == {("1", "2", None, "a.csv"), ("4", "3", None, "b.csv")}
    (tmp_path / "w/PJM/city").mkdir(parents=True)
    (tmp_path / "w/PJM/city/1.json").write_text(json.dumps({"hourly": {"time": ["2025-01-01T00:00", "2025-01-01T01:00"], "t": [None, None]}}))
    rows = readers.json_series(spark, f"file://{tmp_path}/w/*/*", ["t"], r"/w/([A-Z]+)/([^/]+)/").collect()
    assert len(rows) == 2 and rows[0].entity == "PJM" and rows[0].place == "city" and rows[0].t is None
    (tmp_path / "w/PJM/city/2.json").write_text(json.dumps({"hourly": {"time": ["2025-01-01T00:00"], "t": []}}))
    with pytest.raises(Exception, match="unequal length"):
        readers.json_series(spark, f"file://{tmp_path}/w/*/*", ["t"], r"/w/([A-Z]+)/([^/]+)/").collect()
    (tmp_path / "l.jsonl").write_text('{"k":"a","n":1}\n{"k":"a","n":2}\n{"k":"b","n":1}\n')
    assert {(r.k, r.n) for r in readers.jsonl_latest(spark, f"file://{tmp_path}/l.jsonl", "k", "n", "k string, n long").collect()} == {("a", 2), ("b", 1)}
    with pytest.raises(Exception, match="13/45/2025"):
        spark.sql("select to_timestamp('13/45/2025 9:00:00 AM', 'MM/dd/yyyy h:mm:ss a') as t").collect()


def test_store_is_append_only_and_pickup_is_idempotent(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    schema = "entity string, ts timestamp, model string, issued_at timestamp, yhat double"
    at = lambda h: dt.datetime(2025, 7, 15, h, tzinfo=UTC)
    batch = store.audited(spark.createDataFrame([("a", at(10), "m", at(2), 1.0)], schema), at(3), "2025-07-15")
    store.append(batch, path)
    assert store.stored(spark, path).first().late is True
    with pytest.raises(store.DuplicateForecast):
        store.append(batch, path)
    with pytest.raises(store.DuplicateForecast):
        store.append(batch.withColumn("model", F.lit("n")).unionByName(batch.withColumn("model", F.lit("n"))), path)
    with pytest.raises(ValueError, match="too late"):
        store.append(batch.withColumn("issued_at", F.col("ts")), path)
    assert store.append_new(batch, path) == 0 and store.stored(spark, path).count() == 1
    inbox = f"file://{tmp_path}/inbox"
    batch.withColumn("model", F.lit("k")).write.parquet(inbox)
    ddl = ", ".join(f"{n} {t}" for n, t in batch.dtypes)
    for _ in range(2):
        pickup.follow(spark, inbox, ddl, path, f"{tmp_path}/ck{_}").awaitTermination()
    assert store.stored(spark, path).count() == 2


def test_medians_do_not_depend_on_blocks(spark):
    rng = np.random.default_rng(11)
    rows = [(e, int(h), float(v) if v > 1 else None, 1.0) for e in "ab" for h, v in zip(range(470_000, 472_500), rng.gamma(2, 5, 2500), strict=True) if h % 7]
    got = {(r.entity, r.h): r.median for r in clean.flag(spark.createDataFrame(rows, "entity string, h long, value double, benchmark double"), radius=40).collect()}
    assert len(got) == len(rows)
    for e in "ab":
        mine = [(h, v) for k, h, v, _ in rows if k == e]
        for h, _ in mine[::97]:
            assert got[e, h] == pytest.approx(np.median([v for k, v in mine if abs(k - h) <= 40 and v is not None]))
