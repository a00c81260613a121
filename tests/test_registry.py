"""Clocks, registry, spans, contracts, artefacts, ablations and read functions."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import localtime, registry
from tidemark.operators import ablation, backtest, evaluate, features, quality, trees
from tidemark.sources import api, artifacts, issuance, readers, runs, staging, store


def one(spark, expression, **columns):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])
    return df.select(expression.alias("x")).first().x


def test_clocks(spark):
    at = dt.datetime(2025, 1, 16, 4, 59, 59)
    ts = F.col("t").cast("timestamp")
    assert one(spark, localtime.floor_hour(ts), t="2025-01-16 04:59:59.9") == dt.datetime(2025, 1, 16, 4)
    assert one(spark, localtime.floor_hour(ts), t="1969-12-31 23:30:00") == dt.datetime(1969, 12, 31, 23)
    assert one(spark, localtime.to_local(ts, F.lit("America/Denver")), t=str(at)) == at - dt.timedelta(hours=7)
    assert one(spark, localtime.portal_stamp(F.col("t")), t=" 01/16/2025 4:00:00 AM ") == dt.datetime(2025, 1, 16, 4)
    assert one(spark, localtime.portal_stamp(F.col("t")), t="12/31/2024 12:00:00 PM") == dt.datetime(2024, 12, 31, 12)
    with pytest.raises(Exception, match="2025-01-16"):
        one(spark, localtime.portal_stamp(F.col("t")), t="2025-01-16 04:00")
    assert one(spark, localtime.default_target_day(ts), t="2025-01-16 04:59:00") == dt.date(2025, 1, 16)
    assert one(spark, localtime.default_target_day(ts), t="2025-01-16 05:00:00") == dt.date(2025, 1, 17)
    df = spark.sql("select timestamp'2025-01-01' as a, timestamp_ntz'2025-01-01' as b, '2025-01-01' as c")
    assert localtime.require_instants(df, "a") is df
    with pytest.raises(TypeError, match="b .timestamp_ntz., c .string."):
        localtime.require_instants(df, "a", "b", "c")


def test_registry(spark):
    assert [one(spark, registry.slug(F.col("t")), t=t) for t in ("St. Louis", " New--York ", "a", "!!", "Ünited")] == ["st-louis", "new-york", "a", "", "nited"]
    t = spark.createDataFrame([("x", "a", 1.0), ("x", "b", 3.0), ("y", "c", 0.0)], "g string, k string, w double")
    assert {(r.k, r.share) for r in registry.shares(t, "g", "w").collect()} == {("a", 0.25), ("b", 0.75), ("c", None)}
    assert registry.registered(t, "k", ["a", "c"]).count() == 2
    with pytest.raises(KeyError, match="q"):
        registry.registered(t, "k", ["a", "q"])
    with pytest.raises(ValueError, match="twice: x"):
        registry.registered(t, "g", ["x"])


def test_spans(spark):
    d = dt.date
    with pytest.raises(ValueError):
        registry.Span(d(2020, 1, 2), d(2020, 1, 1))
    a, b = registry.Span(d(2020, 1, 1), d(2020, 1, 31)), registry.Span(d(2020, 2, 2), d(2020, 2, 3))
    days = spark.createDataFrame([(d(2019, 12, 31),), (d(2020, 1, 1),), (d(2020, 1, 31),), (d(2020, 2, 1),), (d(2020, 2, 3),)], "day date")
    assert [r.s for r in days.select("day", registry.split(F.col("day"), {"a": a, "b": b}).alias("s")).orderBy("day").collect()] == [None, "a", "a", None, "b"]
    for spans in ({"b": b, "a": a}, {"a": a, "b": registry.Span(d(2020, 1, 31), d(2020, 2, 3))}):
        with pytest.raises(ValueError, match="must start after"):
            registry.split(F.col("day"), spans)
    c = registry.month_chunks(spark.createDataFrame([("x",), ("y",)], "k string"), d(2020, 1, 20), d(2020, 3, 5), d(2020, 3, 4), settle=3, columns=12).orderBy("position").collect()
    assert [(r.k, str(r.first), str(r.last), r.closed, r.weight, r.position) for r in c[:3]] == [("x", "2020-03-01", "2020-03-05", False, 2, 1), ("y", "2020-03-01", "2020-03-05", False, 2, 2), ("x", "2020-02-01", "2020-02-29", True, 6, 3)]
    assert len(c) == 6 and c[-1].weight == 2


def test_contracts_and_severities(spark):
    t = spark.createDataFrame([(1, "a", None)], "k long, v string, w double")
    bad = {tuple(r) for r in quality.contract(t, {"k": "bigint", "v": "int", "z": "string"}).collect()}
    assert bad == {("v", "type", "string"), ("z", "missing", None), ("w", "unexpected", "double")}
    assert quality.contract(t, {"k": "bigint"}, strict=False).count() == 0
    assert quality.judged("x", t, "warn").first().passed and not quality.judged("x", t).first().passed and quality.judged("x", t.limit(0)).first().passed
    with pytest.raises(ValueError):
        quality.judged("x", t, "fatal")


def test_protocols():
    assert features.Protocol.bulk().recent == 3 and features.Protocol.bulk().cutoff_minutes == 0
    with pytest.raises(ValueError, match="two days"):
        features.Protocol(weather_days=1)


def test_small_files(spark, tmp_path):
    schema = "a string, b double"
    path = f"file://{tmp_path}/r"
    assert readers.results(spark, path, schema).count() == 0
    store.save_table(spark.createDataFrame([("z", 1.23456), ("a", None), ("m", 2.0)], schema), path)
    assert [tuple(r) for r in readers.results(spark, path, schema).collect()] == [("a", None), ("m", 2.0), ("z", 1.2346)]
    with pytest.raises(Exception, match="exist"):
        store.save_table(spark.createDataFrame([("z", 1.0)], schema), path)
    (tmp_path / "l.jsonl").write_text('{"k":"a","n":1,"v":"x"}\n{"k":"a","n":2,"v":"p"}\n{"k":"a","n":2,"v":"q"}\n')
    assert {tuple(r) for r in readers.jsonl_latest(spark, f"file://{tmp_path}/l.jsonl", "k", "n", "k string, n long, v string").collect()} == {("a", 2, "q")}


def test_ledger_folder_needs_a_shared_place(spark):
    assert staging.folder(spark).startswith("file:")
    df = staging.written(spark.range(5), "t")
    assert df.count() == 5
    staging.deleted(df)
    with pytest.raises(Exception):
        spark.read.parquet(df.inputFiles()[0])


def test_artefacts(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = spark.createDataFrame([(float(a), "xy"[i % 2], float(a * 2 + i % 2)) for i, a in enumerate(rng.normal(size=200))], "a double, c string, y double")
    forest = trees.fit(rows, "y", ["a"], ["c"], trees.Params(rounds=3, depth=2, bins=8, least=5))
    path = f"file://{tmp_path}/model"
    manifest = artifacts.save(spark, path, forest, "morning", "2025-01-01")
    with pytest.raises(runs.RunExists):
        artifacts.save(spark, path, forest, "morning", "2025-01-01")
    back, read = artifacts.load(spark, path, ["a", "c"], "morning")
    assert read == manifest and manifest["heads"] == forest.heads
    key = lambda f: sorted(map(tuple, trees.predict(f, rows).collect()))
    assert key(back) == key(forest) and back.importance() == forest.importance()
    for wrong in (dict(features=["a"]), dict(protocol="bulk")):
        with pytest.raises(artifacts.ArtifactChanged):
            artifacts.load(spark, path, **wrong)
    file = tmp_path / "model/model.json"
    held = json.loads(file.read_text())
    held["start"][0] += 1
    file.write_text(json.dumps(held, sort_keys=True))
    for crc in (tmp_path / "model").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(artifacts.ArtifactChanged, match="differs"):
        artifacts.load(spark, path)


def test_ablations_pool_all_entities(spark):
    rng = np.random.default_rng(4)
    d0 = (dt.date(2020, 1, 1) - dt.date(1970, 1, 1)).days
    rows = [(e, d0 + i, float(v), float(v + rng.normal(0, 1)), float(v + rng.normal(0, 3)), (d0 + i) % 7) for e in "ab" for i in range(300) for v in [50 + rng.normal(0, 5)]]
    m = spark.createDataFrame(rows, "entity string, day long, y double, good double, poor double, weekday int")
    overall, comp = ablation.ablate(m, {"good": backtest.published("good"), "poor": backtest.published("poor")}, backtest.Plan(dt.date(2020, 8, 1), dt.date(2020, 10, 15)))
    mae = {r.model: r.mae for r in overall.collect()}
    got = {r.entity: r for r in comp.collect()}
    assert set(got) == {"a", "b", "ALL"} and all(r.days == 76 and r.high < 0 and r.p < 0.05 for r in got.values())
    assert abs(got["ALL"].skill - (1 - mae["poor"] / mae["good"])) < 1e-9
    inside = [r for r in rows if (dt.date(2020, 8, 1) - dt.date(1970, 1, 1)).days <= r[1] <= (dt.date(2020, 10, 15) - dt.date(1970, 1, 1)).days]
    sums = {}
    for r in inside:
        a, b = sums.get(r[1], (0.0, 0.0))
        sums[r[1]] = a + abs(r[4] - r[2]), b + abs(r[3] - r[2])
    loss, ref = (np.array([sums[k][i] for k in sorted(sums)]) for i in (0, 1))
    assert (got["ALL"].skill, got["ALL"].low, got["ALL"].high) == pytest.approx(evaluate.bootstrap_skill(loss, ref, 17))


def test_read_functions(spark, tmp_path):
    panel = spark.range(24 * 100).select(F.lit("a").alias("entity"), (F.col("id") + 1).alias("h"), F.col("id").cast("double").alias("value"))
    day = lambda n: dt.date(1970, 1, 1) + dt.timedelta(days=n)
    assert [r.h for r in api.series(panel, "a", day(2), day(3)).collect()] == list(range(49, 97))
    assert api.series(panel, "b", day(2), day(3)).count() == 0 and api.series(panel, "a", day(0), day(61)).count() == 62 * 24
    for a, b in ((day(0), day(62)), (day(3), day(2))):
        with pytest.raises(ValueError, match="1 to 62 days"):
            api.series(panel, "a", a, b)
    root = f"file://{tmp_path}"
    assert api.runs_under(spark, f"{root}/runs").count() == 0
    runs.write_run(spark, f"{root}/runs", {"models": ["m"], "window": ["2020-01-01", "2020-02-01"]}, {"forecasts": panel})
    assert [(r.models, r.start, r.end) for r in api.runs_under(spark, f"{root}/runs").collect()] == [("m", "2020-01-01", "2020-02-01")]
    batch = panel.where("h between 25 and 48").select("entity", F.timestamp_seconds(F.col("h") * 3600).alias("ts"), F.timestamp_seconds(F.lit(0)).alias("issued_at"), F.lit("m").alias("model"), F.lit(day(1)).alias("target_day"), (F.col("value") + 1).alias("yhat"))
    issuance.issue(batch, f"{root}/store", dt.datetime(1970, 1, 1), "p", "v")
    got = api.forecast(spark, f"{root}/store", panel.where("h < 40"), day(1), "a").collect()
    assert [r.h for r in got] == list(range(25, 49)) and all((r.y is None) == (r.h >= 40) and r.yhat == r.h for r in got)
    assert {r["name"]: r.ready for r in api.ready(spark, {"runs": f"{root}/runs", "no": f"{root}/no"}).collect()} == {"runs": True, "no": False}
