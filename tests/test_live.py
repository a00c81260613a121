"""Issuance, live scores and the build graph."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import build, evaluate, leaderboard
from tidemark.sources import issuance, runs
from tidemark.sources.store import DuplicateForecast

SCHEMA = "entity string, ts timestamp, issued_at timestamp, model string, target_day date, yhat double"


def at(day, hour=0):
    return dt.datetime(2025, 7, day, hour)


@pytest.fixture
def batch(spark):
    def make(day, model="m", hours=(1, 2, 3), entities="ab"):
        return spark.createDataFrame([(e, at(day, h), at(day - 1, 10), model, at(day).date(), None if h == 3 else float(h)) for e in entities for h in hours], SCHEMA)

    return make


def test_issuance_is_immutable_and_audited(spark, batch, tmp_path):
    root = f"file://{tmp_path}/store"
    assert issuance.stored(spark, root).count() == 0 and not issuance.has(spark, root, "2025-07-15", "m")
    one = issuance.issue(batch(15), root, at(14, 11), "p", "v1", "c1")
    assert (one.rows, one.entities, one.late_rows, one.null_forecasts, one.existed) == (6, 2, 6, 2, False)
    assert issuance.has(spark, root, "2025-07-15", "m")
    with pytest.raises(DuplicateForecast):
        issuance.issue(batch(15).withColumn("yhat", F.lit(0.0)), root, at(14, 9), "p", "v1")
    again = issuance.issue(batch(15), root, at(14, 9), "p", "v1", skip_existing=True)
    assert again.existed and again.rows == 0 and issuance.stored(spark, root).count() == 6
    assert issuance.issue(batch(16), root, at(15, 9), "p", "v2").late_rows == 0
    row = issuance.stored(spark, root).where("target_day = date'2025-07-16'").first()
    assert (row.model, row.protocol, row.model_version, row.code_version, row.late, row.q10) == ("m", "p", "v2", "unknown", False, None)
    assert issuance.asof(spark, root, at(14, 23)).count() == 6 and issuance.asof(spark, root, at(15, 23)).count() == 12
    assert issuance.asof(spark, root, at(15, 23), start="2025-07-16", models=["m"]).count() == 6
    assert not list((tmp_path / "store/_staged").glob("*"))


def test_refused_batches_leave_nothing(spark, batch, tmp_path):
    root = f"file://{tmp_path}/store"
    for bad, error in (
        (batch(15).unionByName(batch(16)), "one target day"), (batch(15).limit(0), "one target day"), (batch(15, "a/b"), "one target day"),
        (batch(15).unionByName(batch(15)), "repeated"), (batch(15).withColumn("issued_at", F.col("ts")), "too late"),
    ):
        with pytest.raises(ValueError, match=error):
            issuance.issue(bad, root, at(14, 9), "p", "v")
    broken = batch(15).withColumn("yhat", F.when(F.col("entity") == "b", F.raise_error(F.lit("stop")).cast("double")).otherwise(1.0))
    with pytest.raises(Exception, match="stop"):
        issuance.issue(broken, root, at(14, 9), "p", "v")
    assert not issuance.has(spark, root, "2025-07-15", "m")
    assert issuance.issue(batch(15), root, at(14, 9), "p", "v").rows == 6 and issuance.stored(spark, root).count() == 6


def test_a_claimed_batch_is_finished_by_the_next_writer(spark, batch, tmp_path):
    root = f"file://{tmp_path}/store"
    issuance.issue(batch(14), root, at(13, 9), "p", "v")
    (tmp_path / "store/target_day=2025-07-14/model=m").rename(tmp_path / "store/_staged/x")  # as if its writer had died
    (tmp_path / "store/target_day=2025-07-14").rmdir()
    for f in (tmp_path / "store/_claims").glob("*2025-07-14-m*"):
        f.unlink()
    runs._put(spark, f"{root}/_claims/2025-07-14-m", "x")
    assert issuance.issue(batch(14), root, at(13, 9), "p", "v", skip_existing=True).existed
    assert issuance.stored(spark, root).count() == 6


def test_reads_prune_partitions(spark, batch, tmp_path):
    root = f"file://{tmp_path}/store"
    for day in (15, 16, 17):
        issuance.issue(batch(day), root, at(day - 1, 9), "p", "v")
    df = issuance.asof(spark, root, at(20), start="2025-07-17", models=["m"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "target_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(df.inputFiles()) > 0 and df.count() == 6


def test_states_merge_and_reruns_replace(spark, tmp_path):
    path = f"file://{tmp_path}/states"
    rows = [(e, h, m, d, 100.0 + h * (1 + d % 3), None if h == 9 else 90.0 + 7 * h + d, h % 5 == 0) for e in "ab" for m in ("x", "z") for d in range(10) for h in range(24)]
    fc = spark.createDataFrame(rows, "entity string, h long, model string, day long, yhat double, y double, late boolean")
    scored = fc.where("y is not null").withColumn("err", F.col("yhat") - F.col("y")).withColumn("abs_err", F.abs("err"))
    assert leaderboard.leaderboard(leaderboard.read_states(spark, path)).count() == 0
    states = leaderboard.daily_states(leaderboard.scorable(scored, 1))
    leaderboard.write_states(states.withColumn("abs_sum", F.lit(0.0)), path, [2, 3, 4, 5])
    leaderboard.write_states(states, path, [4, 5, 6, 7, 8, 9])
    leaderboard.write_states(states, path, [2, 3])
    key = lambda df: {(r.entity, r.model): r for r in df.collect()}
    got, want = key(leaderboard.leaderboard(leaderboard.read_states(spark, path))), key(evaluate.point_metrics(scored.where("day > 1"), ["entity", "model"]))
    assert set(got) == set(want) and len(got) == 4
    for k, r in got.items():
        assert r.hours == want[k].hours == 8 * 23 and r.days == 8 and r.late_hours == 8 * 5
        assert all(abs(r[c] - want[k][c]) < 1e-9 for c in ("mae", "rmse", "mape", "bias"))
    leaderboard.write_states(states.where("day <> 9"), path, [9])
    assert leaderboard.leaderboard(leaderboard.read_states(spark, path)).first().days == 7


def test_graph_order_and_gates(spark, tmp_path):
    root = f"file://{tmp_path}/wh"
    src = {"raw": spark.range(10)}
    plus = lambda k: lambda t: next(iter(t.values())).select((F.col("id") + k).alias("id"))
    late = build.Check("small", rows=F.col("id") > 12)
    tables = [
        build.Table("c", ("b",), plus(1)),
        build.Table("b", ("a",), plus(2), (late,)),
        build.Table("a", ("raw",), plus(1), (build.Check("odd", rows=F.col("id") % 2 == 1, severity="warn"), build.Check("twice", table=lambda t, all_: t.groupBy("id").count().where("count > 1")))),
        build.Table("d", ("a", "raw"), lambda t: t["a"].join(t["raw"], "id", "left_anti")),
    ]
    assert [t.name for t in build.in_order(tables, {"raw"})] == ["a", "b", "d", "c"]
    with pytest.raises(ValueError, match="circle"):
        build.in_order([build.Table("x", ("y",), None), build.Table("y", ("x",), None)], set())
    with pytest.raises(ValueError, match="nothing makes"):
        build.in_order([build.Table("x", ("q",), None)], set())
    got = {b.name: b for b in build.build(spark, root, tables, src)}
    assert [got["a"].status, got["b"].status, got["c"].status, got["d"].status] == ["built", "built", "built", "built"]
    assert got["a"].rows == 10 and got["a"].failing == {"odd": 5, "twice": 0} and got["d"].rows == 1
    more = {b.name: b for b in build.build(spark, root, tables, {"raw": spark.range(20)})}
    assert more["b"].status == "failed" and more["b"].failing == {"small": 10} and more["c"].status == "skipped" and more["d"].status == "built"
    assert spark.read.parquet(f"{root}/b").count() == 10, "the earlier version stays"
    assert spark.read.parquet(f"{root}/a").count() == 20
    only = build.build(spark, root, tables, src, only={"b"})
    assert [b.name for b in only] == ["a", "b"]
    assert not list((tmp_path / "wh").glob("_*"))


def test_freshness(spark):
    rows = spark.createDataFrame([("a", at(1)), ("a", at(2)), ("b", at(1)), ("c", None)], "k string, t timestamp")
    got = {r.k: r for r in build.freshness(rows, ["k"], "t", at(3, 6), 36).collect()}
    assert got["a"].fresh and got["a"].age_hours == 30 and not got["b"].fresh and not got["c"].fresh and got["c"].age_hours is None
