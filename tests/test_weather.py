"""Weather in the matrix: weights, availability, and independence of what was not yet available."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import holidays
from tidemark.operators import features, live

H0 = 480_000
ZONES = [("a", "America/Chicago"), ("b", "Etc/GMT+5")]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(6)
    panel = spark.createDataFrame([(e, H0 + i, rng.uniform(50, 90)) for e in "ab" for i in range(24 * 24)], "entity string, h long, value double").cache()
    weather = spark.createDataFrame([(e, H0 + i, rng.uniform(-5, 35), rng.uniform(0, 4)) for e in "ab" for i in range(24 * 24) if rng.random() < 0.9], "entity string, h long, temp double, temp_spread double").cache()
    zones = spark.createDataFrame(ZONES, "entity string, zone string")
    days = features.localised(panel, zones).select("entity", "day").distinct().where("day >= date'2024-10-15' and day <= date'2024-10-24'").cache()
    return panel, weather, zones, days


def test_weights_renormalise_over_present_places(spark):
    w = spark.createDataFrame([("a", 1, 10, 4.0), ("a", 2, 10, 10.0), ("a", 3, 10, 99.0), ("a", 1, 11, None), ("a", 2, 11, 6.0), ("a", 1, 12, None)], "entity string, place long, h long, temp double")
    p = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 3.0), ("b", 3, 5.0)], "entity string, place long, weight double")
    got = {r.h: r for r in features.places_weather(w, p).collect()}
    assert (got[10].temp, got[10].temp_unweighted, got[10].temp_spread, got[10].n_places) == (8.5, 7.0, 6.0, 2)
    assert (got[11].temp, got[11].n_places) == (6.0, 1) and (got[12].temp, got[12].temp_spread, got[12].n_places) == (None, None, 0)


def test_features_equal_direct_computation(spark, tables):
    panel, weather, zones, days = tables
    w = {(r.entity, r.h): r for r in weather.collect()}
    rows = features.build_all(panel, zones, days, weather).collect()
    assert len(rows) == 480
    by_day = {}
    for r in rows:
        by_day.setdefault((r.entity, r.day), []).append(w.get((r.entity, r.h)))
    for r in rows:
        at = lambda k: w.get((r.entity, r.h - k))  # noqa: B023, E731
        now, week, recent = at(0), at(168), at(48)
        prev, day = [x for x in map(at, (1, 2, 3)) if x], [x for x in by_day[r.entity, r.day] if x]
        assert r.temp == (now.temp if now else None) and r.temp_spread == (now.temp_spread if now else None)
        assert r.cdd == (max(0.0, now.temp - 18) if now else None) and r.hdd == (max(0.0, 18 - now.temp) if now else None)
        assert r.temp_delta_7d == (now.temp - week.temp if now and week else None) and r.avail__temp_delta_7d == (r.h - 42 if now and week else None)
        assert r.temp_recent == (recent.temp if recent else None) and r.avail__temp_recent == (r.h - 90 if recent else None)
        assert (r.temp_prev3h is None) == (not prev) and (not prev or abs(r.temp_prev3h - sum(x.temp for x in prev) / len(prev)) < 1e-9)
        assert r.avail__temp_prev3h == (max(x.h for x in prev) - 42 if prev else None)
        assert abs(r.temp_mean - sum(x.temp for x in day) / len(day)) < 1e-9 and (r.temp_max, r.temp_min) == (max(x.temp for x in day), min(x.temp for x in day))
        assert r.avail__temp_mean == max(x.h for x in day) - 42 and r.hours_in_day == 24 and not r.is_holiday
    assert {r.is_day_after_holiday for r in rows if str(r.day) == "2024-10-15"} == {True}


def test_no_weather_and_plain_means(spark, tables):
    panel, weather, zones, days = tables
    none = features.build_all(panel, zones, days, None)
    full = features.build_all(panel, zones, days, weather)
    assert sorted(none.columns) == sorted(full.columns) and none.where(" or ".join(f"{c} is not null or avail__{c} is not null" for c in features.WEATHER)).count() == 0
    plain = features.build_all(panel, zones, days, weather.withColumn("temp_unweighted", F.col("temp") + 1), weighted=False)
    assert plain.agg(F.avg("temp")).first()[0] == pytest.approx(full.agg(F.avg("temp")).first()[0] + 1)
    with pytest.raises(ValueError, match="no target hours"):
        features.build_all(panel, zones, days.limit(0), weather)


def test_what_is_not_available_changes_nothing(spark, tables):
    panel, weather, zones, days = tables
    o = features.origins(days, zones, features.Protocol()).where("entity = 'a'").orderBy(F.desc("day")).first()
    moved = weather.withColumn("temp", F.when((F.col("entity") == "a") & (F.col("h") - 42 > o.issued), -50.0).otherwise(F.col("temp")))
    pick = lambda w: [r.asDict() for r in features.build_all(panel, zones, days, w).where((F.col("entity") == "a") & (F.col("day") == F.lit(o.day))).orderBy("h").collect()]
    assert moved.where("temp = -50").count() > 0 and pick(weather) == pick(moved)
    assert features.check_point_in_time(features.build_all(panel, zones, days, weather)).first().violations == 0
    observed = features.build_all(panel, zones, days, weather).withColumn("avail__temp", F.col("h"))
    r = features.check_point_in_time(observed).first()
    assert r.features == "temp" and r.violations == 480


def test_issuing_a_day_checks_for_leaks(spark, tables, tmp_path):
    panel, weather, zones, days = tables
    m = features.build_all(panel, zones, days, weather)
    naive = lambda r: r.select("entity", "h", F.col("lag7").alias("yhat"))
    args = (f"file://{tmp_path}/s", dt.date(2024, 10, 20), "naive", dt.datetime(2024, 10, 18), "morning", "1")
    with pytest.raises(live.Leak, match="temp"):
        live.issue_day(m.withColumn("avail__temp", F.col("h")), naive, *args)
    assert live.issue_day(m, naive, *args).rows == 48
    with pytest.raises(ValueError, match="issued already"):
        live.issue_day(m, naive, *args)
    assert live.issue_day(m, naive, *args, skip_existing=True).existed


def test_known_holidays(spark):
    days = {  # dates from the published calendars
        "2024-01-01": "New Year's Day", "2024-01-15": "Martin Luther King Jr. Day", "2024-02-19": "Washington's Birthday", "2024-05-27": "Memorial Day",
        "2024-06-19": "Juneteenth National Independence Day", "2024-07-04": "Independence Day", "2024-09-02": "Labor Day", "2024-10-14": "Columbus Day", "2024-11-11": "Veterans Day",
        "2024-11-28": "Thanksgiving", "2024-12-25": "Christmas Day", "2023-11-10": "Veterans Day (observed)", "2022-06-20": "Juneteenth National Independence Day (observed)",
        "2021-12-31": "New Year's Day (observed)", "2021-07-05": "Independence Day (observed)", "2020-06-19": None, "2024-10-15": None,
    }
    df = spark.createDataFrame([(k,) for k in days], "d string")
    assert {r.d: r.n for r in df.select("d", holidays.holiday_name(F.col("d").cast("date")).alias("n")).collect()} == days
