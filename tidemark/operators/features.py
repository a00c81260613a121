"""Point-in-time features: every value travels with the instant at which it became available.

Panels are (entity, h, value[, temp]) with h the hour number (UTC) at which the hour ends. A zone table gives each entity
its clock. ``avail`` columns are hour numbers; a feature is admissible if its avail isn't after the origin's issue.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.localtime import hour_ending_instants, hours, local_day_of, local_hour_of, local_wall_time


@dataclass(frozen=True)
class Protocol:
    """When a forecast for day D is issued and how far back values are known, on the local clock of the day before."""

    issue_minutes: int = 10 * 60
    cutoff_minutes: int = 6 * 60
    cutoff_days: int = 1
    weather_days: int = 2  # a weather forecast is at least so many days old when its hour comes

    @staticmethod
    def bulk() -> Protocol:
        """Values are known up to the midnight at which the day two days before the target begins."""
        return Protocol(cutoff_days=2, cutoff_minutes=0)

    def __post_init__(self) -> None:
        if self.weather_days < 2:
            raise ValueError("weather forecasts of less than two days ahead are not available at the issue")
        if self.cutoff_days < 1 or (self.cutoff_days == 1 and self.cutoff_minutes > self.issue_minutes):
            raise ValueError("the cutoff may not be after the issue")

    @property
    def recent(self) -> int:
        """Days back to the latest day that is known in full."""
        return self.cutoff_days + 1


def spine(days: DataFrame, zones: DataFrame) -> DataFrame:
    """(entity, zone, day, h, hour_number, local_hour): every hour of local days, 23 to 25 of them."""
    rows = days.join(zones, "entity")
    rows = rows.select("entity", "zone", "day", F.posexplode(hour_ending_instants(F.col("day"), F.col("zone"))).alias("i", "ts"))
    return rows.select("entity", "zone", "day", hours(F.col("ts")).alias("h"), (F.col("i") + 1).alias("hour_number"), local_hour_of(F.col("ts"), F.col("zone")).alias("local_hour"))


def origins(days: DataFrame, zones: DataFrame, protocol: Protocol) -> DataFrame:
    """(entity, day, issued, cutoff) as hour numbers."""
    rows = days.join(zones, "entity")
    at = lambda back, minutes: hours(local_wall_time(F.date_sub("day", back), F.lit(minutes), F.col("zone")))
    return rows.select("entity", "day", at(1, protocol.issue_minutes).alias("issued"), at(protocol.cutoff_days, protocol.cutoff_minutes).alias("cutoff"))


def localised(panel: DataFrame, zones: DataFrame) -> DataFrame:
    rows = panel.join(zones, "entity")
    ts = F.timestamp_seconds(F.col("h") * 3600)
    return rows.withColumn("day", local_day_of(ts, F.col("zone"))).withColumn("local_hour", local_hour_of(ts, F.col("zone"))).drop("zone")


def same_hour(local: DataFrame, back: int, name: str) -> DataFrame:
    """The value ``back`` days before at the same wall-clock hour; a repeated hour counts as its mean."""
    g = local.groupBy("entity", "day", "local_hour").agg(F.avg("value").alias(name), F.max("h").alias(f"src__{name}"))
    return g.withColumn("day", F.date_add("day", back))


def day_profile(local: DataFrame) -> DataFrame:
    return local.groupBy("entity", "day").agg(F.avg("value").alias("mean"), F.max("value").alias("peak"), F.max("h").alias("last"), F.count("value").alias("n"))


def level(profile: DataFrame, recent: int, span: int = 7, least: int = 5) -> DataFrame:
    """Mean of daily means over ``span`` days that end ``recent`` days before."""
    shift = F.explode(F.sequence(F.lit(recent), F.lit(recent + span - 1)))
    far = profile.where("mean is not null").select("entity", "mean", "last", F.expr("day").alias("d"), shift.alias("s"))
    far = far.select("entity", F.expr("date_add(d, s)").alias("day"), "mean", "last")
    g = far.groupBy("entity", "day").agg(F.avg("mean").alias("level_7d"), F.max("last").alias("src__level_7d"), F.count("*").alias("n"))
    return g.where(F.col("n") >= least).drop("n")


def recent_peak(profile: DataFrame, recent: int) -> DataFrame:
    return profile.select("entity", F.date_add("day", recent).alias("day"), F.col("peak").alias("recent_peak"), F.col("last").alias("src__recent_peak"))


def partial_and_last(local: DataFrame, origin: DataFrame, protocol: Protocol, reach: int = 6) -> DataFrame:
    """Mean of the cutoff day's hours up to the cutoff, and the value at the latest hour within ``reach`` hours of it."""
    known = local.select("entity", F.col("day").alias("src_day"), "h", "value")
    o = origin.withColumn("src_day", F.date_sub("day", protocol.cutoff_days))
    part = o.join(known, ["entity", "src_day"]).where("h <= cutoff").groupBy("entity", "day").agg(F.avg("value").alias("partial_mean"), F.max("h").alias("src__partial_mean"))
    # The hours within reach of a cutoff, as equality on the hour.
    at = o.select("entity", "day", F.explode(F.sequence(F.col("cutoff") - (reach - 1), F.col("cutoff"))).alias("h"))
    last = at.join(known.select("entity", "h", "value"), ["entity", "h"]).groupBy("entity", "day").agg(
        F.max_by(F.struct("value"), "h")["value"].alias("last_known"), F.max("h").alias("src__last_known")
    )
    return last.join(part, ["entity", "day"], "left")


def temperature(target: DataFrame, panel: DataFrame, recent: int, lead: int = 42) -> DataFrame:
    """Exact-hour temperature with degree hours, its day's mean and extremes, and differences to earlier hours."""
    t = panel.where("temp is not null").select("entity", "h", "temp")
    out = target.join(t, ["entity", "h"], "left")
    out = out.withColumn("cdd", F.when(F.col("temp").isNotNull(), F.greatest(F.col("temp") - 18, F.lit(0.0)))).withColumn("hdd", F.when(F.col("temp").isNotNull(), F.greatest(18 - F.col("temp"), F.lit(0.0))))
    day = out.groupBy("entity", "day").agg(F.avg("temp").alias("temp_mean"), F.max("temp").alias("temp_max"), F.min("temp").alias("temp_min"))
    out = out.join(day, ["entity", "day"])
    shifted = lambda d, name: t.select("entity", (F.col("h") + d).alias("h"), F.col("temp").alias(name))
    out = out.join(shifted(168, "__week"), ["entity", "h"], "left").join(shifted(24 * recent, "temp_recent"), ["entity", "h"], "left")
    prev = t.select("entity", F.explode(F.sequence(F.col("h") + 1, F.col("h") + 3)).alias("h"), "temp").groupBy("entity", "h").agg(F.avg("temp").alias("temp_prev3h"))
    out = out.join(prev, ["entity", "h"], "left")
    out = out.withColumn("temp_delta_7d", F.col("temp") - F.col("__week")).withColumn("temp_delta_recent", F.col("temp") - F.col("temp_recent"))
    return out.drop("__week").withColumn("avail__temp", F.when(F.col("temp").isNotNull(), F.col("h") - lead))


def places_weather(weather: DataFrame, places: DataFrame) -> DataFrame:
    """(entity, h, temp, temp_unweighted, temp_spread, n_places) of (entity, place, h, temp) rows and (entity, place, weight).

    The weighted mean renormalises over the places that have a value in that hour; hours in which none has are null.
    """
    from .clean import weighted_mean

    rows = weather.join(places, ["entity", "place"])
    return rows.groupBy("entity", "h").agg(
        weighted_mean(F.col("temp"), F.col("weight")).alias("temp"), F.avg("temp").alias("temp_unweighted"), (F.max("temp") - F.min("temp")).alias("temp_spread"), F.count("temp").alias("n_places")
    )


WEATHER = (
    "temp", "temp_spread", "cdd", "hdd", "temp_mean", "temp_max", "temp_min", "temp_delta_7d", "temp_prev3h", "temp_recent", "temp_delta_recent",
)


def add_weather(target: DataFrame, weather: DataFrame | None, recent: int, weighted: bool = True, lead: int = 42, comfort: float = 18.0) -> DataFrame:
    """``target`` (entity, day, h, ...) with all weather features and ``avail__f`` of each one, the latest of what it is made from.

    A forecast temperature for hour s is available ``lead`` hours before. ``weighted`` picks the weighted mean of places or the
    plain one. Without a weather table all features and their avail columns are null.
    """
    if weather is None:
        return target.withColumns({c: F.lit(None).cast("double") for c in WEATHER} | {f"avail__{c}": F.lit(None).cast("long") for c in WEATHER})
    source = "temp" if weighted or "temp_unweighted" not in weather.columns else "temp_unweighted"
    spread = F.col("temp_spread") if "temp_spread" in weather.columns else F.lit(None).cast("double")
    w = weather.select("entity", "h", F.col(source).alias("temp"), spread.alias("temp_spread")).where("temp is not null").withColumn("avail", F.col("h") - lead)
    # One row of the weather goes to each hour that uses it; a group is one entity's hour.
    uses = F.explode(F.array(*map(F.lit, (0, 1, 2, 3, 24 * recent, 168)))).alias("back")
    u = w.select("*", uses).withColumn("h", F.col("h") + F.col("back"))
    at = lambda back, c: F.max(F.when(F.col("back") == back, F.col(c)))
    before = F.col("back").between(1, 3)
    if 24 * recent in (1, 2, 3, 168):
        raise ValueError("the recent day must differ from the week before")
    hourly = u.groupBy("entity", "h").agg(
        at(0, "temp").alias("temp"), at(0, "temp_spread").alias("temp_spread"), at(0, "avail").alias("avail__temp"), at(168, "temp").alias("__week"), at(168, "avail").alias("__week_at"),
        at(24 * recent, "temp").alias("temp_recent"), at(24 * recent, "avail").alias("avail__temp_recent"), F.avg(F.when(before, F.col("temp"))).alias("temp_prev3h"), F.max(F.when(before, F.col("avail"))).alias("avail__temp_prev3h"),
    )
    out = target.join(hourly, ["entity", "h"], "left")
    days = out.groupBy("entity", "day").agg(F.avg("temp").alias("temp_mean"), F.max("temp").alias("temp_max"), F.min("temp").alias("temp_min"), F.max("avail__temp").alias("__day_at"))
    out = out.join(days, ["entity", "day"], "left")
    # The later of two instants, null if either value is missing.
    both = lambda a, b: F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.greatest(a, b))
    above = lambda x: F.when(F.col("temp").isNotNull(), F.greatest(x, F.lit(0.0)))
    out = out.withColumns({
        "cdd": above(F.col("temp") - comfort), "hdd": above(comfort - F.col("temp")), "temp_delta_7d": F.col("temp") - F.col("__week"), "temp_delta_recent": F.col("temp") - F.col("temp_recent"),
        "avail__temp_spread": F.when(F.col("temp_spread").isNotNull(), F.col("avail__temp")), "avail__cdd": F.col("avail__temp"), "avail__hdd": F.col("avail__temp"),
        "avail__temp_delta_7d": both("avail__temp", "__week_at"), "avail__temp_delta_recent": both("avail__temp", "avail__temp_recent"),
        **{f"avail__{c}": F.col("__day_at") for c in ("temp_mean", "temp_max", "temp_min")},
    })
    return out.drop("__week", "__week_at", "__day_at")


def add_holidays(target: DataFrame) -> DataFrame:
    """``target`` with is_holiday, is_day_after_holiday and hours_in_day of its local days."""
    from ..functions import holidays

    named = lambda d: holidays.holiday_name(d).isNotNull()
    out = target.withColumns({"is_holiday": named(F.col("day")), "is_day_after_holiday": named(F.date_sub("day", 1))})
    n = target.groupBy("entity", "day").agg(F.count("*").alias("hours_in_day"))
    return out.join(n, ["entity", "day"])


def build_all(panel: DataFrame, zones: DataFrame, days: DataFrame, weather: DataFrame | None, protocol: Protocol = Protocol(), weighted: bool = True) -> DataFrame:
    """The whole matrix: lags, calendar with holidays, and weather, each with its avail column. Raises if there is no target hour."""
    out = add_holidays(build(panel, zones, days, protocol))
    out = add_weather(out, weather, protocol.recent, weighted)
    if out.isEmpty():
        raise ValueError("no target hours")
    return out


def calendar(day: Column, prefix: str = "") -> dict[str, Column]:
    doy = F.dayofyear(day) * (2 * 3.141592653589793 / 365.25)
    weekday = F.weekday(day) + 1
    return {f"{prefix}weekday": weekday, f"{prefix}is_weekend": weekday >= 6, f"{prefix}month": F.month(day), f"{prefix}doy_sin": F.sin(doy), f"{prefix}doy_cos": F.cos(doy)}


LAGS = ("lag_recent", "lag7", "level_7d", "recent_peak", "partial_mean", "last_known")


def build(panel: DataFrame, zones: DataFrame, days: DataFrame, protocol: Protocol = Protocol()) -> DataFrame:
    """The feature matrix: one row for each entity, day and hour, ``avail__f`` beside each lagged feature f.

    A value measured in hour s becomes available s + (issued - cutoff) hours: publication takes as long as from the
    cutoff to the issue.
    """
    local = localised(panel, zones)
    profile = day_profile(local)
    o = origins(days, zones, protocol)
    out = spine(days, zones).join(o, ["entity", "day"])
    out = out.join(same_hour(local, protocol.recent, "lag_recent"), ["entity", "day", "local_hour"], "left")
    out = out.join(same_hour(local, 7, "lag7"), ["entity", "day", "local_hour"], "left")
    for part in (level(profile, protocol.recent), recent_peak(profile, protocol.recent), partial_and_last(local, o, protocol)):
        out = out.join(part, ["entity", "day"], "left")
    delay = F.col("issued") - F.col("cutoff")
    out = out.withColumns({f"avail__{f}": F.col(f"src__{f}") + delay for f in LAGS}).drop(*[f"src__{f}" for f in LAGS])
    ratio = lambda a: F.try_divide(F.col(a), F.col("level_7d"))
    out = out.withColumns({f"{a}_ratio": ratio(a) for a in ("lag_recent", "lag7", "partial_mean", "last_known")})
    out = out.withColumns({f"avail__{a}_ratio": F.greatest(f"avail__{a}", "avail__level_7d") for a in ("lag_recent", "lag7", "partial_mean", "last_known")})
    out = out.withColumns(calendar(F.col("day")))
    return out.join(panel.select("entity", "h", F.col("value").alias("y")), ["entity", "h"], "left")


def check_point_in_time(matrix: DataFrame) -> DataFrame:
    """One row: rows, cells with an avail, origins, violations, the worst margin in hours and the offending features."""
    names = [c for c in matrix.columns if c.startswith("avail__")]
    late = lambda c: F.count_if(F.col(c) > F.col("issued"))
    sums = matrix.agg(
        F.count("*").alias("n_rows"), F.count_distinct("entity", "day").alias("origins"), F.min("issued").alias("__i"),
        F.min(F.least(*[F.col("issued") - F.col(c) for c in names], F.lit(10**9))).alias("worst_margin"),
        *[F.count(c).alias(f"__n_{c}") for c in names], *[late(c).alias(f"__v_{c}") for c in names],
    )
    total = lambda p: sum((F.col(f"{p}{c}") for c in names[1:]), F.col(f"{p}{names[0]}"))
    bad = F.array_join(F.filter(F.array(*[F.when(F.col(f"__v_{c}") > 0, F.lit(c.removeprefix("avail__"))) for c in sorted(names)]), lambda x: x.isNotNull()), ",")
    return sums.select("n_rows", "origins", total("__n_").alias("cells"), total("__v_").alias("violations"), F.col("worst_margin").cast("long"), bad.alias("features"))
