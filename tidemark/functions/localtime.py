"""Local clocks as columns: an instant and a zone name go in, dates, hours and instants come out.

Instants are UTC timestamps (session time zone UTC). The hour that ends at midnight belongs to the day before.
A zone is a column, so that one plan serves all entities whatever their zones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hours(ts: Column) -> Column:
    """Whole hours since the epoch."""
    return F.floor(F.unix_timestamp(ts) / 3600).cast("long")


def local_midnight(day: Column, zone: Column) -> Column:
    return F.to_utc_timestamp(day.cast("timestamp"), zone)


def local_day_of(hour_ending: Column, zone: Column) -> Column:
    return F.to_date(F.from_utc_timestamp(hour_ending - F.expr("interval 1 hour"), zone))


def local_hour_of(hour_ending: Column, zone: Column) -> Column:
    """0 to 23: the wall-clock hour that the interval covers."""
    return F.hour(F.from_utc_timestamp(hour_ending - F.expr("interval 1 hour"), zone))


def hours_in_local_day(day: Column, zone: Column) -> Column:
    """23, 24 or 25."""
    return hours(local_midnight(F.date_add(day, 1), zone)) - hours(local_midnight(day, zone))


def hour_ending_instants(day: Column, zone: Column) -> Column:
    """The instants at which the hours of a local day end."""
    first = local_midnight(day, zone) + F.expr("interval 1 hour")
    return F.sequence(first, local_midnight(F.date_add(day, 1), zone), F.expr("interval 1 hour"))


def local_hour_number(hour_ending: Column, zone: Column) -> Column:
    """1-based position of an hour in its local day."""
    return hours(hour_ending) - hours(local_midnight(local_day_of(hour_ending, zone), zone))


def local_wall_time(day: Column, minutes: Column, zone: Column) -> Column:
    """The instant at which a local clock shows ``minutes`` after midnight; raises if it never or twice does."""
    wall = F.timestamp_micros((F.unix_date(day).cast("long") * 1440 + minutes) * 60_000_000)
    at = F.to_utc_timestamp(wall, zone)
    hour = F.expr("interval 1 hour")
    fails = (F.from_utc_timestamp(at, zone) != wall) | (F.from_utc_timestamp(at + hour, zone) == wall) | (F.from_utc_timestamp(at - hour, zone) == wall)
    said = F.concat(F.lit("no single instant for "), wall.cast("string"), F.lit(" in "), zone)
    return F.when(fails, F.raise_error(said).cast("timestamp")).otherwise(at)


def floor_hour(ts: Column) -> Column:
    """The start of an instant's hour in UTC."""
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / 3600) * 3600)


def to_local(ts: Column, zone: Column) -> Column:
    """What a zone's clocks show at an instant."""
    return F.from_utc_timestamp(ts, zone)


def portal_stamp(text: Column) -> Column:
    """The instant, in UTC, of a text like ``01/16/2025 4:00:00 AM``; other texts fail."""
    return F.to_timestamp(F.trim(text), "MM/dd/yyyy h:mm:ss a")


def default_target_day(now: Column, zone: str = "America/New_York") -> Column:
    """Tomorrow, by a zone's clocks."""
    return F.date_add(F.to_date(F.from_utc_timestamp(now, zone)), 1)


def require_instants(df, *columns: str):
    """``df``, if these columns are timestamps with a time zone; wall-clock timestamps and texts raise."""
    kinds = dict(df.dtypes)
    if naive := [c for c in columns if kinds[c] != "timestamp"]:
        raise TypeError(f"not instants: {', '.join(f'{c} ({kinds[c]})' for c in naive)}")
    return df
