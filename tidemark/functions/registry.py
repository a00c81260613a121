"""Registered entities and places, and spans of days."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def slug(name: Column) -> Column:
    """Lower case, with one hyphen for each run of other characters, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), "^-|-$", "")


def shares(places: DataFrame, by: str, weight: str) -> DataFrame:
    """``places`` with ``share``, the part of each one's weight in its group; the parts of a group sum to 1."""
    return places.withColumn("share", F.try_divide(F.col(weight), F.sum(weight).over(W.partitionBy(by))))


def registered(registry: DataFrame, key: str, codes: list[str]) -> DataFrame:
    """The registry's rows of some codes. Unknown codes and codes registered twice raise."""
    found = registry.where(F.col(key).isin(codes))
    n = {r[key]: r["count"] for r in found.groupBy(key).count().collect()}  # of the codes named
    if unknown := sorted(set(codes) - set(n)):
        raise KeyError(f"unknown: {', '.join(unknown)}")
    if twice := sorted(k for k, v in n.items() if v > 1):
        raise ValueError(f"registered twice: {', '.join(twice)}")
    return found


@dataclass(frozen=True)
class Span:
    """Days from ``start`` to ``end``, both included."""

    start: dt.date
    end: dt.date

    def __post_init__(self) -> None:
        if self.end < self.start:
            raise ValueError(f"a span ends on {self.end}, before it starts on {self.start}")

    def contains(self, day: Column) -> Column:
        return day.between(F.lit(self.start), F.lit(self.end))


def split(day: Column, spans: dict[str, Span]) -> Column:
    """The name of the span that holds a day, null outside all. Spans that overlap or aren't in order of time raise."""
    items = list(spans.items())
    for (a, x), (b, y) in zip(items, items[1:], strict=False):
        if y.start <= x.end:
            raise ValueError(f"{b} must start after {a} ends")
    return F.coalesce(*[F.when(s.contains(day), F.lit(name)) for name, s in items])


def month_chunks(groups: DataFrame, start: dt.date, end: dt.date, today: dt.date, settle: int, columns: int) -> DataFrame:
    """``groups`` by months of [start, end], newest first: (..., first, last, closed, weight, position).

    A month is closed once ``settle`` days have passed since its last day. ``weight`` is what a request for it costs: one
    for each 14 days begun times each 10 ``columns`` begun. ``position`` orders all chunks: newest month first, then the
    group's columns.
    """
    names = groups.columns
    month = F.explode(F.sequence(F.trunc(F.lit(start), "month"), F.lit(end), F.expr("interval 1 month"))).alias("m")
    c = groups.select(*names, month).select(*names, F.greatest("m", F.lit(start)).alias("first"), F.least(F.last_day("m"), F.lit(end)).alias("last"))
    days = F.datediff("last", "first") + 1
    c = c.withColumns({"closed": F.date_add("last", settle) < F.lit(today), "weight": (F.ceil(days / 14) * -(-columns // 10)).cast("int")})
    # The rank within a month and the chunks of later months, so no window holds all chunks.
    per = c.groupBy("first").agg(F.count("*").alias("__n"))
    later = per.select("first", F.coalesce(F.sum("__n").over(W.orderBy(F.desc("first")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))  # a row for each month
    return c.join(later, "first").withColumn("position", (F.row_number().over(W.partitionBy("first").orderBy(*names)) + F.col("__before")).cast("long")).drop("__before")
