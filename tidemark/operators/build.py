"""A graph of tables with gates: what a table reads and how it is checked is declared, the order follows.

A table is written once. Its row count and the failing rows of its row checks are counted by ``observe`` in the pass that
writes it, so nothing is scanned for them. A table that fails a check of severity ``error`` isn't published: its earlier
version stays, and everything that reads it, directly or not, is skipped.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.runs import _exists, _fs


@dataclass(frozen=True)
class Check:
    """``rows`` marks failing rows of the table; or ``table`` gives failing rows, from the written table and all it may read."""

    name: str
    rows: Column | None = None
    table: Callable[[DataFrame, dict[str, DataFrame]], DataFrame] | None = None
    severity: str = "error"

    def __post_init__(self) -> None:
        if (self.rows is None) == (self.table is None):
            raise ValueError(f"{self.name}: a check marks rows or makes a table of failing ones")
        if self.severity not in ("error", "warn"):
            raise ValueError(f"{self.name}: severity is error or warn")


@dataclass(frozen=True)
class Table:
    name: str
    inputs: tuple[str, ...]
    make: Callable[[dict[str, DataFrame]], DataFrame]
    checks: tuple[Check, ...] = ()


@dataclass(frozen=True)
class Built:
    """``status``: built, failed (a check stopped it) or skipped (something it reads wasn't built)."""

    name: str
    status: str
    rows: int | None
    failing: dict[str, int]


def in_order(tables: list[Table], sources: set[str]) -> list[Table]:
    """Tables after all that they read. Raises on unknown or repeated names and on circles."""
    by = {t.name: t for t in tables}
    if len(by) < len(tables) or set(by) & sources:
        raise ValueError("a name stands for two tables")
    for t in tables:
        if unknown := set(t.inputs) - set(by) - sources:
            raise ValueError(f"{t.name} reads {sorted(unknown)}, which nothing makes")
    out: list[Table] = []
    waiting = list(tables)
    while waiting:
        ready = [t for t in waiting if not {i for i in t.inputs if i in by} - {d.name for d in out}]
        if not ready:
            raise ValueError(f"these tables read each other in a circle: {sorted(t.name for t in waiting)}")
        out += ready
        waiting = [t for t in waiting if t not in ready]
    return out


def build(spark: SparkSession, root: str, tables: list[Table], sources: dict[str, DataFrame], only: set[str] | None = None) -> list[Built]:
    """Build all tables, or those named and what they read, under ``root``; what happened to each, in order."""
    order = in_order(tables, set(sources))
    if only is not None:
        wanted = set(only)
        for t in reversed(order):
            if t.name in wanted:
                wanted |= set(t.inputs)
        order = [t for t in order if t.name in wanted]
    known, out = dict(sources), []
    for t in order:
        if set(t.inputs) - set(known):
            out.append(Built(t.name, "skipped", None, {}))
            continue
        marks = [c for c in t.checks if c.rows is not None]
        seen, path = Observation(), f"{root}/_new-{uuid.uuid4().hex}"
        df = t.make({i: known[i] for i in t.inputs})
        df.observe(seen, F.count("*").alias("rows"), *[F.count_if(c.rows).alias(f"c{i}") for i, c in enumerate(marks)]).write.parquet(path)
        counts = seen.get
        made = spark.read.schema(df.schema).parquet(path)
        failing = {c.name: counts[f"c{i}"] for i, c in enumerate(marks)}
        failing |= {c.name: c.table(made, known).count() for c in t.checks if c.table is not None}
        if any(failing[c.name] and c.severity == "error" for c in t.checks):
            fs, p = _fs(spark, path)
            fs.delete(p, True)
            out.append(Built(t.name, "failed", counts["rows"], failing))
            continue
        known[t.name] = spark.read.schema(df.schema).parquet(_swapped(spark, root, t.name, path))
        out.append(Built(t.name, "built", counts["rows"], failing))
    return out


def _swapped(spark: SparkSession, root: str, name: str, path: str) -> str:
    """Put a written table in the place of its earlier version."""
    place = f"{root}/{name}"
    fs, new = _fs(spark, path)
    old = _fs(spark, f"{root}/_old-{uuid.uuid4().hex}")[1]
    there = _exists(spark, place)
    if there and not fs.rename(_fs(spark, place)[1], old):
        raise OSError(f"could not move {place}")
    if not fs.rename(new, _fs(spark, place)[1]):
        raise OSError(f"could not move {path} to {place}")
    if there:
        fs.delete(old, True)
    return place


def freshness(table: DataFrame, by: list[str], at: str, now, hours: float) -> DataFrame:
    """(*by, newest, age_hours, fresh): age of the newest instant of each group; a group without instants isn't fresh."""
    g = table.groupBy(*by).agg(F.max(at).alias("newest"))
    age = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))) / 3.6e9
    return g.withColumn("age_hours", age).withColumn("fresh", F.coalesce(F.col("age_hours") < hours, F.lit(False)))
