"""Data-quality checks; each returns the failing rows or counts of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def outside(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Nulls pass."""
    return df.where((F.col(column) < low) | (F.col(column) > high))


def unequal(df: DataFrame, column: str, other: str) -> DataFrame:
    """Null-safe."""
    return df.where(~F.col(column).eqNullSafe(F.col(other)))


def orphans(df: DataFrame, column: str, parents: DataFrame, parent: str) -> DataFrame:
    return df.join(parents, F.col(column) == F.col(parent), "left_anti")


def wrong_day_lengths(hours: DataFrame) -> DataFrame:
    """Local days without 23, 24 or 25 hours; an entity's first and last day may be partial and don't count."""
    n = hours.groupBy("entity", "day").agg(F.count("*").alias("n"))
    mine = W.partitionBy("entity")
    ends = n.select("*", F.min("day").over(mine).alias("__a"), F.max("day").over(mine).alias("__z"))
    return ends.where("day > __a and day < __z and n not in (23, 24, 25)").drop("__a", "__z")


def low_coverage(df: DataFrame, column: str, by: list[str], least: float, time: str | None = None) -> DataFrame:
    """Groups whose share of values is below ``least``; with ``time``, rows after a group's last value are not yet due."""
    if time:
        last = F.max(F.when(F.col(column).isNotNull(), F.col(time))).over(W.partitionBy(*by))
        df = df.withColumn("__last", last).where(F.col(time) <= F.col("__last"))
    return df.groupBy(*by).agg(F.avg(F.col(column).isNotNull().cast("int")).alias("share")).where(F.col("share") < least)


def not_accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    """(value, n): values outside a list; nulls pass."""
    return df.where(~F.col(column).isin(values)).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def trained_after_cutoff(train: DataFrame, test: DataFrame) -> DataFrame:
    """(entity, newest, cutoff): entities with a training hour that ends after the first cutoff of their forecasts.

    By entity, since cutoffs are local times.
    """
    newest = train.groupBy("entity").agg(F.max("h").alias("newest"))
    return newest.join(test.groupBy("entity").agg(F.min("cutoff").alias("cutoff")), "entity").where("newest > cutoff")


def gaps(panel: DataFrame, longest: int = 1) -> DataFrame:
    """Steps of more than ``longest`` between successive periods of an entity."""
    prev = F.lag("h").over(W.partitionBy("entity").orderBy("h"))
    rows = panel.select("entity", prev.alias("prev"), "h")
    return rows.where(F.col("h") - F.col("prev") > longest).select("entity", "prev", "h", (F.col("h") - F.col("prev") - 1).alias("missing"))


def coverage(panel: DataFrame) -> DataFrame:
    """Expected and present periods between each entity's first and last."""
    g = panel.groupBy("entity").agg((F.max("h") - F.min("h") + 1).alias("expected"), F.count("value").alias("present"))
    return g


def violations(df: DataFrame, ranges: dict, required: list[str], unique: list[list[str]]) -> DataFrame:
    """(field, rule, failing): all rules of a contract, counted in one pass."""
    rules = [(c, "range", F.count_if((F.col(c) < lo) | (F.col(c) > hi))) for c, (lo, hi) in ranges.items()]
    rules += [(c, "null", F.count_if(F.col(c).isNull())) for c in required]
    rules += [(",".join(k), "unique", F.count("*") - F.count_distinct(*k)) for k in unique]
    one = df.agg(*[e.alias(f"r{i}") for i, (_, _, e) in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(r).alias("rule"), F.col(f"r{i}").alias("failing")) for i, (f, r, _) in enumerate(rules)])
    return one.select(F.explode(rows).alias("x")).select("x.*")


def contract(df: DataFrame, expected: dict[str, str], strict: bool = True) -> DataFrame:
    """(field, rule, found): columns that are missing, of another type, or, with ``strict``, not in the contract."""
    kinds = dict(df.dtypes)
    rows = [(c, "missing", None) for c in expected if c not in kinds]
    rows += [(c, "type", kinds[c]) for c, t in expected.items() if c in kinds and kinds[c] != t]
    rows += [(c, "unexpected", t) for c, t in kinds.items() if strict and c not in expected]
    return df.sparkSession.createDataFrame(rows, "field string, rule string, found string")


def judged(name: str, failing: DataFrame, severity: str = "error") -> DataFrame:
    """(check, severity, failing, passed) of a check's failing rows; a warning passes whatever it finds."""
    if severity not in ("error", "warn"):
        raise ValueError("severity is error or warn")
    n = F.count("*").alias("failing")
    return failing.agg(n).select(F.lit(name).alias("check"), F.lit(severity).alias("severity"), "failing", ((F.col("failing") == 0) | F.lit(severity == "warn")).alias("passed"))
