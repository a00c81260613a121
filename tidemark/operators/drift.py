"""Drift of many columns between two sets of rows, exact, in one pass over them.

All columns are melted into (feature, value) counts, which are sorted by range. Running counts are taken within a range
and completed by what the ranges before it hold, one row for each range and feature, so neither a column nor a feature's
values meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import written


def filled_columns(rows: DataFrame, columns: list[str]) -> list[str]:
    """Columns less than half of which are null, among rows with and among rows without ``now``."""
    n = rows.groupBy("now").agg(F.count("*").alias("n"), *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)]).collect()  # two rows
    return [c for i, c in enumerate(columns) if len(n) == 2 and all(r["n"] - r[f"n_{i}"] < r["n"] / 2 for r in n)]


def seasonal_windows(rows: DataFrame, last: Column | int, days: int = 28, back: int = 364) -> DataFrame:
    """Rows of the ``days`` days up to ``last`` with ``now``, and of the same dates ``back`` days earlier without."""
    end = last if isinstance(last, Column) else F.lit(last)
    now, then = F.col("day").between(end - (days - 1), end), F.col("day").between(end - (days - 1 + back), end - back)
    return rows.where(now | then).withColumn("now", now)


def kolmogorov(x: Column, terms: int = 100) -> Column:
    """The limit probability that the scaled distance is larger than x."""
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), lambda s, j: s + F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * j * j * x * x))
    return F.when(x < 0.2, 1.0).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def two_sample(rows: DataFrame, columns: list[str], ranges: int = 32, many: int = 1000) -> DataFrame:
    """(feature, n_now, n_ref, ks, p, wasserstein, drifted) of rows with and without ``now``.

    ``wasserstein`` is the mean distance of the distributions over the reference's standard deviation. ``drifted`` is
    p < 0.05 where both samples have at most ``many`` rows, else wasserstein >= 0.1. Rows with a null in any column count
    for none.
    """
    if not columns:
        raise ValueError("no column has data in both windows")
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])).alias("x")
    melted = rows.dropna(subset=columns).select("now", each).select("now", "x.*")
    n = melted.groupBy("feature", "value").agg(F.count_if("now").alias("a"), F.count_if(~F.col("now")).alias("b"))
    n = written(n.repartitionByRange(ranges, "feature", "value").withColumn("part", F.spark_partition_id()), "drift")

    parts = n.groupBy("feature", "part").agg(F.sum("a").alias("pa"), F.sum("b").alias("pb"), F.min("value").alias("low"))
    mine = W.partitionBy("feature").orderBy("part")  # one row for each range
    before = mine.rowsBetween(W.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    parts = parts.select("feature", "part", F.coalesce(F.sum("pa").over(before), none).alias("oa"), F.coalesce(F.sum("pb").over(before), none).alias("ob"), F.lead("low").over(mine).alias("next_low"))
    mean = F.try_divide(F.sum(F.col("value") * F.col("b")), F.sum("b"))
    total = n.groupBy("feature").agg(F.sum("a").alias("n_now"), F.sum("b").alias("n_ref"), mean.alias("mean"))
    spread = n.join(total, "feature").groupBy("feature").agg(F.sqrt(F.try_divide(F.sum(F.pow(F.col("value") - F.col("mean"), 2) * F.col("b")), F.sum("b"))).alias("std"))
    within = W.partitionBy("feature", "part").orderBy("value")
    run = n.select("*", F.sum("a").over(within).alias("ra"), F.sum("b").over(within).alias("rb"), F.lead("value").over(within).alias("next")).join(parts, ["feature", "part"]).join(total, "feature")
    gap = F.abs((F.col("ra") + F.col("oa")) / F.col("n_now") - (F.col("rb") + F.col("ob")) / F.col("n_ref"))
    run = run.where("n_now > 0 and n_ref > 0").withColumns({"gap": gap, "step": F.coalesce("next", "next_low", "value") - F.col("value")})
    g = run.groupBy("feature", "n_now", "n_ref").agg(F.max("gap").alias("ks"), F.sum(F.col("gap") * F.col("step")).alias("moved")).join(spread, "feature")
    size = F.sqrt(F.col("n_now") * F.col("n_ref") / (F.col("n_now") + F.col("n_ref")))
    g = g.withColumns({"p": kolmogorov(F.col("ks") * size), "wasserstein": F.try_divide("moved", "std")})
    few = F.greatest("n_now", "n_ref") <= many
    drifted = F.when(few, F.col("p") < 0.05).otherwise(F.coalesce(F.col("wasserstein") >= 0.1, F.lit(False)))
    return g.select("feature", "n_now", "n_ref", "ks", "p", "wasserstein", drifted.alias("drifted"))

