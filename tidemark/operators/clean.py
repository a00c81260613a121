"""Rule-based cleaning of hourly panels, with counts of affected rows.

R0 keep one row for each key; R1 missing; R2 not positive; R3 outlier against a centred median over a range of
hours; R4 benchmark invalid. Every rule is a flag first, and a repair afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first by ``order``, which must decide ties."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def flag(df: DataFrame, radius: int = 84, low: float = 0.2, high: float = 5.0) -> DataFrame:
    """Columns median and four flags of an (entity, h, value, benchmark) panel; the median takes positive values only.

    Windows run within blocks of hours. A row also goes to the neighbouring block if it lies within ``radius`` of it, so every
    row of a block sees all that its window holds, and no entity's history meets in one task.
    """
    block = lambda h: F.floor(h / (8 * radius)).cast("long")
    h = F.col("h")
    df = df.withColumn("__own", block(h)).withColumn("__b", F.explode(F.array_distinct(F.array(block(h - radius), block(h), block(h + radius)))))
    around = W.partitionBy("entity", "__b").orderBy("h").rangeBetween(-radius, radius)
    df = df.withColumn("median", F.percentile(F.when(F.col("value") > 0, F.col("value")), F.lit(0.5)).over(around))
    df = df.where(F.col("__own").eqNullSafe(F.col("__b"))).drop("__own", "__b")
    band = (F.col("value") < low * F.col("median")) | (F.col("value") > high * F.col("median"))
    return df.withColumns({
        "is_missing": F.col("value").isNull(),
        "is_nonpositive": F.coalesce(F.col("value") <= 0, F.lit(False)),
        "is_outlier": F.coalesce((F.col("value") > 0) & band, F.lit(False)),
        "bad_benchmark": F.coalesce((F.col("benchmark") <= 0) | (F.col("benchmark") > high * F.col("median")), F.lit(False)),
    })


def repair(flagged: DataFrame, low: float = 0.2, high: float = 5.0) -> DataFrame:
    """clean: the value where no rule objects; filled: else the fallback if it lies in the band; benchmark_ok."""
    bad = F.col("is_missing") | F.col("is_nonpositive") | F.col("is_outlier")
    inside = (F.col("fallback") >= low * F.col("median")) & (F.col("fallback") <= high * F.col("median"))
    return flagged.withColumns({
        "clean": F.when(~bad, F.col("value")),
        "filled": F.when(~bad, F.col("value")).when(inside, F.col("fallback")),
        "benchmark_ok": F.when(~F.col("bad_benchmark"), F.col("benchmark")),
    })


def cleaning_log(staged: DataFrame, flagged: DataFrame) -> DataFrame:
    """Rows staged and rows affected by each rule, by entity."""
    n = staged.groupBy("entity").agg(F.count("*").alias("n_staged"))
    log = flagged.groupBy("entity").agg(
        F.count("*").alias("n_kept"), F.count_if("is_missing").alias("r1_missing"), F.count_if("is_nonpositive").alias("r2_nonpositive"),
        F.count_if("is_outlier").alias("r3_outlier"), F.count_if("bad_benchmark").alias("r4_benchmark"),
    )
    return n.join(log, "entity").withColumn("r0_duplicates", F.col("n_staged") - F.col("n_kept"))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean renormalised over members that have a value; null if their weights are 0."""
    return F.try_divide(F.sum(value * weight), F.nullif(F.sum(F.when(value.isNotNull(), weight)), F.lit(0.0)))


def clamp(x: Column, low: float, high: float, null_to_low: bool = False) -> Column:
    """Into [low, high]; null stays null, or becomes ``low`` as where the larger of null and a number is the number."""
    inside = F.least(F.greatest(x, F.lit(low)), F.lit(high))
    return inside if null_to_low else F.when(x.isNotNull(), inside)
