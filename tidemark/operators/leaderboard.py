"""Live scores from daily states: sums that merge, written once for each day and added up on reading.

A day's state holds counts and sums by entity and model, so a leaderboard reads as many rows as there were days, not
hours. Scoring a day again replaces its state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.runs import _exists, _fs

SCHEMA = "entity string, model string, hours long, abs_sum double, sq_sum double, ape_sum double, pe_sum double, pct_hours long, late_hours long, day long"


def scorable(rows: DataFrame, test_end: int) -> DataFrame:
    """Rows of target days after the locked test window: live scores never evaluate it."""
    return rows.where(F.col("day") > test_end)


def daily_states(scored: DataFrame) -> DataFrame:
    """The state of each (entity, model, day) of scored rows with ``late``. Percentages leave out actuals of 0."""
    pct = lambda c: F.try_divide(F.col(c), F.abs("y"))
    return scored.groupBy("entity", "model", F.col("day").cast("long").alias("day")).agg(
        F.count("*").alias("hours"), F.sum("abs_err").alias("abs_sum"), F.sum(F.col("err") * F.col("err")).alias("sq_sum"), F.sum(pct("abs_err")).alias("ape_sum"),
        F.sum(pct("err")).alias("pe_sum"), F.count(pct("err")).alias("pct_hours"), F.count_if("late").alias("late_hours"),
    )


def write_states(states: DataFrame, path: str, days: list[int]) -> None:
    """Put the states of ``days`` in place of what there was of them; other days stay."""
    spark = states.sparkSession
    states.where(F.col("day").isin(days)).select(*[c.split()[0] for c in SCHEMA.split(", ")]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    written = {r["day"] for r in states.where(F.col("day").isin(days)).select("day").distinct().collect()}  # of the days named
    for day in set(days) - written:  # no hour of it can be scored any more
        fs, p = _fs(spark, f"{path}/day={day}")
        fs.delete(p, True)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path) if _exists(spark, path) else spark.createDataFrame([], SCHEMA)


def leaderboard(states: DataFrame, by: list[str] = ("entity", "model")) -> DataFrame:
    """(*by, hours, days, mae, rmse, mape, bias, late_hours) of merged states."""
    g = states.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("hours", "abs_sum", "sq_sum", "ape_sum", "pe_sum", "pct_hours", "late_hours")], F.count_distinct("day").alias("days"))
    return g.select(
        *by, "hours", "days", (F.col("abs_sum") / F.col("hours")).alias("mae"), F.sqrt(F.col("sq_sum") / F.col("hours")).alias("rmse"),
        (F.try_divide("ape_sum", "pct_hours") * 100).alias("mape"), (F.try_divide("pe_sum", "pct_hours") * 100).alias("bias"), "late_hours",
    )
