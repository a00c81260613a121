"""Append-only forecast store: Parquet partitioned by target day and model, never overwritten."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

KEYS = ["entity", "ts", "model", "issued_at"]
SCHEMA = (
    "entity string, ts timestamp, model string, issued_at timestamp, yhat double, q10 double, q90 double, q025 double, q975 double, "
    "created_at timestamp, late boolean, target_day date"
)


class DuplicateForecast(ValueError):
    """A key is in the store already, or twice in a batch."""


def stored(spark: SparkSession, path: str) -> DataFrame:
    """All batches; columns that a batch lacks are null. An empty table before the first write."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def audited(batch: DataFrame, now, target_day) -> DataFrame:
    """The batch with created_at, late (created after the issue it claims) and target_day."""
    at = F.lit(now).cast("timestamp")
    return batch.withColumns({"created_at": at, "late": at > F.col("issued_at"), "target_day": F.lit(target_day).cast("date")})


def append(batch: DataFrame, path: str) -> None:
    """Add an audited batch. Raises if a key repeats, is stored, or is issued less than an hour before its time."""
    spark = batch.sparkSession
    twice = batch.groupBy(*KEYS).count().where("count > 1").select(*KEYS)
    known = batch.join(stored(spark, path).select(*KEYS), KEYS, "left_semi").select(*KEYS)
    if (row := twice.unionByName(known).first()) is not None:
        raise DuplicateForecast(str(row.asDict()))
    if (row := batch.where("issued_at >= ts - interval 1 hour").first()) is not None:
        raise ValueError(f"issued too late for its hour: {row.asDict()}")
    batch.write.mode("append").partitionBy("target_day", "model").parquet(path)


def append_new(batch: DataFrame, path: str) -> int:
    """Add only the rows whose keys aren't stored; the number of rows added. Running it again adds none."""
    new = batch.dropDuplicates(KEYS).join(stored(batch.sparkSession, path).select(*KEYS), KEYS, "left_anti")
    n = new.count()
    if n:
        append(new, path)
    return n


def save_table(df: DataFrame, path: str, digits: int = 4) -> None:
    """A small result as one sorted CSV file with rounded doubles."""
    out = df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
    out.orderBy(*df.columns[:3]).coalesce(1).write.mode("errorifexists").option("header", True).csv(path)
