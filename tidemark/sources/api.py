"""What a reader of the results asks for, as tables: series, a day's forecasts, runs, and which tables are there."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import issuance, runs

MOST_DAYS = 62


def series(panel: DataFrame, entity: str, start: dt.date, end: dt.date, most_days: int = MOST_DAYS) -> DataFrame:
    """Rows of one entity for hours that end in (start 00:00, end 24:00] UTC, in order. Longer or reversed spans raise."""
    if not 0 <= (end - start).days < most_days:
        raise ValueError(f"a series covers 1 to {most_days} days, not {start} to {end}")
    hour = lambda d: (d - dt.date(1970, 1, 1)).days * 24
    rows = panel.where((F.col("entity") == entity) & (F.col("h") > hour(start)) & (F.col("h") <= hour(end) + 24))
    return rows.orderBy("h")


def forecast(spark: SparkSession, root: str, actuals: DataFrame, day, entity: str, model: str | None = None) -> DataFrame:
    """Issued forecasts of an entity for one target day beside the actuals known by now."""
    rows = issuance.stored(spark, root).where((F.col("target_day") == F.lit(day).cast("date")) & (F.col("entity") == entity))
    if model is not None:
        rows = rows.where(F.col("model") == model)
    rows = rows.withColumn("h", F.floor(F.unix_timestamp("ts") / 3600).cast("long"))
    return rows.join(actuals.where(F.col("entity") == entity).select("entity", "h", F.col("value").alias("y")), ["entity", "h"], "left").orderBy("model", "h")


def runs_under(spark: SparkSession, root: str) -> DataFrame:
    """(run, models, start, end) of the runs under a folder: a row for each."""
    fs, p = runs._fs(spark, root)
    names = sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()) if fs.exists(p) else []
    rows = []
    for name in (n for n in names if not n.startswith("_")):
        config = runs.read_config(spark, f"{root}/{name}")
        window = config.get("window") or [None, None]
        rows.append((name, ",".join(config.get("models", [])), *map(str, window)))
    return spark.createDataFrame(rows, "run string, models string, start string, end string")


def ready(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(name, ready): whether each table's folder is there."""
    return spark.createDataFrame([(n, runs._exists(spark, p)) for n, p in paths.items()], "name string, ready boolean")
