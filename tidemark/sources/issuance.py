"""Issued forecasts: one immutable folder for each (target day, model), published whole and read by partition.

A batch covers one target day and model. It is written beside the store, claims its key by creating a file that only one
writer can create, and is then moved into place by one rename. A writer that dies before its claim leaves nothing that a
reader sees; one that dies after it is finished by the next writer of the same key. Issuing again adds nothing.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .runs import _exists, _fs, _put, _text
from .store import DuplicateForecast

KEYS = ["entity", "ts", "issued_at"]
SCHEMA = (
    "entity string, ts timestamp, issued_at timestamp, yhat double, q10 double, q90 double, q025 double, q975 double, created_at timestamp, "
    "late boolean, protocol string, model_version string, code_version string, target_day date, model string"
)
_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


@dataclass(frozen=True)
class Issue:
    """What an issuance did."""

    target_day: str
    model: str
    rows: int
    entities: int
    late_rows: int
    null_forecasts: int
    existed: bool = False


def _at(root: str, day, model: str) -> str:
    return f"{root}/target_day={day}/model={model}"


def has(spark: SparkSession, root: str, day, model: str) -> bool:
    """Whether forecasts of that target day and model were issued."""
    return _exists(spark, _at(root, day, model))


def stored(spark: SparkSession, root: str) -> DataFrame:
    """All issued forecasts, under the declared schema; filters on target_day and model prune folders."""
    if not _exists(spark, root):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).option("basePath", root).parquet(root).select(*_COLUMNS)


def asof(spark: SparkSession, root: str, at, start=None, end=None, models: list[str] | None = None) -> DataFrame:
    """Forecasts that had been created by an instant, of target days in [start, end] and some models."""
    rows = stored(spark, root)
    if start is not None:
        rows = rows.where(F.col("target_day") >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.where(F.col("target_day") <= F.lit(end).cast("date"))
    if models is not None:
        rows = rows.where(F.col("model").isin(models))
    return rows.where(F.col("created_at") <= F.lit(at).cast("timestamp"))


def _published(spark: SparkSession, root: str, day, model: str, name: str) -> None:
    target = _at(root, day, model)
    fs, source = _fs(spark, f"{root}/_staged/{name}")
    fs.mkdirs(_fs(spark, target.rsplit("/", 1)[0])[1])
    if not fs.rename(source, _fs(spark, target)[1]):
        raise OSError(f"could not move {name} to {target}")


def issue(batch: DataFrame, root: str, created_at, protocol: str, model_version: str, code_version: str = "unknown", skip_existing: bool = False) -> Issue:
    """Store a batch with its audit columns. Raises if it is empty, covers more than one key, repeats a row, is issued
    less than an hour before an hour it forecasts, or if its key is there and ``skip_existing`` isn't set."""
    spark = batch.sparkSession
    keys = batch.select(F.col("target_day").cast("date").alias("d"), "model").distinct().limit(2).collect()
    if len(keys) != 1 or keys[0]["d"] is None or not re.fullmatch(r"[A-Za-z0-9_.+-]+", keys[0]["model"] or ""):
        raise ValueError(f"a batch covers one target day and one plainly named model, not {[tuple(k) for k in keys]}")
    day, model = keys[0]["d"], keys[0]["model"]
    claim = f"{root}/_claims/{day}-{model}"
    if not has(spark, root, day, model) and _exists(spark, claim):
        left = _text(spark, claim)
        if _exists(spark, f"{root}/_staged/{left}"):  # claimed by a writer that did not come to publish it
            _published(spark, root, day, model, left)
    if has(spark, root, day, model):
        if skip_existing:
            return Issue(str(day), model, 0, 0, 0, 0, True)
        raise DuplicateForecast(f"{day} {model} is issued already")
    at = F.lit(created_at).cast("timestamp")
    absent = [c for c in ("q10", "q90", "q025", "q975") if c not in batch.columns]
    rows = batch.withColumns({c: F.lit(None).cast("double") for c in absent} | {
        "created_at": at, "late": at > F.col("issued_at"), "protocol": F.lit(protocol), "model_version": F.lit(model_version), "code_version": F.lit(code_version)
    })
    n = rows.groupBy(*KEYS).count().where("count > 1").limit(1).collect()
    if n:
        raise DuplicateForecast(f"repeated in the batch: {n[0].asDict()}")
    if (row := rows.where("issued_at >= ts - interval 1 hour").select(*KEYS).first()) is not None:
        raise ValueError(f"issued too late for its hour: {row.asDict()}")
    name = uuid.uuid4().hex
    kept = [c for c in _COLUMNS if c not in ("target_day", "model")]
    rows.select(*kept).write.parquet(f"{root}/_staged/{name}")
    try:
        _put(spark, claim, name)
    except Exception as e:
        fs, p = _fs(spark, f"{root}/_staged/{name}")
        fs.delete(p, True)
        raise DuplicateForecast(f"{day} {model} is being issued by another writer") from e
    _published(spark, root, day, model, name)
    g = spark.read.schema(", ".join(x for x in SCHEMA.split(", ") if x.split()[0] in kept)).parquet(_at(root, day, model)).agg(
        F.count("*").alias("n"), F.count_distinct("entity").alias("e"), F.count_if("late").alias("l"), F.count_if(F.col("yhat").isNull()).alias("u")
    ).first()
    return Issue(str(day), model, g["n"], g["e"], g["l"], g["u"])
