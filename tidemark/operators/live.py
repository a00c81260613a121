"""Issuing a day's forecasts: features are checked, predicted and stored in one go."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import issuance
from . import features


class Leak(AssertionError):
    """A feature knows what was not available when the forecast was issued."""


def issue_day(matrix: DataFrame, predict: Callable[[DataFrame], DataFrame], root: str, day, model: str, created_at, protocol: str, model_version: str, code_version: str = "unknown", skip_existing: bool = False) -> issuance.Issue:
    """Store ``predict``'s forecasts (entity, h, yhat and quantiles) for a matrix of one target day.

    Raises ``Leak`` if a feature of the matrix breaks its protocol. A day that was issued before adds nothing if
    ``skip_existing`` is set, and raises otherwise; neither computes a forecast.
    """
    spark = matrix.sparkSession
    if issuance.has(spark, root, day, model):
        if skip_existing:
            return issuance.Issue(str(day), model, 0, 0, 0, 0, True)
        raise issuance.DuplicateForecast(f"{day} {model} is issued already")
    rows = matrix.where(F.col("day") == F.lit(day).cast("date"))
    checked = features.check_point_in_time(rows).first()
    if checked["violations"]:
        raise Leak(f"features leak: {checked['features']}")
    made = predict(rows)
    quantiles = [c for c in ("q10", "q90", "q025", "q975") if c in made.columns]
    batch = rows.select("entity", "h", "issued").join(made.select("entity", "h", "yhat", *quantiles), ["entity", "h"])
    batch = batch.select("entity", F.timestamp_seconds(F.col("h") * 3600).alias("ts"), F.timestamp_seconds(F.col("issued") * 3600).alias("issued_at"), F.lit(model).alias("model"), F.lit(day).cast("date").alias("target_day"), "yhat", *quantiles)
    return issuance.issue(batch, root, created_at, protocol, model_version, code_version, skip_existing)
