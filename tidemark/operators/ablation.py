"""What a part of a model is worth: variants of it backtested alike and compared with the first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import written
from . import backtest, evaluate

SEED = 17


def ablate(matrix: DataFrame, variants: dict[str, backtest.Model], plan: backtest.Plan, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(overall, comparisons): metrics of each variant over its own scored rows, and each later variant against the first.

    Comparisons pair days with equally many scored rows, for each entity and for all together (``ALL``).
    """
    base = next(iter(variants))
    y = matrix.where("y is not null and y > 0").select("entity", "day", "y")
    made = written(backtest.forecasts(matrix, variants, plan), "variants")
    scored = made.where("yhat is not null").join(y, ["entity", "day"]).withColumn("err", F.col("yhat") - F.col("y")).withColumn("abs_err", F.abs("err"))
    overall = evaluate.point_metrics(scored, ["model"])
    pairs = evaluate.with_pooled(evaluate.paired(evaluate.daily_losses(scored), base))
    return overall, evaluate.compare(pairs, base, least=1, seed=seed)
