"""Scores of forecasts against actuals on common support, and uncertainty of daily losses.

A scored frame has entity, day, h (hour or day number), model, y, yhat and, where there are intervals, lo80, hi80, lo95, hi95.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def common_support(forecasts: DataFrame, actuals: DataFrame, keys: list[str]) -> DataFrame:
    """Forecasts joined to actuals, on the keys for which every model has a forecast and there is an actual."""
    n_models = forecasts.agg(F.count_distinct("model").alias("n_models"))
    live = forecasts.where("yhat is not null").join(actuals.where("y is not null"), keys)
    n = F.count("model").over(W.partitionBy(*keys))
    live = live.withColumn("__n", n).join(F.broadcast(n_models), F.col("__n") == F.col("n_models"))  # one row
    return live.drop("__n", "n_models").withColumn("err", F.col("yhat") - F.col("y")).withColumn("abs_err", F.abs("err"))


def point_metrics(scored: DataFrame, by: list[str]) -> DataFrame:
    return scored.groupBy(*by).agg(
        F.count("*").alias("hours"), F.avg("abs_err").alias("mae"), F.sqrt(F.avg(F.col("err") * F.col("err"))).alias("rmse"),
        (F.avg(F.try_divide(F.col("abs_err"), F.abs("y"))) * 100).alias("mape"), (F.avg(F.try_divide(F.col("err"), F.col("y"))) * 100).alias("bias"),
    )


def peak_metrics(scored: DataFrame, least: int) -> DataFrame:
    """Error of the daily maximum, over days with at least ``least`` periods, and share of days whose peak is more than one off."""
    last = lambda v: F.max_by("h", F.struct(F.col(v), F.col("h")))  # noqa: E731  of equal maxima the latest period
    days = scored.groupBy("entity", "model", "day").agg(
        F.count("*").alias("n"), F.max("y").alias("top"), F.max("yhat").alias("said"), last("y").alias("at"), last("yhat").alias("said_at")
    )
    return days.where(F.col("n") >= least).groupBy("entity", "model").agg(
        F.count("*").alias("days"), (F.avg(F.abs(F.col("said") - F.col("top")) / F.col("top")) * 100).alias("peak_ape"),
        (F.avg((F.abs(F.col("said_at") - F.col("at")) > 1).cast("int")) * 100).alias("peak_miss"),
    )


def pinball(y: Column, q: Column, level: float) -> Column:
    return F.greatest(level * (y - q), (level - 1) * (y - q))


def interval_metrics(scored: DataFrame, by: list[str]) -> DataFrame:
    rows = scored.where("lo80 is not null and hi95 is not null")
    inside = lambda lo, hi: F.avg(F.col("y").between(F.col(lo), F.col(hi)).cast("int")) * 100
    width = lambda lo, hi: F.avg((F.col(hi) - F.col(lo)) / F.col("y")) * 100
    loss = (pinball(F.col("y"), F.col("lo80"), 0.1) + pinball(F.col("y"), F.col("hi80"), 0.9)) / 2
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"), inside("lo80", "hi80").alias("cover80"), inside("lo95", "hi95").alias("cover95"),
        width("lo80", "hi80").alias("width80"), width("lo95", "hi95").alias("width95"), F.avg(loss).alias("pinball80"),
    )


def slice_metrics(scored: DataFrame, slices: list[str]) -> DataFrame:
    """Point metrics by model and each one of several groupings, in one pass."""
    one = F.explode(F.array(*[F.struct(F.lit(s).alias("slice"), F.col(s).cast("string").alias("level")) for s in slices]))
    return point_metrics(scored.select("model", "y", "err", "abs_err", one.alias("s")).select("*", "s.*"), ["model", "slice", "level"])


def skill(metrics: DataFrame, reference: str, keys: list[str]) -> DataFrame:
    """1 - MAE / MAE of the reference model."""
    ref = metrics.where(F.col("model") == reference).select(*keys, F.col("mae").alias("__ref"))
    return metrics.join(ref, keys, "left").withColumn("skill", 1 - F.try_divide(F.col("mae"), F.col("__ref"))).drop("__ref")


def pinball95(scored: DataFrame, by: list[str]) -> DataFrame:
    """Mean pinball loss of the two ends of the 95 % interval."""
    loss = (pinball(F.col("y"), F.col("lo95"), 0.025) + pinball(F.col("y"), F.col("hi95"), 0.975)) / 2
    return scored.where("lo95 is not null and hi95 is not null").groupBy(*by).agg(F.count("*").alias("n"), F.avg(loss).alias("pinball95"))


def pooled(pairs: DataFrame) -> DataFrame:
    """Paired daily losses summed over the entities: (model, day, entities, loss, ref_loss, n)."""
    return pairs.groupBy("model", "day").agg(F.count("*").alias("entities"), F.sum("loss").alias("loss"), F.sum("ref_loss").alias("ref_loss"), F.sum("n").alias("n"))


def daily_losses(scored: DataFrame) -> DataFrame:
    """(entity, model, day, loss, ape, n): sums of absolute and of relative absolute errors, and scored hours."""
    ape = F.try_divide(F.col("abs_err"), F.abs("y"))
    return scored.groupBy("entity", "model", "day").agg(F.sum("abs_err").alias("loss"), F.sum(ape).alias("ape"), F.count("*").alias("n"))


def paired(losses: DataFrame, reference: str) -> DataFrame:
    """Each model's daily losses beside the reference's, on days with equally many scored hours."""
    ref = losses.where(F.col("model") == reference).select("entity", "day", F.col("loss").alias("ref_loss"), F.col("n").alias("ref_n"))
    return losses.where(F.col("model") != reference).join(ref, ["entity", "day"]).where("n = ref_n").drop("ref_n")


def with_pooled(pairs: DataFrame, name: str = "ALL") -> DataFrame:
    """Paired losses of each entity, and those of all entities together as the entity ``name``."""
    return pairs.select("entity", "model", "day", "loss", "ref_loss", "n").unionByName(pooled(pairs).select(F.lit(name).alias("entity"), "model", "day", "loss", "ref_loss", "n"))


def diebold_mariano(d: np.ndarray, lag: int = 7) -> tuple[float, float]:
    """Statistic with Bartlett weights and the small-sample correction for horizon ``lag`` + 1, and its two-sided normal p."""
    n, x = len(d), d - d.mean()
    if n < 10:
        return math.nan, math.nan
    var = float(x @ x) / n + 2 * sum((1 - k / (lag + 1)) * float(x[k:] @ x[:-k]) / n for k in range(1, min(lag, n - 1) + 1))
    if var <= 0:
        return 0.0, 1.0
    h = lag + 1
    t = float(d.mean()) / math.sqrt(var / n) * math.sqrt(max(0.0, n + 1 - 2 * h + h * (h - 1) / n) / n)
    return t, math.erfc(abs(t) / math.sqrt(2))


def bootstrap_skill(loss: np.ndarray, ref: np.ndarray, seed: int, draws: int = 1000, block: int = 7) -> tuple[float, float, float]:
    """Skill and the 95 % percentile interval of moving-block resamples of days."""
    n, rng = len(loss), np.random.default_rng(seed)
    block = min(block, n)
    start = rng.integers(0, n - block + 1, size=(draws, -(-n // block)))
    at = (start[:, :, None] + np.arange(block)).reshape(draws, -1)[:, :n]
    low, high = np.quantile(1 - loss[at].sum(1) / ref[at].sum(1), [0.025, 0.975])
    return 1 - float(loss.sum() / ref.sum()), float(low), float(high)


def compare(pairs: DataFrame, reference: str, least: int = 30, seed: int | None = None) -> DataFrame:
    """Skill with its interval and the Diebold-Mariano test for each entity and model. One group is one model's days.

    Without a ``seed`` each comparison has its own, made of the names.
    """

    def one(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("day")
        entity, model = g.entity.iloc[0], g.model.iloc[0]
        own = zlib.crc32(f"{model}|{reference}|{entity}".encode()) if seed is None else seed
        s, low, high = bootstrap_skill(g.loss.to_numpy(), g.ref_loss.to_numpy(), own)
        t, p = diebold_mariano((g.loss - g.ref_loss).to_numpy())
        return pd.DataFrame([(entity, model, len(g), s, low, high, t, p)], columns=["entity", "model", "days", "skill", "low", "high", "dm", "p"])

    enough = pairs.withColumn("__d", F.count("*").over(W.partitionBy("entity", "model"))).where(F.col("__d") >= least).drop("__d")
    schema = "entity string, model string, days long, skill double, low double, high double, dm double, p double"
    return enough.groupBy("entity", "model").applyInPandas(one, schema)


def significance(comparisons: DataFrame) -> DataFrame:
    """Wins, losses and undecided comparisons by model."""
    win, lose = "low > 0 and p < 0.05", "high < 0 and p < 0.05"
    return comparisons.groupBy("model").agg(
        F.count_if(F.expr(win)).alias("wins"), F.count_if(F.expr(lose)).alias("losses"), F.count_if(F.expr(f"not ({win}) and not ({lose})")).alias("open")
    )


def conformal(scored: DataFrame, window: int = 56, gap: int = 2, least: int = 21, alpha: float = 0.2) -> DataFrame:
    """Conformalised interval of an (entity, model, day, y, lo, hi) frame: both ends move by the finite-sample quantile
    of the scores of the ``window`` days that end ``gap`` days before; null with fewer than ``least`` days of scores."""
    score = F.greatest(F.col("lo") - F.col("y"), F.col("y") - F.col("hi"))
    past = W.partitionBy("entity", "model").orderBy("day").rangeBetween(-(window + gap - 1), -gap)
    rows = scored.withColumn("__s", F.array_sort(F.collect_list(score).over(past))).withColumn("__d", F.size(F.array_distinct(F.collect_list(F.when(score.isNotNull(), F.col("day"))).over(past))))
    n = F.size("__s")
    k = F.least(n, F.ceil((n + 1) * (1 - alpha)).cast("int"))
    rows = rows.withColumn("move", F.when(F.col("__d") >= least, F.element_at("__s", F.greatest(k, F.lit(1)))))
    return rows.drop("__s", "__d").withColumns({"lo_cal": F.col("lo") - F.col("move"), "hi_cal": F.col("hi") + F.col("move")})


def nearest_quantile(values: Column, level: float) -> Column:
    """The element of a sorted aggregate nearest to a level: no interpolation."""
    v = F.array_sort(F.collect_list(values))
    return F.element_at(v, (F.round(level * (F.size(v) - 1)) + 1).cast("int"))


#: Meteorological seasons by month. Fixed values.
SEASONS = {12: "winter", 1: "winter", 2: "winter", 3: "spring", 4: "spring", 5: "spring", 6: "summer", 7: "summer", 8: "summer", 9: "autumn", 10: "autumn", 11: "autumn"}


def extremes(days: DataFrame, by: list[str], column: str, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """(*by, lo, hi): nearest quantiles of ``column`` over the rows of each group, by running counts of its values."""
    n = days.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("__n"))
    mine = W.partitionBy(*by)
    n = n.withColumns({"__r": F.sum("__n").over(mine.orderBy(column)), "__t": F.sum("__n").over(mine)})
    at = lambda q: F.min(F.when(F.col("__r") > F.round(q * (F.col("__t") - 1)), F.col(column)))
    return n.groupBy(*by).agg(at(low).alias("lo"), at(high).alias("hi"))


def all_slices(scored: DataFrame, keys: DataFrame) -> DataFrame:
    """(slice, value, model, hours, mape) over season, hour block, day type and temperature, pooled over entities.

    ``keys`` has entity, h, day (a date), local_hour and temp_mean, the mean temperature of that day. Days whose
    temperature is among the highest or lowest 5 % of an entity's and model's scored hours are hot or cold.
    """
    from ..functions import holidays

    rows = scored.drop("day", "temp_mean", "local_hour").join(keys.select("entity", "h", "day", "local_hour", "temp_mean"), ["entity", "h"], "left")
    rows = rows.join(extremes(rows, ["entity", "model"], "temp_mean"), ["entity", "model"], "left")
    season = F.element_at(F.create_map(*[F.lit(x) for kv in SEASONS.items() for x in kv]), F.month("day"))
    temperature = F.when(F.col("temp_mean").isNull(), "no weather").when(F.col("temp_mean") >= F.col("hi"), "hot 5%").when(F.col("temp_mean") <= F.col("lo"), "cold 5%").otherwise("normal")
    block = F.lpad((F.floor(F.col("local_hour") / 6) * 6).cast("string"), 2, "0")
    rows = rows.select("model", "abs_err", "y", season.alias("season"), block.alias("hour_block"), holidays.day_type(F.col("day")).alias("day_type"), temperature.alias("temperature"))
    names = ["season", "hour_block", "day_type", "temperature"]
    sets = rows.groupingSets([[F.col("model"), F.col(c)] for c in names], F.col("model"), *map(F.col, names))
    g = sets.agg(F.grouping_id().alias("__g"), F.count("*").alias("hours"), (F.avg(F.try_divide(F.col("abs_err"), F.col("y"))) * 100).alias("mape"))
    bit = lambda i: F.col("__g").bitwiseAND(1 << (len(names) - 1 - i)) == 0  # noqa: E731  a grouped column has a zero bit
    which = F.coalesce(*[F.when(bit(i), F.lit(c)) for i, c in enumerate(names)])
    value = F.coalesce(*[F.when(bit(i), F.col(c)) for i, c in enumerate(names)])
    return g.select(which.alias("slice"), value.alias("value"), "model", "hours", "mape")
