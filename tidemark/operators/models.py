"""Forecasters as DataFrame plans; only the ridge fit runs per entity and month in numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def seasonal_naive(panel: DataFrame, back: int) -> DataFrame:
    """(entity, day, yhat): the value ``back`` days before, for days of the panel."""
    past = panel.select("entity", (F.col("day") + back).alias("day"), F.col("value").alias("yhat"))
    return panel.select("entity", "day").join(past, ["entity", "day"])


def residual_quantiles(panel: DataFrame, back: int, levels: dict[str, float]) -> DataFrame:
    """Nearest quantiles of the ratio of actual and naive forecast, by entity."""
    r = panel.join(seasonal_naive(panel, back), ["entity", "day"]).select("entity", F.try_divide("value", "yhat").alias("r")).where("r is not null")
    mine = W.partitionBy("entity")
    r = r.select("*", F.row_number().over(mine.orderBy("r")).alias("k"), F.count("*").over(mine).alias("n"))
    at = lambda q: F.max(F.when(F.col("k") == F.round(q * (F.col("n") - 1)) + 1, F.col("r")))
    return r.groupBy("entity").agg(F.count("*").alias("n"), *[at(q).alias(c) for c, q in levels.items()])


def bias(rows: DataFrame, span: int = 28, least: int = 14, delay: int = 2, by: tuple[str, ...] = ("entity",)) -> DataFrame:
    """(*by, day, bias): mean error of the benchmark over ``span`` days that end ``delay`` days before; null with fewer than ``least``."""
    past = W.partitionBy(*by).orderBy("day").rangeBetween(-(span - 1), 0)
    err = F.col("benchmark") - F.col("value")
    return rows.select(*by, (F.col("day") + delay).alias("day"), F.when(F.count(err).over(past) >= least, F.avg(err).over(past)).alias("bias"))


def debias(rows: DataFrame, span: int = 28, least: int = 14, delay: int = 2, by: tuple[str, ...] = ("entity",)) -> DataFrame:
    """(*by, day, yhat): the benchmark less its ``bias``, as it is where that is null."""
    off = bias(rows, span, least, delay, by)
    return rows.join(off, [*by, "day"], "left").select(*by, "day", (F.col("benchmark") - F.coalesce("bias", F.lit(0.0))).alias("yhat"))


def hourly_residual_quantiles(rows: DataFrame, levels: dict[str, float]) -> DataFrame:
    """Nearest quantiles of value / yhat by entity and local hour: a rank of each row, no arrays of a group's rows."""
    mine = W.partitionBy("entity", "local_hour")
    r = rows.select("entity", "local_hour", F.try_divide("value", "yhat").alias("r")).where("r is not null")
    r = r.select("*", F.row_number().over(mine.orderBy("r")).alias("k"), F.count("*").over(mine).alias("n"))
    at = lambda q: F.max(F.when(F.col("k") == F.round(q * (F.col("n") - 1)) + 1, F.col("r")))
    return r.groupBy("entity", "local_hour").agg(F.count("*").alias("n"), *[at(q).alias(c) for c, q in levels.items()])


def local_climatology(panel: DataFrame) -> DataFrame:
    """Mean value by entity, month and local hour."""
    return panel.groupBy("entity", F.month("day").alias("month"), "local_hour").agg(F.count("value").alias("n"), F.avg("value").alias("mean"))


def climatology(panel: DataFrame) -> DataFrame:
    return panel.groupBy("entity", ((F.col("h") - 1) % 24).cast("int").alias("hour")).agg(F.avg("value").alias("mean"))


def fill_grid(panel: DataFrame) -> DataFrame:
    """A regular grid between each entity's first and last period, gaps filled forward."""
    span = panel.groupBy("entity").agg(F.min("h").alias("a"), F.max("h").alias("z"))
    grid = span.select("entity", F.explode(F.sequence("a", "z")).alias("h"))
    past = W.partitionBy("entity").orderBy("h").rowsBetween(W.unboundedPreceding, 0)
    out = grid.join(panel.select("entity", "h", "value"), ["entity", "h"], "left")
    return out.select("entity", "h", F.last("value", ignorenulls=True).over(past).alias("value"))


def ridge_backtest(panel: DataFrame, alpha: float = 1.0, gap: int = 2, least: int = 180) -> DataFrame:
    """(entity, month, days, mae, naive_mae): monthly refits of a ridge on lags of 7, 14, 28 and 364 days and the weekday.

    A fit for a month takes the days that end ``gap`` days before it, ``least`` of them at least. One group is one entity.
    """
    lagged = panel
    for k in (7, 14, 28, 364):
        lagged = lagged.join(panel.select("entity", (F.col("day") + k).alias("day"), F.col("value").alias(f"lag{k}")), ["entity", "day"])
    month = F.trunc(F.date_from_unix_date(F.col("day").cast("int")), "month")
    lagged = lagged.withColumn("month", month.cast("string")).withColumn("month_day", F.unix_date(month).cast("long"))

    def fit(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("day")
        x = np.column_stack([np.log1p(g[[f"lag{k}" for k in (7, 14, 28, 364)]].to_numpy()), *[(g.day % 7 == w).to_numpy(float) for w in range(7)]])
        y, out = np.log1p(g.value.to_numpy()), []
        for name, start in sorted(set(zip(g.month, g.month_day, strict=True))):
            train, test = (g.day < start - gap + 1).to_numpy(), (g.month == name).to_numpy()
            if train.sum() < least:
                continue
            mean, center = x[train].mean(0), y[train].mean()
            w = np.linalg.solve((x[train] - mean).T @ (x[train] - mean) + alpha * np.eye(x.shape[1]), (x[train] - mean).T @ (y[train] - center))
            yhat, real = np.expm1((x[test] - mean) @ w + center), g.value.to_numpy()[test]
            out.append((g.entity.iloc[0], name, int(test.sum()), float(np.abs(yhat - real).mean()), float(np.abs(g.lag7.to_numpy()[test] - real).mean())))
        return pd.DataFrame(out, columns=["entity", "month", "days", "mae", "naive_mae"])

    return lagged.groupBy("entity").applyInPandas(fit, "entity string, month string, days long, mae double, naive_mae double")


def population_stability(rows: DataFrame, columns: list[str], bins: int = 10) -> DataFrame:
    """(feature, psi, drifted): stability of each column between rows with and without ``now``, over deciles of the latter."""
    out = None
    for c in columns:
        edges = rows.where("not now").agg(F.percentile(c, F.array(*[F.lit(i / bins) for i in range(1, bins)])).alias("e"))
        b = rows.where(F.col(c).isNotNull()).join(F.broadcast(edges)).select("now", F.size(F.filter("e", lambda e: e < F.col(c))).alias("bin"))  # one row
        n = b.groupBy("bin").agg(F.count_if("now").alias("a"), F.count_if(~F.col("now")).alias("b"))
        total = n.agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"))
        share = lambda x, t: (F.col(x) + 0.5) / (F.col(t) + 0.5 * bins)
        term = (share("a", "ta") - share("b", "tb")) * F.log(share("a", "ta") / share("b", "tb"))
        one = n.join(F.broadcast(total)).agg(F.sum(term).alias("psi")).select(F.lit(c).alias("feature"), "psi", (F.col("psi") > 0.2).alias("drifted"))
        out = one if out is None else out.unionByName(one)
    return out
