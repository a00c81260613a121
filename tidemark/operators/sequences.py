"""Sequences for models that read history: filled grids, histories cut at each origin's own cutoff, horizons, abstention.

History is dealt into blocks of hours. A block is gathered once, as an array of bounded length, and goes to the origins
whose history touches it, so no entity's history meets in one task and a row reaches a bounded number of origins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def regular(panel: DataFrame) -> DataFrame:
    """Every hour between an entity's first and last, with the panel's columns where there is a row."""
    span = panel.groupBy("entity").agg(F.min("h").alias("a"), F.max("h").alias("z"))
    return span.select("entity", F.explode(F.sequence("a", "z")).alias("h")).join(panel, ["entity", "h"], "left")


def filled(grid: DataFrame, forward: list[str], backward: list[str] = (), block: int = 720) -> DataFrame:
    """Nulls of ``forward`` columns take the last value before, those of ``backward`` columns then the first one after.

    Windows run within blocks of ``block`` hours; a second pass over one row for each block says what it inherits.
    """
    grid = grid.withColumn("__b", F.floor(F.col("h") / block))
    for columns, last, order in ((forward, True, "h"), (backward, False, "-h")):
        if not columns:
            continue
        within = W.partitionBy("entity", "__b").orderBy(F.expr(order)).rowsBetween(W.unboundedPreceding, 0)
        grid = grid.withColumns({c: F.last(c, ignorenulls=True).over(within) for c in columns})
        # max_by / min_by skip no nulls, so only hours with a value are named.
        pick = F.max_by if last else F.min_by
        ends = grid.groupBy("entity", "__b").agg(*[pick(c, F.when(F.col(c).isNotNull(), F.col("h"))).alias(f"__{c}") for c in columns])
        before = W.partitionBy("entity").orderBy(F.col("__b") if last else F.desc("__b")).rowsBetween(W.unboundedPreceding, -1)
        ends = ends.select("entity", "__b", *[F.last(f"__{c}", ignorenulls=True).over(before).alias(f"__{c}") for c in columns])
        grid = grid.join(ends, ["entity", "__b"]).withColumns({c: F.coalesce(c, f"__{c}") for c in columns}).drop(*[f"__{c}" for c in columns])
    return grid.drop("__b")


def histories(grid: DataFrame, origins: DataFrame, value: str, length: int = 168) -> DataFrame:
    """(entity, day, cutoff, last, n, values): the ``length`` hours up to an origin's cutoff, in order, as far as there are rows.

    ``last`` is the newest hour among them. Origins without a row in reach are left out.
    """
    block = lambda h: F.floor(h / length).cast("long")
    blocks = grid.groupBy("entity", block(F.col("h")).alias("b")).agg(F.sort_array(F.collect_list(F.struct("h", F.col(value).alias("v")))).alias("rows"))
    at = F.explode(F.array(block(F.col("cutoff")) - 1, block(F.col("cutoff")))).alias("b")
    wanted = origins.select("entity", "day", "cutoff", at)
    inside = F.filter("rows", lambda r: (r["h"] <= F.col("cutoff")) & (r["h"] > F.col("cutoff") - length))
    parts = wanted.join(blocks, ["entity", "b"]).select("entity", "day", "cutoff", "b", inside.alias("rows"))
    g = parts.groupBy("entity", "day", "cutoff").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("b", "rows"))), lambda x: x["rows"])).alias("rows"))
    g = g.where(F.size("rows") > 0)
    return g.select("entity", "day", "cutoff", F.element_at("rows", -1)["h"].alias("last"), F.size("rows").alias("n"), F.transform("rows", lambda r: r["v"]).alias("values"))


def horizon(history: DataFrame, panel: DataFrame, exogenous: list[str], hours: int = 44) -> DataFrame:
    """(entity, day, step, h, exogenous): the ``hours`` hours after each history's last, exogenous gaps filled forward within them."""
    grid = history.select("entity", "day", "last", F.explode(F.sequence(F.lit(1), F.lit(hours))).alias("step"))
    grid = grid.select("entity", "day", "step", (F.col("last") + F.col("step")).alias("h"))
    past = W.partitionBy("entity", "day").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    out = grid.join(panel.select("entity", "h", *exogenous), ["entity", "h"], "left")
    return out.select("entity", "day", "step", "h", *[F.last(c, ignorenulls=True).over(past).alias(c) for c in exogenous])


def past_cutoff(history: DataFrame) -> DataFrame:
    """Histories that hold an hour after their origin's cutoff: none, by construction."""
    return history.where("last > cutoff")


def abstained(forecasts: DataFrame, train: DataFrame, columns: list[str], times: float = 3.0) -> DataFrame:
    """Forecasts with ``abstained``: those above ``times`` the largest value seen in training become null in all ``columns``."""
    top = F.broadcast(train.agg(F.max("value").alias("__top")))  # one row
    rows = forecasts.join(top).withColumn("abstained", F.coalesce(F.col("yhat") > times * F.col("__top"), F.lit(False)))
    return rows.withColumns({c: F.when(~F.col("abstained"), F.col(c)) for c in columns}).drop("__top")
