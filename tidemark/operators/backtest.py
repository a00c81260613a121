"""Rolling-origin backtests as one plan: every refit of a set-based model is a group, not an iteration.

A matrix has entity, day (a day number), y and features. A window is cut into refits, one for each calendar month. A row
trains a refit if its day is at least ``gap`` days before the refit's first day, so it belongs to all refits from some
number on (``period``); sums over periods cumulate into what each refit may know, and what needs the last year of
training rows gets each row dealt to the few refits it counts for.

A model is a function (matrix, plan) -> rows with entity, day, refit, yhat and any of the quantiles.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import ridge, trees

QUANTILES = trees.QUANTILES
RECENT = 365
_EPOCH = dt.date(1970, 1, 1)


@dataclass(frozen=True)
class Plan:
    """An evaluation window and its training policy; days are dates."""

    start: dt.date
    end: dt.date
    train_start: dt.date | None = None
    least_days: int = 180
    gap: int = 2

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError("the window ends before it starts")
        if self.gap < 1:
            raise ValueError("training must end before the forecast starts")

    def months(self) -> list[tuple[int, int]]:
        """(first, last) day number of each refit."""
        out, at = [], self.start
        while at <= self.end:
            following = dt.date(at.year + at.month // 12, at.month % 12 + 1, 1)
            out.append(((at - _EPOCH).days, (min(following, self.end + dt.timedelta(days=1)) - _EPOCH).days - 1))
            at = following
        return out

    @property
    def refits(self) -> Column:
        """The numbers of all refits, as an array."""
        return F.sequence(F.lit(0).cast("long"), F.lit(len(self.months()) - 1).cast("long"))

    def _month(self, day: Column) -> Column:
        """Calendar months from that of the window's start to that of a day number."""
        date = F.date_from_unix_date(day.cast("int"))
        return (12 * (F.year(date) - self.start.year) + F.month(date) - self.start.month).cast("long")

    def period(self) -> Column:
        """The number of the first refit that a row of that day may train; as many as there are refits if none."""
        later = F.least(self._month(F.col("day") + (self.gap - 1)) + 1, F.lit(len(self.months())).cast("long"))
        return F.when(F.col("day") + self.gap <= self.months()[0][0], F.lit(0).cast("long")).otherwise(later)

    def known(self, matrix: DataFrame) -> DataFrame:
        """Rows that train some refit, with their ``period``."""
        rows = matrix.where("y is not null")
        if self.train_start is not None:
            rows = rows.where(F.col("day") >= (self.train_start - _EPOCH).days)
        return rows.withColumn("period", self.period()).where(F.col("period") < len(self.months()))

    def tested(self, matrix: DataFrame) -> DataFrame:
        """Rows of the window with the number of their ``refit``."""
        first, last = self.months()[0][0], self.months()[-1][1]
        return matrix.where(F.col("day").between(first, last)).withColumn("refit", self._month(F.col("day")))

    def newest(self, matrix: DataFrame) -> list[int | None]:
        """The newest training day of each refit. Raises if a refit has fewer than ``least_days`` days to train on."""
        per = self.known(matrix).select("period", "day").distinct().groupBy("period").agg(F.max("day").alias("day"), F.count("*").alias("n"))
        by = {r["period"]: r for r in per.collect()}  # one row for each refit at most
        tested = {r["refit"] for r in self.tested(matrix).select("refit").distinct().collect()}
        out, newest, days = [], None, 0
        for k, (first, _) in enumerate(self.months()):
            if k in by:
                newest = by[k]["day"] if newest is None else max(newest, by[k]["day"])
                days += by[k]["n"]
            if k in tested and days < self.least_days:
                raise ValueError(f"only {days} training days before {_EPOCH + dt.timedelta(days=first)}; need {self.least_days}")
            out.append(newest)
        return out

    def recent(self, matrix: DataFrame, newest: list[int | None], span: int = RECENT) -> DataFrame:
        """Training rows dealt to each ``refit`` whose newest training day is at most ``span`` days after theirs."""
        ends = F.array(*[F.lit(n).cast("long") for n in newest])
        refits = F.filter(self.refits, lambda i: (i >= F.col("period")) & (F.get(ends, i.cast("int")) - span <= F.col("day")))
        return self.known(matrix).withColumn("refit", F.explode(refits))


Model = Callable[[DataFrame, Plan], DataFrame]


def _banded(rows: DataFrame, bands: DataFrame, by: list[str]) -> DataFrame:
    return rows.join(bands, by, "left").withColumns({q: F.col("yhat") * F.col(q) for q in QUANTILES})


def seasonal_naive(lag: str = "lag7", slot: str = "weekday") -> Model:
    """The value a week before; bands are quantiles of its ratio to the actual by entity and ``slot`` over the last year."""

    def run(matrix: DataFrame, plan: Plan) -> DataFrame:
        rows = plan.recent(matrix, plan.newest(matrix)).withColumn("ratio", F.try_divide(F.col("y"), F.col(lag)))
        by = ["entity", "refit", slot]
        return _banded(plan.tested(matrix).withColumn("yhat", F.col(lag)), ridge.ratio_bands(rows, by, QUANTILES), by)

    return run


def climatology(slot: str = "weekday") -> Model:
    """Mean of all training values of an entity and slot: sums by period, cumulated."""

    def run(matrix: DataFrame, plan: Plan) -> DataFrame:
        sums = plan.known(matrix).groupBy("entity", slot, "period").agg(F.sum("y").alias("s"), F.count("y").alias("n"))
        every = sums.select("entity", slot).distinct().select("*", F.explode(plan.refits).alias("period"))
        past = W.partitionBy("entity", slot).orderBy("period").rowsBetween(W.unboundedPreceding, 0)
        mean = every.join(sums, ["entity", slot, "period"], "left").select("entity", slot, F.col("period").alias("refit"), F.try_divide(F.sum("s").over(past), F.sum("n").over(past)).alias("yhat"))
        return plan.tested(matrix).join(mean, ["entity", slot, "refit"], "left")

    return run


def published(column: str) -> Model:
    """A forecast that comes with the matrix."""
    return lambda matrix, plan: plan.tested(matrix).withColumn("yhat", F.col(column))


def debiased(column: str, span: int = 28, least: int = 14, delay: int = 2) -> Model:
    """A published forecast less its mean error over ``span`` days that ended ``delay`` days before."""

    def run(matrix: DataFrame, plan: Plan) -> DataFrame:
        from .models import bias

        off = bias(matrix.where(F.col(column).isNotNull() & F.col("y").isNotNull()).withColumns({"benchmark": F.col(column), "value": F.col("y")}), span, least, delay)
        rows = plan.tested(matrix).join(off, ["entity", "day"], "left")
        return rows.withColumn("yhat", F.col(column) - F.coalesce("bias", F.lit(0.0))).drop("bias")

    return run


def ridge_model(design: ridge.Design, level: str = "level", needs: tuple[str, ...] = ("lag7_ratio",), slot: str = "weekday", alpha: float = 1.0) -> Model:
    """Ridge on the target relative to ``level``, refitted by prefix sums; bands as those of the naive model, from its own fit."""

    def run(matrix: DataFrame, plan: Plan) -> DataFrame:
        newest = plan.newest(matrix)
        rows = matrix.withColumn("__t", F.try_divide(F.col("y"), F.col(level)))
        usable = F.col("__t").isNotNull()
        for c in needs:
            usable &= F.col(c).isNotNull()
        train = plan.known(rows).where(usable)
        ends = ridge.basis(train.where("period = 0"), design)
        x = ridge.vectors(rows, ends, design, "__t")
        sums = ridge.grams(plan.known(x).where(usable), "period")
        refits = ends.select("entity", F.explode(plan.refits).alias("refit")).withColumn("train_end", F.col("refit"))
        weights = ridge.refits(sums, ends, refits, design, alpha)
        fitted = ridge.predicted(plan.recent(x, newest).where(usable), weights).withColumn("ratio", F.try_divide(F.col("y"), F.col("fit") * F.col(level)))
        by = ["entity", "refit", slot]
        # Rows of entities without a basis stay, without a forecast.
        keys = matrix.columns
        scored = ridge.predicted(plan.tested(x), weights).withColumn("yhat", F.col("fit") * F.col(level))
        rest = plan.tested(matrix).join(ends.select("entity"), "entity", "left_anti").withColumn("yhat", F.lit(None).cast("double"))
        return _banded(scored.select(*keys, "refit", "yhat").unionByName(rest.select(*keys, "refit", "yhat")), ridge.ratio_bands(fitted, by, QUANTILES), by)

    return run


def boosted(features: list[str], categorical: list[str], level: str = "level", params: trees.Params = trees.Params(), every: int = 1) -> Model:
    """Boosted trees on the target relative to ``level``, fitted anew for every ``every``-th refit, one after the other."""

    def run(matrix: DataFrame, plan: Plan) -> DataFrame:
        plan.newest(matrix)
        train = plan.known(matrix.withColumn("__t", F.try_divide(F.col("y"), F.col(level))))
        out = None
        for k in range(0, len(plan.months()), every):
            forest = trees.fit(train.where(F.col("period") <= k), "__t", features, categorical, params)
            test = plan.tested(matrix).where(F.col("refit").between(k, k + every - 1))
            part = trees.predict(forest, test, level)
            out = part if out is None else out.unionByName(part)
        return out

    return run


def as_batch(rows: DataFrame, model: str) -> DataFrame:
    """A model's rows in the form all forecasts have: entity, day, refit, model, yhat and four quantiles, null where absent."""
    q = [F.col(c).cast("double").alias(c) if c in rows.columns else F.lit(None).cast("double").alias(c) for c in QUANTILES]
    return rows.select("entity", F.col("day").cast("long").alias("day"), "refit", F.lit(model).alias("model"), F.col("yhat").cast("double").alias("yhat"), *q)


def forecasts(matrix: DataFrame, models: dict[str, Model], plan: Plan) -> DataFrame:
    """Forecasts of all models for all rows of the window."""
    out = None
    for name, model in models.items():
        batch = as_batch(model(matrix, plan), name)
        out = batch if out is None else out.unionByName(batch)
    return out


def report(matrix: DataFrame, made: DataFrame, plan: Plan) -> DataFrame:
    """(refit, train_rows, train_days, newest, first_test, too_new, forecasts, null_forecasts) for each refit.

    ``too_new`` counts entities whose newest training day isn't ``gap`` days before their first tested day: 0 by design.
    """
    known = plan.known(matrix).groupBy("entity", "period").agg(F.count("*").alias("n"), F.max("day").alias("newest"))
    refits = F.explode(plan.refits).alias("refit")
    dealt = known.select("*", refits).where("refit >= period").groupBy("entity", "refit").agg(F.sum("n").alias("n"), F.max("newest").alias("newest"))
    days = plan.known(matrix).select("period", "day").distinct().groupBy("period").agg(F.count("*").alias("d")).select("d", "period", refits)
    days = days.where("refit >= period").groupBy("refit").agg(F.sum("d").alias("train_days"))
    tested = plan.tested(matrix).groupBy("entity", "refit").agg(F.min("day").alias("first_test"))
    g = dealt.join(tested, ["entity", "refit"]).groupBy("refit").agg(
        F.sum("n").alias("train_rows"), F.max("newest").alias("newest"), F.min("first_test").alias("first_test"), F.count_if(F.col("newest") > F.col("first_test") - plan.gap).alias("too_new")
    )
    done = made.groupBy("refit").agg(F.count("*").alias("forecasts"), F.count_if(F.col("yhat").isNull()).alias("null_forecasts"))
    return g.join(days, "refit").join(done, "refit").select("refit", "train_rows", "train_days", "newest", "first_test", "too_new", "forecasts", "null_forecasts")
