"""Ridge regression with expanding refits from sums that add up.

A row becomes a vector of columns: one-hot groups, cubic B-splines, and numeric columns, each of the latter two with an
indicator of nulls. Products of these vectors are summed by (entity, period) and cumulated over an entity's periods, so a
refit on all periods up to one is a prefix sum, whatever the length of the history, and no entity's rows meet in one
task. Imputation, scaling and the intercept are linear in these sums: a median replaces a null as a multiple of the
indicator column, and standardising is a change of the penalty. So the coefficients are those of a fit on the imputed,
scaled rows themselves.

Knots (equally spaced from the least to the largest value) and medians belong to an entity and come from its ``basis``
rows, the first training range; values outside count as the nearest end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Design:
    """Columns of the regression: levels of each one-hot column (unknown ones are all zero), splines and numbers."""

    onehot: dict[str, tuple[int, ...]]
    splines: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    knots: int = 7

    @property
    def functions(self) -> int:
        return self.knots + 2  # of a cubic spline

    @property
    def width(self) -> int:
        """Columns of a row: the constant, one-hot, each spline and its nulls, each number and its nulls."""
        return 1 + sum(map(len, self.onehot.values())) + len(self.splines) * (self.functions + 1) + 2 * len(self.numbers)


def basis(rows: DataFrame, design: Design, accuracy: int = 10_000) -> DataFrame:
    """(entity, lo_*, hi_*, mid_*): ends of the splines and medians of an entity's rows; one row for each entity."""
    names = [*design.splines, *design.numbers]
    return rows.groupBy("entity").agg(
        *[f(c).alias(f"{p}_{c}") for c in design.splines for p, f in (("lo", F.min), ("hi", F.max))],
        *[F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(f"mid_{c}") for c in names],
    )


def spline(x: Column, lo: Column, hi: Column, knots: int) -> list[Column]:
    """The cubic B-splines of equally spaced knots at x, which counts as the nearer end outside [lo, hi]; a constant if lo = hi."""
    t = F.coalesce(F.try_divide(F.least(F.greatest(x, lo), hi) - lo, hi - lo), F.lit(0.0)) * (knots - 1)

    def bump(k: int) -> Column:
        u = F.abs(t - (k - 1))  # distance from the middle of the k-th function, in knots
        return F.when(u < 1, (4 - 6 * u * u + 3 * u * u * u) / 6).when(u < 2, (2 - u) * (2 - u) * (2 - u) / 6).otherwise(0.0)

    return [bump(k) for k in range(knots + 2)]


def vectors(rows: DataFrame, ends: DataFrame, design: Design, target: str) -> DataFrame:
    """``rows`` with ``x``, the columns of the design, and ``t``, the target as a double; entities without a basis go.

    ``ends`` has a row for each entity and is joined by it.
    """
    rows = rows.join(ends, "entity")
    known = lambda c: F.when(F.col(c).isNull(), 0.0).otherwise(1.0)
    parts = [F.lit(1.0)]
    for c, levels in design.onehot.items():
        parts += [F.when(F.col(c) == v, 1.0).otherwise(0.0) for v in levels]
    for c in design.splines:
        parts += [F.coalesce(b, F.lit(0.0)) * known(c) for b in spline(F.col(c).cast("double"), F.col(f"lo_{c}"), F.col(f"hi_{c}"), design.knots)]
        parts.append(1 - known(c))
    for c in design.numbers:
        parts += [F.coalesce(F.col(c).cast("double"), F.lit(0.0)), 1 - known(c)]
    return rows.withColumn("x", F.array(*parts)).withColumn("t", F.col(target).cast("double"))


def _lists(m: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32), pa.array(m.ravel().astype(float)))


def grams(rows: DataFrame, period: str) -> DataFrame:
    """(entity, period, g): sums of the products of (x, t) with themselves, upper triangle, by entity and period.

    Tasks sum first; what they send is a row for each entity and period they saw, merged in order of these.
    """
    schema = "entity string, period long, g array<double>"

    def batch(held: dict) -> pa.RecordBatch:
        keys = list(held)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), _lists(np.array([held[k] for k in keys]))], names=["entity", "period", "g"]
        )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            if not b.num_rows:
                continue
            y = b["t"].to_numpy(zero_copy_only=False)
            z = np.column_stack([b["x"].flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1), y])
            keys = list(zip(b["entity"].to_pylist(), b["period"].to_pylist(), strict=True))
            upper = np.triu_indices(z.shape[1])
            for key in dict.fromkeys(keys):
                m = z[[k == key for k in keys]]
                held[key] = held.get(key, 0.0) + (m.T @ m)[upper]
            if len(held) >= 256:
                yield batch(held)
                held = {}
        if held:
            yield batch(held)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, None
        for b in batches:
            for entity, period, g in zip(b["entity"].to_pylist(), b["period"].to_pylist(), b["g"], strict=True):
                g = g.values.to_numpy(zero_copy_only=False)
                if (entity, period) == last:
                    total = total + g
                else:
                    if last is not None:
                        yield batch({last: total})
                    last, total = (entity, period), g
        if last is not None:
            yield batch({last: total})

    part = rows.where("t is not null").select(F.col("entity").cast("string").alias("entity"), F.col(period).cast("long").alias("period"), "x", "t")
    part = part.sortWithinPartitions("entity", "period").mapInArrow(summed, schema)
    return part.repartition("entity", "period").sortWithinPartitions("entity", "period").mapInArrow(merged, schema)


def solve(g: np.ndarray, design: Design, ends: dict, alpha: float) -> np.ndarray | None:
    """Weights over the columns of a row (the first is the intercept) from summed products; None without rows."""
    p = design.width
    m = np.zeros((p + 1, p + 1))
    m[np.triu_indices(p + 1)] = g
    m = m + np.triu(m, 1).T
    n = m[0, 0]
    if n <= 0:
        return None
    # Columns of the imputed, scaled design as combinations of the columns of a row.
    columns, scaled = [], []
    at = 1
    for levels in design.onehot.values():
        columns += [{at + k: 1.0} for k in range(len(levels))]
        at += len(levels)
    for c in design.splines:
        fill = _plain_spline(ends[f"mid_{c}"], ends[f"lo_{c}"], ends[f"hi_{c}"], design.knots)
        columns += [{at + k: 1.0, at + design.functions: fill[k]} for k in range(design.functions)]
        at += design.functions + 1
    for c in design.numbers:
        scaled.append(len(columns))
        columns.append({at: 1.0, at + 1: ends[f"mid_{c}"] or 0.0})
        at += 2
    t = np.zeros((p, len(columns)))
    for k, c in enumerate(columns):
        for i, v in c.items():
            t[i, k] = v
    gram, xy = t.T @ m[:p, :p] @ t, t.T @ m[:p, p]
    mean, mean_y = t.T @ m[0, :p] / n, m[0, p] / n
    gram, xy = gram - n * np.outer(mean, mean), xy - n * mean * mean_y
    size = np.ones(len(columns))
    spread = np.sqrt(np.maximum(np.diag(gram) / n, 0.0))
    for k in scaled:
        size[k] = spread[k] if spread[k] > 1e-12 * max(1.0, abs(mean[k])) else 1.0
    w = np.linalg.solve(gram / np.outer(size, size) + alpha * np.eye(len(columns)), xy / size) / size
    out = t @ w
    out[0] += mean_y - mean @ w
    return out


def _plain_spline(x, lo, hi, knots: int) -> np.ndarray:
    if x is None or lo is None or hi is None:
        return np.zeros(knots + 2)
    t = (min(max(x, lo), hi) - lo) / (hi - lo) * (knots - 1) if hi > lo else 0.0
    u = np.abs(t - (np.arange(knots + 2) - 1))
    return np.where(u < 1, (4 - 6 * u**2 + 3 * u**3) / 6, np.where(u < 2, (2 - u) ** 3 / 6, 0.0))


def refits(sums: DataFrame, ends: DataFrame, periods: DataFrame, design: Design, alpha: float = 1.0, least: float = 1) -> DataFrame:
    """(entity, refit, n, w): weights for each (entity, refit, train_end) of ``periods`` from the sums of all periods up to train_end.

    A refit with fewer than ``least`` rows is left out. A group is an entity's sums: one row for each period, not its rows.
    """
    names = [c for c in ends.columns if c != "entity"]
    ends = ends.select("entity", F.array(*[F.col(c).cast("double") for c in names]).alias("ends"))
    want = periods.select("entity", F.col("train_end").cast("long").alias("period"), F.lit(None).cast("array<double>").alias("g"), F.col("refit").cast("long").alias("refit"), F.lit(1).alias("kind"))
    have = sums.select("entity", "period", "g", F.lit(None).cast("long").alias("refit"), F.lit(0).alias("kind"))
    rows = have.unionByName(want).join(ends, "entity").repartition("entity").sortWithinPartitions("entity", "period", "kind", "refit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entity, total = None, None
        for b in batches:
            for e, g, refit, kind, ends_ in zip(b["entity"].to_pylist(), b["g"], b["refit"].to_pylist(), b["kind"].to_pylist(), b["ends"].to_pylist(), strict=True):
                if e != entity:
                    entity, total = e, None
                if kind == 0:
                    g = g.values.to_numpy(zero_copy_only=False)
                    total = g.copy() if total is None else total + g
                elif total is not None and total[0] >= least:
                    w = solve(total, design, dict(zip(names, ends_, strict=True)), alpha)
                    yield pa.RecordBatch.from_arrays([pa.array([e]), pa.array([refit], pa.int64()), pa.array([int(total[0])], pa.int64()), pa.array([w.tolist()], pa.list_(pa.float64()))], names=["entity", "refit", "n", "w"])

    return rows.mapInArrow(run, "entity string, refit long, n long, w array<double>")


def predicted(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """``rows`` with (entity, refit, x) and ``fit``, the product of x and the weights of that entity and refit; null without weights."""
    joined = rows.join(weights.select("entity", "refit", "w"), ["entity", "refit"], "left")
    dot = F.aggregate(F.zip_with("x", "w", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return joined.withColumn("fit", F.when(F.col("w").isNotNull(), dot)).drop("w")


def ratio_bands(rows: DataFrame, by: list[str], levels: dict[str, float]) -> DataFrame:
    """Nearest quantiles of the finite values of ``ratio`` in each group, by rank: no group is held as an array."""
    r = rows.where(F.col("ratio").isNotNull() & ~F.isnan("ratio") & (F.abs("ratio") < float("inf")))
    mine = W.partitionBy(*by)
    r = r.select(*by, "ratio", F.row_number().over(mine.orderBy("ratio")).alias("k"), F.count("*").over(mine).alias("n"))
    at = lambda q: F.max(F.when(F.col("k") == F.round(q * (F.col("n") - 1)) + 1, F.col("ratio")))
    return r.groupBy(*by).agg(*[at(q).alias(c) for c, q in levels.items()])
