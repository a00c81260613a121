"""Gradient-boosted trees with a point head and quantile heads, grown level by level from histograms.

All rows stay where they are. A task maps its rows to the nodes of the growing trees and sums gradients and counts by
(head, node, feature, bin); these sums meet in one aggregation, a window over the bins of a node scores every split, and
the best split of each node, a table of at most heads x nodes rows, comes back to the driver. All heads grow in the same
jobs. The point head fits squared error. A quantile head takes the gradient of the pinball loss for its splits, and its
leaves are refitted to the quantile of the residuals of their members.

Features are dealt into ``bins`` bins by approximate quantiles; a null has the lowest bin of its own. A categorical
feature has a bin for each category, ordered in each node by its mean gradient, so a split parts the categories in two;
categories beyond the ``bins`` - 1 most frequent share the bin of unknown ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.staging import deleted, written

QUANTILES = {"q025": 0.025, "q10": 0.1, "q90": 0.9, "q975": 0.975}


@dataclass(frozen=True)
class Params:
    rounds: int = 40
    depth: int = 4
    rate: float = 0.1
    bins: int = 32
    least: int = 20  # rows on either side of a split
    l2: float = 1.0
    quantiles: dict[str, float] = field(default_factory=lambda: dict(QUANTILES))
    keep_every: int = 8  # rounds after which predictions are written down
    accuracy: int = 100_000  # of quantiles of residuals: exact in groups of up to so many rows


@dataclass
class Tree:
    """A complete binary tree. ``feature`` -1: no split, all go left. ``right``: whether a bin of that feature goes right."""

    feature: np.ndarray
    right: np.ndarray
    leaf: np.ndarray

    @staticmethod
    def stump(depth: int, bins: int) -> Tree:
        return Tree(np.full(2**depth - 1, -1), np.zeros((2**depth - 1, bins), bool), np.zeros(2**depth))

    def node(self, x: np.ndarray, levels: int) -> np.ndarray:
        """The node, within its level, that each row of bins reaches after so many levels."""
        at = np.zeros(len(x), np.int64)
        for k in range(levels):
            inner = at + 2**k - 1
            f = self.feature[inner]
            at = 2 * at + (self.right[inner, x[np.arange(len(x)), f]] & (f >= 0))
        return at


@dataclass
class Forest:
    names: list[str]
    categories: dict[str, list[str]]
    edges: dict[str, list[float]]
    params: Params
    start: list[float]
    trees: list[list[Tree]] = field(default_factory=list)  # by round, then head
    gain: dict[str, float] = field(default_factory=dict)

    @property
    def heads(self) -> list[str]:
        return ["yhat", *self.params.quantiles]

    def binned(self) -> Column:
        def one(name: str) -> Column:
            if name in self.categories:
                return F.coalesce(F.array_position(F.array(*map(F.lit, self.categories[name])), F.col(name).cast("string")), F.lit(0)).cast("int")
            x = F.col(name).cast("double")
            edges = F.array(*map(F.lit, self.edges[name])) if self.edges[name] else F.array().cast("array<double>")
            return F.when(x.isNull() | F.isnan(x), 0).otherwise(F.size(F.filter(edges, lambda e: e < x)) + 1).cast("int")

        return F.array(*map(one, self.names))

    def values(self, x: np.ndarray, rounds: list[list[Tree]]) -> np.ndarray:
        """What some rounds add to each head, for rows of bins."""
        out = np.zeros((len(x), len(self.heads)))
        for trees in rounds:
            for h, t in enumerate(trees):
                out[:, h] += self.params.rate * t.leaf[t.node(x, self.params.depth)]
        return out

    def importance(self) -> dict[str, float]:
        """Share of each feature in the gain of the point head's splits."""
        total = sum(self.gain.values()) or 1.0
        return {k: self.gain.get(k, 0.0) / total for k in self.names}


def _matrix(column, dtype) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _lists(m: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32), pa.array(m.ravel().astype(float)))


def _gradients(y: np.ndarray, p: np.ndarray, taus: list[float | None]) -> np.ndarray:
    return np.column_stack([y - p[:, h] if t is None else np.where(y < p[:, h], t - 1, t) for h, t in enumerate(taus)])


def _histograms(forest: Forest, growing: list[Tree], pending: list[list[Tree]], level: int) -> Callable:
    """Sums of gradients and counts by (head, node, feature, bin) of a task's rows."""
    d, b, nodes = len(forest.names), forest.params.bins + 1, 2**level
    taus = [None, *forest.params.quantiles.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, n = np.zeros((len(taus), nodes * d * b)), np.zeros((len(taus), nodes * d * b), np.int64)
        for batch in batches:
            x, y = _matrix(batch["x"], np.int64), batch["y"].to_numpy(zero_copy_only=False)
            if not len(y):
                continue
            grads = _gradients(y, _matrix(batch["p"], float) + forest.values(x, pending), taus)
            for h, tree in enumerate(growing):
                at = ((tree.node(x, level)[:, None] * d + np.arange(d)) * b + x).ravel()
                g[h] += np.bincount(at, np.repeat(grads[:, h], d), nodes * d * b)
                n[h] += np.bincount(at, minlength=nodes * d * b)
        head, at = np.nonzero(n)
        columns = [head, at // (d * b), at // b % d, at % b]
        yield pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int32)) for c in columns], pa.array(g[head, at]), pa.array(n[head, at])], names=["head", "node", "feature", "bin", "g", "n"])

    return run


def best_splits(sums: DataFrame, categorical: list[int], least: int, l2: float) -> DataFrame:
    """(head, node, feature, right, gain): the best split of each node that has one, of sums by (head, node, feature, bin).

    Equal gains take the smallest feature, then the fewest bins to the left.
    """
    h = sums.groupBy("head", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
    group = W.partitionBy("head", "node", "feature")
    order = F.when(F.col("feature").isin(categorical), F.col("g") / F.col("n")).otherwise(F.col("bin").cast("double")) if categorical else F.col("bin")
    left = group.orderBy(order, "bin")
    every = group.orderBy(order, "bin").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    h = h.select(
        "*", F.sum("g").over(left).alias("gl"), F.sum("n").over(left).alias("nl"), F.row_number().over(left).alias("k"),
        F.sum("g").over(every).alias("gt"), F.sum("n").over(every).alias("nt"), F.collect_list("bin").over(every).alias("bins"),
    ).withColumns({"gr": F.col("gt") - F.col("gl"), "nr": F.col("nt") - F.col("nl")})
    part = lambda g, n: F.col(g) * F.col(g) / (F.col(n) + l2)
    h = h.where((F.col("nl") >= least) & (F.col("nr") >= least)).withColumn("gain", part("gl", "nl") + part("gr", "nr") - part("gt", "nt"))
    right = F.slice("bins", F.col("k") + 1, F.size("bins")).alias("right")
    best = F.max_by(F.struct("feature", right, "gain"), F.struct("gain", -F.col("feature"), -F.col("k"))).alias("s")
    return h.where("gain > 1e-12").groupBy("head", "node").agg(best).select("head", "node", "s.*")


def fit(train: DataFrame, target: str, features: list[str], categorical: list[str] = (), params: Params = Params()) -> Forest:
    """The forest of a table's rows that have a target. Raises if there are none."""
    rows = train.where(F.col(target).isNotNull() & ~F.isnan(F.col(target).cast("double")))
    names, taus = [*features, *categorical], list(params.quantiles.values())
    steps = [i / params.bins for i in range(1, params.bins)]
    numeric = rows.agg(
        F.count("*").alias("n"), F.avg(target).alias("mean"), F.percentile_approx(target, taus or [0.5], params.accuracy).alias("q"),
        *[F.percentile_approx(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), steps, 10_000).alias(f"e{i}") for i, c in enumerate(features)],
    ).first()
    if not numeric["n"]:
        raise ValueError("no row has a target")
    edges = {c: sorted(set(numeric[f"e{i}"] or [])) for i, c in enumerate(features)}
    groups = {c: rows.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("v")).count().orderBy(F.desc("count"), "v") for c in categorical}
    categories = {c: [r["v"] for r in g.limit(params.bins - 1).collect()] for c, g in groups.items()}
    forest = Forest(names, categories, edges, params, [numeric["mean"], *(numeric["q"][: len(taus)])])
    state = rows.select(forest.binned().alias("x"), F.col(target).cast("double").alias("y"), F.array(*map(F.lit, map(float, forest.start))).alias("p"))
    state, pending, cats = written(state, "boost"), [], [names.index(c) for c in categorical]
    for _ in range(params.rounds):
        growing = [Tree.stump(params.depth, params.bins + 1) for _ in forest.heads]
        for level in range(params.depth):
            sums = state.mapInArrow(_histograms(forest, growing, pending, level), "head int, node int, feature int, bin int, g double, n long")
            for r in best_splits(sums, cats, params.least, params.l2).collect():  # at most heads x nodes
                at, tree = 2**level - 1 + r["node"], growing[r["head"]]
                tree.feature[at] = r["feature"]
                tree.right[at, r["right"]] = True
                if r["head"] == 0:
                    forest.gain[names[r["feature"]]] = forest.gain.get(names[r["feature"]], 0.0) + r["gain"]
        for (head, leaf), value in _leaves(state, forest, growing, pending).items():
            growing[head].leaf[leaf] = value
        forest.trees.append(growing)
        pending.append(growing)
        if len(pending) == params.keep_every:
            before, state = state, written(state.mapInArrow(_stepped(forest, pending), state.schema), "boost")
            deleted(before)
            pending = []
    deleted(state)
    return forest


def _leaves(state: DataFrame, forest: Forest, growing: list[Tree], pending: list[list[Tree]]) -> dict[tuple[int, int], float]:
    """Leaf values: shrunken mean residuals of the point head, quantiles of residuals of the others."""
    taus, depth = [*forest.params.quantiles.values()], forest.params.depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _matrix(batch["x"], np.int64), batch["y"].to_numpy(zero_copy_only=False)
            if not len(y):
                continue
            rest = y[:, None] - _matrix(batch["p"], float) - forest.values(x, pending)
            for h, tree in enumerate(growing):
                leaf = tree.node(x, depth).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(y), h, np.int32)), pa.array(leaf), pa.array(rest[:, h].copy())], names=["head", "leaf", "r"])

    rows = state.mapInArrow(run, "head int, leaf int, r double")
    q = F.percentile_approx("r", taus or [0.5], forest.params.accuracy)
    out = {}
    for r in rows.groupBy("head", "leaf").agg(F.sum("r").alias("s"), F.count("*").alias("n"), q.alias("q")).collect():  # heads x leaves
        out[r["head"], r["leaf"]] = r["s"] / (r["n"] + forest.params.l2) if r["head"] == 0 else r["q"][r["head"] - 1]
    return out


def _stepped(forest: Forest, pending: list[list[Tree]]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                p = _matrix(b["p"], float) + forest.values(_matrix(b["x"], np.int64), pending)
                yield pa.RecordBatch.from_arrays([b["x"], b["y"], _lists(p)], names=["x", "y", "p"])

    return run


def predict(forest: Forest, rows: DataFrame, scale: str | None = None) -> DataFrame:
    """``rows`` with a column for each head, times the column ``scale``; quantiles are sorted, so they never cross."""
    heads, start, names = forest.heads, np.array(forest.start, float), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                p = forest.values(_matrix(b["__x"], np.int64), forest.trees) + start
                p[:, 1:] = np.sort(p[:, 1:], axis=1)
                yield pa.RecordBatch.from_arrays([*[b[c] for c in names], _lists(p)], names=[*names, "__p"])

    schema = T.StructType([*rows.schema.fields, T.StructField("__p", T.ArrayType(T.DoubleType()))])
    out = rows.withColumn("__x", forest.binned()).mapInArrow(run, schema)
    by = F.col(scale) if scale else F.lit(1.0)
    return out.select(*names, *[(F.get("__p", F.lit(i)) * by).alias(h) for i, h in enumerate(heads)])
