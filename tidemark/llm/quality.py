"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

One pass over the texts turns each into a short vector of statistics (lengths, shares of character classes,
repetition of words, word pairs and lines, compressibility), transformed so that their tails are mild. Counts and
sums of each class, then sums of products about its mean, come from all labelled rows of the training fold, added up by
Spark; only these few hundred numbers reach the driver. Each class covariance is shrunk towards the pooled one and the pooled
diagonal, its Cholesky factor is kept, and a score is the logistic function of the difference of the two
Mahalanobis log-densities plus that of the class sizes.

Defined results: a null or empty text has the statistics of an empty text and gets a score. Documents with a null
doc_id are scored and never trained on. Several label rows of one document count as their largest; label rows
with nulls count for nothing. If a class has no rows, every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

import math
import operator
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stash, table, trimmed

_UPPER, _LOWER, _DIGIT = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
_STOPS, _COMMAS, _SIGNS = b".!?", b",;:", b"#$%&*+<=>@^_~|\\/{}[]"
NAMES = (
    "chars words word_length word_spread upper_share shout_share digit_share stop_rate bang_rate comma_rate sign_rate "
    "bar_rate distinct_words twin_rate distinct_pairs line_words distinct_lines top_lines press"
).split()


def statistics(text: str | None) -> list[float]:
    """The vector of one text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words, lines = text.split(), text.split("\n")
    n, w, k = len(raw), len(words), len(lines)
    share = lambda marks: (n - len(raw.translate(None, marks))) / (n + 20)
    lengths = np.fromiter(map(len, words), np.int64, w)
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        math.log1p(n),
        math.log1p(w),
        math.log1p(float(lengths.mean()) if w else 0.0),
        math.log1p(float(lengths.std()) if w else 0.0),
        math.sqrt(share(_UPPER)),
        math.sqrt(sum(map(str.isupper, words)) / (w + 5)),
        math.sqrt(share(_DIGIT)),
        math.sqrt(text.count(".") / (w + 5)),
        math.sqrt((text.count("!") + text.count("?")) / (w + 5)),
        math.sqrt(share(_COMMAS)),
        math.sqrt(share(_SIGNS)),
        math.sqrt(text.count("|") / (w + 5)),
        len(set(words)) / (w + 1) * 2 + math.log1p(w) / 8,
        math.sqrt(sum(map(operator.eq, words, words[1:])) / (w + 5)),
        math.log((pairs + 2) / (w + 2)),
        math.log1p(w / k),
        math.log((len(set(lines)) + 1) / (k + 1)),
        math.log1p(k),
        math.log((len(zlib.compress(raw, 1)) + 60) / (n + 60)),
    ]


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = np.array([statistics(t) for t in b["text"].to_pylist()], dtype=np.float64).reshape(-1, len(NAMES))
        flat = pa.ListArray.from_arrays(np.arange(0, x.size + 1, len(NAMES), dtype=np.int32), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([b["doc_id"], b["text_hash"], flat], names=["doc_id", "text_hash", "x"])


def vectors(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, x) for each row of a documents table; text_hash is ``xxhash64(text)``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(trimmed(_vectors), "doc_id long, text_hash long, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Means, inverted Cholesky factors, log-determinants and log-shares of the two classes; or one constant score."""

    constant: float | None
    mean: tuple = ()
    inverse: tuple = ()
    offset: tuple = ()

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = []
        for mean, inverse, offset in zip(self.mean, self.inverse, self.offset, strict=True):
            z = inverse @ (x - mean).T  # its squared length is the Mahalanobis distance
            density.append(offset - 0.5 * np.einsum("ij,ij->j", z, z))
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -40, 40)))


def _moments(means: np.ndarray | None):
    """Counts and sums of each class's rows in a task; with ``means``, sums of the products of rows less their class's mean."""
    d = len(NAMES)
    size = 1 + d if means is None else d * d

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size))
        for b in batches:
            x = b["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            y = b["label"].to_numpy(zero_copy_only=False)
            for c in (0, 1):
                v = x[y == c]
                if means is None:
                    total[c] += np.concatenate(([len(v)], v.sum(0)))
                else:
                    v = v - means[c]
                    total[c] += (v.T @ v).ravel()
        at = np.arange(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], size)), pa.array(np.tile(at, 2)), pa.array(total.ravel())], names=["c", "at", "v"]
        )

    return run


def _summed(rows: DataFrame, means: np.ndarray | None) -> np.ndarray:
    d = len(NAMES)
    out = np.zeros((2, 1 + d if means is None else d * d))
    sums = rows.mapInArrow(trimmed(_moments(means)), "c long, at long, v double").groupBy("c", "at").agg(F.sum("v").alias("v"))
    for c, at, v in sums.collect():  # two rows for each of a fixed number of moments
        out[c, at] = v
    return out


def fit(labelled: DataFrame, pool: float = 0.05, diagonal: float = 0.05) -> Discriminant:
    """The discriminant of (x, label) rows. ``pool`` and ``diagonal`` are the shares of the two shrinkage targets."""
    d = len(NAMES)
    rows = labelled.select("x", F.col("label").cast("long").alias("label")).where("label in (0, 1)")
    total = _summed(rows, None)
    n = total[:, 0]
    if not n.all():
        return Discriminant(float(n[1] / n.sum()) if n.sum() else 0.5)
    mean = total[:, 1:] / n[:, None]
    products = _summed(rows, mean)
    cov = [products[c].reshape(d, d) / n[c] for c in (0, 1)]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    spread = np.diag(np.diag(pooled) + 1e-6)
    factor = [np.linalg.cholesky((1 - pool - diagonal) * s + pool * pooled + diagonal * spread) for s in cov]
    offset = [math.log(n[c] / n.sum()) - float(np.log(np.diag(factor[c])).sum()) for c in (0, 1)]
    return Discriminant(None, tuple(mean), tuple(np.linalg.solve(f, np.eye(d)) for f in factor), tuple(offset))


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def score_quality(docs: DataFrame, labels: DataFrame, accept: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted, text_hash) for each row of a documents table."""
    x = stash(vectors(docs), "statistics")
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("label"))
    model = fit(x.where(~held_out()).join(known, "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
            score = model.score(v)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["held_out"], pa.array(score), pa.array((score >= accept).astype(np.int32)), b["text_hash"]],
                names=["doc_id", "held_out", "score", "predicted", "text_hash"],
            )

    rows = x.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text_hash", "x")
    return rows.mapInArrow(trimmed(run), "doc_id long, held_out boolean, score double, predicted int, text_hash long")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op9_quality": op9_quality}
SQL: dict[str, str] = {}
