"""A training-data pipeline of five stages, each one operator of ``tidemark.llm`` whose decisions take effect.

A stage takes (spark, docs, sf_dir) and returns the rows that it keeps, with the columns of documents; the last
returns the pieces of packed windows. Every stage works on all rows that its predecessor kept.

Defined results: rows with a null doc_id pass the stages that compare documents. Null or empty texts are scored
like empty texts, lose no line, resemble nothing, leak nothing and pack as one end id. Rows that repeat a doc_id
stay or go together after the first stage, which judges each text. Extra columns are carried to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import drop_stash, stash, table
from tidemark.llm.decontaminate import find_leaks
from tidemark.llm.jaccard_join import jaccard_classes
from tidemark.llm.line_dedup import apply_keep_bitmaps, keep_bitmaps
from tidemark.llm.packing import pack, token_pieces, vocabulary
from tidemark.llm.quality import score_quality


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose doc_id isn't in ``gone``, a table of one column of that name."""
    ids = gone.select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(ids, docs["doc_id"] == ids["__gone"], "left_anti")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    bad = score_quality(docs, table(spark, sf_dir, "labels")).where("predicted = 0")
    bad = bad.select(F.col("doc_id").alias("__gone"), F.col("text_hash").alias("__text")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__gone"]) & (F.xxhash64(docs["text"]) == bad["__text"]), "left_anti")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay only in the largest; a document that loses every line goes."""
    out = apply_keep_bitmaps(docs, keep_bitmaps(docs)).where("n_dropped < n_lines")
    new = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles at 0.8, the smallest doc_id stays."""
    return _without(docs, jaccard_classes(docs, words=5, num=80, den=100).where("component_id <> doc_id"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return _without(docs, find_leaks(docs, table(spark, sf_dir, "benchmark")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(token_pieces(docs, vocabulary()))


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The classifier, the tokenizer and differencing can't be said in SQL; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
        if last is not None:
            drop_stash(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
