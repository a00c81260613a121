"""Readers for raw files, each into typed tables. Values that don't parse fail and are named (ANSI mode)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv_by_name(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Text columns of CSV files, united by header name, with the file's name as ``source_file``.

    Files of one header are one scan. (A single scan over differing headers would assign columns by position.)
    """
    by_header: dict[tuple, list[str]] = {}
    for path in paths:
        head = spark.read.option("header", True).csv(path).columns
        by_header.setdefault(tuple(head), []).append(path)
    scans = [spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in head])).option("header", True).csv(files)
             .withColumn("source_file", F.regexp_extract(F.col("_metadata.file_path"), r"[^/]+$", 0)) for head, files in by_header.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def text_or_null(c: str):
    """Trimmed text; blank is null."""
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def json_series(spark: SparkSession, path: str, variables: list[str], pattern: str) -> DataFrame:
    """Rows (entity, place, ts, variables) of files that hold equal-length arrays under ``hourly``.

    The schema is declared, since an array may be all null. ``pattern`` takes entity and place from the path. Arrays of
    unequal length fail.
    """
    fields = [T.StructField("time", T.ArrayType(T.StringType()))] + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables]
    raw = spark.read.schema(T.StructType([T.StructField("hourly", T.StructType(fields))])).option("multiLine", True).json(path)
    name = F.url_decode(F.col("_metadata.file_path"))
    sizes = [F.size(f"hourly.{v}") for v in variables]
    checked = F.when(reduce(lambda a, b: a & b, [s == F.size("hourly.time") for s in sizes]), F.arrays_zip("hourly.time", *[f"hourly.{v}" for v in variables])).otherwise(
        F.raise_error(F.concat(F.lit("arrays of unequal length in "), name))
    )
    rows = raw.select(F.regexp_extract(name, pattern, 1).alias("entity"), F.regexp_extract(name, pattern, 2).alias("place"), F.explode(checked).alias("x"))
    return rows.select("entity", "place", F.to_timestamp("x.time", "yyyy-MM-dd'T'HH:mm").alias("ts"), *[F.col(f"x.{v}").alias(v) for v in variables])


def jsonl_latest(spark: SparkSession, path: str, key: str, order: str, schema: str) -> DataFrame:
    """The latest entry of each key of an append-only JSON-lines ledger; of equally late ones the greatest as JSON text."""
    rows = spark.read.schema(schema).json(path)
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.col(order).desc(), F.to_json(F.struct(*rows.columns)).desc()))
    return rows.withColumn("__r", rank).where("__r = 1").drop("__r")


def typed_range(spark: SparkSession, path: str, entities: list[str], start, end) -> DataFrame:
    """Rows of an (entity, ts) table for some entities and the half-open range [start, end); both reach the scan."""
    bad = [e for e in entities if not e.isalnum()]
    if bad:
        raise ValueError(f"not an entity code: {bad[0]!r}")
    return spark.read.parquet(path).where(F.col("entity").isin(entities) & (F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(end)))


def results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV of results with a header; an empty table if there is no such file or nothing in it."""
    from .runs import _exists

    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).csv(path)
