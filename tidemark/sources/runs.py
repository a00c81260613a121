"""Run directories: what a backtest forecast, under which configuration, written once and rescored at will.

``<root>/<run id>`` holds config.json and a folder of Parquet for each table. A run is written beside its place and
published by one rename, so a run that is there is whole. The configuration's hash is part of it and of the run id, and
is checked when a run is read. Scores live beside the forecasts, which nothing rewrites.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class RunExists(ValueError):
    pass


class RunChanged(ValueError):
    pass


class TestSplitLocked(ValueError):
    pass


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _put(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, False)  # fails if it is there
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def config_hash(config: dict) -> str:
    """SHA-256 of the configuration, independent of the order of its keys."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()


def write_run(spark: SparkSession, root: str, config: dict, tables: dict[str, DataFrame], tag: str = "") -> str:
    """Write a run and return its path. A run of the same configuration and tag raises ``RunExists``."""
    digest = config_hash(config)
    path = f"{root}/{digest[:16]}{'-' + tag if tag else ''}"
    if _exists(spark, path):
        raise RunExists(path)
    beside = f"{root}/_{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{beside}/{name}")
    _put(spark, f"{beside}/config.json", json.dumps({"config": config, "hash": digest}, sort_keys=True, default=str))
    fs, p = _fs(spark, beside)
    if _exists(spark, path) or not fs.rename(p, _fs(spark, path)[1]):
        fs.delete(p, True)
        raise RunExists(path)
    return path


def read_config(spark: SparkSession, path: str) -> dict:
    held = json.loads(_text(spark, f"{path}/config.json"))
    if config_hash(held["config"]) != held["hash"]:
        raise RunChanged(path)
    return held["config"]


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    read_config(spark, path)
    return spark.read.parquet(f"{path}/{name}")


def rescore(spark: SparkSession, path: str, score: Callable[[DataFrame, dict], dict[str, DataFrame]], tag: str) -> dict[str, DataFrame]:
    """Tables that ``score(forecasts, config)`` makes, written under ``scores-<tag>`` of the run and read back."""
    config = read_config(spark, path)
    out = f"{path}/scores-{tag}"
    if _exists(spark, out):
        raise RunExists(out)
    made = score(spark.read.parquet(f"{path}/forecasts"), config)
    for name, df in made.items():
        df.write.parquet(f"{out}/{name}")
    return {name: spark.read.parquet(f"{out}/{name}") for name in made}


def combine(spark: SparkSession, root: str, paths: list[str], same: list[str], tag: str) -> str:
    """A run of the forecasts of several runs that agree on the configuration's keys ``same``; a forecast that several hold counts once.

    Of unequal forecasts for one (entity, day, model) the first run's in ``paths`` stays.
    """
    from ..operators.clean import keep_latest

    configs = [read_config(spark, p) for p in paths]
    for k in same:
        if len({json.dumps(c.get(k), sort_keys=True, default=str) for c in configs}) > 1:
            raise ValueError(f"the runs differ in {k}")
    rows = None
    for i, p in enumerate(paths):
        one = spark.read.parquet(f"{p}/forecasts").withColumn("__run", F.lit(i))
        rows = one if rows is None else rows.unionByName(one)
    rows = keep_latest(rows, ["entity", "day", "model"], [F.col("__run")]).drop("__run")
    config = {k: configs[0].get(k) for k in same} | {"runs": sorted(config_hash(c) for c in configs), "models": sorted({m for c in configs for m in c.get("models", [])})}
    return write_run(spark, root, config, {"forecasts": rows}, tag)


def guard_test_split(spark: SparkSession, root: str, split: str, confirmed: bool = False) -> None:
    """The test split may be evaluated once: the first call leaves a lock, later ones need ``confirmed``."""
    lock = f"{root}/test-split.lock"
    if split != "test":
        return
    if _exists(spark, lock):
        if not confirmed:
            raise TestSplitLocked("the test split has been evaluated before")
        return
    _put(spark, lock, json.dumps({"split": split}))
