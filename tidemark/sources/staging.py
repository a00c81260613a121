"""Tables written to the shared folder between the steps of an iterative operator.

The folder is that of ``spark.checkpoint.dir`` (or the context's checkpoint folder), which all executors see, so a step
survives lost executors and its lineage stays short. Only with a local master and neither set is a temporary folder
made.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shared-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table read back from the shared folder."""
    path = f"{folder(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deleted(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` made and nothing reads any more."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
