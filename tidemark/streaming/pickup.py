"""Incremental pickup of forecast files into the append-only store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.store import append_new


def follow(spark: SparkSession, inbox: str, schema: str, store: str, checkpoint: str) -> StreamingQuery:
    """Append each new Parquet file of ``inbox`` once. A replayed micro-batch adds nothing, since keys are checked."""

    def one(batch: DataFrame, _: int) -> None:
        append_new(batch, store)

    stream = spark.readStream.schema(schema).parquet(inbox)
    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
