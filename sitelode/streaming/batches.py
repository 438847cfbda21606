"""Micro-batches stored under their number, so that a batch played again replaces itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery


def write_batch(rows: DataFrame, batch_id: int, location: str) -> None:
    """Store what a batch gave, in the place of what the same batch gave before."""
    rows.write.mode("overwrite").parquet(f"{location}/batch={batch_id}")


def read_batches(spark: SparkSession, location: str) -> DataFrame:
    """The rows of all batches, with the number of each."""
    return spark.read.parquet(location)


def write_batches(stream: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True, mode: str = "append") -> StreamingQuery:
    """Hand every micro-batch to ``store``; after a failure the last one is handed over again with the same number."""
    writer = stream.writeStream.foreachBatch(store).outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
