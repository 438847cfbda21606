"""The captures that count, from a stream of captures and re-captures in any order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.fetch import captures, unique_captures
from .batches import read_batches, write_batch, write_batches


def store_arriving(arriving: DataFrame, location: str, checkpoint: str, captured_at: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Keep the best capture of each key in every micro-batch, under the number of the batch.

    Which of two captures counts does not depend on the others, so the best of a batch stand for all of it.
    """

    def store(batch: DataFrame, number: int) -> None:
        write_batch(unique_captures(captures(batch), captured_at), number, location)

    return write_batches(arriving, store, checkpoint, available_now)


def settled_captures(spark: SparkSession, location: str, captured_at: str | None = None) -> DataFrame:
    """One capture per key over all batches so far: what ``unique_captures`` gives for the whole table."""
    return unique_captures(read_batches(spark, location).drop("batch"), captured_at)
