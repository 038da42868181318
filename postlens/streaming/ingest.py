"""Landed files -> upserted table, as a stream of micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from postlens.sources.buckets import BucketedTable


def ingest_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    table: BucketedTable,
    checkpoint: str,
    step: Callable[[DataFrame, DataFrame], DataFrame],
    files_per_batch: int = 1000,
    unique: Sequence[str] | None = None,
    event_time: str | None = None,
    lateness: str = "1 day",
) -> int:
    """Process every landed file not seen yet into `table`; returns the number of rewritten buckets.

    A micro-batch reads and rewrites the buckets that its keys touch (`BucketedTable.merge`), so its cost follows the
    batch, not the table. `step` must be an upsert by key, as a batch that is retried after a failure is merged again.
    With `event_time`, records that repeat the `unique` columns (default: the table's keys) within `lateness` are merged
    once, whatever batches they land in; the stream forgets them when the watermark has passed.
    """
    rewritten = 0

    def write(batch: DataFrame, number: int) -> None:
        nonlocal rewritten
        rewritten += len(table.merge(batch, step))

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(landing)
    if event_time is not None:
        stream = stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(list(unique or table.keys))
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return rewritten
