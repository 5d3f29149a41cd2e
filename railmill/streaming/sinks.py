"""Streaming queries over micro-batches; output goes to logged tables (see ``table_log``) or under batch numbers.

Under batch numbers a replayed micro-batch replaces its own files, nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

BATCH = "batch_id"


def write_batch(df: DataFrame, batch_id: int, path: str, partition_by: list[str] | None = None) -> None:
    """Writes one micro-batch under its number, below the values of ``partition_by`` that readers prune by."""
    numbered = df.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
    (
        numbered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*(partition_by or []), BATCH)
        .parquet(path)
    )


def start(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    available_now: bool = False,
    interval: str = "1 second",
) -> StreamingQuery:
    """Starts a query that hands every micro-batch to ``handle``."""
    writer: DataStreamWriter = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).foreachBatch(handle).start()


def run_to_end(query: StreamingQuery, timeout_seconds: int | None = None) -> None:
    """Waits for an available-now query, which ends by itself; with a time limit it fails if the query does not end in time."""
    try:
        if timeout_seconds is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout_seconds):
            raise TimeoutError(f"stream {query.id} did not finish in {timeout_seconds} s")
    finally:
        query.stop()
