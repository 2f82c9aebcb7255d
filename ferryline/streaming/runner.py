"""Start streaming queries with one checkpoint each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start_stream(
    df: DataFrame,
    handler: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start an append-mode ``foreachBatch`` query.

    ``trigger=None`` keeps Spark's default (next micro-batch as soon as the
    last one commits); ``{"availableNow": True}`` drains what is there and
    stops; ``{"processingTime": "10 seconds"}`` paces batches. Offsets are
    logged to ``checkpoint`` before each batch and committed after it, so a
    restart resumes from the last committed batch. Never share a
    checkpoint between queries.
    """
    writer = df.writeStream.outputMode("append").foreachBatch(handler).option(
        "checkpointLocation", checkpoint
    )
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def run_available(
    df: DataFrame,
    handler: Callable[[DataFrame, int], None],
    checkpoint: str,
    query_name: str | None = None,
) -> StreamingQuery:
    """Process everything available now, then stop (blocking)."""
    query = start_stream(df, handler, checkpoint, {"availableNow": True}, query_name)
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise exc
    return query
