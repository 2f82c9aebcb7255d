"""Bounded debug preview of a stream (the console sink, made safe).

Spark's console and memory sinks ship every row to the driver; this one
prints at most ``num_rows`` rows of each micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def preview_handler(num_rows: int = 20, truncate: bool = True, out: Callable[[str], None] = print):
    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.limit(num_rows).collect()
        out(f"-- batch {batch_id}: {len(rows)} row(s) shown --")
        for row in rows:
            text = str(tuple(row))
            out(text[:200] if truncate else text)

    return handle
