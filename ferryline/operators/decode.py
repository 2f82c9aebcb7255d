"""Decode raw topic rows (binary key/value) into text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def decode_messages(df: DataFrame, keep=("topic",)) -> DataFrame:
    """``key, value`` as UTF-8 text plus the kept metadata columns.

    Partition, offset and timestamp are dropped unless listed in ``keep``.
    NULL key or value stays NULL.
    """
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        *[F.col(c) for c in keep],
    )
