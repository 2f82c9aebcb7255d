"""Line operators: keyed messages and positional field projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.functions.text import field_at, first_field, split_fields_array, strip_quotes


def keyed_messages(
    lines: DataFrame,
    topic: str,
    line_col: str = "value",
    partition: int | None = None,
) -> DataFrame:
    """Raw line -> message ``key, value, topic[, partition]``.

    The key is the first comma field of the *raw* line and the value is the
    line with every double quote deleted. With ``partition=None`` no
    partition column is emitted and the topic spreads messages by key hash;
    pinning one partition (the original pipeline used 1) puts the whole
    stream on one consumer task.
    """
    raw = F.col(line_col)
    cols = [
        first_field(raw).alias("key"),
        strip_quotes(raw).alias("value"),
        F.lit(topic).alias("topic"),
    ]
    if partition is not None:
        cols.append(F.lit(int(partition)).alias("partition"))
    return lines.select(*cols)


def split_fields(
    df: DataFrame,
    names: Sequence[str],
    line_col: str = "value",
    sep: str = ",",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Positional projection: field *i* of the split line becomes ``names[i]``.

    The line is split once into an array and every name reads one ordinal,
    so extra fields drop off the end and missing ones are NULL. No quote
    handling: a comma inside quotes shifts the later fields. Columns in
    ``keep`` are carried through in front.
    """
    arr = "__fields"
    return df.select(*keep, split_fields_array(F.col(line_col), sep).alias(arr)).select(
        *keep, *[field_at(arr, i).alias(name) for i, name in enumerate(names)]
    )
