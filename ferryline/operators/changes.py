"""Change-envelope operators.

A change message is JSON ``{"payload": {"before": ..., "after": {...},
"op": ...}}``. Only ``payload.after`` is read: inserts, snapshot reads and
updates all become one appended row each, and a delete (``after: null``), a
tombstone (NULL value) or a value that is not JSON becomes one all-NULL row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.json as pj
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.functions.json import json_path, parse_json

#: Messages of a batch that Arrow's reader refuses are halved down to so many.
_FEWEST = 64
#: Limits of Spark's reader: levels of nesting and characters of a number, and
#: characters of a name.
_LEVELS, _NAME = 1_000, 50_000
#: A run of as many characters as make a number too long has one of these at
#: 20 places in a row that lie 50 apart.
_PLACES = 20
_OF_NUMBERS = np.isin(np.arange(256), np.frombuffer(b"0123456789.eE+-", np.uint8))


def payload_text(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Keep only ``$.payload`` as text."""
    return df.select(json_path(value_col, "$.payload").alias("payload"))


def after_text(df: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Keep only ``$.after`` of a payload as text."""
    return df.select(json_path(payload_col, "$.after").alias("after"))


def with_parsed(df: DataFrame, schema: T.StructType, src: str = "after", name: str = "data") -> DataFrame:
    """Add a parsed struct column next to the source text."""
    return df.withColumn(name, parse_json(src, schema))


def expand_struct(df: DataFrame, struct_col: str = "data") -> DataFrame:
    """One column per struct field; a NULL struct gives an all-NULL row."""
    return df.select(f"{struct_col}.*")


def keep_fields(schema: T.StructType, names) -> T.StructType:
    """The schema narrowed to ``names`` (schema order kept).

    The optimizer does not prune a nested ``from_json`` schema, so a job
    that needs few fields passes the narrowed schema itself; values of the
    kept fields are unchanged (PERMISSIVE parsing skips unknown fields).
    """
    wanted = set(names)
    missing = wanted - set(schema.fieldNames())
    if missing:
        raise ValueError(f"fields not in schema: {sorted(missing)}")
    return T.StructType([f for f in schema.fields if f.name in wanted])


def unwrap_after(df: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Envelope -> the fields of ``payload.after``, in one projection.

    The text of ``$.payload``, the text of its ``$.after``, then one parse
    with ``schema``, so the result is that of :func:`unwrap_after_three_step`
    for every message: also where ``payload`` or ``after`` is itself JSON
    text, holds raw control characters, or occurs twice (the first counts). A
    single parse with a nested schema is about 1.8 times as fast and gives
    other rows for all of these. Callers narrow ``schema`` to the fields
    they use (:func:`keep_fields`).
    """
    after = json_path(json_path(value_col, "$.payload"), "$.after")
    return df.select(parse_json(after, schema).alias("__data")).select("__data.*")


def unwrap_after_three_step(df: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Same result as :func:`unwrap_after`, as separate operators: payload
    text, after text, parse, expand."""
    return expand_struct(with_parsed(after_text(payload_text(df, value_col)), schema))


def unwrap_after_in_arrow(df: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Same result as :func:`unwrap_after` at a fraction of the CPU time.

    Plain messages (see :func:`_after_reader`) are read once, a batch at a
    time, by Arrow's JSON reader; all others, one by one, by
    :func:`unwrap_after`'s expressions. A schema with other fields than text
    is read by those alone.
    """
    names = schema.fieldNames()
    texts = all(isinstance(f.dataType, T.StringType) for f in schema.fields)
    if not names or not texts or len({n.lower() for n in names}) < len(names) or "_corrupt_record" in names:
        return unwrap_after(df, schema, value_col)
    columns = [f"f{i}" for i in range(len(names))]
    out = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, "other")])
    read = df.select(F.col(value_col).alias("value")).mapInArrow(_after_reader(names, columns), out)
    after = json_path(json_path("other", "$.payload"), "$.after")
    read = read.select(*columns, parse_json(after, schema).alias("data"))
    return read.select(*[F.coalesce(c, F.col("data").getField(n)).alias(n) for c, n in zip(columns, names, strict=True)])


def _after_reader(
    names: Sequence[str], columns: Sequence[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Messages -> the fields of ``payload.after``, or the message itself in
    ``other`` where it isn't plain. (Inner functions travel to the executors.)"""

    def plain_after(values):
        """The ``after`` structs of messages that are plain JSON objects, or
        None if one isn't, or holds what Spark's reader takes otherwise.

        Without backslashes and control characters, each from brace to brace,
        as many objects as messages are one in each. The reader refuses bad
        JSON (but takes NaN and Inf), fields given twice and fields of another
        type than asked for."""
        if not pc.all(pc.and_(pc.starts_with(values, "{"), pc.ends_with(values, "}"))).as_py():
            return None
        lengths = pc.binary_length(values)
        if (longest := pc.max(lengths).as_py()) >= 2 * _LEVELS:
            long = values.filter(pc.greater_equal(lengths, 2 * _LEVELS))
            opened = pc.add(pc.count_substring(long, "{"), pc.count_substring(long, "["))
            if longest >= _NAME or pc.max(opened).as_py() >= _LEVELS:
                return None
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values), "\n")
        text = joined[0].as_buffer().to_pybytes()
        raw = np.frombuffer(text, np.uint8)
        if b"\\" in text or np.count_nonzero(raw < 32) != len(values) - 1:
            return None
        if (b"NaN" in text or b"Inf" in text) and re.search(rb"[:,\[\s-](?:NaN|Inf)", text):
            return None
        others = np.flatnonzero(np.concatenate([[True], ~of_numbers[raw[:: _LEVELS // _PLACES]], [True]]))
        if np.diff(others).max() > _PLACES:
            return None
        try:
            text.isascii() or text.decode()
            read = pj.read_json(
                pa.BufferReader(text),
                read_options=pj.ReadOptions(use_threads=False, block_size=len(text) + 1),
                parse_options=parse,
            )
        except (pa.ArrowInvalid, UnicodeDecodeError):
            return None
        if read.num_rows != len(values):
            return None
        return pc.struct_field(read.column("payload").combine_chunks(), ["after"])

    def pieces(values):
        after = plain_after(values.fill_null("{}"))
        if after is not None:
            fields = [pc.struct_field(after, [n]) for n in names]
            yield pa.RecordBatch.from_arrays([*fields, pa.nulls(len(values), pa.string())], names=out)
        elif len(values) <= _FEWEST:
            nothing = [pa.nulls(len(values), pa.string())] * len(names)
            yield pa.RecordBatch.from_arrays([*nothing, values], names=out)
        else:
            half = len(values) // 2
            yield from pieces(values[:half])
            yield from pieces(values[half:])

    def read_after(batches):
        for batch in batches:
            if batch.num_rows:
                yield from pieces(batch.column(0))

    out, of_numbers = [*columns, "other"], _OF_NUMBERS
    asked = pa.struct([("after", pa.struct([(n, pa.string()) for n in names]))])
    parse = pj.ParseOptions(explicit_schema=pa.schema([("payload", asked)]), unexpected_field_behavior="ignore")
    return read_after
