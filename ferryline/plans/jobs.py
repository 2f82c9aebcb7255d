"""The three pipeline jobs.

* :func:`publish_lines` — text file -> keyed messages on the line topic.
* :func:`ingest_lines` — line topic -> 30 named text columns -> table.
* :func:`route_changes` — change topic -> unwrap ``payload.after`` -> two
  typed projections -> two tables, from one scan per micro-batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ferryline.config import TopicConfig
from ferryline.operators.changes import keep_fields, unwrap_after_in_arrow
from ferryline.operators.decode import decode_messages
from ferryline.operators.lines import keyed_messages, split_fields
from ferryline.operators.typed import Route
from ferryline.schemas import (
    CHANGE_SCHEMA,
    INGEST_FIELDS,
    QUALITATIVE_ROUTE,
    QUALITATIVE_TABLE,
    QUANTITATIVE_ROUTE,
    QUANTITATIVE_TABLE,
)
from ferryline.sinks.tables import TableSink
from ferryline.sinks.topics import write_topic
from ferryline.sources.text_lines import raw_lines
from ferryline.sources.topics import read_topic_stream
from ferryline.streaming.fanout import fan_out, single_sink
from ferryline.streaming.runner import start_stream

DEFAULT_ROUTES: tuple[Route, ...] = (
    Route(QUANTITATIVE_TABLE, QUANTITATIVE_ROUTE),
    Route(QUALITATIVE_TABLE, QUALITATIVE_ROUTE),
)


def publish_lines(
    spark: SparkSession,
    path: str,
    topic: TopicConfig,
    header: bool = True,
    partition: int | None = None,
    keep_blank_lines: bool = True,
) -> None:
    """Batch job: every line but the first of each file becomes one message
    (blank lines too unless ``keep_blank_lines=False``, see :func:`raw_lines`)."""
    lines = raw_lines(spark, path, header, keep_blank_lines=keep_blank_lines)
    write_topic(keyed_messages(lines, topic.name, partition=partition), topic)


def line_records(stream: DataFrame, names: Sequence[str] = INGEST_FIELDS) -> DataFrame:
    """Topic rows -> one text column per name (ingest transform)."""
    return split_fields(decode_messages(stream), names)


def change_records(stream: DataFrame, schema: T.StructType = CHANGE_SCHEMA) -> DataFrame:
    """Topic rows -> fields of ``payload.after`` (route transform)."""
    return unwrap_after_in_arrow(decode_messages(stream, keep=()), schema)


def ingest_lines(
    spark: SparkSession,
    source: TopicConfig,
    sink: TableSink,
    checkpoint: str,
    names: Sequence[str] = INGEST_FIELDS,
    trigger: dict | None = None,
) -> StreamingQuery:
    return start_stream(
        line_records(read_topic_stream(spark, source), names), single_sink(sink), checkpoint, trigger
    )


def route_changes(
    spark: SparkSession,
    source: TopicConfig,
    sinks: Sequence[tuple[Route, TableSink]],
    checkpoint: str,
    schema: T.StructType = CHANGE_SCHEMA,
    trigger: dict | None = None,
    persist: bool = True,
    stage_dir: str | None = None,
) -> StreamingQuery:
    """Unwrap each micro-batch once, parsing only the fields the routes
    use, and write every route from that one parse (persisted, or staged
    as a table under ``stage_dir``; see :func:`fan_out`)."""
    used = {f for route, _ in sinks for f in route.fields}
    parse_schema = keep_fields(schema, [f for f in schema.fieldNames() if f in used])
    return start_stream(
        change_records(read_topic_stream(spark, source), parse_schema),
        fan_out(sinks, persist=persist, stage_dir=stage_dir),
        checkpoint,
        trigger,
    )
