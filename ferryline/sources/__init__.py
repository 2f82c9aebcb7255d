"""Sources: raw text lines, topics (Kafka or file-backed), JDBC tables."""

from ferryline.sources.jdbc import jdbc_read_options, read_table
from ferryline.sources.text_lines import raw_lines
from ferryline.sources.topics import (
    TOPIC_ROW_SCHEMA,
    kafka_source_options,
    read_topic,
    read_topic_stream,
)

__all__ = [
    "TOPIC_ROW_SCHEMA",
    "jdbc_read_options",
    "kafka_source_options",
    "raw_lines",
    "read_table",
    "read_topic",
    "read_topic_stream",
]
