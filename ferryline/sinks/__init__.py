"""Sinks: topics, JDBC tables, file tables and a bounded preview."""

from ferryline.sinks.jdbc import JdbcSink, jdbc_append, jdbc_write_options
from ferryline.sinks.preview import preview_handler
from ferryline.sinks.tables import FileTableSink, TableSink
from ferryline.sinks.topics import topic_rows, write_topic

__all__ = [
    "FileTableSink",
    "JdbcSink",
    "TableSink",
    "jdbc_append",
    "jdbc_write_options",
    "preview_handler",
    "topic_rows",
    "write_topic",
]
