"""File tables (Parquet by default) as micro-batch sinks."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Local property that Structured Streaming sets on a micro-batch's thread.
_QUERY_ID = "sql.streaming.queryId"


class TableSink(Protocol):
    def write(self, df: DataFrame, batch_id: int | None = None) -> None: ...


@dataclass(frozen=True)
class FileTableSink:
    """A table in a folder that many queries may append to.

    A stream's batch goes to ``<path>/query-<query id>/batch-<id>`` with
    overwrite: a batch replayed after a crash replaces its own output and
    nothing else. The query id lives in the query's checkpoint, so two
    queries on one table, or a new checkpoint, never meet in a folder (a new
    checkpoint reads its topic again, and its rows are appended). A
    batch write appends a folder of its own. ``query_id`` names the query
    where batches are handed over outside of one.
    """

    path: str
    format: str = "parquet"
    query_id: str | None = None

    def write(self, df: DataFrame, batch_id: int | None = None) -> None:
        if batch_id is None:
            folder = f"append-{uuid.uuid4().hex}"
        else:
            query = self.query_id or df.sparkSession.sparkContext.getLocalProperty(_QUERY_ID)
            if not query:
                raise RuntimeError("a batch with an id comes from a streaming query, or names one with query_id")
            folder = f"query-{query}/batch-{batch_id}"
        df.write.mode("overwrite").format(self.format).save(f"{self.path}/{folder}")

    def read(self, spark: SparkSession, schema: T.StructType | str | None = None) -> DataFrame:
        """All rows of all queries and appends. ``schema`` saves looking into
        a file for it, and lets an empty table be read."""
        reader = spark.read.format(self.format).option("recursiveFileLookup", True)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(self.path)
