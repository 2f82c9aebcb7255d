"""Publish messages to a topic (Kafka or file-backed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.config import TopicConfig


def topic_rows(messages: DataFrame, cfg: TopicConfig) -> DataFrame:
    """Messages ``key, value[, partition]`` -> full topic rows.

    Without a partition column the partition is the key hash modulo the
    topic's partition count (a NULL key goes by writer task), like a Kafka
    producer's default partitioner. Only a broker numbers messages, so
    ``offset`` is NULL.
    """
    cols = messages.columns
    if "partition" in cols:
        partition = F.col("partition").cast("int")
    else:
        n = F.lit(cfg.num_partitions)
        partition = F.when(F.col("key").isNull(), F.pmod(F.spark_partition_id(), n)).otherwise(
            F.pmod(F.xxhash64(F.col("key")), n)
        ).cast("int")
    return messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(cfg.name).alias("topic"),
        partition.alias("partition"),
        F.lit(None).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def write_topic(messages: DataFrame, cfg: TopicConfig) -> None:
    """Append messages to the topic (batch write, one producer per task).
    A file-backed topic is compressed with zstd: messages
    repeat each other's field names and values."""
    if cfg.is_kafka:
        keep = [c for c in ("key", "value", "partition", "headers") if c in messages.columns]
        (
            messages.select(*keep)
            .write.format("kafka")
            .option("kafka.bootstrap.servers", cfg.servers)
            .option("topic", cfg.name)
            .options(**cfg.options)
            .save()
        )
        return
    topic_rows(messages, cfg).write.mode("append").option("compression", "zstd").parquet(cfg.path)
