"""Topic sources, Kafka or file-backed, with the same row schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ferryline.config import TopicConfig

# Row schema of Spark's Kafka source; file-backed topics store exactly this.
TOPIC_ROW_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)


def kafka_source_options(cfg: TopicConfig, streaming: bool = True) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": cfg.servers or "",
        "subscribe": cfg.name,
        "startingOffsets": cfg.starting_offsets,
        "failOnDataLoss": str(cfg.fail_on_data_loss).lower(),
    }
    if streaming and cfg.max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(cfg.max_offsets_per_trigger)
    if cfg.min_partitions:
        opts["minPartitions"] = str(cfg.min_partitions)
    opts.update(cfg.options)
    return opts


def read_topic_stream(spark: SparkSession, cfg: TopicConfig) -> DataFrame:
    """Unbounded read of one topic from its earliest (or given) offsets."""
    if cfg.is_kafka:
        return spark.readStream.format("kafka").options(**kafka_source_options(cfg)).load()
    reader = spark.readStream.schema(TOPIC_ROW_SCHEMA)
    if cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    return reader.parquet(_topic_path(cfg))


def read_topic(spark: SparkSession, cfg: TopicConfig) -> DataFrame:
    """Bounded read of everything currently in the topic."""
    if cfg.is_kafka:
        opts = kafka_source_options(cfg, streaming=False)
        opts.setdefault("endingOffsets", "latest")
        return spark.read.format("kafka").options(**opts).load()
    return spark.read.schema(TOPIC_ROW_SCHEMA).parquet(_topic_path(cfg))


def _topic_path(cfg: TopicConfig) -> str:
    if not cfg.path:
        raise ValueError(f"topic {cfg.name!r} has neither servers nor a path")
    return cfg.path
