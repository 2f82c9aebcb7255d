"""Frozen job configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession


# What one micro-batch takes at most unless the caller says otherwise.
MAX_OFFSETS_PER_TRIGGER = 10_000_000
MAX_FILES_PER_TRIGGER = 1_000


@dataclass(frozen=True)
class TopicConfig:
    """A message topic.

    With ``servers`` set, the topic lives on a Kafka cluster. Without it,
    ``path`` names a folder of Parquet files carrying Kafka's row schema (a
    file-backed topic), which behaves the same for every operator here.

    A streaming micro-batch takes at most ``max_offsets_per_trigger``
    messages (Kafka) or ``max_files_per_trigger`` files; None lifts the
    limit. The defaults hold everywhere, in the library, the jobs and the
    registered queries; they bound a batch, not what is read in the end.
    ``options`` go to the Kafka source and sink as they are (security,
    consumer settings).
    """

    name: str
    servers: str | None = None
    path: str | None = None
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    max_offsets_per_trigger: int | None = MAX_OFFSETS_PER_TRIGGER
    min_partitions: int | None = None
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER
    num_partitions: int = 3
    options: dict[str, str] = field(default_factory=dict)

    @property
    def is_kafka(self) -> bool:
        return self.servers is not None


@dataclass(frozen=True)
class JdbcConfig:
    """JDBC connection. Credentials come from the caller (or Spark conf via
    :meth:`from_spark_conf`), never from literals in job code."""

    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    batch_size: int | None = None
    num_partitions: int | None = None
    isolation_level: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_spark_conf(cls, spark: SparkSession, prefix: str) -> JdbcConfig:
        """Every field from ``<prefix>.<field>`` (``batch_size`` and
        ``num_partitions`` as numbers), and Spark's own JDBC options from
        ``<prefix>.options.<name>``."""
        conf = {k[len(prefix) + 1 :]: v for k, v in spark.conf.getAll.items() if k.startswith(f"{prefix}.")}
        if not conf.get("url"):
            raise ValueError(f"{prefix}.url is not set")
        number = lambda k: int(conf[k]) if conf.get(k) else None
        return cls(
            url=conf["url"],
            user=conf.get("user"),
            password=conf.get("password"),
            driver=conf.get("driver"),
            batch_size=number("batch_size"),
            num_partitions=number("num_partitions"),
            isolation_level=conf.get("isolation_level"),
            options={k[len("options.") :]: v for k, v in conf.items() if k.startswith("options.")},
        )
