"""JDBC table read, range-partitioned for parallel scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ferryline.config import JdbcConfig


def jdbc_read_options(
    cfg: JdbcConfig,
    table: str,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = 10_000,
) -> dict[str, str]:
    opts = {"url": cfg.url, "dbtable": table}
    for key, value in (("user", cfg.user), ("password", cfg.password), ("driver", cfg.driver)):
        if value:
            opts[key] = value
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs lower/upper bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    opts.update(cfg.options)
    return opts


def read_table(spark: SparkSession, cfg: JdbcConfig, table: str, **partitioning) -> DataFrame:
    """Batch read of a table; pass ``partition_column`` with bounds so a big
    table is read by ``num_partitions`` tasks instead of one."""
    return spark.read.format("jdbc").options(**jdbc_read_options(cfg, table, **partitioning)).load()
