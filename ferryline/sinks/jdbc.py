"""JDBC append sink."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ferryline.config import JdbcConfig


def jdbc_write_options(cfg: JdbcConfig, table: str) -> dict[str, str]:
    opts = {"url": cfg.url, "dbtable": table}
    for key, value in (("user", cfg.user), ("password", cfg.password), ("driver", cfg.driver)):
        if value:
            opts[key] = value
    if cfg.batch_size:
        opts["batchsize"] = str(cfg.batch_size)
    if cfg.num_partitions:
        # caps concurrent connections: Spark coalesces to this many writers
        opts["numPartitions"] = str(cfg.num_partitions)
    if cfg.isolation_level:
        opts["isolationLevel"] = cfg.isolation_level
    opts.update(cfg.options)
    return opts


def jdbc_append(df: DataFrame, cfg: JdbcConfig, table: str) -> None:
    """Plain append (at-least-once when replayed by a stream)."""
    df.write.format("jdbc").options(**jdbc_write_options(cfg, table)).mode("append").save()


@dataclass(frozen=True)
class JdbcSink:
    cfg: JdbcConfig
    table: str

    def write(self, df: DataFrame, batch_id: int | None = None) -> None:
        jdbc_append(df, self.cfg, self.table)
