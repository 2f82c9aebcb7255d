"""Where jobs put topics, tables and streaming checkpoints.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(or a checkpoint directory already set on the context). Only a local-mode
session (a laptop or a test) without one gets a folder made here, which is
then registered as its checkpoint directory. A cluster session without a
shared folder is an error: a machine-local folder would be invisible to
the executors and lost with the driver.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: give the session a folder every "
                "executor can reach (HDFS, S3, ...) for topics, tables and checkpoints"
            )
        root = tempfile.mkdtemp(prefix="ferryline-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete folders made by :func:`fresh_dir` that nothing reads any more.

    Whoever makes a folder owns it: the registered queries discard the
    topics, staged batches and checkpoints of a run that has ended; a folder
    that a returned DataFrame reads belongs to its caller."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder under the shared root (never reused across runs)."""
    return f"{shared_root(spark)}/ferryline/{name}-{uuid.uuid4().hex[:12]}"
