"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.workspace import shared_root

#: Stands for a NULL identifier in orderings where it counts as the largest.
LAST_ID = 2**63 - 1


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back from
    there: its lineage ends, and a lost executor costs no recomputation."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def release_shuffles(spark: SparkSession) -> None:
    """Frees the disk of shuffles that no table still in use was made from.
    Spark deletes a shuffle's files once the driver's garbage collector finds
    that nothing refers to it; a driver with little to do may not run it for
    hours, while the executors' disks fill."""
    spark.sparkContext._jvm.System.gc()


#: A key with more than this share of all rows is hot, so there are at most
#: ``1 / HOT_SHARE`` hot keys, whatever the size of the input.
HOT_SHARE = 1e-5
#: Keys of fewer rows are not hot.
SMALL_KEY = 10_000


def hot_limit(total: int) -> int:
    """A key of more rows than this, of ``total`` in all, is hot."""
    return max(SMALL_KEY, int(total * HOT_SHARE))


def hot_join(
    rows: DataFrame, table: DataFrame, on: str, total: int, how: str = "inner", most: int | None = None
) -> DataFrame:
    """``rows`` joined with ``table``, which has each key once and tells in
    ``n_rows`` how many of the ``total`` rows have it. Rows of hot keys stay
    where they are and get theirs by broadcast (at most ``1 / HOT_SHARE``
    rows of ``table``); only the others are shuffled, so no task gets a hot
    key whole. Where ``most`` tells that no key has more rows than that, it
    is a plain join."""
    limit = hot_limit(total)
    if (total if most is None else most) <= limit:
        return rows.join(table.drop("n_rows"), on, how)
    hot = F.col("n_rows") > limit
    few = table.where(hot).drop("n_rows")
    rest = rows.join(F.broadcast(few.select(on)), on, "left_anti").join(table.where(~hot).drop("n_rows"), on, how)
    return rows.join(F.broadcast(few), on).unionByName(rest)


#: Bits of a membership filter: 16 a key, within these powers of two (64 MB at most).
LEAST_BITS, MOST_BITS = 20, 29


def membership(keys: DataFrame, column: Column) -> Callable[[Column], Column]:
    """A test of whether a long is among those of ``column``, by one bit of
    its hash: always true of one that is, rarely of another (more often
    beyond some 30 million keys; 64 MB at most are broadcast whatever their
    number). It lets rows that surely have no partner skip a join's shuffle."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(16 * keys.count() + 1))))
    shards = 16
    size = (1 << bits) // shards

    def fill(batches):
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            place = batch.column("place").to_numpy()
            for shard in np.unique(place // size):
                marks = own.setdefault(int(shard), np.zeros(size, bool))
                marks[place[place // size == shard] % size] = True
        for shard, marks in own.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([np.packbits(marks).tobytes()], pa.binary())],
                ["shard", "bits"],
            )

    places = keys.select(F.shiftrightunsigned(F.xxhash64(column), 64 - bits).alias("place")).distinct()
    dealt = places.repartition(shards, F.floor(F.col("place") / size))
    filled = np.zeros(1 << (bits - 3), np.uint8)
    for shard, own in dealt.mapInArrow(fill, "shard int, bits binary").collect():
        filled[shard * size // 8 : (shard + 1) * size // 8] |= np.frombuffer(own, np.uint8)
    sent = keys.sparkSession.sparkContext.broadcast(filled)

    @F.pandas_udf("boolean")
    def among(place: pd.Series) -> pd.Series:
        at = place.to_numpy()
        return pd.Series((sent.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1)

    return lambda value: among(F.shiftrightunsigned(F.xxhash64(value), 64 - bits))


def left_join_few(rows: DataFrame, few: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` left-joined with ``few``, which has partners for few of them:
    rows that surely have none are not shuffled."""
    few = checkpointed(few)
    may = membership(few, F.xxhash64(*on))(F.xxhash64(*on))
    alone = [F.lit(None).cast(f.dataType).alias(f.name) for f in few.schema.fields if f.name not in on]
    return rows.where(may).join(few, on, "left").unionByName(rows.where(~may).select("*", *alone))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, base: str) -> str:
    """``base``, prefixed until no column of ``df`` has the name (column
    names are compared without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def quoted(name: str) -> Column:
    """The column called ``name``, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, th, text`` of every row: NULL text is empty, a NULL identifier
    counts as the largest. ``th`` tells rows that share an identifier apart;
    rows equal in both are the same document twice and fare alike."""
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(quoted(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64(text).alias("th"),
        text.alias("text"),
    )


def restored_id(column: str = "id") -> Column:
    """The identifier with its NULL back."""
    return F.when(F.col(column) != LAST_ID, F.col(column))
