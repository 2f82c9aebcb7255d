"""Mixing sources to target weights by Poisson replication.

Each document is repeated a Poisson number of times whose mean is its
source's rate: the share of the mixture its source is to have over the share
it has. The number is found by inverting the distribution at a uniform
number hashed from the seed and the document, so it is the same on every run
and on every partitioning. Documents are exploded by their numbers and
shuffled globally by a second hash.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.llm.common import checkpointed, free_name, quoted, shuffle_partitions

#: A larger mean is drawn as the sum of numbers of means up to this.
MEAN_STEP = 16.0
#: Terms of the distribution of a mean up to MEAN_STEP that are summed; what
#: lies beyond has a probability below 2**-53, the step of the uniform numbers.
TERMS = 80
#: Up to this many sources, the table of rates is sent to every executor.
BROADCAST_SOURCES = 10_000
#: Otherwise the rows of a source are dealt over this many keys of the join.
SALTS = 64


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the parts' MD5."""
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, source_col: str, weights: Mapping[str, float] | None, total: int | None) -> DataFrame:
    """``source, draws, cdf`` of every source: its mean repetition rate as
    ``draws`` equal parts, and the distribution of one part.

    A NULL source is one of its own, named by the empty string in
    ``weights``. Without weights every source weighs the same; with them, a
    source they do not name is left out. The mixture is meant to have
    ``total`` documents, as many as there are when it is not given.
    """
    counts = docs.groupBy(F.coalesce(quoted(source_col).cast("string"), F.lit("")).alias("source")).agg(
        F.count("*").alias("n")
    )
    if weights is None:
        counts = counts.withColumn("weight", F.lit(1.0))
    else:
        pairs = [F.lit(x) for k, v in weights.items() for x in (k, float(v))]
        table = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
        counts = counts.withColumn("weight", F.coalesce(F.element_at(table, F.col("source")), F.lit(0.0)))
    sums = counts.agg(F.sum("weight").alias("weight"), F.sum("n").alias("n")).first()
    wanted = float(total if total is not None else sums["n"] or 0)
    mean = F.col("weight") / F.lit(float(sums["weight"] or 1.0)) * F.lit(wanted) / F.col("n")
    draws = F.greatest(F.ceil(F.col("mean") / F.lit(MEAN_STEP)), F.lit(1)).cast("int")
    part = F.col("mean") / F.col("draws")
    terms = F.transform(
        F.sequence(F.lit(0), F.lit(TERMS)),
        lambda k: F.exp(-part + k * F.log(part) - F.aggregate(
            F.when(k > 0, F.sequence(F.lit(1), k)).otherwise(F.array().cast("array<int>")),
            F.lit(0.0),
            lambda s, j: s + F.log(j.cast("double")),
        )),
    )
    cdf = F.transform(
        F.sequence(F.lit(1), F.lit(TERMS + 1)),
        lambda k: F.aggregate(F.slice(F.col("terms"), F.lit(1), k), F.lit(0.0), lambda s, x: s + x),
    )
    rated = counts.withColumn("mean", mean).where(F.col("mean") > 0).withColumn("draws", draws)
    return rated.withColumn("terms", terms).select("source", "mean", "draws", cdf.alias("cdf"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: Mapping[str, float] | None = None,
    total: int | None = None,
    seed: int = 0,
    out: str | None = None,
) -> DataFrame:
    """The mixture: rows of ``docs``, all columns untouched, each repeated
    its number of times, in a global random order, with one struct column
    more (``out``, or ``mix`` prefixed until it clashes with none): ``copy``
    (from 0), ``copies``, ``order`` (32 hexadecimal digits; rows are sorted by it
    inside each partition, and dealt to partitions by its hash).

    A NULL identifier is hashed as the empty string; rows that share an
    identifier have the same number of copies. Sources as in
    ``source_rates``. Text is not read, so empty and long texts fare alike.
    An empty table gives no rows.
    """
    parts = shuffle_partitions(docs.sparkSession)
    out = out or free_name(docs, "mix")
    names = docs.columns
    inner = [f"c{i}" for i in range(len(names))]
    rates = checkpointed(source_rates(docs, source_col, weights, total))
    rows = (
        docs.withColumn(free_name(docs, "key"), F.coalesce(quoted(id_col).cast("string"), F.lit("")))
        .withColumn(free_name(docs, "origin"), F.coalesce(quoted(source_col).cast("string"), F.lit("")))
        .toDF(*inner, "key", "source")
    )
    if rates.count() <= BROADCAST_SOURCES:
        rated = rows.join(F.broadcast(rates), "source")
    else:
        salted = rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rated = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(
            salted, ["source", "salt"]
        )
    own_seed = F.lit(str(seed))

    us = F.transform(
        F.sequence(F.lit(1), F.col("draws")),
        lambda j: uniform(own_seed, F.lit("count"), j.cast("string"), F.col("key")),
    )
    copies = F.aggregate("us", F.lit(0), lambda s, u: s + F.size(F.filter("cdf", lambda c: c <= u)))
    counted = rated.withColumn("us", us).withColumn("copies", copies).where(F.col("copies") > 0)
    spread = counted.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    order = F.md5(F.concat_ws(":", own_seed, F.lit("order"), F.col("copy").cast("string"), F.col("key")))
    spread = spread.withColumn("order", order).select(*inner, "copy", "copies", "order")
    shuffled = spread.repartition(parts, "order").sortWithinPartitions("order")
    return shuffled.select(
        *[F.col(c).alias(n) for c, n in zip(inner, names, strict=True)],
        F.struct("copy", "copies", "order").alias(out),
    )


def digest(out: DataFrame, column: str = "mix") -> DataFrame:
    return out.select(
        "doc_id", "source", *[F.col(f"{column}.{f}").alias(f) for f in ("copy", "copies", "order")], "text"
    )
