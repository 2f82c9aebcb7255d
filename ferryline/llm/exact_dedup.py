"""Exact dedup by content sort.

Rows are range-partitioned by their normalised content (its first characters,
then a hash) at sampled splitters and sorted, externally with spill, so equal
contents lie side by side in one task; a window over the sorted rows compares whole neighbouring contents
and settles each run of equals. A content that holds a large share of the
rows is dealt by a second key into many ranges; each settles its part, and
the few part results (one per range) are combined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.common import checkpointed, free_name, quoted, shuffle_partitions

#: Groups of up to this many rows are never dealt out.
SMALL_GROUP = 64
#: Characters of a content that splitters hold; contents that agree in all of
#: them are ordered by a hash, then compared whole.
SPLITTER_CHARS = 32


def same(text: Column) -> Column:
    """No normalisation: equal means identical."""
    return text


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise=same,
    out: str | None = None,
) -> DataFrame:
    """Every row of ``docs``, all its columns untouched, with one struct
    column more: ``keep_id`` (identifier of the row that stays),
    ``group_size``, ``kept``, ``text_sha256`` (hex, of the normalised
    content in UTF-8).

    ``keep`` names the identifier that stays, ``smallest`` or ``largest``.
    The column's name is ``out``; without it, ``dedup``, prefixed until it
    clashes with none. NULL text equals empty text. A NULL identifier never
    stays while another of the group can; of rows that tie on the identifier
    one stays. Texts of any length are compared whole. An empty table gives
    no rows.

    Groups above ``rows / (4 * shuffle partitions)`` rows are dealt out, so
    at most four times that many contents are named in the small tables
    that steer it: their size depends on the partition count only.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    parts = shuffle_partitions(docs.sparkSession)
    out = out or free_name(docs, "dedup")
    names = docs.columns
    inner = [f"c{i}" for i in range(len(names))]
    text_at = [n.lower() for n in names].index(text_col.lower())
    content = normalise(F.coalesce(F.col(inner[text_at]).cast("string"), F.lit("")))
    plain = normalise is same and docs.schema[text_at].dataType.typeName() == "string"
    carried = [c for i, c in enumerate(inner) if not (plain and i == text_at)]
    rows = (
        docs.withColumn(free_name(docs, "ident"), quoted(id_col).cast("long"))
        .toDF(*inner, "ident")
        .select(*carried, F.col(inner[text_at]).isNull().alias("blank"), "ident", content.alias("content"))
        .withColumn("h", F.xxhash64("content"))
    )

    # how many rows the largest groups hold, by a 64-bit hash of the content
    # (counted in each task first); a collision only deals out more than needed
    total = docs.count()
    counts = rows.groupBy("h").agg(F.count("*").alias("rows"))
    hot = checkpointed(
        counts.where(F.col("rows") > max(SMALL_GROUP, total // (4 * parts))).select(
            "h", F.least(F.ceil(F.col("rows") * 4 * parts / max(total, 1)), F.lit(parts)).cast("int").alias("ranges")
        )
    )
    deal = F.pmod(F.xxhash64("ident"), F.col("ranges")).cast("int")
    dealt = rows.join(F.broadcast(hot), "h", "left").withColumn("deal", F.coalesce(deal, F.lit(-1))).drop("ranges")
    # splitters are sampled over the first characters, then a hash, so that
    # what the sample sends to the driver doesn't grow with the texts' length
    dealt = dealt.withColumn("start", F.substring("content", 1, SPLITTER_CHARS))

    ordered = F.col("ident").asc_nulls_last() if keep == "smallest" else F.col("ident").desc_nulls_last()
    run = Window.partitionBy("start", "h", "content", "deal").orderBy(ordered)
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    settled = (
        dealt.repartitionByRange(parts, "start", "h", "deal")
        .withColumn("best", F.first("ident").over(whole))
        .withColumn("n", F.count(F.lit(1)).over(whole))
        .withColumn("place", F.row_number().over(run))
        .withColumn("sha", F.sha2("content", 256))
    )

    # what the ranges of the groups dealt out come to: a row per group,
    # known by its content's digest
    least = F.min if keep == "smallest" else F.max
    last = F.lit(2**63 - 1) if keep == "smallest" else F.lit(-(2**63))
    by = F.min_by if keep == "smallest" else F.max_by
    groups = (
        rows.join(F.broadcast(hot), "h")
        .select(F.sha2("content", 256).alias("sha"), deal.alias("deal"), "ident")
        .groupBy("sha", "deal")
        .agg(least("ident").alias("best"), F.count("*").alias("n"))
        .groupBy("sha")
        .agg(
            F.sum("n").alias("all_n"),
            by("deal", F.coalesce("best", last)).alias("top_deal"),
            least("best").alias("top"),
        )
    )
    found = F.struct(
        F.when(F.col("all_n").isNull(), F.col("best")).otherwise(F.col("top")).alias("keep_id"),
        F.coalesce("all_n", "n").alias("group_size"),
        ((F.col("place") == 1) & (F.col("deal") == F.coalesce("top_deal", "deal"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    text = F.when(~F.col("blank"), F.col("content"))
    return settled.join(F.broadcast(groups), "sha", "left").select(
        *[
            (text if plain and i == text_at else F.col(c)).alias(n)
            for i, (c, n) in enumerate(zip(inner, names, strict=True))
        ],
        found.alias(out),
    )


def digest(out: DataFrame, id_col: str = "doc_id", column: str = "dedup") -> DataFrame:
    return out.select(
        quoted(id_col).alias("doc_id"),
        *[F.col(f"{column}.{f}").alias(f) for f in ("keep_id", "group_size", "kept", "text_sha256")],
    )
