"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.common import checkpointed, hot_join, hot_limit


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``edges`` (``a, b`` of one type
    that has an order, any direction): the least node it is connected to,
    itself included.

    Alternating large-star and small-star steps until every node is tied to
    the least one alone. Each step is shuffles and aggregations of edges (a
    node's neighbours are never gathered), each round ends in the shared
    checkpoint folder, and the rounds grow with the logarithm of the graph.
    The edges of a hub stay where they are and get its least neighbour by
    broadcast (see ``hot_join``), so no task gets a hub whole. Only counts
    reach the driver.
    """
    oriented = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    oriented = checkpointed(oriented)
    while True:
        total, most, tangled = _shape(oriented)
        if not tangled:
            break
        oriented = checkpointed(_small_star(_large_star(oriented, total, most), total, most))
    return oriented.select(F.explode(F.array("u", "v")).alias("node"), F.col("v").alias("component")).distinct()


def _shape(edges: DataFrame) -> tuple[int, int, bool]:
    """Edges, the most that one node has, and whether some node that is tied
    to a smaller one has another edge still."""

    def end(node: str, tied: int):
        return F.struct(F.col(node).alias("node"), F.lit(tied).alias("tied"))

    ends = edges.select(F.explode(F.array(end("u", 1), end("v", 0))).alias("end")).select("end.*")
    nodes = ends.groupBy("node").agg(F.count("*").alias("n"), F.sum("tied").alias("tied"))
    row = nodes.agg(
        F.sum("tied").alias("total"), F.max("n").alias("most"), F.max((F.col("tied") > 0) & (F.col("n") > 1)).alias("tangled")
    ).first()
    return row["total"] or 0, row["most"] or 0, bool(row["tangled"])


def _with_least(edges: DataFrame, total: int, most: int) -> DataFrame:
    """``edges`` with ``m``, the least ``v`` of their ``u``."""
    if most <= hot_limit(total):
        return edges.withColumn("m", F.min("v").over(Window.partitionBy("u")))
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n_rows"))
    return hot_join(edges, least, "u", total, most=most)


def _large_star(edges: DataFrame, total: int, most: int) -> DataFrame:
    """Every node's larger neighbours are tied to its least one (or itself)."""
    turned = F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    both = edges.select(F.explode(F.array(F.struct("u", "v"), turned)).alias("edge")).select("edge.*")
    both = _with_least(both, 2 * total, most)
    return both.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame, total: int, most: int) -> DataFrame:
    """Every node and its smaller neighbours are tied to the least of them.
    (No node has more of these than it had neighbours before the large star.)"""
    told = _with_least(edges, total, most)
    ends = told.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return ends.where("u <> v").distinct()
