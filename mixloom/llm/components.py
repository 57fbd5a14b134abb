"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.llm.base import stored


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a", "b").agg(F.lit(1).alias("_")).drop("_")


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every greater neighbour of a node to the least among the node and its neighbours."""
    ways = F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    both = edges.select(F.inline(ways))
    least = both.groupBy("u").agg(F.min("v").alias("_m")).select(F.col("u").alias("_u"), F.least("u", "_m").alias("m"))
    linked = both.where("v > u").join(least, F.col("u") == F.col("_u"))
    return _distinct(linked.select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links every node and its lesser neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least.withColumnRenamed("a", "_a"), F.col("a") == F.col("_a")).where("b <> m")
    moved = linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _distinct(moved.unionByName(least.withColumnRenamed("m", "b")))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b`` (longs, ``a <> b``) but the roots; a root is its least node.

    Rounds are written to the shared folder and stop when one changes nothing. A node's neighbours are never
    gathered: they are joined to their minimum.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, before = stored(_distinct(edges), "links"), None
    while True:
        edges = stored(_small_star(stored(_large_star(edges), "large")), "small")
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark
