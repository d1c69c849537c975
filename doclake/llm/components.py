"""Connected components of a table of links, by stars that shrink toward the smallest node of each component."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from doclake.llm.common import stored


def _toward_smallest(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's larger (or smaller) neighbours, linked with the smallest of its neighbourhood instead."""
    if large:
        pairs = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = pairs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    moved = pairs.join(lowest, "a")
    if large:
        moved = moved.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(lowest.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def component_labels(links: DataFrame) -> DataFrame:
    """``(node, label)`` of every node in ``links (a, b)``: the smallest node reachable from it.

    Links may repeat, run either way, or join a node with itself (such a node alone gets no row). Each round is stored;
    rounds grow with the logarithm of the largest component, and no node's neighbours are ever gathered in one row.
    """
    edges = stored(links.filter("a <> b").select("a", "b").distinct(), "links")
    state = None
    while True:
        edges = stored(_toward_smallest(_toward_smallest(edges, True), False), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("label"))
            ).distinct()
        state = now
