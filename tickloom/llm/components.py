"""Connected components by alternating stars, each round a written table.

A round hangs every node's larger neighbours below its smallest neighbour, then every
node's smaller neighbours. The rounds end when the edges are stars around the smallest
nodes. Hubs are no problem: a hub's smallest neighbour is an aggregate, and it comes back
to the edges by a join, which Spark splits where it is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import written


def _hung(edges: DataFrame, lowest: DataFrame) -> DataFrame:
    return edges.join(lowest, "u", "left")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    hung = _hung(both, lowest).where(F.col("v") > F.col("u"))
    return hung.select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = _hung(down, lowest)
    under = hung.where(F.col("v") != F.col("m")).select(F.col("m").alias("a"), F.col("v").alias("b"))
    return under.union(lowest.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the links ``(a, b)``; a component is named by its smallest node.

    Links count both ways; repeated ones, links of a node to itself and links with a null
    end do no harm (the latter two name no node).
    """
    clean = links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = written(clean.distinct(), "links")
    before = _digest(edges)
    while before[0]:
        edges = written(_small(_large(edges)), "stars")
        after = _digest(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots)
