"""Connected components of an edge table, by alternating star contraction.

Nodes are longs. Every round joins and aggregates; nothing is collected but counts. The
number of rounds grows with the logarithm of the longest path. A hub with any number of
neighbours is met with pre-aggregated minima and joins whose skewed side Spark splits.
Each round is stored in the shared folder, so a lost executor costs no more than a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetable.session import settle


def _smallest(pairs: DataFrame) -> DataFrame:
    """``u, m``: the smallest among a node and its neighbours in ``u, v`` rows."""
    return pairs.groupBy(F.col("u").alias("n")).agg(F.least(F.min("v"), F.min("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    larger = both.filter("v > u")
    return larger.join(_smallest(both), F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = _smallest(edges)
    moved = edges.join(low, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = low.select(F.col("n").alias("u"), F.col("m").alias("v"))
    return moved.union(own).filter("u <> v").distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the ``a, b`` edges: the smallest node it can reach.

    Loops and repeated edges are allowed; a node that only has a loop, and an empty table, give no row.
    """
    current = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        current = settle(_small_star(_large_star(current)))
        row = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
