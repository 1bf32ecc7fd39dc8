"""Connected components of a graph given as an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import stored

MAX_ROUNDS = 60


def _nearest(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each node, itself included, from edges (u, v) in both directions."""
    return edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest node it is connected to.

    Each step replaces a node's edges by edges to its smallest neighbour. Minima are aggregates and the joins have one
    row per node on one side, so a node with very many neighbours is split like any skewed key. Rounds grow with the
    logarithm of the longest path. Self-loops and null ends are dropped; an empty table gives an empty result.
    """
    e = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    e = stored(e.distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_nearest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        e = stored(small.select("x.*").where("u != v").distinct(), "edges")
        ends = e.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.where("up > 1 OR up > 0 AND down > 0").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
