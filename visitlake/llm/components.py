"""Connected components of a large graph by alternating large-star and small-star steps.

Each step joins edges with the least neighbour of a node, which is found by a partial aggregation, so that a node with
very many neighbours is combined before the shuffle and its edges can be split by the skew join. Every round is written
to the shared folder: that cuts the plan and survives lost executors.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.session import staged


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for each node of the edges (``a``, ``b``); the root is the component's least node.

    Loops, repeated edges and both directions are allowed; an edge with a missing end is no edge.
    """
    larger, smaller = F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")
    found = staged(edges.filter("a <> b").select(larger, smaller).distinct(), "edges")
    seen = None
    while (state := _state(found)) != seen:
        seen = state
        found = staged(_small_star(_large_star(found)), "edges")
    roots = found.select(F.col("root").alias("node"), "root").distinct()
    return found.unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root")),
                           F.bit_xor(F.xxhash64("root", "node"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy("node").agg(F.least("node", F.min("root")).alias("least"))
    return (both.join(least, "node").filter("root > node")
            .select(F.col("root").alias("node"), F.col("least").alias("root")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("node").agg(F.min("root").alias("least"))
    tied = edges.join(least, "node").filter("root > least").select(F.col("root").alias("node"), F.col("least").alias("root"))
    return tied.unionByName(least.withColumnRenamed("least", "root")).distinct()
