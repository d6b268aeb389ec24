"""Connected components of an edge table, by DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import checkpointed


def _star(edges: DataFrame, keep_larger: bool) -> DataFrame:
    """Each node's neighbours, or those below it, linked to the smallest of them."""
    lowest = edges.groupBy("node").agg(F.min("peer").alias("low"))
    lowest = lowest.withColumn("low", F.least("node", "low"))
    joined = edges.join(lowest, "node")
    if keep_larger:
        linked = joined.where("peer > node").select(F.col("peer").alias("node"), F.col("low").alias("peer"))
    else:
        linked = joined.select(F.col("peer").alias("node"), F.col("low").alias("peer")).union(
            lowest.select("node", F.col("low").alias("peer"))
        )
    return linked.where("node <> peer").distinct()


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node``, ``root``: every node of an edge with the smallest node it can reach.

    Alternates large and small stars (each node points at the smallest of its
    neighbourhood) until the edge table stays as it is; the number of rounds grows
    with the logarithm of the longest path. A hub's rows are reduced in the tasks
    before the shuffle; its join is one that adaptive execution may split. Edges are
    never collected. Null ends and loops are left out; repeated edges count once.
    """
    pairs = edges.select(F.col(left).alias("node"), F.col(right).alias("peer"))
    pairs = checkpointed(pairs.where("node is not null and peer is not null and node <> peer").distinct())
    state = None
    while True:
        print_of = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("node", "peer").cast("decimal(38,0)")).alias("s")).first()
        if (print_of.n, print_of.s) == state or not print_of.n:
            break
        state = (print_of.n, print_of.s)
        both = pairs.union(pairs.select(F.col("peer").alias("node"), F.col("node").alias("peer"))).distinct()
        large = _star(both, keep_larger=True)
        below = large.select(F.greatest("node", "peer").alias("node"), F.least("node", "peer").alias("peer"))
        pairs = checkpointed(_star(below, keep_larger=False))
    roots = pairs.groupBy("node").agg(F.min("peer").alias("root"))
    return roots.union(pairs.select(F.col("peer").alias("node"), F.col("peer").alias("root")).distinct())
