"""Connected components of an edge table, by repeated narrow joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.session import stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node in ``edges (a, b)``; the root is the smallest node that can be reached.

    Each round points every node at the smallest neighbour of itself and of that neighbour (large-star, then small-star),
    so a chain of n nodes needs about log n rounds. Only the number of changed edges reaches the driver, and every round
    is written out, so a lost executor re-reads files. A node with very many edges is aggregated before the shuffle.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        # Large-star: every greater neighbour of a node moves to the node's smallest.
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        # Small-star: a node and its smaller neighbours move to the smallest of them.
        down = large.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        least = down.groupBy("a").agg(F.min("b").alias("low"))
        small = (down.join(least, "a").select(F.col("b").alias("x"), F.col("low").alias("b"))
                 .unionByName(least.select(F.col("a").alias("x"), F.col("low").alias("b"))))
        now = stored(small.filter("x <> b").select(F.col("x").alias("a"), "b").distinct())
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
