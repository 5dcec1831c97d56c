"""Connected components by alternating large stars and small stars; every step is an aggregation and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, settle


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of all nodes of an edge table; component is the least node in it.

    Loops, repeated edges and edges with null are harmless; a node with loops only has no row. Nodes are long. Hot nodes
    are pre-aggregated for their minimum; minima are written first, so that adaptive execution can split a hot node's
    edges in the join with them.
    """
    x, y = F.col(a), F.col(b)
    now = settle(edges.filter(x != y).select(F.greatest(x, y).cast("long").alias("u"), F.least(x, y).cast("long").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large, "large")
        lowest = settle(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        joined = large.join(lowest, "u")
        small = joined.select("u", F.col("m").alias("v")).unionByName(joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        after = settle(small.distinct(), "edges")
        row = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        for done in (now, least, large, lowest):
            discard(done)
        now = after
        if (row.n, row.s) == mark:
            break
        mark = (row.n, row.s)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
