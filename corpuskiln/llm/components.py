"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a groupBy with partial aggregation plus a join back, in which the edges of a node with many
neighbours are cut into parts (spread_join); nothing is collected but counts. State between rounds is
written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import materialize, spread_join

MAX_ROUNDS = 40


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge to another.

    Repeated edges, both directions and self loops may occur; edges with a null end are dropped.
    An empty table gives an empty one.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = materialize(now.where("u is not null and v is not null and u <> v").distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n")), "lows")
        large = spread_join(both.where("v > u"), low.select("u", "m"), "u", low.select("u", "n"), "v")
        large = materialize(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        small_low = materialize(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "lows")
        small = spread_join(large, small_low.select("u", "m"), "u", small_low.select("u", "n"), "v")
        small = small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        small = small.union(small_low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = materialize(small, "edges")
        # a forest of stars: no centre is itself a leaf, and each leaf has one centre
        leaves = after.groupBy("u").agg(F.count("*").alias("n"))
        open_ = leaves.where("n > 1").select("u").union(after.select(F.col("v").alias("u")).distinct().join(leaves, "u", "left_semi"))
        now = after
        if open_.limit(1).count() == 0:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
