"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuekit.llm.common import dropped, staged


def components(edges: DataFrame) -> DataFrame:
    """``edges``: u, v (long, u != v, any direction, repeats allowed). Returns
    node, root: the smallest node reachable, for every node with an edge.

    Each round ties every node's larger neighbours to its smallest one (large
    star), then its smaller neighbours likewise (small star), until only stars
    are left; edges that are stars already take no round. Every step is a grouped
    minimum (combined before the shuffle) and a join; the minima and each round's
    edges are written to the shared folder, the minima so that the join does not
    take over their partitions and a hot node's rows can be split, and what a
    round no longer needs is deleted."""
    now = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not only_stars(now):
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        # neighbour v of u goes to u's minimum
        large = staged(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        lower = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = (large.join(lower, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(lower.select("u", F.col("m").alias("v"))))
        past, now = now, staged(small.where("u > v").distinct(), "edges")
        dropped(past, least, large, lower)
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).groupBy("node").agg(F.min("root").alias("root")))


def only_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or tied to one centre alone. Edges
    are distinct with u > v, so a centre then is the smallest node it reaches."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).union(edges.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    per_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return per_node.where((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("least") == 0))).isEmpty()
