"""Connected components by alternating large-star and small-star rounds.

Each round is two grouped passes over the edges; a node's group is never collected: its least
neighbour comes from a partial aggregate and is joined back.  Rounds follow the logarithm of the
component size.  Edges are cut to the checkpoint folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def star(edges: DataFrame, small: bool) -> DataFrame:
    """edges (u > v). Large star: links each larger neighbour to the node's least neighbour or itself."""
    both = edges if small else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # cut: the join then has an exchange on either side, so that the rows of a hub can be split
    least = cut(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")))
    joined = both.join(least, "u")
    if small:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    else:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter("u > v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of edges (columns u, v of one ordered type)."""
    edges = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    before = None
    while True:
        edges = cut(star(cut(star(edges, False)), True))
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            break
        before = now
    return nodes.join(edges.withColumnRenamed("u", "node"), "node", "left").select("node", F.coalesce("v", "node").alias("component"))
