"""Connected components by randomised contraction, in DataFrame operations.

Each round sends every node to the neighbour (or itself) of least random rank
and keeps the edges between the chosen nodes.  Ranks are fresh in every second
round, so a constant share of the nodes is expected to vanish whatever the shape
of the graph: long chains and hubs need a logarithmic number of rounds.  Minima
are taken before the shuffle, joins are against one row per node (adaptive
execution splits a hub's rows), and nothing but "are edges left" reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.llm.staging import stage


def _rank(node: str, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(seed), F.col(node)).alias("rank"), F.col(node).alias("node"))


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) to (node, root) for every node that has an edge to another.

    ``root`` is the smallest node of the component.  Repeated edges, loops and
    edges with a null end change nothing; no edges give no rows.
    """
    left = stage(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    hops: list[DataFrame] = []
    while not left.isEmpty():
        seed = len(hops) // 2
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(_rank("b", seed)).alias("best"))
        hop = stage(
            best.select(F.col("a").alias("node"), F.least("best", _rank("a", seed))["node"].alias("to")), "hop"
        )
        ends = (
            left.join(hop.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(hop.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y")
        )
        left = stage(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        hops.append(hop)
    if not hops:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = hops.pop()
    while hops:
        later = found.select(F.col("node").alias("to"), F.col("to").alias("end"))
        found = hops.pop().join(later, "to", "left").select("node", F.coalesce("end", "to").alias("to"))
    found = stage(found, "ends")
    roots = stage(found.groupBy("to").agg(F.min("node").alias("root")), "roots")
    return found.join(roots, "to").select("node", F.least("root", "to").alias("root"))
