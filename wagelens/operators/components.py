"""Connected components of a graph of text keys or numbers, in DataFrame operations.

Every round keeps, for each node, a link to the least node it knows of, and then lets the
nodes it knew link to that one instead.  Larger neighbours and smaller ones take turns, so
what is left after some rounds, logarithmic in the size of a component, is a star: every
node linked to the least of its component.  Rounds are written, minima are taken before
the shuffle, and joins are against one row per node, so a hub is split like any frequent key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.session import scratch_path


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "links")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _least(both: DataFrame) -> DataFrame:
    """(node, least): the least of a node's neighbours and itself."""
    return both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))


def _onto_least(links: DataFrame, larger: bool) -> DataFrame:
    """Links (node, other), other < node, with each node's larger or smaller neighbours linked to the least it knows."""
    turned = links.select(F.col("other").alias("node"), F.col("node").alias("other"))
    if larger:
        both = links.unionByName(turned)
        moved = both.join(_least(both).hint("merge"), "node").where("other > node").select(F.col("other").alias("node"), F.col("least").alias("other"))
    else:
        joined = links.join(_least(links).hint("merge"), "node")
        moved = joined.select(F.col("other").alias("node"), F.col("least").alias("other")).unionByName(joined.select("node", F.col("least").alias("other")))
    return moved.where("node <> other").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """Edges (a, b) to (node, root): every node with an edge to another, and the least node it can reach.

    Loops, repeated edges and edges with a null end change nothing; no edges give no rows.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).distinct()
    links = _written(links)
    while True:
        nearer = _written(_onto_least(_onto_least(links, larger=True), larger=False))
        # the same number of links with the same content: all are stars
        state = [x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first() for x in (links, nearer)]
        links = nearer
        if state[0] == state[1]:
            break
    roots = links.select(F.col("other").alias("node")).distinct()
    return links.withColumnRenamed("other", "root").unionByName(roots.select("node", F.col("node").alias("root")))
