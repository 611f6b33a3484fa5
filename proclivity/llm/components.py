"""Connected components by alternating stars, as joins and minima on tables of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Workspace


def _star(edges: DataFrame) -> DataFrame:
    """For each ``a``: link every neighbour ``b`` to the smallest of a and its neighbours.

    The minimum is aggregated in the map tasks first, and the join can split a node with very many edges.
    """
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return edges.join(least, "a")


def smallest_reachable(ws: Workspace, edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node of its component.

    ``edges`` has longs ``a`` and ``b`` without nulls. Each round links every node to a smaller one and
    writes its edges to the shared folder; the number of rounds grows with the logarithm of the diameter.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = ws.write(pairs.distinct(), "edges")
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        large = ws.write(large, "large")
        starred = _star(large)
        small = starred.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            starred.select("a", F.col("least").alias("b"))
        )
        later = ws.write(small.where("a <> b").distinct(), "small")
        # Stars only: each node has one smaller neighbour, which has none. Then another round changes nothing.
        parents = later.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("b"))
        open_ones = parents.where("n > 1").select("a").union(
            parents.join(parents.select(F.col("a").alias("b")), "b", "left_semi").select("a")
        )
        done = open_ones.isEmpty()
        ws.drop(current, large)
        current = later
        if done:
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
