"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litscope.session import durable


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable, for every id that has a link.

    Each round every vertex takes its smallest neighbour (or itself) as parent,
    the parents are followed twice, and the graph shrinks to the links between
    different parents. Every vertex with a smaller neighbour leaves, so the graph
    at least halves; the driver only learns whether links are left. Null ends and
    loops are ignored.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    edges = durable(ends.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    found = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = durable(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("p")))
        step = parents.select(F.col("a").alias("p"), F.col("p").alias("next"))
        for _ in range(2):
            parents = parents.join(step, "p").select("a", F.col("next").alias("p"))
        parents = durable(parents)
        up_a, up_b = (parents.select(F.col("a").alias(c), F.col("p").alias(f"p{c}")) for c in "ab")
        moved = edges.join(up_a, "a").join(up_b, "b").where("pa <> pb")
        edges = durable(moved.select(F.greatest("pa", "pb").alias("a"), F.least("pa", "pb").alias("b")).distinct())
        if found is None:
            found = parents.select(F.col("a").alias("id"), F.col("p").alias("component"))
        else:
            above = parents.select(F.col("a").alias("component"), F.col("p").alias("root"))
            joined = found.join(above, "component", "left")
            found = durable(joined.select("id", F.coalesce("root", "component").alias("component")))
    if found is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return found
