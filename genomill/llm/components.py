"""Connected components of a graph held as DataFrames.

Each round hooks a node's parent, and the node, to the smallest grandparent among its
neighbours, and shortens paths (the FastSV scheme), so long chains need few rounds.  All
steps are joins and minimum aggregates, combined before they are shuffled; nodes with a large
part of all edges, and roots with a large part of all nodes, are joined by broadcast (at most
``HOT_PART`` of them), so that no task gathers a giant component.  The driver gets one count
and these nodes each round.  Each round is written to shared storage, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, save, spread_join


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges(a, b)``; component is its smallest id."""
    half = edges.filter(F.col("a") != F.col("b")).select("a", "b")
    both = save(half.union(half.select("b", "a")).distinct(), "edges")
    parents = save(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("f")), "parents")
    if parents.isEmpty():
        return parents.select("id", F.col("f").alias("component"))
    n_edges, n_nodes = both.count(), parents.count()
    while True:
        grand = spread_join(parents, parents.select(F.col("id").alias("f"), F.col("f").alias("gf")), "f", n_nodes).select("id", "f", "gf")
        grand = save(grand, "grand")
        seen = spread_join(both, grand.select(F.col("id").alias("b"), F.col("gf").alias("g")), "b", n_edges).groupBy(F.col("a").alias("id")).agg(F.min("g").alias("g"))
        best = grand.join(seen, "id").select("id", "f", "gf", "g")
        hooks = best.select(F.col("f").alias("id"), F.col("g").alias("n")).union(best.select("id", F.least("gf", "g").alias("n")))
        new = save(hooks.groupBy("id").agg(F.min("n").alias("n")).join(parents, "id").select("id", F.least("f", "n").alias("f"), (F.col("n") < F.col("f")).alias("moved")), "parents")
        more = new.filter("moved").limit(1).count()
        drop(parents, grand)
        parents = new.select("id", "f")
        if not more:
            drop(both)
            return parents.select("id", F.col("f").alias("component"))
