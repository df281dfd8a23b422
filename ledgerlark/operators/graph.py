"""Reachability over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlark.operators.settle import settle


def reachable_from(edges: DataFrame, start: DataFrame) -> DataFrame:
    """Nodes reachable from the start nodes with the level at which each is first met.

    ``edges(src, dst)``, ``start(node)``.  One join per level; every node is expanded
    once.  Each level is settled before the next, and the visited nodes every few
    levels, so the plan stays short however deep the graph is.
    """
    edges = settle(edges.distinct())
    frontier = settle(start.select("node").distinct().withColumn("level", F.lit(0)))
    visited, level = frontier, 0
    while not frontier.isEmpty():
        level += 1
        found = (
            edges.join(frontier.select(F.col("node").alias("src")), "src", "left_semi")
            .select(F.col("dst").alias("node"))
            .distinct()
        )
        frontier = settle(
            found.join(visited.select("node"), "node", "left_anti").withColumn("level", F.lit(level))
        )
        visited = visited.unionByName(frontier)
        if level % 8 == 0:
            visited = settle(visited)
    return visited
