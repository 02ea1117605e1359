"""Connected components of a graph of links, by contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.functions.sizing import stored


def ends(points: DataFrame) -> DataFrame:
    """(node, to) with every pointer followed to its end: pointers double until none moves, so a chain of n takes log2(n) rounds.

    Pointers form no cycle but that of a node to itself.
    """
    while True:
        step = points.filter("node <> to").select(F.col("node").alias("to"), F.col("to").alias("next"))
        moved = points.join(step, "to", "left").select("node", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved"))
        # A pointer moves when its target points on; the first look costs one join where nothing does.
        if not moved.filter("moved AND node <> to").limit(1).count():
            return points
        points = stored(moved.select("node", "to"), "points")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (a, b): component is the smallest node reachable.

    In a round every node points to the smallest of itself and its neighbours, pointers are followed to their end by doubling, and
    edges are renamed to what their ends point to; the smallest node of a component always points to itself, so it is what remains
    when no edge is left. A chain, however long, ends in one round of logarithmically many doublings. Rounds are written to the
    shared folder; hubs are pre-aggregated before the shuffle.
    """
    rounds = []
    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to")), "points")
        points = ends(points)
        rounds.append(points)
        left, right = points.select(F.col("node").alias("a"), F.col("to").alias("x")), points.select(F.col("node").alias("b"), F.col("to").alias("y"))
        renamed = edges.join(left, "a").join(right, "b").filter("x <> y")
        edges = stored(renamed.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))

    def follow(sofar: DataFrame, points: DataFrame) -> DataFrame:
        step = points.select(F.col("node").alias("to"), F.col("to").alias("next"))
        return sofar.join(step, "to", "left").select("node", F.coalesce("next", "to").alias("to"))

    return stored(reduce(follow, rounds[1:], rounds[0]).withColumnRenamed("to", "component"), "components")
