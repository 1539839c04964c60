"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordtrust.sources.workspace import Workspace


def _star(edges: DataFrame, workspace: Workspace, large: bool) -> DataFrame:
    """Link every neighbour above a node (large), or every one up to it and the node (small), to the least
    of the node and its neighbours.

    The least neighbours are written, so the join has two plain shuffles and Spark can split the node at
    the centre of a large star.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("near"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("near")))
    least = workspace.stage(both.groupBy("node").agg(F.min("near").alias("least")), "least")
    joined = both.join(least, "node")
    root = F.least("least", "node")
    if large:
        found = joined.where(F.col("near") > F.col("node")).select(F.col("near").alias("a"), root.alias("b"))
    else:
        found = joined.select(F.col("near").alias("a"), root.alias("b")).unionByName(least.select(F.col("node").alias("a"), root.alias("b")))
    return found.where(F.col("a") != F.col("b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every edge leads to a centre: no node has two lesser ends, or is an end of both kinds."""
    below, above = F.struct(F.col("a").alias("node"), F.col("b").alias("to")), F.struct(F.col("b").alias("node"), F.lit(None).cast("long").alias("to"))
    ends = edges.select(F.explode(F.array(below, above)).alias("end")).groupBy("end.node")
    state = ends.agg(F.min("end.to").alias("low"), F.max("end.to").alias("high"), F.count("end.to").alias("lower"), F.count(F.lit(1)).alias("all"))
    return state.where("low != high OR (lower > 0 AND lower < all)").isEmpty()


def components(edges: DataFrame, workspace: Workspace) -> DataFrame:
    """Node and least node reachable of every node in ``edges`` (a, b).

    Null ends, loops and repeated edges do no harm. Edges are kept with the larger end first; each round
    is written to the workspace, and the rounds, of the order of log(nodes)**2 at most, end when only stars
    are left, which needs none for input that is stars.
    """
    current = workspace.stage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct(), "edges"
    )
    while not _settled(current):
        wide = workspace.stage(_star(current, workspace, large=True), "large")
        current = workspace.stage(_star(wide, workspace, large=False), "small")
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)
