"""Connected components of an edge table, by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of ``edges``; the root is one node of
    the component.

    Each round sends every node to its least neighbour or itself (a grouped
    min, combined before the shuffle, so a node with very many neighbours is
    no load), then renames the edges' ends and drops loops and repeats.  Node
    names should be hashes: in random order a round leaves a fixed share of
    the nodes.  Tables of a round are written to the shared folder, edges and
    labels never reach the driver."""
    left = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a") != F.col("b")).distinct(),
                   "edges")
    known = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    known = written(known.withColumn("root", F.col("node")), "roots")
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        steps = written(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("to")), "steps")
        known = written(known.join(steps.withColumnRenamed("a", "root"), "root", "left")
                        .select("node", F.coalesce("to", "root").alias("root")), "roots")
        one = left.join(steps.withColumnRenamed("to", "x"), "a").select("x", "b")
        two = one.join(steps.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
        left = written(two.where(F.col("x") != F.col("y")).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                       .distinct(), "edges")
    return known
