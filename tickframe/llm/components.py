"""Connected components of an edge table: every node points to its smallest neighbour, pointers are doubled until they end at a
root, and each tree is contracted to its root, until no edge is left.

A contraction merges each node that has an edge with another one, so the trees of a round are half as many as its nodes at
most; doubling takes as many joins as a path's length has bits. A chain of n ids in rising order takes one contraction and log2(n) doublings.
Edges stay in tables of the shared folder; nothing is collected but whether a table has rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import dropped, stored


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) of longs -> (node, component): the smallest node reachable, for every node that has an edge. ``rounds`` of the result
    says how many contractions and doublings it took.

    Self loops, repeated edges and nulls add nothing; without edges the result is empty.
    """
    edge, rounds = stored(edges.select("a", "b").where("a <> b").distinct(), "edges"), 0
    nodes = edge.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    label = stored(nodes.withColumn("component", F.col("node")), "labels")
    while not edge.isEmpty():
        both = edge.unionByName(edge.select(F.col("b").alias("a"), F.col("a").alias("b")))
        root = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m")), "roots")
        while True:
            rounds += 1
            of = root.select(F.col("u").alias("v"), F.col("m").alias("n"))
            jumped = stored(root.join(of, F.col("m") == F.col("v")).select("u", F.col("n").alias("m"), (F.col("n") < F.col("m")).alias("moved")), "roots")
            dropped(root)
            root = jumped
            if root.where("moved").isEmpty():
                break
        step = edge.join(root, F.col("a") == F.col("u")).select(F.col("m").alias("x"), "b").join(root, F.col("b") == F.col("u")).select(F.col("x").alias("a"), F.col("m").alias("b"))
        after = stored(step.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        moved = stored(label.join(root, F.col("component") == F.col("u"), "left").select("node", F.coalesce("m", "component").alias("component")), "labels")
        dropped(edge, label, root)
        edge, label, rounds = after, moved, rounds + 1
    dropped(edge)
    label.rounds = rounds
    return label
