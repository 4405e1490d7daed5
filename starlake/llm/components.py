"""Distributed connected components by randomised contraction.

Each round every node points to the neighbour (or itself) of least hash, edges are rewritten to the
pointed-to nodes and loops go. With a fresh hash per round the number of nodes that still have edges
falls by a constant factor, so the rounds grow with the logarithm of the largest component, whatever
its shape. A node's neighbours are reduced by ``min`` (partial aggregation), never gathered, so a node
with a third of all edges is no group in one task. Only the number of remaining edges reaches the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

MAX_ROUNDS = 200


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(node, root)`` for every node that has an edge to another node.

    Loops and rows with a null end are ignored; repeated edges count once. ``root`` is one node of
    the component (not a given one: take a minimum over the component for a canonical id). An empty
    input gives an empty output. The rows equal on every run: the hash is seeded by the round.
    """
    e = cut(edges.select("a", "b").where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    roots = None
    for turn in range(MAX_ROUNDS):
        def rank(c, turn=turn):
            return F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("v"))

        sides = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = cut(sides.groupBy("a").agg(F.min(rank("b")).alias("m"))
                     .select(F.col("a").alias("node"), F.least(F.col("m"), rank("a"))["v"].alias("up")))
        if roots is None:
            roots = parent.select("node", F.col("up").alias("root"))
        else:
            roots = cut(roots.join(parent.select(F.col("node").alias("root"), "up"), "root", "left")
                        .select("node", F.coalesce("up", "root").alias("root")))
        e = cut(e.join(parent.select(F.col("node").alias("a"), F.col("up").alias("pa")), "a")
                .join(parent.select(F.col("node").alias("b"), F.col("up").alias("pb")), "b")
                .where("pa <> pb")
                .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        if e.isEmpty():
            return roots
    raise RuntimeError(f"components did not contract in {MAX_ROUNDS} rounds")
