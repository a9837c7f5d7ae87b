"""Connected components of an edge table, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.sources.scratch import settle


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns ``node`` and ``component`` (the smallest node it is linked to, however far) for every
    node of ``edges`` (``a``, ``b``, of one orderable type; loops, repeats and either order allowed).

    Each round, every node that has a smaller neighbour moves to its smallest one, chains of moves
    are followed to their ends, and the edges are renamed to those ends; edges that close up
    vanish. Smallest neighbours are minima, so a node with very many links costs partial aggregates
    only, and renaming is a join that adaptive execution splits where a node is hot. Tables are
    written to shared storage each round. An empty table gives an empty one; edges with a null end
    link nothing.
    """
    live = settle(_tidy(edges.select("a", "b")), "edges")
    moves: list[DataFrame] = []
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).where("to < node")
        ends = _follow(settle(smallest, "moves"))
        moves.append(ends)
        first = ends.select(F.col("node").alias("a"), F.col("to").alias("a_to"))
        second = ends.select(F.col("node").alias("b"), F.col("to").alias("b_to"))
        renamed = (
            live.join(first, "a", "left")
            .join(second, "b", "left")
            .select(F.coalesce("a_to", "a").alias("a"), F.coalesce("b_to", "b").alias("b"))
        )
        live = settle(_tidy(renamed), "edges")
    return _compose(edges, moves)


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _follow(moves: DataFrame) -> DataFrame:
    """``moves`` (node, to) with every ``to`` replaced by the end of its chain; chains only descend,
    and each pass doubles the steps taken."""
    while True:
        further = moves.select(F.col("node").alias("to"), F.col("to").alias("next"))
        if moves.join(further, "to", "left_semi").isEmpty():
            return moves
        moves = settle(
            moves.join(further, "to", "left").select("node", F.coalesce("next", "to").alias("to")), "moves"
        )


def _compose(edges: DataFrame, moves: list[DataFrame]) -> DataFrame:
    """Where each node of the first edges has come to after all rounds."""
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node")))
    found = nodes.where("node is not null").distinct().withColumn("component", F.col("node"))
    for step in moves:
        later = step.select(F.col("node").alias("component"), F.col("to").alias("_to"))
        found = found.join(later, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    return found
