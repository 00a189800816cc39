"""Connected components of an undirected graph by shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def oriented(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """The distinct pairs of different nodes as (high, low)."""
    return pairs.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct()


def contracted(pairs: DataFrame, moves: DataFrame) -> DataFrame:
    """``pairs`` between what ``moves`` (node, to) makes of their ends. The high ends go first: what remains of a node with very
    many neighbours is then a few rows, before its own end is looked up."""
    first = pairs.join(moves, F.col("high") == F.col("node")).where("to <> low").select("to", "low").distinct()
    return oriented(first.withColumnRenamed("to", "x").join(moves, F.col("low") == F.col("node"), "left").select("x", F.coalesce("to", "low").alias("y")), "x", "y")


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node reachable) for every node of ``edges`` (a, b).

    Each round every node moves to its smallest neighbour if that is smaller, then along the moves of others, in round r
    2 ** r steps in all, and the edges are contracted: ends that meet are one node of the next round, and what lies inside
    a node is gone. So a star is one round, a chain in any order takes a number of rounds logarithmic in its
    length, and an edge is not read again once its ends have met. The moves are put together at the end.
    """
    pairs = stored(oriented(edges, "a", "b"))
    rounds: list[DataFrame] = []
    sizes: list[int] = []
    while n := pairs.count():
        moves = stored(pairs.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("to")), n)
        for _ in range(len(rounds) + 1):
            further = moves.select(F.col("node").alias("via"), F.col("to").alias("further"))
            moves = stored(moves.join(further, F.col("to") == F.col("via"), "left").select("node", F.coalesce("further", "to").alias("to")), n)
        rounds.append(moves)
        sizes.append(n)
        pairs = stored(contracted(pairs, moves), n)

    if not rounds:
        return pairs.select(F.col("high").alias("node"), F.col("low").alias("label"))
    labels = rounds.pop().withColumnRenamed("to", "label")
    for r, moves in reversed([*enumerate(rounds)]):
        later = labels.select(F.col("node").alias("via"), "label")
        moved = moves.join(later, F.col("to") == F.col("via"), "left").select("node", F.coalesce("label", "to").alias("label"))
        labels = stored(moved.union(labels.join(moves, "node", "left_anti")), sum(sizes[r:]))
    return labels.union(labels.select("label").distinct().select(F.col("label").alias("node"), "label"))
