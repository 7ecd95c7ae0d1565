"""Connected components of a distributed graph, as rows all along."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    return both.join(least, F.col("a") == F.col("k")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to its least neighbour."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    across = down.join(least.select(F.col("a").alias("k"), "m"), F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return across.unionAll(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): least node reachable, for every node that has an edge in ``edges`` (a, b, longs).

    Alternates star contractions until nothing changes; each round is written to
    the shared folder, so lineage stays short and lost executors cost one round. A hub's
    neighbours are aggregated before the shuffle and never gathered.
    """
    current = stage(edges.select("a", "b").where("a != b").distinct(), "edges")
    before = _state(current)
    if not before[0]:
        return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(rounds):
        current = stage(_small(_large(current)), "edges")
        after = _state(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionAll(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
