"""Account hierarchies S11, S22."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage


def expand_accounts(clients: DataFrame, seeds: DataFrame) -> DataFrame:
    """All clients of the seeds, then the non-manager clients of managers met there that are no seed.

    ``clients`` holds one row per (manager_id, id) listing; ``seeds`` holds id.
    """
    seed_ids = seeds.select(F.col("id").alias("manager_id")).distinct()
    direct = clients.join(seed_ids, "manager_id", "left_semi")
    managers = direct.filter("manager").select(F.col("id").alias("manager_id")).distinct()
    fresh = managers.join(seed_ids, "manager_id", "left_anti")
    nested = clients.filter(~F.col("manager")).join(fresh, "manager_id", "left_semi")
    return direct.unionByName(nested)


def account_tree(clients: DataFrame, seed) -> DataFrame:
    """Every account reachable from the seed with its depth and the manager it was last met under.

    One join per level, each cut by a checkpoint; a manager is expanded once, so
    cycles end.
    """
    spark = clients.sparkSession
    edges = clients.select("manager_id", "id", "manager")
    key = edges.schema["manager_id"].dataType
    expanded = spark.range(1).select(F.lit(seed).cast(key).alias("manager_id"))
    level = cut_lineage(edges.filter(F.col("manager_id") == F.lit(seed)).withColumn("depth", F.lit(1)))
    found, depth = level, 1
    while not level.isEmpty():
        depth += 1
        managers = level.filter("manager").select(F.col("id").alias("manager_id")).distinct()
        frontier = managers.join(expanded, "manager_id", "left_anti")
        level = cut_lineage(edges.join(frontier, "manager_id", "left_semi").withColumn("depth", F.lit(depth)))
        found = found.unionByName(level)
        expanded = cut_lineage(expanded.unionByName(frontier))
    return found.groupBy("id").agg(
        F.max_by("manager_id", F.struct("depth", "manager_id")).alias("via_manager"),
        F.min("depth").alias("depth"),
        F.bool_or("manager").alias("manager"),
    )
