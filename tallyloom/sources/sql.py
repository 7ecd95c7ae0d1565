"""SQL text with parameters and catalog look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query(spark: SparkSession, sql: str, **params) -> DataFrame:
    """Named parameters ``:name``; values are bound, never pasted into the text."""
    return spark.sql(sql, args=params)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int, partitions: int, **options) -> DataFrame:
    """S7 for an external database, split over tasks by a numeric column."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    bounds = {"partitionColumn": partition_column, "lowerBound": lower, "upperBound": upper, "numPartitions": partitions}
    return reader.options(**bounds).load()


def table_exists(spark: SparkSession, name: str) -> bool:
    """S15."""
    return spark.catalog.tableExists(name)


def matching_tables(spark: SparkSession, pattern: str) -> list[str]:
    """Names like ``ads_*``."""
    return sorted(t.name for t in spark.catalog.listTables(pattern=pattern))


def column_names(spark: SparkSession, table: str) -> list[str]:
    """S15."""
    return [c.name for c in spark.catalog.listColumns(table)]
