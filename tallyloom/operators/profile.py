"""Column profiles A13 and row counts P17."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyloom.operators.columns import ref


def profile_columns(df: DataFrame) -> DataFrame:
    """Long form: type, non-null and null counts and null share per column; one pass, one row per task shuffled."""
    fields = df.schema.fields
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(ref(f.name)).alias(f"_{i}") for i, f in enumerate(fields)])
    rows = [
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("dtype"), F.col(f"_{i}").alias("non_null"))
        for i, f in enumerate(fields)
    ]
    long = counts.select("n", F.inline(F.array(*rows)))
    return long.select(
        "column_name",
        "dtype",
        "non_null",
        (F.col("n") - F.col("non_null")).alias("nulls"),
        F.when(F.col("n") > 0, (F.col("n") - F.col("non_null")) / F.col("n") * 100).otherwise(0.0).alias("null_pct"),
    )


def group_profile(df: DataFrame, key: str) -> DataFrame:
    """Distinct groups and mean rows per group, from group counts rather than a distinct set."""
    sizes = df.filter(ref(key).isNotNull()).groupBy(ref(key)).agg(F.count(F.lit(1)).alias("c"))
    return sizes.agg(
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("rows"),
        F.coalesce(F.avg("c"), F.lit(0.0)).alias("rows_per_group"),
    )


def loss(before: DataFrame, after: DataFrame) -> DataFrame:
    """Share of rows a step removed."""
    counts = before.agg(F.count(F.lit(1)).alias("rows_before")).withColumn(
        "rows_after", after.agg(F.count(F.lit(1))).scalar()
    )
    lost = F.col("rows_before") - F.col("rows_after")
    return counts.withColumn("lost_pct", F.when(F.col("rows_before") > 0, lost / F.col("rows_before") * 100).otherwise(0.0))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count of a frame taken while its own query runs, so without another scan.

    For logs; counters that must be exact under task retries come from ``load_counts``.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
