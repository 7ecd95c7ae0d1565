"""Run totals and the nightly report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTERS = ("rows_from_api", "rows_written", "rows_inserted", "rows_updated", "rows_skipped", "rows_filtered")


def run_totals(tables: DataFrame, keys: tuple[str, ...] = ("execution_id", "platform")) -> DataFrame:
    """Per run the six row totals, table counts and status from one row per table.

    A failed table counts with zero rows. No failure is success, no success is failed, else partial.
    """
    ok = F.col("success")
    sums = [F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).alias(f"total_{c}") for c in COUNTERS]
    counted = tables.groupBy(*keys).agg(
        *sums,
        F.count(F.lit(1)).alias("tables_count"),
        F.count_if(ok).alias("tables_succeeded"),
        F.count_if(~ok).alias("tables_failed"),
    )
    status = (
        F.when(F.col("tables_failed") == 0, "success").when(F.col("tables_succeeded") == 0, "failed").otherwise("partial_success")
    )
    return counted.withColumn("status", status)


def summary_tables(summaries: DataFrame) -> DataFrame:
    """One row per table of each summary."""
    return summaries.select("execution_id", "platform", "date", F.inline("tables"))


def nightly_report(summaries: DataFrame) -> DataFrame:
    """Per date the runs by status and the overall state."""
    counted = summaries.groupBy("date").agg(
        F.count(F.lit(1)).alias("total_platforms"),
        F.count_if(F.col("status") == "success").alias("platforms_success"),
        F.count_if(F.col("status") == "failed").alias("platforms_failed"),
        F.count_if(F.col("status") == "partial_success").alias("platforms_partial"),
        F.coalesce(F.sum("total_rows_written"), F.lit(0)).alias("rows_written"),
    )
    overall = F.when(F.col("platforms_failed") > 0, "error").when(F.col("platforms_partial") > 0, "warning").otherwise("success")
    return counted.withColumn("overall", overall)
