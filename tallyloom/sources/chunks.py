"""Date ranges S9."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def chunk_ranges(start: Column, end: Column, days: int) -> Column:
    """Array of (since, until): contiguous closed ranges up to and with the end day (trap T13); null when end is before start."""
    starts = F.sequence(start, F.greatest(start, end), F.expr(f"interval {int(days)} days"))
    ranges = F.transform(
        starts, lambda s: F.struct(s.alias("since"), F.least(F.date_add(s, days - 1), end).alias("until"))
    )
    return F.when(start <= end, ranges)


def date_chunks(spark: SparkSession, start: date, end: date, days: int) -> DataFrame:
    """S9 for two given days; an empty span gives no rows."""
    span = spark.range(1).select(F.lit(start).alias("s"), F.lit(end).alias("e"))
    return span.select(F.inline(chunk_ranges(F.col("s"), F.col("e"), days)))
