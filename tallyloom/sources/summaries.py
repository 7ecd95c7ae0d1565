"""Run summaries as JSON lines under ``platform=/date=`` folders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.schemas import SUMMARY


def write_summaries(summaries: DataFrame, root: str) -> None:
    """Append; every run adds files of its own, so runs never collide."""
    day = F.to_date(F.substring("start_time", 1, 10)).alias("date")
    summaries.select("*", day).write.mode("append").partitionBy("platform", "date").json(root)


def read_summaries(spark: SparkSession, root: str, day: date | None = None, platforms: list[str] | None = None) -> DataFrame:
    """All platforms found under the root; day and platform filters prune folders (trap T24)."""
    df = spark.read.schema(T.StructType([*SUMMARY.fields, T.StructField("date", T.DateType())])).json(root)
    if day is not None:
        df = df.filter(F.col("date") == F.lit(day))
    if platforms is not None:
        df = df.filter(F.col("platform").isin(*platforms))
    return df
