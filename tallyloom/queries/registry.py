"""Query registry and the helpers queries share."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# One clock for all queries, inside the span of the tables.
AS_OF = date(2001, 6, 30)
RUN_TS = datetime(2024, 2, 1, 3, 30)


def query(oracle: str | None = None):
    """Register a query function under its own name."""

    def keep(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return keep


def tab(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(col: Column) -> Column:
    """Exact sums need decimals."""
    return col.cast("decimal(18,2)")


def r4(col: Column) -> Column:
    """Four places, the same way in every engine."""
    return F.floor(col * 10000 + 0.5) / 10000


def day_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")
