"""Landing records and their unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.operators.columns import ref
from tallyloom.operators.dedupe import deduplicate
from tallyloom.schemas import LANDING


def read_records(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """JSON records of any number of accounts in one read; ``schema`` may name a landing table."""
    if isinstance(schema, str):
        schema = LANDING[schema]
    return spark.read.schema(schema).json(path if isinstance(path, str) else list(path))


def union_wide(*frames: DataFrame) -> DataFrame:
    """Concatenate; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_splits(df: DataFrame, predicates: Sequence[Column | str], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Several predicate reads of one source; a row that meets several counts once.

    One scan with the predicates or-ed, then one row per key.
    """
    from pyspark.sql import functions as F

    conds = [F.expr(p) if isinstance(p, str) else p for p in predicates]
    return deduplicate(df.filter(reduce(lambda a, b: a | b, conds)), keys, order, "first")


def account_match(df: DataFrame, accounts: Sequence[str], col: str = "id") -> DataFrame:
    """Records of the wanted accounts, by id or URN tail."""
    from tallyloom.functions.text import urn_tail

    return df.filter(urn_tail(ref(col).cast("string")).isin(*accounts))


def account_join(df: DataFrame, accounts: DataFrame, col: str = "id", account: str = "account") -> DataFrame:
    """S19 for a table of wanted accounts: each side may hold ids or URNs, and both are brought to the tail, so one equi-join decides."""
    from pyspark.sql import functions as F

    from tallyloom.functions.text import urn_tail

    tail = lambda c: F.nullif(urn_tail(ref(c).cast("string")), F.lit(""))
    wanted = accounts.select(tail(account).alias("__tail")).distinct()
    return df.withColumn("__tail", tail(col)).join(wanted, "__tail", "left_semi").drop("__tail")
