"""Joins that keep a hot key of the large side in many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.columns import ref
from tallyloom.session import staged

SALTS = 8


def row_salt(df: DataFrame, salts: int) -> Column:
    """A number from the whole row: the same again when a task is repeated, other than a random one."""
    return F.pmod(F.xxhash64(*map(ref, df.columns)), F.lit(salts)).cast("int")


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join where a key may hold much of the left side and the right side is aggregated or joined on it.

    AQE splits a hot partition by its measured size, but only between bare
    shuffles, which such a right side is not. So the right is staged first; no row
    of either side is copied but those of hot partitions, and a small right broadcasts.
    """
    return left.join(staged(right, "spread"), list(keys), how)
