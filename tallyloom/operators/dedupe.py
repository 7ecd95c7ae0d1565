"""Deduplication, top-k and numbering W1-W7.

Every "first" and "last" takes an order column; remaining columns break ties.
``row_number() <= k`` lets Spark cut each group to k rows inside every map task
before the shuffle, so a key that holds a third of the table sends k rows per
task, not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.columns import ref, require
from tallyloom.operators.skew import spread_join

_RN = "__rn"


def _tie_columns(df: DataFrame, used: Sequence[str]) -> list[str]:
    def sortable(t: T.DataType) -> bool:
        return not isinstance(t, (T.MapType, T.VariantType))

    return sorted(f.name for f in df.schema.fields if f.name not in used and sortable(f.dataType))


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank_col: str | None = None) -> DataFrame:
    """First ``k`` rows per group in the given total order."""
    win = Window.partitionBy(*map(ref, keys)).orderBy(*order)
    ranked = df.withColumn(rank_col or _RN, F.row_number().over(win)).filter(F.col(rank_col or _RN) <= k)
    return ranked if rank_col else ranked.drop(_RN)


def deduplicate(
    df: DataFrame, keys: Sequence[str] | None = None, order: Sequence[str] = (), keep: str | bool = "first"
) -> DataFrame:
    """One row per key.

    ``keep='first'|'last'`` in ``order`` (ties: all other columns), ``keep=False``
    drops every key that repeats. Without keys whole rows are compared.
    """
    if not keys:
        if keep is False:
            return _unrepeated(df, df.columns)
        return df.dropDuplicates()
    require(df, keys, "deduplicate")
    if keep is False:
        return _unrepeated(df, keys)
    names = [*order, *_tie_columns(df, [*keys, *order])]
    if keep == "first":
        sort = [ref(c).asc_nulls_last() for c in names]
    elif keep == "last":
        sort = [ref(c).desc_nulls_first() for c in names]
    else:
        raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")
    return top_k(df, keys, sort or [F.lit(1)], 1)


def _unrepeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once. A group-by, so repeats collapse before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    aggs = [F.count(F.lit(1)).alias(_RN)]
    if rest:
        aggs.append(F.any_value(F.struct(*[ref(c).alias(c) for c in rest])).alias("__rest"))
    single = df.groupBy(*map(ref, keys)).agg(*aggs).filter(F.col(_RN) == 1)
    return single.select(*[(ref(c) if c in keys else F.col("__rest").getField(c)).alias(c) for c in df.columns])


def limit_placements(
    df: DataFrame, k: int = 25, group: str = "id", metric: str = "impressions", ties: Sequence[str] = ("placement",)
) -> DataFrame:
    """Top ``k`` placements by impressions per ad group."""
    order = [ref(metric).try_cast("bigint").desc_nulls_last(), *[ref(t).asc_nulls_last() for t in ties]]
    return top_k(df, [group], order, k)


def keep_highest_level(df: DataFrame, id_col: str, level: str = "level") -> DataFrame:
    """One row per id with the highest level, compared as a number (trap T10)."""
    ties = [ref(c).asc_nulls_last() for c in _tie_columns(df, [id_col, level])]
    return top_k(df, [id_col], [ref(level).try_cast("bigint").desc_nulls_last(), *ties], 1)


def latest_load(df: DataFrame, load: str, per: Sequence[str] = ()) -> DataFrame:
    """Rows of the last load, overall or per source.

    The maximum is aggregated first, staged and joined back. A big source may hold
    most rows in its last load; its partition is split by size.
    """
    if not per:
        newest = df.agg(F.max(ref(load))).scalar()
        return df.filter(ref(load) == newest)
    newest = df.groupBy(*map(ref, per)).agg(F.max(ref(load)).alias(load))
    return spread_join(df, newest, [*per, load], "left_semi")


def number_in_order(
    df: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[Column], name: str, per_key: DataFrame | None = None
) -> DataFrame:
    """Consecutive numbers per key without one task per key.

    ``chunk`` must grow with ``order`` (a day of a timestamp, a bucket of a
    sequence). Rows are numbered inside (key, chunk); the chunk sizes of a key
    are summed up in front of it. A hot key is thus split by chunk, and rows
    shuffle once, on (key, chunk). Columns of ``per_key`` (one row per key) ride
    along with the chunk sizes; null where the key is missing there.
    """
    chunked = df.withColumn("__chunk", chunk)
    sizes = chunked.groupBy(*map(ref, keys), "__chunk").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*map(ref, keys)).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    if per_key is not None:
        offsets = offsets.join(per_key, list(keys), "left")
    local = Window.partitionBy(*map(ref, keys), "__chunk").orderBy(*order)
    numbered = chunked.withColumn(_RN, F.row_number().over(local)).join(offsets, [*keys, "__chunk"])
    return numbered.withColumn(name, F.col(_RN) + F.col("__off")).drop(_RN, "__off", "__chunk")


def next_number(existing: DataFrame, keys: Sequence[str], file_name: str) -> DataFrame:
    """Per key the next free trailing number: highest ``_n`` plus 1, else 1."""
    stem = F.regexp_replace(ref(file_name), r"\.[^.]*$", "")
    tail = F.nullif(F.regexp_extract(stem, r"_([0-9]+(?:\.[0-9]+)?)$", 1), F.lit(""))
    number = tail.try_cast("double").cast("bigint")
    return existing.groupBy(*map(ref, keys)).agg((F.coalesce(F.max(number), F.lit(0)) + 1).alias("next_number"))


def name_incoming(
    incoming: DataFrame, existing: DataFrame, campaign: str, activity: str, file_name: str, extension: str, chunk: Column, order: Sequence[Column]
) -> DataFrame:
    """W7 for a batch: the first file of an unknown activity is ``code.ext``, all others
    ``code_n.ext`` with n counting on from the stored ones, in arrival order."""
    keys = [campaign, activity]
    counters = next_number(existing, keys, file_name)
    joined = number_in_order(incoming, keys, chunk, order, "__k", counters)
    known = F.col("next_number").isNotNull()
    n = F.when(known, F.col("next_number") + F.col("__k") - 1).otherwise(F.col("__k") - 1)
    stem = F.when(n == 0, ref(activity)).otherwise(F.concat(ref(activity), F.lit("_"), n.cast("string")))
    return joined.withColumn("target_name", F.concat(stem, F.lit("."), ref(extension))).drop("next_number", "__k")
