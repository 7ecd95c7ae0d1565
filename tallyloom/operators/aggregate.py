"""Roll-ups and counts A1-A6, A9-A12, A14-A18, O4.

Everything here is a partial-then-final aggregate: a hot key collapses to one
row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.numbers import ratio, to_number
from tallyloom.operators.columns import present, ref, require
from tallyloom.operators.dedupe import deduplicate, top_k

# --- Fixed values -----------------------------------------------------------
ENTITY_IDS = ("creative_id", "ad_id", "adgroup_id", "campaign_id", "account_id", "account", "id")
METADATA = ("row_loaded_date", "last_updated_date", "date", "date_start", "date_stop")
ID_PATTERNS = ("_id", "id_", "account")
SUM_METRICS = ("cost_micros", "clicks", "impressions", "conversions")
CUSTOMER_IDS = ("customer_id", "customer_id_google")
# ----------------------------------------------------------------------------

_AGGS = {
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    "avg": F.avg,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
}


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def entity_columns(df: DataFrame, entity_ids: Sequence[str] = ENTITY_IDS) -> list[str]:
    """Group columns when none are given: the entity ids, else what is neither metric nor metadata."""
    return present(df, entity_ids) or [c for c in df.columns if c not in _numeric(df) and c not in METADATA]


def metric_columns(df: DataFrame, group: Sequence[str]) -> list[str]:
    """Numeric columns that are neither grouped by nor named like an id."""
    return [c for c in _numeric(df) if c not in group and not any(p in c.lower() for p in ID_PATTERNS)]


def entity_rollup(
    df: DataFrame,
    group: Sequence[str] | None = None,
    metrics: Sequence[str] | None = None,
    agg: str | Mapping[str, str] = "sum",
    entity_ids: Sequence[str] = ENTITY_IDS,
    keep_null_keys: bool = False,
    order: Sequence[str] = (),
) -> DataFrame:
    """A1: daily rows to one row per entity.

    Dates and other columns go; rows with a null key are left out unless kept
    (trap T3); text metrics are read as numbers (trap T4); a sum of nothing is 0.
    ``agg`` is one method or one per metric; ``first`` is the first non-null value
    in ``order``, the least one where the order ties.
    """
    keys = list(group) if group else entity_columns(df, entity_ids)
    if not keys:
        raise ValueError("entity_rollup: no group columns")
    require(df, keys, "entity_rollup")
    names = present(df, metrics) if metrics is not None else metric_columns(df, keys)
    if not names:
        return df
    numeric = set(_numeric(df))

    def value(name: str) -> Column:
        return ref(name) if name in numeric else to_number(ref(name))

    method = {n: agg if isinstance(agg, str) else agg.get(n, "sum") for n in names}
    if "first" in method.values() and not order:
        raise ValueError("entity_rollup: first needs an order")

    def total(name: str) -> Column:
        c = value(name)
        if method[name] == "first":
            return F.min_by(c, F.when(c.isNotNull(), F.struct(*map(ref, order), c)))
        return _AGGS[method[name]](c)

    rows = df if keep_null_keys else df.filter(reduce(lambda a, b: a & b, [ref(k).isNotNull() for k in keys]))
    return rows.groupBy(*map(ref, keys)).agg(*[total(n).alias(n) for n in names])


def add_ratios(
    df: DataFrame, cost: str = "cost_micros", clicks: str = "clicks", impressions: str = "impressions", as_percent: bool = True
) -> DataFrame:
    """A2/M4: cost per click, cost per thousand, cost copy and click rate, from sums; 0 without a divisor."""
    have = set(df.columns)
    out: dict[str, Column] = {}
    if {cost, clicks} <= have:
        out["averagecpc"] = ratio(ref(cost), ref(clicks))
    if {cost, impressions} <= have:
        out["averagecpm"] = ratio(ref(cost), ref(impressions), 1000)
    if cost in have:
        out["averagecost"] = ref(cost)
    if {clicks, impressions} <= have:
        out["ctr"] = ratio(ref(clicks), ref(impressions), 100 if as_percent else 1)
    return df.withColumns(out)


def _sum_by_keys(df: DataFrame, group: Sequence[str], order: Sequence[str], metrics: Sequence[str], ids: Sequence[str]) -> DataFrame:
    require(df, group, "aggregate_by_keys")
    one = deduplicate(df, group, order, "first")
    sums = [F.coalesce(F.sum(to_number(ref(c))), F.lit(0.0)).alias(c) for c in present(df, metrics)]
    firsts = [F.first(ref(c), ignorenulls=True).alias(c) for c in present(df, ids) if c not in group]
    return one.groupBy(*map(ref, group)).agg(*sums, *firsts) if sums or firsts else one


def aggregate_by_keys(df: DataFrame, group: Sequence[str] = ("ad_id", "device"), order: Sequence[str] = ()) -> DataFrame:
    """A2: first row per key, summed metrics, first customer, recomputed ratios."""
    return add_ratios(_sum_by_keys(df, group, order, SUM_METRICS, CUSTOMER_IDS))


def aggregate_by_device(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """A3: as A2 for cost and clicks, without ratios."""
    ids = present(df, ("customer_id_google",)) or ("customer_id",)
    return _sum_by_keys(df, ("ad_id", "device"), order, ("cost_micros", "clicks"), ids)


GRAINS = {"day": "day", "week": "week", "month": "month", "summary": None}


def lifetime_rollup(
    df: DataFrame, entity: Sequence[str], date_col: str, metrics: Sequence[str], grain: str = "summary"
) -> DataFrame:
    """Daily source rows to a day, week, month or lifetime grain; ratios belong on top of the sums."""
    keys = list(map(ref, entity))
    if GRAINS[grain]:
        keys.append(F.date_trunc(GRAINS[grain], ref(date_col)).cast("date").alias("period"))
    return df.groupBy(*keys).agg(*[F.coalesce(F.sum(ref(m)), F.lit(0)).alias(m) for m in metrics])


def last_per(df: DataFrame, keys: Sequence[str], ts: str, name: str) -> DataFrame:
    """Greatest value per key."""
    return df.groupBy(*map(ref, keys)).agg(F.max(ref(ts)).alias(name))


def count_of_counts(df: DataFrame, key: str, item: str) -> DataFrame:
    """How many keys have n distinct items."""
    per_key = df.groupBy(ref(key)).agg(F.countDistinct(ref(item)).alias("items"))
    return per_key.groupBy("items").agg(F.count(F.lit(1)).alias("keys"))


def freshness(df: DataFrame, key: str, load: str) -> DataFrame:
    """A10: rows and last load per account."""
    return df.groupBy(ref(key)).agg(F.count(F.lit(1)).alias("rows"), F.max(ref(load)).alias("last_load"))


def rows_per_load_day(df: DataFrame, load: str, n: int = 10) -> DataFrame:
    """A10: row counts of the last ``n`` load days."""
    day = ref(load).cast("date").alias("load_day")
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("load_day")).limit(n)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of several tables."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def ranked_contacts(df: DataFrame, newsletter: str, message: str, contact: str, ts: str, k: int = 10) -> DataFrame:
    """The ``k`` contacts per newsletter that rendered it last; ties by contact, then message."""
    last = df.groupBy(ref(newsletter), ref(message), ref(contact)).agg(F.max(ref(ts)).alias("last_render"))
    order = [F.desc("last_render"), ref(contact).asc_nulls_last(), ref(message).asc_nulls_last()]
    return top_k(last, [newsletter], order, k, rank_col="rn")


def contacts_per_newsletter(ranked: DataFrame, newsletter: str, message: str, contact: str) -> DataFrame:
    """Contacts in rank order, each once, with the first row's message. Input is cut to k rows per group by W2."""
    pairs = F.array_sort(F.collect_list(F.when(ref(contact).isNotNull(), F.struct("rn", ref(contact).alias("c")))))
    return ranked.groupBy(ref(newsletter)).agg(
        F.min_by(ref(message), F.col("rn")).alias("message_id"),
        F.array_distinct(F.transform(pairs, lambda p: p["c"])).alias("contact_ids"),
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Nulls are a value."""
    return df.groupBy(ref(col).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def top_groups(df: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """The largest groups."""
    counted = df.groupBy(*map(ref, keys)).agg(F.count(F.lit(1)).alias("rows"))
    return counted.orderBy(F.desc("rows"), *[ref(k).asc_nulls_last() for k in keys]).limit(n)


def success_rate(success: Column, total: Column) -> Column:
    """Percentage, 0 without any."""
    return ratio(success, total, 100)


def net_follower_change(organic: Column, paid: Column) -> Column:
    """A17."""
    return F.coalesce(organic, F.lit(0)) + F.coalesce(paid, F.lit(0))


def partition_rows(df: DataFrame, partition_col: str, value: str) -> DataFrame:
    """Rows of one partition; the filter prunes directories."""
    return df.filter(ref(partition_col) == value).agg(F.count(F.lit(1)).alias("rows"))


def sort_by(df: DataFrame, cols: Sequence[str], ascending: bool | Sequence[bool] = True) -> DataFrame:
    """O1/O2: existing columns only."""
    flags = [ascending] * len(cols) if isinstance(ascending, bool) else list(ascending)
    order = [ref(c).asc_nulls_last() if up else ref(c).desc_nulls_last() for c, up in zip(cols, flags) if c in df.columns]
    return df.orderBy(*order) if order else df


def grain_rollups(df: DataFrame, entity: Sequence[str], date_col: str, metrics: Sequence[str], grains: Sequence[str]) -> DataFrame:
    """A4 for several grains in one scan: days first, then each day counts once per grain."""
    days = lifetime_rollup(df, entity, date_col, metrics, "day")
    periods = [
        F.struct(
            F.lit(g).alias("grain"),
            (F.date_trunc(GRAINS[g], F.col("period")).cast("date") if GRAINS[g] else F.lit(None).cast("date")).alias("period"),
        )
        for g in grains
    ]
    spread = days.select(*map(ref, entity), *map(ref, metrics), F.inline(F.array(*periods)))
    return spread.groupBy(*map(ref, entity), "grain", "period").agg(*[F.sum(ref(m)).alias(m) for m in metrics])
