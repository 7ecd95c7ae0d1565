"""Keyed loads as one DataFrame plan per mode (K2-K6, K11) with exact counters.

Each function returns the whole target as it should be after the load. The
target is the streamed side of its join, so a batch below Spark's broadcast
threshold never shuffles it; a large batch becomes a sort-merge join, and keys
are unique on both sides by then, so no key can be hot.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.columns import ref, require
from tallyloom.operators.dedupe import deduplicate
from tallyloom.operators.lookup import anti_existing, key_side, same_key
from tallyloom.operators.nulls import drop_null_rows
from tallyloom.operators.skew import spread_join
from tallyloom.sinks.spec import LOAD_DATES, LoadSpec


def key_columns(df: DataFrame, spec: LoadSpec) -> list[str]:
    """The spec's key, or all columns but the load dates."""
    return list(spec.keys) or [c for c in df.columns if c.lower() not in LOAD_DATES]


def prepare_batch(batch: DataFrame, spec: LoadSpec) -> DataFrame:
    """F9 then W5: rows without a key go first (trap T16), then one row per key."""
    keys = key_columns(batch, spec)
    require(batch, keys, spec.table)
    rows = drop_null_rows(batch, keys) if spec.keys else batch
    return deduplicate(rows, keys, spec.order, spec.keep)


def key_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that hold more than one row; empty when the key is sound."""
    return df.groupBy(*map(ref, keys)).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def _new_side(new: DataFrame) -> DataFrame:
    return new.select(*[ref(c).alias(f"__n_{c}") for c in new.columns])


def _match(keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & (ref(k) == ref(f"__n_{k}"))
    return cond


def append_rows(new: DataFrame, target: DataFrame, spec: LoadSpec) -> DataFrame:
    """K2: only the rows to add."""
    return anti_existing(new, target, key_columns(new, spec), spec.date_key, unique=bool(spec.keys))


def _scope_filter(target: DataFrame, spec: LoadSpec) -> Column:
    """K4: the first scope column with values; never a wider delete than asked for (trap T29)."""
    for name, values in spec.scope.items():
        usable = [v for v in values if v is not None]
        if name in target.columns and usable:
            return ref(name).isin(usable)
    raise ValueError(f"{spec.table}: no usable scope in {dict(spec.scope)}")


def _updates(target: DataFrame, new: DataFrame, spec: LoadSpec) -> dict[str, Column]:
    """K5, K6: what a known row takes from the batch, by column."""
    if spec.mode == "upsert":
        return {c: ref(f"__n_{c}") for c in (target.columns if spec.update is None else spec.update)}
    sums = {
        # Cast: a sum of decimals is a wider type than the target's.
        c: (F.coalesce(ref(c), F.lit(0)) + F.coalesce(ref(f"__n_{c}"), F.lit(0))).cast(target.schema[c].dataType)
        for c in spec.increment
    }
    return sums | {c: ref(f"__n_{c}") for c in target.columns if c.lower() in LOAD_DATES}


def changed_rows(new: DataFrame, target: DataFrame, spec: LoadSpec) -> DataFrame:
    """K5, K6: the target's rows after a prepared batch, with ``__change`` where the batch knows them.

    One pass over the target. The batch is the side Spark may broadcast, so a small one leaves the target
    where it is. Rows that are new are those of the batch whose key has no changed row.
    """
    keys, updates = key_columns(new, spec), _updates(target, new, spec)
    hit = ref(f"__n_{keys[0]}").isNotNull()
    joined = target.join(_new_side(new), _match(keys), "left")
    return joined.select(
        *[(F.when(hit, updates[c]).otherwise(ref(c)) if c in updates else ref(c)).alias(c) for c in target.columns], hit.alias("__change")
    )


def fresh_rows(new: DataFrame, known: DataFrame, spec: LoadSpec) -> DataFrame:
    """Rows of the batch whose key is not among the known ones."""
    keys = key_columns(new, spec)
    return new.join(key_side(known, keys, unique=True), same_key(keys, null_safe=False), "left_anti")


def merge_rows(new: DataFrame, target: DataFrame, spec: LoadSpec) -> DataFrame:
    """Target after loading a prepared batch."""
    require(new, target.columns, spec.table)
    new = new.select(*map(ref, target.columns))
    keys = key_columns(new, spec)
    if spec.mode == "append":
        return target.unionByName(append_rows(new, target, spec))
    if spec.mode == "replace":
        if not spec.scope:
            return new
        outside = ~F.coalesce(_scope_filter(target, spec), F.lit(False))
        return target.filter(outside).unionByName(new)
    if spec.mode == "upsert" and spec.update is None:
        kept = target.join(_new_side(new.select(*map(ref, keys))), _match(keys), "left_anti")
        return kept.unionByName(new)
    return changed_rows(new, target, spec).drop("__change").unionByName(fresh_rows(new, target, spec))


def merge_into(new: DataFrame, table: str, spec: LoadSpec) -> None:
    """K5 on a catalog table whose format takes row-level changes: one MERGE, only touched files are rewritten."""
    keys = key_columns(new, spec)
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"{table}.{k}") == F.col(f"batch.{k}"))
    changed = {c: F.col(f"batch.{c}") for c in (spec.update or [c for c in new.columns if c not in keys])}
    merge = prepare_batch(new, spec).alias("batch").mergeInto(table, cond)
    merge.whenMatched().update(changed).whenNotMatched().insertAll().merge()


def load_counts(batch: DataFrame, target: DataFrame, spec: LoadSpec, by: str | None = None) -> DataFrame:
    """The five counters and ``rows_written`` as one row, or one row for each value of ``by``, a column of the batch.

    Keys are counted before they meet the target, so the join sees each key
    once and ``inserted + updated + skipped + filtered = rows_from_api``.
    """
    keys = key_columns(batch, spec)
    group = [by] if by else []
    sizes = batch.groupBy(*map(ref, [*keys, *[c for c in group if c not in keys]])).agg(F.count(F.lit(1)).alias("__rows"))
    full = F.lit(True)
    if spec.keys:
        for k in keys:
            full = full & ref(k).isNotNull()
    if spec.mode == "replace":
        marked = sizes.withColumn("__old", F.lit(False))
    else:
        old = key_side(target, keys, unique=bool(spec.keys)).withColumn("__hit", F.lit(True))
        marked = sizes.join(old, same_key(keys), "left").withColumn("__old", F.col("__hit").isNotNull())
    total = F.coalesce(F.sum("__rows"), F.lit(0))
    usable, known = F.count_if(full), F.count_if(full & F.col("__old"))
    zero = F.lit(0).cast("bigint")
    counts = marked.groupBy(*map(ref, group)).agg(total.alias("rows_from_api"), usable.alias("__usable"), known.alias("__known"))
    updated = zero if spec.mode in ("append", "replace") else F.col("__known")
    skipped = F.col("__known") if spec.mode == "append" else zero
    inserted = F.col("__usable") - F.col("__known")
    return counts.select(
        *map(ref, group),
        "rows_from_api",
        inserted.alias("rows_inserted"),
        updated.alias("rows_updated"),
        skipped.alias("rows_skipped"),
        (F.col("rows_from_api") - F.col("__usable")).alias("rows_filtered"),
        (inserted + updated).alias("rows_written"),
    )


def sound_tenants(batch: DataFrame, tenant: str, sound: Column) -> tuple[DataFrame, DataFrame]:
    """The rows of tenants all of whose rows are sound, and (tenant, rows, failed_rows) of the others, which load nothing.

    All tenants are one plan: a bad one is left out by a join, not by a loop of runs. Rows of no
    tenant fail together.
    """
    named = batch.withColumn("__tenant", F.coalesce(ref(tenant).cast("string"), F.lit("")))
    bad = ~F.coalesce(sound & ref(tenant).isNotNull(), F.lit(False))
    failed = named.groupBy("__tenant").agg(F.max(ref(tenant)).alias(tenant), F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("failed_rows")).filter("failed_rows > 0")
    kept = spread_join(named, failed.select("__tenant"), ["__tenant"], "left_anti").drop("__tenant")
    return kept, failed.drop("__tenant")


def replace_tenants(new: DataFrame, target: DataFrame, tenant: str) -> DataFrame:
    """A replace whose scope is the tenants in the batch; others keep their rows, and so do tenants that failed."""
    scope = new.select(ref(tenant)).distinct()
    return spread_join(target, scope, [tenant], "left_anti").unionByName(new.select(*map(ref, target.columns)))


def tenant_counts(batch: DataFrame, target: DataFrame, spec: LoadSpec, tenant: str, sound: Column) -> DataFrame:
    """Load counters of every tenant with its status; those of a failed tenant are zero but for the rows it sent and the bad ones."""
    kept, failed = sound_tenants(batch, tenant, sound)
    good = load_counts(kept, target, spec, tenant).withColumns({"failed_rows": F.lit(0).cast("bigint"), "status": F.lit("success")})
    zero = F.lit(0).cast("bigint")
    bad = failed.select(*[{"rows_from_api": ref("rows"), "failed_rows": ref("failed_rows"), "status": F.lit("failed"), tenant: ref(tenant)}.get(c, zero).alias(c) for c in good.columns])
    return good.unionByName(bad)


def apply_retention(df: DataFrame, column: str, as_of: date, days: int) -> DataFrame:
    """Rows of the last ``days`` days; a null date stays, as a delete by date would leave it."""
    return df.filter(ref(column).isNull() | (ref(column) >= F.lit(as_of - timedelta(days=days))))
