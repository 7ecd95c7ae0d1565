"""Projection and schema operators P1-P19."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import numbers


def ref(name: str) -> Column:
    """Column by exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def require(df: DataFrame, names: Sequence[str], what: str = "operator") -> None:
    """Raise when a named column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}; have {df.columns}")


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename what exists.

    Sources that share a target, or collide with a column already named so, are
    coalesced in mapping order, so names stay unique (trap T14).
    """
    sources: dict[str, list[str]] = {}
    for old, new in mapping.items():
        if old in df.columns:
            sources.setdefault(new, []).append(old)
    out: dict[str, Column] = {}
    for name in df.columns:
        target = mapping.get(name, name)
        if target in out:
            continue
        cols = list(sources.get(target, []))
        if target in df.columns and target not in mapping and target not in cols:
            cols.append(target)
        out[target] = (F.coalesce(*map(ref, cols)) if len(cols) > 1 else ref(cols[0])).alias(target)
    return df.select(*out.values())


def shorten_columns(df: DataFrame, keep_prefix: str = "customer", drop: str = "resource") -> DataFrame:
    """Prefix up to the first dot removed (except ``customer`` names), dots to ``_``,
    ``resource`` columns dropped, lower case, the first of equal names kept."""
    chosen: dict[str, str] = {}
    for name in df.columns:
        short = name if keep_prefix in name or "." not in name else name.split(".", 1)[1]
        short = short.replace(".", "_")
        if drop not in short.lower():
            chosen.setdefault(short.lower(), name)
    return df.select(*[ref(old).alias(new) for new, old in chosen.items()])


def map_columns(df: DataFrame, api_to_db: Mapping[str, str]) -> DataFrame:
    """Declared API names to target names; unmapped columns keep their names."""
    return rename_columns(df, api_to_db)


def unmapped_columns(df: DataFrame, api_to_db: Mapping[str, str]) -> list[str]:
    """Names the mapping does not know, resource names aside."""
    return [c for c in df.columns if c not in api_to_db and "resourceName" not in c]


def snake_name(name: str) -> str:
    """``AdGroupId`` to ``ad_group_id``."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Za-z])(?=[A-Z][a-z])", "_", name).lower()


def snake_columns(df: DataFrame) -> DataFrame:
    """P5."""
    return df.select(*[ref(c).alias(snake_name(c)) for c in df.columns])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Existing names only."""
    return df.select(*[ref(c) for c in df.columns if c not in set(cols)])


def with_columns(df: DataFrame, cols: Sequence[str], fn) -> DataFrame:
    """Apply ``fn(Column) -> Column`` to the existing ones of ``cols``."""
    return df.withColumns({c: fn(ref(c)) for c in present(df, cols)})


def _is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def ids_to_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Ids as text, nulls stay null (trap T9).

    Without ``cols`` every column with ``id`` in its name, and nested columns as JSON.
    """
    picked = set(cols) if cols is not None else {c for c in df.columns if "id" in c}
    out = []
    for field in df.schema.fields:
        c = ref(field.name)
        if _is_nested(field.dataType) and (cols is None or field.name in picked):
            c = F.to_json(c)
        elif field.name in picked:
            c = c.cast("string")
        out.append(c.alias(field.name))
    return df.select(*out)


def convert_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P10: nullable integers."""
    return with_columns(df, cols, lambda c: numbers.to_number(c).try_cast("bigint"))


def plain_id(col: Column) -> Column:
    """``123.0`` to ``123``, whole numbers without leading zeros; anything else trimmed text."""
    text = F.trim(col.cast("string"))
    # Other first characters than those from + to 9 are no number's, and need no pattern.
    return F.when((text >= "+") & (text < ":"), F.regexp_replace(text, r"^\+?(-?)0*(\d+)(?:\.0*)?$", "$1$2")).otherwise(text)


def convert_id_types(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns must exist (trap T20)."""
    require(df, cols, "convert_id_types")
    return with_columns(df, cols, plain_id)


def add_load_metadata(df: DataFrame, run_ts: datetime, names: Sequence[str] = ("load_date",)) -> DataFrame:
    """Run clock columns; one clock per run so results repeat."""
    values = {
        "load_date": F.lit(run_ts.date()),
        "row_loaded_date": F.lit(run_ts).cast("timestamp_ntz"),
        "last_updated_date": F.lit(run_ts).cast("timestamp_ntz"),
        "IngestionTimestamp": F.lit(run_ts.isoformat()),
    }
    return df.withColumns({n: values[n] for n in names})


def convert_costs(df: DataFrame, cols: Sequence[str], null_as_zero: bool = False) -> DataFrame:
    """P15."""
    return with_columns(df, cols, lambda c: numbers.micros(c, null_as_zero))


def null_key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key column with its null count, in one pass."""
    require(df, keys, "null_key_report")
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(ref(k).isNull()).alias(f"_{i}") for i, k in enumerate(keys)]
    )
    rows = F.array(*[F.struct(F.lit(k).alias("column_name"), F.col(f"_{i}").alias("nulls")) for i, k in enumerate(keys)])
    return counts.select("n", F.inline(rows))


def null_key_sample(df: DataFrame, keys: Sequence[str], n: int = 3) -> DataFrame:
    """A few rows with a null key, for the report."""
    is_null = F.lit(False)
    for k in keys:
        is_null = is_null | ref(k).isNull()
    return df.filter(is_null).limit(n)


def request_columns(columns: Sequence[str], aggregation: str, time_column: str = "TimePeriod") -> list[str]:
    """The time column leaves a summary request."""
    return [c for c in columns if not (aggregation == "Summary" and c == time_column)]


def _cast_to(col: Column, source: T.DataType, target: T.DataType) -> Column:
    if isinstance(target, (T.StringType, T.CharType, T.VarcharType)):
        return F.to_json(col) if _is_nested(source) else col.cast("string")
    if isinstance(target, T.IntegralType):
        text = isinstance(source, T.StringType)
        return (numbers.to_number(col) if text else col).try_cast(target)
    if isinstance(target, (T.DoubleType, T.FloatType)):
        return numbers.to_number(col).try_cast(target)
    if isinstance(target, T.DateType) and isinstance(source, T.StringType):
        from tallyloom.functions.dates import flexible_day

        return flexible_day(col).cast("date")
    if isinstance(target, (T.TimestampNTZType, T.TimestampType)) and isinstance(source, T.StringType):
        from tallyloom.functions.dates import parse_timestamp

        return parse_timestamp(col).cast(target)
    return col.try_cast(target)


def align_to_schema(
    df: DataFrame,
    target: T.StructType,
    keys: Sequence[str] = (),
    run_date: date | None = None,
    fill_all_null: bool = True,
) -> DataFrame:
    """Target columns in target order and type.

    Missing columns are null (``load_date`` gets the run date), extra ones go.
    Unparseable values are null. Null integers become 0 except in keys
    (trap T17); ``fill_all_null=False`` also leaves a column alone that holds no
    value at all, at the price of one pruned pass over it.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for field in target.fields:
        if field.name not in have:
            lit = F.lit(run_date) if field.name == "load_date" else F.lit(None)
            out.append(lit.cast(field.dataType).alias(field.name))
            continue
        col = _cast_to(ref(field.name), have[field.name], field.dataType)
        if isinstance(field.dataType, T.IntegralType) and field.name not in keys:
            zero = F.lit(0).cast(field.dataType)
            if fill_all_null:
                col = F.coalesce(col, zero)
            else:
                any_value = df.agg(F.bool_or(ref(field.name).isNotNull())).scalar()
                col = F.when(col.isNull() & any_value, zero).otherwise(col)
        out.append(col.alias(field.name))
    return df.select(*out)
