"""Null and placeholder handling F1-F7 and F9."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.columns import present, ref, with_columns

# Text that stands for a missing value.
NULL_WORDS = ("nan", "NaT", "None")


def drop_null_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """rows with a null in any of ``cols`` (default: any column)."""
    names = df.columns if cols is None else present(df, cols)
    return df.filter(reduce(lambda a, b: a & b, [ref(c).isNotNull() for c in names], F.lit(True)))


def drop_all_null_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """rows where every one of the metric columns is null."""
    names = present(df, cols)
    if not names:
        return df
    return df.filter(reduce(lambda a, b: a | b, [ref(c).isNotNull() for c in names]))


def drop_footer_rows(df: DataFrame, patterns: Sequence[str], column: str | None = None) -> DataFrame:
    """rows whose first column holds one of the patterns, in any case."""
    text = F.lower(F.coalesce(ref(column or df.columns[0]).cast("string"), F.lit("")))
    return df.filter(~reduce(lambda a, b: a | b, [text.contains(p.lower()) for p in patterns], F.lit(False)))


def _fractional(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN to null; only floating columns can hold it."""
    names = _fractional(df) & set(df.columns if cols is None else cols)
    return with_columns(df, [c for c in df.columns if c in names], lambda c: F.when(~F.isnan(c), c))


def fill_missing(df: DataFrame, cols: Sequence[str] | None = None, value: float = 0) -> DataFrame:
    """null and NaN to ``value`` (default: in all numeric columns)."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    names = numeric if cols is None else present(df, cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    floats = _fractional(df)
    out = {}
    for n in names:
        c = F.when(~F.isnan(ref(n)), ref(n)) if n in floats else ref(n)
        out[n] = F.coalesce(c, F.lit(value).cast(types[n]))
    return df.withColumns(out)


def null_words_to_null(df: DataFrame, cols: Sequence[str] | None = None, words: Sequence[str] = NULL_WORDS) -> DataFrame:
    """placeholder text to null; no row is removed."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    names = [c for c in texts if cols is None or c in cols]
    return with_columns(df, names, lambda c: F.when(~c.isin(*words), c))
