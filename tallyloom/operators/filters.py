"""Selections F8 and F10-F18."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import years_back_start
from tallyloom.functions.text import BLANKS
from tallyloom.operators.columns import present, ref

# --- Fixed values -----------------------------------------------------------
OPEN_STATUSES = ("ACTIVE", "PAUSED", "DRAFT")
CLOSED_STATUS = "COMPLETED"
VIOLATION_STATUSES = ("DISAPPROVED", "AREA_OF_INTEREST_ONLY")
# ----------------------------------------------------------------------------


def filter_rows(df: DataFrame, condition: str | Column) -> DataFrame:
    """F8."""
    return df.filter(condition)


def eligible_campaigns(
    df: DataFrame,
    as_of: date,
    days: int = 90,
    open_statuses: Sequence[str] = OPEN_STATUSES,
    closed_status: str = CLOSED_STATUS,
    end: str = "end_date",
) -> DataFrame:
    """open campaigns, and closed ones that ended lately or carry no end; distinct id and name."""
    recent = ref(end).isNull() | (ref(end) >= F.lit(as_of - timedelta(days=days)))
    keep = F.col("status").isin(*open_statuses) | ((F.col("status") == closed_status) & recent)
    return df.filter(keep).select("id", "name").distinct()


def recent_ids(df: DataFrame, id_col: str, date_col: str, as_of: date, days: int = 90) -> DataFrame:
    """distinct non-null ids with a date in the window; the bound is a literal, so it prunes."""
    start = F.lit(as_of - timedelta(days=days))
    return df.filter((ref(date_col) >= start) & ref(id_col).isNotNull()).select(ref(id_col).alias("id")).distinct()


def year_window(df: DataFrame, ts: str, as_of: date, years: int) -> DataFrame:
    """``year(ts) >= year(as_of) - years`` written as a range."""
    return df.filter(ref(ts) >= years_back_start(as_of, years))


def lookback(df: DataFrame, ts: str, end: date, days: int) -> DataFrame:
    """Rows of the closed day range ``[end - days, end]``."""
    return df.filter((ref(ts) >= F.lit(end - timedelta(days=days))) & (ref(ts) < F.lit(end + timedelta(days=1))))


def client_accounts(df: DataFrame, enabled_only: bool = True) -> DataFrame:
    """non-manager accounts, by default enabled ones only."""
    keep = ~F.col("manager")
    return df.filter(keep & (F.col("status") == "ENABLED") if enabled_only else keep)


def has_content(col: Column) -> Column:
    """text that is not blank."""
    return F.coalesce(col.rlike(f"[^{BLANKS}]"), F.lit(False))


def policy_violations(df: DataFrame, statuses: Sequence[str] = VIOLATION_STATUSES) -> DataFrame:
    """F16: rows for the alert sink."""
    return df.filter(F.col("approval_status").isin(*statuses))


def tag_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """adds ``reject_reasons``, the names of the broken rules; an unknown outcome breaks the rule."""
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("reject_reasons", F.array_compact(F.array(*broken)))


def check_constraints(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reasons)."""
    tagged = tag_violations(df, rules)
    valid = tagged.filter(F.size("reject_reasons") == 0).drop("reject_reasons")
    return valid, tagged.filter(F.size("reject_reasons") > 0)


def find_id(tables: Mapping[str, DataFrame], columns: Sequence[str], value: str) -> DataFrame:
    """per table the columns searched and the rows that hold the id in any of them.

    One scan per table; each scan gives one partial count per task.
    """
    parts = []
    for name, df in tables.items():
        cols = present(df, columns)
        if not cols:
            continue
        hit = reduce(lambda a, b: a | b, [ref(c).cast("string") == value for c in cols])
        parts.append(
            df.agg(F.count_if(hit).alias("matches")).select(
                F.lit(name).alias("table_name"), F.lit(",".join(cols)).alias("columns_searched"), "matches"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def find_id_rows(df: DataFrame, columns: Sequence[str], value: str, n: int = 5) -> DataFrame:
    """sample rows of one table."""
    hit = reduce(lambda a, b: a | b, [ref(c).cast("string") == value for c in present(df, columns)], F.lit(False))
    return df.filter(hit).limit(n)
