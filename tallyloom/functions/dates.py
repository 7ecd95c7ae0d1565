"""Date and time functions D1-D9.

All results are wall-clock ``timestamp_ntz`` or ``date`` and do not depend on
the session time zone. Bad input gives null.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _since_epoch(unit: str, amount: Column) -> Column:
    return F.timestamp_add(unit, amount, F.expr(_EPOCH))


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Parts may be text or floats like ``2026.0`` (trap T27)."""
    parts = [p.try_cast("double").cast("int").cast("string") for p in (year, month, day)]
    whole = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull()
    return F.when(whole, F.concat_ws("-", *parts).try_cast("date"))


def millis_to_ts(col: Column) -> Column:
    """Unix milliseconds to UTC."""
    return _since_epoch("MILLISECOND", col.try_cast("bigint"))


def seconds_to_ts(col: Column) -> Column:
    """D3: Unix seconds to UTC."""
    return _since_epoch("SECOND", col.try_cast("bigint"))


_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:?\d{2})$"
_DAY = r"^\d{4}-\d{1,2}-\d{1,2}$"


def iso_to_utc(col: Column) -> Column:
    """ISO text with an offset to UTC wall clock."""
    local = F.substring(col, 1, 19).try_cast("timestamp_ntz")
    sign = F.when(F.substring(col, 20, 1) == "-", -1).otherwise(1)
    digits = F.replace(F.substring(col, 21, 6), F.lit(":"), F.lit(""))
    # ``Z`` has no digits: asked first, as a failing cast costs an exception per row.
    numeric = F.length(digits) == 4
    hours = F.when(numeric, F.substring(digits, 1, 2).try_cast("int")).otherwise(0)
    minutes = F.when(numeric, F.substring(digits, 3, 2).try_cast("int")).otherwise(0)
    shifted = F.timestamp_add("MINUTE", -sign * (hours * 60 + minutes), local)
    return F.when(col.rlike(_ISO), shifted)


def iso_to_zone(col: Column, zone: str = "Europe/Rome") -> Column:
    """ISO text with offset to the wall clock of ``zone``; plain dates are UTC midnight (trap T18)."""
    utc = F.coalesce(iso_to_utc(col), F.when(col.rlike(_DAY), col.try_cast("timestamp_ntz")))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def day_from_text(col: Column) -> Column:
    """``yyyy-MM-dd`` or null."""
    return F.when(col.rlike(_DAY), col.try_cast("date"))


def _compact(col: Column) -> Column:
    return F.concat_ws("-", F.substring(col, 1, 4), F.substring(col, 5, 2), F.substring(col, 7, 2))


def flexible_day(col: Column) -> Column:
    """``yyyyMMdd``, ``yyyy-MM-dd``, else any ISO date-time, row by row (trap T11)."""
    text = col.cast("string")
    return F.coalesce(
        F.when(text.rlike(r"^\d{8}$"), _compact(text).try_cast("timestamp_ntz")),
        F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("timestamp_ntz")),
    )


def parse_timestamp(col: Column) -> Column:
    """ISO date-time text, bad text to null."""
    text = col.cast("string")
    return F.coalesce(iso_to_utc(text), F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("timestamp_ntz")))


def to_timestamp_any(col: Column) -> Column:
    """D3/D7 by shape: digits are epoch seconds, anything else ISO text (trap T19)."""
    text = col.cast("string")
    return F.when(text.rlike(r"^\d+$"), seconds_to_ts(text)).otherwise(parse_timestamp(text))


def years_back_start(as_of: date, years: int) -> Column:
    """First day of the year ``years`` before ``as_of``; a literal, so it prunes."""
    return F.lit(date(as_of.year - years, 1, 1))


def days_back(as_of: date, days: int) -> Column:
    """D8."""
    return F.date_sub(F.lit(as_of), days)


def range_day(start_millis: Column, run_date: date) -> Column:
    """Day of a range start, else the run date."""
    return F.coalesce(millis_to_ts(start_millis).cast("date"), F.lit(run_date))
