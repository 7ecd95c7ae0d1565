"""Number functions M1-M5 and the guarded ratios of the aggregations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(col: Column) -> Column:
    """M5: numeric or null; text ``NaN`` counts as missing."""
    return F.nullif(col.try_cast("double"), F.lit(float("nan")))


def percent_to_fraction(col: Column) -> Column:
    """M1: ``"12.3%"`` to 0.123."""
    return to_number(F.rtrim(F.trim(col.cast("string")), F.lit("%"))) / 100


def safe_int(col: Column, default: int = 0) -> Column:
    """M2: through float, truncated; bad text gives the default."""
    return F.coalesce(to_number(col).try_cast("bigint"), F.lit(default).cast("bigint"))


def safe_decimal(col: Column, default: Column | None = None) -> Column:
    """M3: two places, half-even; ``NaN`` and bad text give the default."""
    text = col.cast("string")
    value = F.bround(F.when(F.lower(text) != "nan", text).try_cast("decimal(38,10)"), 2).try_cast("decimal(18,2)")
    return value if default is None else F.coalesce(value, default.cast("decimal(18,2)"))


def ratio(num: Column, den: Column, scale: float = 1.0) -> Column:
    """M4: ``num / den * scale``; 0 when the divisor is not positive."""
    value = num.cast("double") / F.when(den > 0, den.cast("double"))
    return F.coalesce(value * F.lit(float(scale)), F.lit(0.0))


def micros(col: Column, null_as_zero: bool = False) -> Column:
    """Millionths to units. ``null_as_zero`` truncates to whole millionths, null to 0 (trap T30)."""
    if null_as_zero:
        return F.coalesce(to_number(col).try_cast("bigint"), F.lit(0)) / F.lit(1_000_000.0)
    return to_number(col) / F.lit(1_000_000.0)


def acceptance_rate(given: Column, delivered: Column, sent: Column) -> Column:
    """The given rate, else delivered / sent as a percentage; null when nothing was sent."""
    share = F.when(sent > 0, delivered.cast("double") / sent.cast("double") * 100)
    return F.coalesce(safe_decimal(given), safe_decimal(share))
