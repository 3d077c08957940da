"""Rounding, ratios and money sums that give the same bits on every partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(24,4)"


def round_half_even(value: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def round_half_up(value: Column, digits: int) -> Column:
    """For non-negative values."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5).cast("double") / scale


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, null for a zero or missing whole."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def share(part: Column, whole: Column) -> Column:
    """part / whole * 100."""
    return ratio(part, whole) * 100.0


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return round_half_even(share(part, whole), digits)


def money_sum(value: Column) -> Column:
    """Exact sum: doubles are summed as decimals, so the order of rows cannot matter."""
    return F.coalesce(F.sum(value.cast(MONEY)), F.lit(0).cast("decimal(34,4)")).cast("double")


def n_rows() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, free of time zones for timestamp_ntz columns."""
    return (end - start).cast("interval second").cast("bigint")


def whole_days_between(start: Column, end: Column) -> Column:
    """Completed 24-hour periods, not calendar days."""
    return F.floor(seconds_between(start, end) / F.lit(86400)).cast("bigint")
