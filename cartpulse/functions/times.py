"""Durations and calendar parts of zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS_PER_HOUR = 3_600_000_000.0


def hours_between(start: str, end: str) -> Column:
    """Signed hours from ``start`` to ``end``; NULL if either is NULL."""
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)) / F.lit(_MICROS_PER_HOUR)


def days_between(start: str, end: str) -> Column:
    """Signed days from ``start`` to ``end``; NULL if either is NULL."""
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)) / F.lit(24 * _MICROS_PER_HOUR)


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def as_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
