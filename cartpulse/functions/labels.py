"""Bucket ladders and labels.

All texts, limits and orders in this file are fixed values: they are part of the
query results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "missing"

# (upper limit, label); the last label has no limit
DELAY_LADDER = (
    (-7, "7+ hari lebih cepat"),
    (-1, "1-7 hari lebih cepat"),
    (0, "Tepat waktu"),
    (7, "1-7 hari terlambat"),
    (14, "8-14 hari terlambat"),
    (None, "14+ hari terlambat"),
)
DELAY_UNKNOWN = "N/A"

SHIPPING_LADDER = (
    (3, "0-3 hari"),
    (7, "4-7 hari"),
    (14, "8-14 hari"),
    (21, "15-21 hari"),
    (None, "22+ hari"),
)
SHIPPING_UNKNOWN = "Belum Terkirim"

APPROVAL_LADDER = (
    (1, "< 1 jam"),
    (6, "1-6 jam"),
    (24, "6-24 jam"),
    (48, "1-2 hari"),
    (None, "2+ hari"),
)

WEEKDAYS = ("Senin", "Selasa", "Rabu", "Kamis", "Jumat", "Sabtu", "Minggu")

LATE, ON_TIME = "Terlambat", "Tepat Waktu"
WITH_COMMENT, WITHOUT_COMMENT = "Dengan Komentar", "Tanpa Komentar"
TOP, BOTTOM = "Top Performer", "Bottom Performer"
SAME_STATE, OTHER_STATE = "Same State", "Different State"

LOYALTY_TIERS = ("Gold", "Silver", "Bronze")
CHURN_RISKS = ("High", "Medium", "Low")

# (lower limit that must be exceeded, label)
NULL_IMPACT = (
    (10, "⚠️ High Impact"),
    (5, "⚡ Medium Impact"),
    (0, "✅ Low Impact"),
    (None, "✅ Complete"),
)
ROI_LEVELS = ((10000, "High ROI"), (5000, "Medium ROI"), (None, "Low ROI"))
# (lower limit that may be equalled, label)
DRIVER_LEVELS = (
    (50, "Critical Driver"),
    (20, "Major Driver"),
    (10, "Moderate Driver"),
    (None, "Minor Driver"),
)
FACTOR_GROUPS = ("0 factors (baseline)", "1 factor", "2 factors", "3 factors (worst)")

HIGH_FREIGHT = 30.0
SLOW_APPROVAL_HOURS = 24.0
HEAVY_GRAMS = 5000.0


def _first_match(tests: Sequence[tuple[Column, str]], default: str) -> Column:
    condition, label = tests[0]
    picked = F.when(condition, F.lit(label))
    for condition, label in tests[1:]:
        picked = picked.when(condition, F.lit(label))
    return picked.otherwise(F.lit(default))


def at_most(value: Column, ladder: Sequence[tuple], unknown: str | None = None) -> Column:
    """Label of the first ladder step whose limit is not exceeded."""
    tests = [(value <= F.lit(limit), label) for limit, label in ladder[:-1]]
    if unknown is not None:
        tests.insert(0, (value.isNull(), unknown))
    return _first_match(tests, ladder[-1][1])


def above(value: Column, ladder: Sequence[tuple]) -> Column:
    return _first_match([(value > F.lit(limit), label) for limit, label in ladder[:-1]], ladder[-1][1])


def from_(value: Column, ladder: Sequence[tuple]) -> Column:
    return _first_match([(value >= F.lit(limit), label) for limit, label in ladder[:-1]], ladder[-1][1])


def rank_of(value: Column, order: Sequence[str]) -> Column:
    """Position of a label in a stated order, for sorting."""
    return F.array_position(F.array(*[F.lit(label) for label in order]), value)


def yes_no(condition: Column) -> Column:
    return F.when(condition, F.lit("Yes")).otherwise(F.lit("No"))


def negative(score: Column) -> Column:
    return score <= 2


def positive(score: Column) -> Column:
    return score >= 4


def review_bucket(score: Column) -> Column:
    return (
        F.when(negative(score), F.lit("negative"))
        .when(positive(score), F.lit("positive"))
        .otherwise(F.lit("neutral"))
    )
