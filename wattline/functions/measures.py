"""Interval arithmetic behind the daily KPIs.

Sums of ``decimal(38,9)`` are exact and do not depend on task order, so values leave
for double only after they are summed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two duration forms that have an interval length in the KPI tables.
_MINUTES = r"^PT([0-9]+)M$"
_HOURS = r"^PT([0-9]+)H$"
MINUTES_PER_DAY = 1440


def interval_minutes(resolution: Column) -> Column:
    """Whole minutes of ``PTnM`` or ``PTnH``; null for every other form and on overflow."""

    def amount(pattern: str) -> Column:
        return F.regexp_extract(resolution, pattern, 1).try_cast("bigint")

    return F.when(resolution.rlike(_MINUTES), amount(_MINUTES)).when(
        resolution.rlike(_HOURS), F.try_multiply(F.lit(60).cast("bigint"), amount(_HOURS))
    )


def rounded_ratio(numerator: Column, denominator: Column) -> Column:
    """Integer quotient rounded half away from zero; null when it cannot be formed."""
    return F.round(F.try_divide(numerator.cast("double"), denominator.cast("double"))).cast(
        "bigint"
    )


def numeric_average(value: Column) -> Column:
    return F.avg(value).cast("decimal(38,9)")


def merged_average(total: Column, count: Column) -> Column:
    """Average from a decimal sum and a count, rounded like ``numeric_average``."""
    return F.try_divide(total, count.cast("decimal(20,0)")).cast("decimal(38,9)")


def interval_hours(minutes: Column) -> Column:
    return minutes.cast("double") / F.lit(60.0)


def energy_mwh(power_sum: Column, minutes: Column) -> Column:
    """Power times hours, for a sum over intervals of one length."""
    return power_sum.cast("double") * minutes / F.lit(60.0)


def earliest_peak(instant: Column, value: Column) -> Column:
    """Aggregate: instant of the largest value, the earliest one on ties."""
    return F.max_by(instant, F.struct(value, -F.unix_micros(instant)))
