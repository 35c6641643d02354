"""Data-quality checks.

A check describes violations: some functions list the offending rows or groups of one check,
and ``count_checks`` counts all checks of one table in a single pass over it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RowCheck:
    """Rows for which ``predicate`` is true are violations."""

    name: str
    predicate: Column


def not_null_checks(columns: Sequence[str]) -> list[RowCheck]:
    return [RowCheck(f"not_null:{c}", F.col(c).isNull()) for c in columns]


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, null_count)`` per column, in one scan."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"))
                    for c in columns
                ]
            )
        )
    )


def duplicated_keys(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Groups of ``grain`` with more than one row."""
    return df.groupBy(*grain).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def unequal_duplicates(
    df: DataFrame, keys: Sequence[str], payload: Sequence[str]
) -> DataFrame:
    """Groups whose rows repeat a key with different payloads.

    The payload is one struct: a null field is a value of its own, and does not make the
    whole payload vanish from the distinct count.
    """
    return (
        df.groupBy(*keys)
        .agg(
            F.count("*").alias("row_count"),
            F.countDistinct(F.struct(*payload)).alias("payload_variant_count"),
        )
        .filter("row_count > 1 and payload_variant_count > 1")
    )


def not_single_zone() -> Column:
    """Neither or both of the two zone columns are set."""
    return F.col("in_bidding_zone").isNull() == F.col("out_bidding_zone").isNull()


def domains_differ() -> Column:
    return F.col("in_domain") != F.col("out_domain")


def _any(*conditions: Column) -> Column:
    return reduce(or_, conditions)


def _invalid_coverage(complete: str) -> Column:
    observed, expected = F.col("observed_interval_count"), F.col("expected_interval_count")
    coverage = F.col("coverage_ratio")
    return _any(
        F.col("interval_minutes") <= 0,
        expected <= 0,
        observed < 0,
        observed > expected,
        coverage < 0,
        coverage > 1,
        F.col(complete) != (observed == expected),
    )


def _unordered(minimum: str, average: str, maximum: str) -> Column:
    return (F.col(minimum) > F.col(average)) | (F.col(average) > F.col(maximum))


def invalid_power_day(measure: str) -> Column:
    peak, day = F.col(f"peak_{measure}_timestamp"), F.col("observation_date")
    return _any(
        _invalid_coverage("is_complete_observation_day"),
        _unordered(f"minimum_{measure}_mw", f"average_{measure}_mw", f"maximum_{measure}_mw"),
        F.col("observed_energy_mwh") < 0,
        peak < day.cast("timestamp"),
        peak >= F.date_add(day, 1).cast("timestamp"),
    )


def invalid_price_day() -> Column:
    observed = F.col("observed_interval_count")
    negative, hours = (
        F.col("negative_price_interval_count"),
        F.col("negative_price_duration_hours"),
    )
    return _any(
        _invalid_coverage("is_complete_delivery_day"),
        F.col("period_end") <= F.col("period_start"),
        negative < 0,
        negative > observed,
        hours < 0,
        hours > (observed * F.col("interval_minutes")).cast("double") / F.lit(60.0),
        _unordered(
            "minimum_price_eur_per_mwh", "average_price_eur_per_mwh", "maximum_price_eur_per_mwh"
        ),
    )


def count_checks(
    df: DataFrame,
    row_checks: Sequence[RowCheck],
    unique: tuple[str, Sequence[str]] | None = None,
    clustered: bool = True,
) -> DataFrame:
    """``(check, violations)`` for all checks of one table.

    Row checks are one aggregation that shuffles no rows. A uniqueness check
    ``(name, grain)`` has to count per grain. ``clustered`` says that ``df`` already ends
    in a step that groups by the grain: then both are counted in the same pass, which shuffles
    at most the already grouped rows once more. Otherwise, as for a table read from storage, they are two passes,
    so that only the grain columns are shuffled.
    """
    counts = [F.count_if(c.predicate).alias(f"c{i}") for i, c in enumerate(row_checks)]
    names = [c.name for c in row_checks]
    if unique is None:
        return _long(df.agg(*counts), names)
    name, grain = unique
    if not clustered:
        repeated = duplicated_keys(df, grain).agg(F.count("*").alias("c0"))
        return _long(df.agg(*counts), names).unionByName(_long(repeated, [name]))
    per_key = df.groupBy(*grain).agg(*counts, F.count("*").alias("rows"))
    totals = per_key.agg(
        *[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(counts))],
        F.count_if(F.col("rows") > 1).alias(f"c{len(counts)}"),
    )
    return _long(totals, [*names, name])


def _long(totals: DataFrame, names: Sequence[str]) -> DataFrame:
    pairs = [
        F.struct(F.lit(n).alias("check"), F.col(f"c{i}").alias("violations"))
        for i, n in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*pairs)))
