"""Coverage-aware daily KPIs.

Partial days are published with a coverage below one; nothing is interpolated. Unit,
resolution and interval are part of the power grouping, so a day with two resolutions
gives two rows, which the uniqueness check of the daily grain then reports.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions import measures as m


def _with_coverage(daily: DataFrame, complete: str) -> DataFrame:
    observed, expected = F.col("observed_interval_count"), F.col("expected_interval_count")
    return daily.withColumn(
        "coverage_ratio", F.try_divide(observed.cast("double"), expected.cast("double"))
    ).withColumn(complete, observed == expected)


def daily_power_kpis(
    facts: DataFrame, value: str, measure: str, dimensions: Sequence[str] = ()
) -> DataFrame:
    """Per zone, UTC day, ``dimensions``, unit and resolution.

    ``value`` is the power column and ``measure`` names the outputs (``average_<measure>_mw``).
    The interval length follows from the resolution, so it is read from the text once per
    group instead of once per row.
    """
    keys = ["bidding_zone", "observation_date", *dimensions, "quantity_unit", "resolution"]
    power, instant = F.col(value), F.col("point_timestamp")
    minutes = F.col("interval_minutes")
    summed = (
        facts.select(
            "bidding_zone", *dimensions, "quantity_unit", "resolution", instant, power,
            F.to_date(instant).alias("observation_date"),
        )
        .groupBy(*keys)
        .agg(
            F.count("*").alias("observed_interval_count"),
            m.numeric_average(power).alias(f"average_{measure}_mw"),
            F.min(power).alias(f"minimum_{measure}_mw"),
            F.max(power).alias(f"maximum_{measure}_mw"),
            m.earliest_peak(instant, power).alias(f"peak_{measure}_timestamp"),
            F.sum(power).alias("_power_sum"),
        )
        .withColumn("interval_minutes", m.interval_minutes(F.col("resolution")))
    )
    daily = summed.select(
        *keys,
        minutes,
        "observed_interval_count",
        m.rounded_ratio(F.lit(m.MINUTES_PER_DAY), minutes).alias("expected_interval_count"),
        *[f"{kind}_{measure}_mw" for kind in ("average", "minimum", "maximum")],
        f"peak_{measure}_timestamp",
        m.energy_mwh(F.col("_power_sum"), minutes).alias("observed_energy_mwh"),
    )
    return _with_coverage(daily, "is_complete_observation_day")


def daily_price_kpis(facts: DataFrame) -> DataFrame:
    """Per zone, classification position and delivery day.

    The delivery day is the UTC date of the period's *end*, since a delivery period
    crosses midnight UTC. The expected count comes from the period's own length, so
    23- and 25-hour days count 92 and 100 quarter hours. Amounts keep their currency.

    Rows are first summed per unit and resolution, normally one group per day: that step
    aggregates fixed-width values in a hash table and reads a resolution once per group.
    The second step merges the few groups of a day.
    """
    day = ["bidding_zone", "classification_sequence_position", "delivery_date"]
    texts = ["currency_unit", "price_unit", "resolution"]
    price, minutes, count = F.col("price_amount"), F.col("interval_minutes"), F.col("_negative")
    summed = (
        facts.select(
            *day[:2], *texts, "period_start", "period_end", price,
            F.to_date("period_end").alias("delivery_date"),
        )
        .groupBy(*day, *texts)
        .agg(
            F.min("period_start").alias("period_start"),
            F.max("period_end").alias("period_end"),
            F.count("*").alias("_rows"),
            F.count(price).alias("_prices"),
            F.sum(price).alias("_price_sum"),
            F.min(price).alias("_minimum"),
            F.max(price).alias("_maximum"),
            F.count_if(price < 0).alias("_negative"),
        )
        .withColumn("interval_minutes", m.interval_minutes(F.col("resolution")))
    )
    length = F.timestamp_diff("MINUTE", F.min("period_start"), F.max("period_end"))
    # Every row counts: a negative one its interval, which may be unknown, any other one zero.
    others = F.when(F.col("_rows") > count, F.lit(0).cast("bigint"))
    negative_minutes = F.sum(F.coalesce(count * minutes, others))
    daily = summed.groupBy(*day).agg(
        F.min("period_start").alias("period_start"),
        F.max("period_end").alias("period_end"),
        *[F.min(c).alias(c) for c in texts],
        F.min(minutes).alias("interval_minutes"),
        F.sum("_rows").alias("observed_interval_count"),
        m.rounded_ratio(length, F.min(minutes)).alias("expected_interval_count"),
        m.merged_average(F.sum("_price_sum"), F.sum("_prices")).alias(
            "average_price_eur_per_mwh"
        ),
        F.min("_minimum").alias("minimum_price_eur_per_mwh"),
        F.max("_maximum").alias("maximum_price_eur_per_mwh"),
        F.sum(count).alias("negative_price_interval_count"),
        m.interval_hours(negative_minutes).alias("negative_price_duration_hours"),
    )
    return _with_coverage(daily, "is_complete_delivery_day")
