"""What to request: one row per dataset, zone and interval.

The manifest is data for whatever fetches documents; nothing here talks to a network.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions import text
from wattline.sources.zones import zone_array

# Request parameters of each dataset, and the ones that carry the zone.
REQUESTS = {
    "actual_load": (
        {"documentType": "A65", "processType": "A16"},
        ("outBiddingZone_Domain",),
    ),
    "actual_generation": (
        {"documentType": "A75", "processType": "A16"},
        ("in_Domain",),
    ),
    "day_ahead_prices": (
        {"documentType": "A44", "contract_MarketAgreement.type": "A01"},
        ("out_Domain", "in_Domain"),
    ),
}


def _params(dataset: str, zone: Column, start: Column, end: Column) -> Column:
    fixed, zone_names = REQUESTS[dataset]
    pairs = [(k, F.lit(v)) for k, v in fixed.items()]
    pairs += [(k, zone) for k in zone_names]
    pairs += [("periodStart", text.utc_minute(start)), ("periodEnd", text.utc_minute(end))]
    return F.create_map(*[part for k, v in pairs for part in (F.lit(k), v)])


def daily_intervals(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One UTC day interval per day between two date columns, both included."""
    day = F.explode(F.sequence(F.col(first), F.col(last), F.expr("interval 1 day")))
    days = bounds.select(day.alias("day"))
    return days.select(
        F.col("day").cast("timestamp").alias("period_start"),
        F.date_add("day", 1).cast("timestamp").alias("period_end"),
    )


def parsed_intervals(df: DataFrame, start: str, end: str) -> DataFrame:
    """Reads text bounds as UTC instants and says what is wrong with an interval.

    ``problem`` is null for a valid interval. Bounds without an offset are not accepted.
    """
    first, last = text.offset_timestamp(F.col(start)), text.offset_timestamp(F.col(end))
    return df.withColumns(
        {
            "period_start": first,
            "period_end": last,
            "problem": F.when(first.isNull(), f"{start}: not a timestamp with offset")
            .when(last.isNull(), f"{end}: not a timestamp with offset")
            .when(last <= first, f"{end} is not after {start}"),
        }
    )


def request_manifest(intervals: DataFrame) -> DataFrame:
    """Every dataset and zone for each ``(period_start, period_end)``.

    Zones and datasets are exploded from constant arrays, so the fan-out is a projection.
    """
    if "problem" in intervals.columns:
        intervals = intervals.filter("problem is null")
    start, end = F.col("period_start"), F.col("period_end")
    per_zone = intervals.select(start, end, F.explode(zone_array()).alias("zone"))
    zone = F.col("zone.eic_code")
    requests = F.array(
        *[
            F.struct(
                F.lit(name).alias("dataset"),
                _params(name, zone, start, end).alias("params"),
                text.object_name(name, zone, start, end).alias("source_object_name"),
            )
            for name in REQUESTS
        ]
    )
    return per_zone.select(
        zone.alias("bidding_zone"), start, end, F.explode(requests).alias("r")
    ).select("r.dataset", "bidding_zone", start, end, "r.params", "r.source_object_name")
