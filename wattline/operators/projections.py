"""Staging renames, direction normalization and fact projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_IDS = {"document_mrid": "document_id", "time_series_mrid": "time_series_id"}


def stage_load(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(
        {**_IDS, "out_bidding_zone": "bidding_zone", "quantity": "load_quantity"}
    )


def stage_generation(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed({**_IDS, "quantity": "generation_quantity"})


def stage_prices(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(_IDS)


def domain_direction(zone_in: Column, zone_out: Column) -> Column:
    """Which of the two zone columns is set: ``in``, ``out``, ``both`` or ``none``."""
    return (
        F.when(zone_in.isNotNull() & zone_out.isNotNull(), "both")
        .when(zone_in.isNotNull(), "in")
        .when(zone_out.isNotNull(), "out")
        .otherwise("none")
    )


def normalize_direction(generation: DataFrame) -> DataFrame:
    """Adds ``bidding_zone`` and ``domain_direction``; the source zone columns stay."""
    zone_in, zone_out = F.col("in_bidding_zone"), F.col("out_bidding_zone")
    return generation.withColumns(
        {
            "bidding_zone": F.coalesce(zone_in, zone_out),
            "domain_direction": domain_direction(zone_in, zone_out),
        }
    )


def load_facts(canonical: DataFrame) -> DataFrame:
    return canonical.select(
        "source_object_name", "document_id", "time_series_id", "bidding_zone",
        "point_timestamp", "load_quantity", "quantity_unit", "resolution",
    )


def generation_facts(canonical: DataFrame) -> DataFrame:
    return canonical.select(
        "source_object_name", "document_id", "time_series_id", "bidding_zone",
        "domain_direction", "psr_type", "point_timestamp", "generation_quantity",
        "quantity_unit", "resolution",
    )


def price_facts(canonical: DataFrame) -> DataFrame:
    return canonical.select(
        "source_object_name", "document_id", "time_series_id",
        F.col("in_domain").alias("bidding_zone"), "classification_sequence_position",
        "auction_type", "contract_market_agreement_type", "period_start", "period_end",
        "point_timestamp", "price_amount", "currency_unit", "price_unit", "resolution",
    )
