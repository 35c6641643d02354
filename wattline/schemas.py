"""Declared schemas, layouts and required columns of every table.

Nothing here is inferred from data: readers pass these schemas, and the
``not_null`` checks take their column lists from ``REQUIRED_COLUMNS``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

NUMERIC = T.DecimalType(38, 9)

_STR, _INT, _TS = T.StringType(), T.LongType(), T.TimestampType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


# Columns of the RAW tables, in order, and whether they may be null.
_DOCUMENT = (
    ("source_object_name", _STR, False),
    ("document_mrid", _STR, False),
    ("document_type", _STR, False),
    ("revision_number", _INT, False),
    ("document_created_at", _TS, False),
)
_POINT = (
    ("period_start", _TS, False),
    ("period_end", _TS, False),
    ("resolution", _STR, False),
    ("position", _INT, False),
    ("point_timestamp", _TS, False),
)

RAW_LOAD = _struct(
    *_DOCUMENT,
    ("process_type", _STR, False),
    ("time_series_mrid", _STR, False),
    ("business_type", _STR, False),
    ("object_aggregation", _STR, False),
    ("out_bidding_zone", _STR, False),
    ("quantity_unit", _STR, False),
    ("curve_type", _STR, False),
    *_POINT,
    ("quantity", NUMERIC, False),
)

RAW_GENERATION = _struct(
    *_DOCUMENT,
    ("process_type", _STR, False),
    ("time_series_mrid", _STR, False),
    ("business_type", _STR, False),
    ("object_aggregation", _STR, False),
    ("in_bidding_zone", _STR, True),
    ("out_bidding_zone", _STR, True),
    ("quantity_unit", _STR, False),
    ("curve_type", _STR, False),
    ("psr_type", _STR, False),
    *_POINT,
    ("quantity", NUMERIC, False),
)

RAW_PRICES = _struct(
    *_DOCUMENT,
    ("time_series_mrid", _STR, False),
    ("auction_type", _STR, False),
    ("business_type", _STR, False),
    ("in_domain", _STR, False),
    ("out_domain", _STR, False),
    ("contract_market_agreement_type", _STR, False),
    ("currency_unit", _STR, False),
    ("price_unit", _STR, False),
    ("classification_sequence_position", _INT, True),
    ("curve_type", _STR, False),
    *_POINT,
    ("price_amount", NUMERIC, False),
)


@dataclass(frozen=True)
class Layout:
    """Physical layout of a table: one day column, then sort columns inside the files."""

    day_column: str
    day_of: str | None
    cluster_by: tuple[str, ...]


@dataclass(frozen=True)
class Dataset:
    """One of the three source datasets."""

    name: str
    schema: T.StructType
    layout: Layout


LOAD = Dataset(
    "actual_load",
    RAW_LOAD,
    Layout("point_date", "point_timestamp", ("out_bidding_zone",)),
)
GENERATION = Dataset(
    "actual_generation",
    RAW_GENERATION,
    Layout("point_date", "point_timestamp", ("in_bidding_zone", "out_bidding_zone", "psr_type")),
)
PRICES = Dataset(
    "day_ahead_prices",
    RAW_PRICES,
    Layout("point_date", "point_timestamp", ("in_domain", "out_domain")),
)
DATASETS = {d.name: d for d in (LOAD, GENERATION, PRICES)}

MART_LAYOUTS = {
    "fct_actual_load": Layout("point_date", "point_timestamp", ("bidding_zone",)),
    "fct_generation_by_type": Layout(
        "point_date", "point_timestamp", ("bidding_zone", "psr_type", "domain_direction")
    ),
    "fct_day_ahead_prices": Layout("point_date", "point_timestamp", ("bidding_zone",)),
    "agg_daily_load": Layout("observation_date", None, ("bidding_zone",)),
    "agg_daily_generation_by_type": Layout(
        "observation_date", None, ("bidding_zone", "psr_type", "domain_direction")
    ),
    "agg_daily_day_ahead_prices": Layout("delivery_date", None, ("bidding_zone",)),
}

# Business grain of each model, used for version picking and uniqueness checks.
# Time comes first in each: it varies most, so sorting by a grain rarely compares the rest.
LOAD_GRAIN = ("point_timestamp", "bidding_zone")
GENERATION_GRAIN = ("point_timestamp", "bidding_zone", "psr_type", "domain_direction")
PRICE_GRAIN = ("point_timestamp", "in_domain", "classification_sequence_position")
PRICE_FACT_GRAIN = ("point_timestamp", "bidding_zone", "classification_sequence_position")
PRICE_DUPLICATE_KEYS = (
    "point_timestamp",
    "source_object_name",
    "document_id",
    "in_domain",
    "out_domain",
    "auction_type",
    "business_type",
    "contract_market_agreement_type",
    "classification_sequence_position",
)
PRICE_PAYLOAD = (
    "document_type",
    "revision_number",
    "document_created_at",
    "currency_unit",
    "price_unit",
    "curve_type",
    "period_start",
    "period_end",
    "resolution",
    "position",
    "price_amount",
)
DAILY_LOAD_GRAIN = ("observation_date", "bidding_zone")
DAILY_GENERATION_GRAIN = ("observation_date", "bidding_zone", "psr_type", "domain_direction")
DAILY_PRICE_GRAIN = ("delivery_date", "bidding_zone", "classification_sequence_position")

# Columns that must never be null, per model.
_LINEAGE = ("source_object_name", "document_id", "time_series_id")
_DAILY_COVERAGE = ("interval_minutes", "observed_interval_count", "expected_interval_count")
REQUIRED_COLUMNS = {
    "stg_actual_load": (*_LINEAGE, "bidding_zone", "point_timestamp", "load_quantity"),
    "stg_actual_generation": (*_LINEAGE, "psr_type", "point_timestamp", "generation_quantity"),
    "stg_day_ahead_prices": (
        *_LINEAGE, "in_domain", "out_domain", "point_timestamp", "price_amount",
    ),
    "int_actual_load_canonical": (
        *_LINEAGE, "bidding_zone", "point_timestamp", "load_quantity",
    ),
    "int_actual_generation_normalized": (
        *_LINEAGE, "bidding_zone", "domain_direction", "psr_type", "point_timestamp",
        "generation_quantity",
    ),
    "int_actual_generation_canonical": (
        *_LINEAGE, "bidding_zone", "domain_direction", "psr_type", "point_timestamp",
        "generation_quantity",
    ),
    "int_day_ahead_prices_deduplicated": (
        *_LINEAGE, "in_domain", "out_domain", "point_timestamp", "price_amount",
    ),
    "int_day_ahead_prices_canonical": (
        *_LINEAGE, "in_domain", "out_domain", "point_timestamp", "price_amount",
    ),
    "fct_actual_load": (
        *_LINEAGE, "bidding_zone", "point_timestamp", "load_quantity", "quantity_unit",
        "resolution",
    ),
    "fct_generation_by_type": (
        *_LINEAGE, "bidding_zone", "domain_direction", "psr_type", "point_timestamp",
        "generation_quantity", "quantity_unit", "resolution",
    ),
    "fct_day_ahead_prices": (
        *_LINEAGE, "bidding_zone", "auction_type", "contract_market_agreement_type",
        "period_start", "period_end", "point_timestamp", "price_amount", "currency_unit",
        "price_unit", "resolution",
    ),
    "agg_daily_load": (
        "bidding_zone", "observation_date", "quantity_unit", "resolution", *_DAILY_COVERAGE,
        "average_load_mw", "minimum_load_mw", "maximum_load_mw", "peak_load_timestamp",
        "observed_energy_mwh", "coverage_ratio", "is_complete_observation_day",
    ),
    "agg_daily_generation_by_type": (
        "bidding_zone", "observation_date", "psr_type", "domain_direction", "quantity_unit",
        "resolution", *_DAILY_COVERAGE, "average_generation_mw", "minimum_generation_mw",
        "maximum_generation_mw", "peak_generation_timestamp", "observed_energy_mwh",
        "coverage_ratio", "is_complete_observation_day",
    ),
    "agg_daily_day_ahead_prices": (
        "bidding_zone", "delivery_date", "period_start", "period_end", "currency_unit",
        "price_unit", "resolution", *_DAILY_COVERAGE, "average_price_eur_per_mwh",
        "minimum_price_eur_per_mwh", "maximum_price_eur_per_mwh",
        "negative_price_interval_count", "negative_price_duration_hours", "coverage_ratio",
        "is_complete_delivery_day",
    ),
}
