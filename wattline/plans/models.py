"""The model graph from RAW rows to daily KPIs, as composed DataFrames.

    RAW -> staging -> (normalized | deduplicated) -> canonical -> facts -> daily KPIs

Everything is lazy. Each version pick and each aggregation costs one shuffle, on keys
that include a time column, so the ten zones never limit the spread.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline import schemas
from wattline.operators import kpis, projections, versions

# Columns that complete the revision order, so that equal revisions never tie arbitrarily.
_PERIOD_TIES = ("resolution", "period_start", "period_end")


def canonical_load(staged: DataFrame) -> DataFrame:
    return versions.latest_version(
        staged, schemas.LOAD_GRAIN, ("load_quantity", "quantity_unit", *_PERIOD_TIES)
    )


def canonical_generation(normalized: DataFrame) -> DataFrame:
    return versions.latest_version(
        normalized,
        schemas.GENERATION_GRAIN,
        ("generation_quantity", "quantity_unit", *_PERIOD_TIES),
    )


def deduplicated_prices(staged: DataFrame) -> DataFrame:
    return versions.first_duplicate(
        staged,
        schemas.PRICE_DUPLICATE_KEYS,
        "time_series_id",
        ("revision_number", "document_created_at", "price_amount", "currency_unit",
         "price_unit", *_PERIOD_TIES),
    )


def canonical_prices(deduplicated: DataFrame) -> DataFrame:
    return versions.latest_version(
        deduplicated,
        schemas.PRICE_GRAIN,
        ("out_domain", "auction_type", "business_type", "contract_market_agreement_type",
         "price_amount"),
    )


def daily_load(facts: DataFrame) -> DataFrame:
    return kpis.daily_power_kpis(facts, "load_quantity", "load")


def daily_generation(facts: DataFrame) -> DataFrame:
    return kpis.daily_power_kpis(
        facts, "generation_quantity", "generation", ("psr_type", "domain_direction")
    )


def daily_prices(facts: DataFrame) -> DataFrame:
    return kpis.daily_price_kpis(facts)


def load_branch(raw: DataFrame) -> dict[str, DataFrame]:
    staged = projections.stage_load(raw)
    canonical = canonical_load(staged)
    facts = projections.load_facts(canonical)
    return {
        "stg_actual_load": staged,
        "int_actual_load_canonical": canonical,
        "fct_actual_load": facts,
        "agg_daily_load": daily_load(facts),
    }


def generation_branch(raw: DataFrame) -> dict[str, DataFrame]:
    staged = projections.stage_generation(raw)
    normalized = projections.normalize_direction(staged)
    canonical = canonical_generation(normalized)
    facts = projections.generation_facts(canonical)
    return {
        "stg_actual_generation": staged,
        "int_actual_generation_normalized": normalized,
        "int_actual_generation_canonical": canonical,
        "fct_generation_by_type": facts,
        "agg_daily_generation_by_type": daily_generation(facts),
    }


def price_branch(raw: DataFrame) -> dict[str, DataFrame]:
    staged = projections.stage_prices(raw)
    deduplicated = deduplicated_prices(staged)
    canonical = canonical_prices(deduplicated)
    facts = projections.price_facts(canonical)
    return {
        "stg_day_ahead_prices": staged,
        "int_day_ahead_prices_deduplicated": deduplicated,
        "int_day_ahead_prices_canonical": canonical,
        "fct_day_ahead_prices": facts,
        "agg_daily_day_ahead_prices": daily_prices(facts),
    }


def all_models(load: DataFrame, generation: DataFrame, prices: DataFrame) -> dict[str, DataFrame]:
    return {**load_branch(load), **generation_branch(generation), **price_branch(prices)}


def create_views(models: Mapping[str, DataFrame]) -> None:
    """Session views of the lazy models, for use from SQL."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)


def affected_days(changed: DataFrame) -> DataFrame:
    """Distinct UTC days of changed points; at most one row per calendar day."""
    return changed.select(F.to_date("point_timestamp").alias("point_date")).distinct()
