"""The check suite over all models, its report, and the gate that depends on it."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline import schemas
from wattline.operators import checks

# The uniqueness check of each model and its grain.
UNIQUE = {
    "int_actual_load_canonical": ("actual_load_canonical_is_unique", schemas.LOAD_GRAIN),
    "int_actual_generation_canonical": (
        "actual_generation_canonical_is_unique", schemas.GENERATION_GRAIN,
    ),
    "int_day_ahead_prices_deduplicated": (
        "day_ahead_prices_are_unique", schemas.PRICE_DUPLICATE_KEYS,
    ),
    "int_day_ahead_prices_canonical": (
        "day_ahead_prices_canonical_is_unique", schemas.PRICE_GRAIN,
    ),
    "fct_actual_load": ("actual_load_is_unique", schemas.LOAD_GRAIN),
    "fct_generation_by_type": ("generation_by_type_is_unique", schemas.GENERATION_GRAIN),
    "fct_day_ahead_prices": ("day_ahead_price_mart_is_unique", schemas.PRICE_FACT_GRAIN),
    "agg_daily_load": ("daily_load_is_unique", schemas.DAILY_LOAD_GRAIN),
    "agg_daily_generation_by_type": (
        "daily_generation_by_type_is_unique", schemas.DAILY_GENERATION_GRAIN,
    ),
    "agg_daily_day_ahead_prices": (
        "daily_day_ahead_prices_is_unique", schemas.DAILY_PRICE_GRAIN,
    ),
}


def row_checks(model: str) -> list[checks.RowCheck]:
    """The null checks of a model plus its own row-level rule, if it has one."""
    own = {
        "int_actual_generation_normalized": [
            ("actual_generation_has_single_bidding_zone", checks.not_single_zone()),
        ],
        "int_day_ahead_prices_deduplicated": [
            ("day_ahead_domains_match", checks.domains_differ()),
        ],
        "agg_daily_load": [
            ("daily_load_metrics_are_valid", checks.invalid_power_day("load")),
        ],
        "agg_daily_generation_by_type": [
            ("daily_generation_by_type_metrics_are_valid",
             checks.invalid_power_day("generation")),
        ],
        "agg_daily_day_ahead_prices": [
            ("daily_day_ahead_price_metrics_are_valid", checks.invalid_price_day()),
        ],
    }
    rules = [checks.RowCheck(name, predicate) for name, predicate in own.get(model, [])]
    return checks.not_null_checks(schemas.REQUIRED_COLUMNS[model]) + rules


def model_report(model: str, df: DataFrame, stored: bool = False) -> DataFrame:
    """``(model, check, violations)`` for every check of one model.

    ``stored`` says that ``df`` is read from a table. A model that is not stored ends in a
    version pick or an aggregation on its grain.
    """
    counted = checks.count_checks(
        df, row_checks(model), UNIQUE.get(model), clustered=not stored
    )
    if model == "stg_day_ahead_prices":
        unequal = checks.unequal_duplicates(
            df, schemas.PRICE_DUPLICATE_KEYS, schemas.PRICE_PAYLOAD
        ).agg(F.count("*").alias("violations"))
        counted = counted.unionByName(
            unequal.select(
                F.lit("day_ahead_price_duplicates_are_equivalent").alias("check"), "violations"
            )
        )
    return counted.select(F.lit(model).alias("model"), "check", "violations")


def quality_report(models: Mapping[str, DataFrame], stored: Collection[str] = ()) -> DataFrame:
    """One row per check of the given models, also where nothing is violated."""
    reports = [model_report(name, df, name in stored) for name, df in models.items()]
    return reduce(DataFrame.unionByName, reports)


def passes(report: DataFrame) -> bool:
    return report.filter("violations > 0").isEmpty()
