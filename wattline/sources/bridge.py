"""RAW-shaped frames derived from the ``events`` test table.

The test data has no electricity tables. These projections turn every event into one
point: ten zones, hourly grain, three revisions, five production types, and delivery
periods that cross midnight UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import schemas

EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    return table.withColumn("ts", F.col("ts").cast("timestamp"))


def zone() -> Column:
    return F.concat(F.lit("Z"), (F.col("user_id") % 10).cast("string"))


def uniform_resolution() -> Column:
    return F.when(F.col("user_id") % 2 == 0, "PT60M").otherwise("PT1H")


def mixed_resolution() -> Column:
    """Two resolutions within a zone and day, and a third one without an interval length."""
    return (
        F.when(F.col("event_id") % 5 == 0, "PT1H30M")
        .when(F.col("event_id") % 2 == 0, "PT60M")
        .otherwise("PT30M")
    )


def _common(resolution: Column, document_type: str) -> dict[str, Column]:
    day = F.date_trunc("day", "ts")
    return {
        "source_object_name": F.concat(F.lit("src/"), F.col("event_type")),
        "document_mrid": F.concat(F.lit("d"), (F.col("event_id") % 2).cast("string")),
        "document_type": F.lit(document_type),
        "revision_number": F.col("event_id") % 3 + 1,
        "document_created_at": day,
        "process_type": F.lit("A16"),
        "time_series_mrid": F.concat(F.lit("s"), F.col("event_id").cast("string")),
        "business_type": F.lit("A04"),
        "object_aggregation": F.lit("A01"),
        "quantity_unit": F.lit("MAW"),
        "curve_type": F.lit("A03"),
        "period_start": day,
        "period_end": day + F.expr("interval 1 day"),
        "resolution": resolution,
        "position": (F.hour("ts") + 1).cast("bigint"),
        "point_timestamp": F.date_trunc("hour", "ts"),
        "quantity": F.col("value").cast("decimal(38,9)"),
    }


def _shaped(df: DataFrame, columns: dict[str, Column], dataset: schemas.Dataset) -> DataFrame:
    return df.select(*[columns[n].alias(n) for n in dataset.schema.fieldNames()])


def raw_load(df: DataFrame, resolution: Column | None = None) -> DataFrame:
    columns = _common(uniform_resolution() if resolution is None else resolution, "A65")
    columns["out_bidding_zone"] = zone()
    return _shaped(df, columns, schemas.LOAD)


def raw_generation(df: DataFrame, resolution: Column | None = None) -> DataFrame:
    columns = _common(uniform_resolution() if resolution is None else resolution, "A75")
    which = F.col("event_id") % 3
    missing = F.col("event_id") % 97 == 0
    columns["in_bidding_zone"] = F.when(~missing & which.isin(0, 2), zone())
    columns["out_bidding_zone"] = F.when(~missing & which.isin(1, 2), zone())
    columns["psr_type"] = F.col("event_type")
    return _shaped(df, columns, schemas.GENERATION)


def raw_prices(df: DataFrame, resolution: Column | None = None) -> DataFrame:
    columns = _common(uniform_resolution() if resolution is None else resolution, "A44")
    two_hours = F.expr("interval 2 hours")
    start = F.date_trunc("day", F.col("ts") + two_hours) - two_hours
    point = columns["point_timestamp"]
    hours = (F.unix_timestamp(point) - F.unix_timestamp(start)) / 3600
    sequence = F.col("user_id") % 3
    columns |= {
        "source_object_name": F.concat(
            F.lit("p/"), zone(), F.lit("/"), F.date_format("ts", "yyyy-MM-dd")
        ),
        "auction_type": F.lit("A01"),
        "business_type": F.lit("A62"),
        "in_domain": zone(),
        "out_domain": zone(),
        "contract_market_agreement_type": F.lit("A01"),
        "currency_unit": F.lit("EUR"),
        "price_unit": F.lit("MWH"),
        "classification_sequence_position": F.when(sequence != 0, sequence),
        "period_start": start,
        "period_end": start + F.expr("interval 1 day"),
        "position": (hours + 1).cast("bigint"),
        "price_amount": (F.col("value") - 100).cast("decimal(38,9)"),
    }
    return _shaped(df, columns, schemas.PRICES)
