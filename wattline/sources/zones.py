"""The zone dimension: ten zones, fixed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Market, zone name and zone code of every supported bidding zone.
ZONES = (
    ("France", "FR", "10YFR-RTE------C"),
    ("Germany / Luxembourg", "DE-LU", "10Y1001A1001A82H"),
    ("Spain", "ES", "10YES-REE------0"),
    ("Italy", "IT-North", "10Y1001A1001A73I"),
    ("Italy", "IT-Centre-North", "10Y1001A1001A70O"),
    ("Italy", "IT-Centre-South", "10Y1001A1001A71M"),
    ("Italy", "IT-South", "10Y1001A1001A788"),
    ("Italy", "IT-Calabria", "10Y1001C--00096J"),
    ("Italy", "IT-Sicily", "10Y1001A1001A75E"),
    ("Italy", "IT-Sardinia", "10Y1001A1001A74G"),
)
ZONE_DDL = "market string, name string, eic_code string"


def zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ZONES, ZONE_DDL)


def zone_array() -> Column:
    """The dimension as one array value, to explode per row without a join."""
    return F.array(
        *[
            F.struct(F.lit(m).alias("market"), F.lit(n).alias("name"), F.lit(c).alias("eic_code"))
            for m, n, c in ZONES
        ]
    )


def with_zone(df: DataFrame, code_column: str) -> DataFrame:
    """Adds market and zone name. The dimension has ten rows, so it is broadcast."""
    dimension = zones(df.sparkSession).withColumnRenamed("eic_code", code_column)
    return df.join(F.broadcast(dimension), code_column, "left")
