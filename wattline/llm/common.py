"""Pieces that several corpus operators share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.session import work_folder

# A word is a longest run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends here."""
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def others(df: DataFrame, outputs) -> list[str]:
    """Input columns that no output column replaces."""
    taken = {name.lower() for name in outputs}
    return [f"`{name}`" for name in df.columns if name.lower() not in taken]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def extended(schema: T.StructType, ddl: str) -> T.StructType:
    """A schema with further fields."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])


# Allocators of Python workers: what a batch took goes back to the system after it.
ALLOCATORS = {
    "ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_TRIM_THRESHOLD_": "262144",
}


def workers(spark: SparkSession, rows: int = 1000) -> None:
    """Lets Python workers find this package, bounds the rows of an Arrow batch and what
    workers hold on to."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    for name, value in ALLOCATORS.items():
        env.setdefault(name, value)
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)
