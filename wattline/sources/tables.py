"""Reading stored tables with their declared schema and a day range."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline import schemas


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    layout: schemas.Layout,
    first_day: date | str | None = None,
    last_day: date | str | None = None,
    with_day: bool = False,
) -> DataFrame:
    """A stored table, optionally limited to days ``first_day``..``last_day``.

    ``with_day`` keeps the day column of the folders. The bound is put on the day column of
    the layout, so whole directories are skipped; a bound on a timestamp column would still
    open every file.
    """
    day = layout.day_column
    extra = [] if day in schema.fieldNames() else [T.StructField(day, T.DateType())]
    df = spark.read.schema(T.StructType([*schema.fields, *extra])).parquet(path)
    if first_day is not None:
        df = df.filter(F.col(day) >= F.lit(first_day).cast("date"))
    if last_day is not None:
        df = df.filter(F.col(day) <= F.lit(last_day).cast("date"))
    return df.select(*schema.fieldNames(), *([day] if with_day and extra else []))


COMMIT_DDL = "number bigint, dataset string, batch string, load_batch string"


def committed(spark: SparkSession, root: str, table: DataFrame) -> DataFrame:
    """Rows whose ``load_batch`` has a commit; all rows where no log of commits exists.

    The log has one row per attempt and the batch is a folder, so folders are skipped whole.
    """
    try:
        log = spark.read.schema(COMMIT_DDL).json(f"{root.rstrip('/')}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # before the first commit only tables that were written without batches count
        return table
    return table.join(log.select("load_batch").distinct(), "load_batch", "left_semi").select(
        *table.columns
    )


def read_raw(
    spark: SparkSession,
    root: str,
    dataset: schemas.Dataset,
    first_day: date | str | None = None,
    last_day: date | str | None = None,
    with_day: bool = False,
) -> DataFrame:
    """A RAW table below ``root``, in its declared schema: rows of finished batches."""
    path = f"{root.rstrip('/')}/{dataset.name}"
    keyed = T.StructType([*dataset.schema.fields, T.StructField("load_batch", T.StringType())])
    rows = read_table(spark, path, keyed, dataset.layout, first_day, last_day, with_day)
    return committed(spark, root, rows).drop("load_batch")
