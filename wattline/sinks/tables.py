"""Writing laid-out tables.

Every table is partitioned by a day column and sorted by its cluster columns inside the
files. Days are brought together with a rebalance, not a plain repartition: Spark splits
a day that is larger than the advisory partition size over several tasks and packs small
days together, so one hot day neither sits in one task nor makes one giant file.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattline.schemas import Layout

# Day folder that holds the empty file of a provisioned table.
_NO_DAY = "1970-01-01"


def laid_out(df: DataFrame, layout: Layout) -> DataFrame:
    day = layout.day_column
    dated = df if layout.day_of is None else df.withColumn(day, F.to_date(layout.day_of))
    return dated.hint("rebalance", F.col(day)).sortWithinPartitions(day, *layout.cluster_by)


def _writer(df: DataFrame, layout: Layout) -> DataFrameWriter:
    return laid_out(df, layout).write.partitionBy(layout.day_column)


def write_table(df: DataFrame, path: str, layout: Layout) -> None:
    """Full rebuild. ``path`` must not be one that ``df`` reads."""
    _writer(df, layout).mode("overwrite").parquet(path)


def replace_days(df: DataFrame, path: str, layout: Layout) -> None:
    """Replaces the days that occur in ``df`` and leaves all others as they are."""
    _writer(df, layout).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def clear_days(spark: SparkSession, path: str, layout: Layout, days: Iterable[date]) -> None:
    """Empties days, which a replacement without rows for them cannot do.

    Their folders are removed: no job runs, however many days there are.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    for day in days:
        folder = hadoop.Path(f"{path}/{layout.day_column}={day.isoformat()}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def provision(spark: SparkSession, folder: str, schema: StructType, layout: Layout) -> None:
    """Makes a table readable before its first write; an existing one is left alone."""
    day = f"{folder.rstrip('/')}/{layout.day_column}={_NO_DAY}"
    columns = [f for f in schema.fields if f.name != layout.day_column]
    spark.createDataFrame([], StructType(columns)).write.mode("ignore").parquet(day)


def batch_path(root: str, table: str, batch: str) -> str:
    """Folder of one batch of an append-only table."""
    return f"{root.rstrip('/')}/{table}/load_batch={batch}"


def drop_batch(spark: SparkSession, root: str, table: str, batch: str) -> None:
    """Removes the folder of a batch that will not be committed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(batch_path(root, table, batch))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_batch(
    df: DataFrame, root: str, table: str, batch: str, layout: Layout | None,
    folders: Sequence[str] = (),
) -> None:
    """Appends a batch by writing its own folder, so writing it again changes nothing.

    A table without a layout may be divided into ``folders`` by some of its columns.
    """
    path = batch_path(root, table, batch)
    if layout is None:
        writer = df.hint("rebalance", *map(F.col, folders)) if folders else df
        writer.write.mode("overwrite").partitionBy(*folders).parquet(path)
    else:
        write_table(df, path, layout)
