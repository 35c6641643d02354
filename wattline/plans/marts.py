"""Building, refreshing and publishing the six stored tables.

Facts are stored first and the daily KPIs are computed from the stored facts: those are
partitioned by day and sorted by zone, so the map side of the KPI aggregation already
collapses whole zone-days and hardly anything is shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline import schemas
from wattline.plans import models, quality
from wattline.session import work_folder
from wattline.sinks import tables as sinks
from wattline.sources import tables as sources


@dataclass(frozen=True)
class Chain:
    """One dataset's way from RAW rows to its fact table and its KPI table."""

    dataset: schemas.Dataset
    staged: str
    intermediate: tuple[str, ...]
    facts: str
    daily: str
    branch: Callable[[DataFrame], dict[str, DataFrame]]
    kpis: Callable[[DataFrame], DataFrame]


CHAINS = (
    Chain(
        schemas.LOAD, "stg_actual_load", ("int_actual_load_canonical",),
        "fct_actual_load", "agg_daily_load", models.load_branch, models.daily_load,
    ),
    Chain(
        schemas.GENERATION, "stg_actual_generation",
        ("int_actual_generation_normalized", "int_actual_generation_canonical"),
        "fct_generation_by_type", "agg_daily_generation_by_type",
        models.generation_branch, models.daily_generation,
    ),
    Chain(
        schemas.PRICES, "stg_day_ahead_prices",
        ("int_day_ahead_prices_deduplicated", "int_day_ahead_prices_canonical"),
        "fct_day_ahead_prices", "agg_daily_day_ahead_prices",
        models.price_branch, models.daily_prices,
    ),
)


def _path(root: str, table: str, attempt: str | None = None) -> str:
    """Folder of a stored table, or of what one attempt at a published run holds of it."""
    path = f"{root.rstrip('/')}/{table}"
    return path if attempt is None else f"{path}/attempt={attempt}"


def build_chain(
    spark: SparkSession, raw: DataFrame, chain: Chain, root: str, attempt: str | None = None
) -> dict:
    """Stores facts and KPIs of one dataset below ``root``; returns all its models."""

    def stored(df: DataFrame, table: str) -> DataFrame:
        path, layout = _path(root, table, attempt), schemas.MART_LAYOUTS[table]
        sinks.write_table(df, path, layout)
        return sources.read_table(spark, path, df.schema, layout)

    branch = chain.branch(raw)
    facts = stored(branch[chain.facts], chain.facts)
    daily = stored(chain.kpis(facts), chain.daily)
    return {**branch, chain.facts: facts, chain.daily: daily}


def _rows_of_days(raw: DataFrame, day: str, days: DataFrame) -> DataFrame:
    """Rows of the given days. There is at most one row per calendar day to broadcast, and
    as a broadcast it also prunes the day folders that are read."""
    return raw.join(F.broadcast(days), day, "left_semi")


def refresh_chain(
    spark: SparkSession, raw_root: str, chain: Chain, root: str, changed: DataFrame
) -> None:
    """Rebuilds the stored days that ``changed`` RAW rows touch.

    Gives the same tables as a full rebuild. Facts are replaced by UTC day. The KPIs of
    load and generation have the same days. A delivery day is spread over several UTC
    days, so its KPIs are recomputed from all its facts: for every delivery day that any
    RAW row of a touched UTC day belongs to, which covers rows that win now and rows that
    won before.
    """
    layout, daily_layout = (schemas.MART_LAYOUTS[t] for t in (chain.facts, chain.daily))
    facts_path, daily_path = _path(root, chain.facts), _path(root, chain.daily)
    day, days = layout.day_column, models.affected_days(changed)

    raw = sources.read_raw(spark, raw_root, chain.dataset, with_day=True)
    touched = _rows_of_days(raw, day, days).select(*chain.dataset.schema.fieldNames())
    facts = chain.branch(touched)[chain.facts]
    sinks.replace_days(facts, facts_path, layout)

    stored = sources.read_table(spark, facts_path, facts.schema, layout, with_day=True)
    if chain.dataset is not schemas.PRICES:
        daily = chain.kpis(_rows_of_days(stored, day, days).select(*facts.columns))
        sinks.replace_days(daily, daily_path, daily_layout)
        return

    delivery_path = work_folder(spark, "delivery-days")
    touched.select(F.to_date("period_end").alias("delivery_date")).distinct().write.parquet(
        delivery_path
    )
    delivery = spark.read.schema("delivery_date date").parquet(delivery_path)
    first, last = delivery.agg(F.min("delivery_date"), F.max("delivery_date")).first()
    if first is None:
        return
    # The range skips row groups; the exact days are then picked by the join.
    in_range = (F.col("period_end") >= F.lit(first).cast("timestamp")) & (
        F.col("period_end") < F.date_add(F.lit(last), 1).cast("timestamp")
    )
    dated = stored.filter(in_range).withColumn("delivery_date", F.to_date("period_end"))
    selected = _rows_of_days(dated, "delivery_date", delivery)
    daily = chain.kpis(selected.select(*facts.columns))
    sinks.replace_days(daily, daily_path, daily_layout)
    # Delivery days whose last fact moved to another one; no more than the calendar holds.
    kept = selected.select("delivery_date").distinct()
    emptied = delivery.join(kept, "delivery_date", "left_anti").collect()
    sinks.clear_days(spark, daily_path, daily_layout, [row[0] for row in emptied])


def build_all(
    spark: SparkSession, raw_root: str, root: str, attempt: str | None = None
) -> dict[str, DataFrame]:
    """Full rebuild of all stored tables; returns all fourteen models."""
    built: dict[str, DataFrame] = {}
    for chain in CHAINS:
        raw = sources.read_raw(spark, raw_root, chain.dataset)
        built.update(build_chain(spark, raw, chain, root, attempt))
    return built


PUBLICATION_DDL = "run string, folder string, published_at timestamp, passed boolean"
REPORT_DDL = "model string, `check` string, violations bigint"
SNAPSHOT_DDL = "`table` string, day string, folder string"


def _attempt(root: str, run: str) -> str:
    """Folder of one attempt at a run: a name that is used again overwrites nothing.

    It holds report and snapshot. What the attempt wrote of a table lies with the table, in a
    partition named after the attempt, so that a published table is read by one scan however
    many attempts hold its days.
    """
    if set("/=") & set(run):
        raise ValueError(f"{run}: a run name becomes part of a folder name")
    return f"{root.rstrip('/')}/runs/{run}-{uuid.uuid4().hex}"


def _tables(folder: str) -> tuple[str, str]:
    """Where the tables lie that the attempt of a folder belongs to, and its name there."""
    root, name = folder.rsplit("/runs/", 1)
    return f"{root}/tables", name


def _days_of(spark: SparkSession, folder: str, tables) -> DataFrame:
    """(table, day, folder) of the stored tables of an attempt."""
    shapes, parts = mart_schemas(spark), []
    root, attempt = _tables(folder)
    for table in tables:
        layout = schemas.MART_LAYOUTS[table]
        stored = sources.read_table(
            spark, _path(root, table, attempt), shapes[table], layout, with_day=True
        )
        day = F.date_format(layout.day_column, "yyyy-MM-dd").alias("day")
        parts.append(stored.select(F.lit(table).alias("table"), day).distinct())
    return reduce(DataFrame.unionByName, parts).withColumn("folder", F.lit(folder))


def _conclude(
    spark: SparkSession, root: str, run: str, folder: str, report: DataFrame, days: DataFrame
) -> bool:
    """Keeps report and snapshot of an attempt and logs whether its checks passed."""
    report.write.parquet(f"{folder}/report")
    days.coalesce(1).write.parquet(f"{folder}/snapshot")
    passed = quality.passes(spark.read.schema(REPORT_DDL).parquet(f"{folder}/report"))
    entry = spark.range(1).select(
        F.lit(run).alias("run"),
        F.lit(folder).alias("folder"),
        F.current_timestamp().alias("published_at"),
        F.lit(passed).alias("passed"),
    )
    entry.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/publications")
    return passed


def build_and_publish(spark: SparkSession, raw_root: str, root: str, run: str) -> bool:
    """Builds a run in a folder of its own, checks it, and publishes it if all checks pass.

    Publishing adds one row to a log and copies nothing, so a run that fails leaves the
    published tables as they were. Its tables and report stay in the folder of the attempt.
    """
    folder = _attempt(root, run)
    built = build_all(spark, raw_root, *_tables(folder))
    report = quality.quality_report(built, stored=schemas.MART_LAYOUTS)
    days = _days_of(spark, folder, schemas.MART_LAYOUTS)
    return _conclude(spark, root, run, folder, report, days)


def refresh_and_publish(
    spark: SparkSession, raw_root: str, root: str, run: str, changed: dict[str, DataFrame]
) -> bool:
    """Rebuilds what ``changed`` RAW rows (by dataset) touch, checks it, and publishes it.

    The new snapshot names the rebuilt days in the folder of this attempt and all other days
    where they already lie, so nothing is copied and a day that lost its rows is left out.
    Checks run over the rebuilt days; every grain holds the day, so none spans two of them.
    """
    if not set(changed) <= {c.dataset.name for c in CHAINS} or not changed:
        raise ValueError(f"no changed rows of a dataset: {sorted(changed)}")
    before = snapshot(spark, root)
    folder, rebuilt, parts, reports = _attempt(root, run), [], [], []
    tables, attempt = _tables(folder)
    for chain in (c for c in CHAINS if c.dataset.name in changed):
        layout, daily_layout = (schemas.MART_LAYOUTS[t] for t in (chain.facts, chain.daily))
        days = models.affected_days(changed[chain.dataset.name])
        days = _listed(spark, days, "point_date")
        raw = sources.read_raw(spark, raw_root, chain.dataset, with_day=True)
        touched = _rows_of_days(raw, layout.day_column, _frame(spark, days, layout.day_column))
        touched = touched.select(*chain.dataset.schema.fieldNames())
        branch = chain.branch(touched)
        facts_path, daily_path = (_path(tables, t, attempt) for t in (chain.facts, chain.daily))
        sinks.write_table(branch[chain.facts], facts_path, layout)
        facts = sources.read_table(spark, facts_path, branch[chain.facts].schema, layout)
        if chain.dataset is schemas.PRICES:
            # a delivery day is spread over several UTC days, some of which did not change
            delivery = touched.select(F.to_date("period_end").alias("delivery_date"))
            daily_days = _listed(spark, delivery, "delivery_date")
            kept = before.filter((F.col("table") == chain.facts) & ~F.col("day").isin(days))
            every = facts.unionByName(
                _read_snapshot(spark, kept, chain.facts).select(*facts.columns)
            )
            of_days = _rows_of_days(
                every.withColumn("delivery_date", F.to_date("period_end")), "delivery_date",
                _frame(spark, daily_days, "delivery_date"),
            ).select(*facts.columns)
        else:
            daily_days, of_days = days, facts
        daily = chain.kpis(of_days)
        sinks.write_table(daily, daily_path, daily_layout)
        stored = sources.read_table(spark, daily_path, daily.schema, daily_layout)
        rebuilt += [(chain.facts, day) for day in days] + [(chain.daily, day) for day in daily_days]
        parts.append(_days_of(spark, folder, (chain.facts, chain.daily)))
        reports.append(quality.quality_report(
            {**branch, chain.facts: facts, chain.daily: stored}, stored=schemas.MART_LAYOUTS
        ))
    # at most one row per stored table and calendar day
    gone = spark.createDataFrame(rebuilt, "`table` string, day string")
    entries = reduce(
        DataFrame.unionByName, parts, before.join(gone, ["table", "day"], "left_anti")
    )
    report = reduce(DataFrame.unionByName, reports)
    return _conclude(spark, root, run, folder, report, entries)


def _listed(spark: SparkSession, rows: DataFrame, column: str) -> list[str]:
    """The days that occur: no more than the calendar has."""
    day = F.date_format(column, "yyyy-MM-dd")
    return sorted(r[0] for r in rows.select(day).distinct().collect() if r[0])


def _frame(spark: SparkSession, days: list[str], column: str) -> DataFrame:
    return spark.createDataFrame([(d,) for d in days], "d string").select(
        F.to_date("d").alias(column)
    )


def publication_log(spark: SparkSession, root: str) -> DataFrame:
    """One row per run, also for runs that did not pass."""
    return spark.read.schema(PUBLICATION_DDL).parquet(f"{root.rstrip('/')}/publications")


def published_folder(spark: SparkSession, root: str) -> str | None:
    """Folder of the latest attempt that passed, or None."""
    try:
        log = publication_log(spark, root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return log.filter("passed").agg(F.max_by("folder", "published_at")).first()[0]


def snapshot(spark: SparkSession, root: str) -> DataFrame:
    """(table, day, folder) of everything that is published."""
    folder = published_folder(spark, root)
    if folder is None:
        raise LookupError(f"nothing is published below {root}")
    return spark.read.schema(SNAPSHOT_DDL).parquet(f"{folder}/snapshot")


def _read_snapshot(
    spark: SparkSession, entries: DataFrame, table: str, first_day=None, last_day=None
) -> DataFrame:
    """A stored table from the folders that hold its days, as one scan.

    The folder of every published day is listed by name; there are no more than the calendar
    has. Attempt and day are partitions below the table, so the plan is the same for a table
    that one rebuild wrote and for one that a thousand refreshes wrote.
    """
    shape, layout = mart_schemas(spark)[table], schemas.MART_LAYOUTS[table]
    held = entries.filter(F.col("table") == table)
    if first_day is not None:
        held = held.filter(F.col("day") >= str(first_day))
    if last_day is not None:
        held = held.filter(F.col("day") <= str(last_day))
    places = [(_tables(row.folder), row.day) for row in held.select("folder", "day").collect()]
    if not places:
        return spark.createDataFrame([], shape)
    day = layout.day_column
    extra = [] if day in shape.fieldNames() else [T.StructField(day, T.DateType())]
    full = T.StructType([*shape.fields, *extra, T.StructField("attempt", T.StringType())])
    root = _path(places[0][0][0], table)
    leaves = sorted(f"{_path(at, table, attempt)}/{day}={value}" for (at, attempt), value in places)
    stored = spark.read.schema(full).option("basePath", root).parquet(*leaves)
    return stored.select(*shape.fieldNames())


def fold_published(spark: SparkSession, root: str, run: str, min_days: int = 31) -> bool:
    """Rewrites published days that lie scattered over small attempts into one attempt.

    An attempt is small for a table if it holds fewer than ``min_days`` of its published days.
    The new snapshot names the folded days in the new attempt and all others where they lie, so
    readers see the same rows before and after. The report of the last published run goes with
    them. Returns whether there was anything to fold; attempts that no snapshot names can then
    be deleted.
    """
    before, folder = snapshot(spark, root), _attempt(root, run)
    tables, attempt = _tables(folder)
    # one row per stored table and calendar day at most
    by_attempt: dict[tuple[str, str], list[str]] = {}
    for row in before.collect():
        by_attempt.setdefault((row.table, row.folder), []).append(row.day)
    moved = []
    for table in sorted({name for name, _ in by_attempt}):
        small = [k for k, days in by_attempt.items() if k[0] == table and len(days) < min_days]
        if len(small) < 2:
            continue
        moved += [(table, day) for key in small for day in by_attempt[key]]
        entries = before.filter(F.col("folder").isin([old for _, old in small]))
        sinks.write_table(
            _read_snapshot(spark, entries, table), _path(tables, table, attempt),
            schemas.MART_LAYOUTS[table],
        )
    if not moved:
        return False
    gone = spark.createDataFrame(moved, "`table` string, day string")
    entries = before.join(gone, ["table", "day"], "left_anti").unionByName(
        gone.withColumn("folder", F.lit(folder))
    )
    report = spark.read.schema(REPORT_DDL).parquet(f"{published_folder(spark, root)}/report")
    return _conclude(spark, root, run, folder, report, entries)


def read_published(spark: SparkSession, root: str, table: str, first_day=None, last_day=None):
    """A published table, optionally limited to a range of its days."""
    return _read_snapshot(spark, snapshot(spark, root), table, first_day, last_day)


def mart_schemas(spark: SparkSession) -> dict:
    """Schemas of the stored tables, taken from the plans that make them."""
    out = {}
    for chain in CHAINS:
        branch = chain.branch(spark.createDataFrame([], chain.dataset.schema))
        out.update({name: branch[name].schema for name in (chain.facts, chain.daily)})
    return out
