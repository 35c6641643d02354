"""Picking one row per business key.

Both operators are ``row_number() = 1``. Spark plans that filter as a group limit
before and after the shuffle: every map task first keeps one row per key, so a key
holding any share of the input sends at most one row per map task, and no group is
ever gathered whole.

The given order is completed by all other columns of the row. Without that, rows equal
on the order columns would tie arbitrarily, and a recomputed task could pick another one
than the task it replaces. An order given as a whole is left as it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _rest(df: DataFrame, named: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`").desc() for c in df.columns if c not in named]


def _first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


_REVISION = ("revision_number", "document_created_at")


def revision_order(ties: Sequence[str] = ()) -> list[Column]:
    """Highest revision, then latest creation, then the technical tie-breakers."""
    last = ["source_object_name", "document_id", "time_series_id", *ties]
    return [
        F.col("revision_number").try_cast("bigint").desc(),
        F.col("document_created_at").desc(),
        *[F.col(c).desc() for c in last],
    ]


def latest_version(
    df: DataFrame,
    grain: Sequence[str],
    ties: Sequence[str] = (),
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """The latest revision per ``grain``; null grain values form their own group."""
    if order is not None:
        return _first_by(df, grain, order)
    named = {*grain, *ties, *_REVISION, "source_object_name", "document_id", "time_series_id"}
    return _first_by(df, grain, [*revision_order(ties), *_rest(df, named)])


def first_duplicate(
    df: DataFrame, keys: Sequence[str], order_by: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The duplicate with the lowest ``order_by`` per key."""
    order = [F.col(order_by).asc(), *[F.col(c).desc() for c in ties]]
    return _first_by(df, keys, [*order, *_rest(df, {*keys, *ties, order_by})])
