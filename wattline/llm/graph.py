"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import stored


def _settled(edges: DataFrame) -> bool:
    """Whether every vertex hangs on one other, which hangs on nothing: one shuffle of sums."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("hung"), F.lit(0).alias("held")).unionByName(
        edges.select(F.col("b").alias("v"), F.lit(0).alias("hung"), F.lit(1).alias("held"))
    )
    vertices = ends.groupBy("v").agg(F.sum("hung").alias("hung"), F.max("held").alias("held"))
    return not vertices.agg(F.max((F.col("hung") + F.col("held") > 1) & (F.col("hung") > 0))).first()[0]


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(id, root) of all vertices but the roots; the root is the smallest id of a component.

    ``edges`` has columns a and b (long, in any order). Each round hangs the larger neighbours
    of a vertex on the smallest (large star), then all smaller neighbours likewise (small
    star), until only stars are left: a number of rounds that grows with the logarithm of the
    vertices. An edge always leads to its smaller end, so the centre of a star is its root.
    Minima are combined before they are shuffled, and the joins have one row per
    vertex on one side, so that hubs can be split. Every round is written to the shared folder.
    """
    now = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        label,
    )
    while not _settled(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        large = (
            both.where("b > a").join(least, F.col("a") == F.col("u"))
            .select(F.col("b").alias("a"), F.least("m", "u").alias("b")).distinct()
        )
        least = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        hung = large.join(least, F.col("a") == F.col("u"))
        small = (
            hung.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .distinct()
        )
        now = stored(small, label)
    return now.select(F.col("a").alias("id"), F.col("b").alias("root"))
