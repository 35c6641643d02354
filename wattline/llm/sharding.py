"""Resharding by minimum-cost flow: sizes become near equal and the fewest bytes move.

A layout holds rows in shards, and each shard in blocks: one folder per block. Within a block a
row knows its place and where it begins on the line of bytes that the block's rows form.

Resharding looks at block sizes only. All bytes are a flow from old shards to new ones, bounded
by what the old hold and the new can take; a byte that changes its shard costs one, a byte that
stays costs nothing. The flow is solved by shortest augmenting paths, on as many nodes as there
are shards. What flows from one shard to another is one stretch of the old shard's line, so
whole blocks move and few are cut. Rows that lie in one stretch follow it. Rows that straddle the
end of a stretch, one per end at most, are placed one by one, largest first: they stay while they
fit, and else go to the emptiest shard. So do rows as large as a whole new shard, of which there
are no more than new shards: they are placed before the flow, which then fills the other shards
alike. Only blocks that lose a row are written again; all others keep their files.

Defined cases: a null text has size 16; rows of a null or negative old shard start in shard 0;
repeated rows are rows of their own, and equal texts are not kept together, since one group may
be larger than a shard; an empty table makes an empty layout; column names cannot clash, as the
input row is stored as a struct.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm.common import stored, table
from wattline.session import work_folder

LEAST_BLOCK, MOST_BLOCK, BLOCKS = 4 << 20, 256 << 20, 10_000


def min_cost_flow(supply, demand, cost) -> np.ndarray:
    """Bytes from each old to each new shard, at least total cost; both sides add up alike."""
    left, room = np.array(supply, np.int64), np.array(demand, np.int64)
    cost = np.array(cost, np.float64)
    flow = np.zeros(cost.shape, np.int64)
    while left.any():
        # shortest ways from any old shard with bytes left, forth over all arcs, back over used ones
        old = np.where(left > 0, 0.0, np.inf)
        via_old, via_new = np.full(len(room), -1), np.full(len(left), -1)
        new = np.full(len(room), np.inf)
        while True:
            forth = old[:, None] + cost
            best = forth.min(axis=0)
            nearer = best < new
            new[nearer], via_old[nearer] = best[nearer], forth.argmin(axis=0)[nearer]
            back = np.where(flow > 0, new[None, :] - cost, np.inf)
            best = back.min(axis=1)
            nearer = best < old
            if not nearer.any():
                break
            old[nearer], via_new[nearer] = best[nearer], back.argmin(axis=1)[nearer]
        end = int(np.where(room > 0, new, np.inf).argmin())
        path, j = [], end
        while True:
            i = int(via_old[j])
            path.append((i, j))
            if via_new[i] < 0:
                break
            j = int(via_new[i])
        amount = min(left[i], room[end], *(flow[i, k] for (i, _), (_, k) in zip(path, path[1:])))
        for (i, j), after in zip(path, [*path[1:], None]):
            flow[i, j] += amount
            if after:
                flow[i, after[1]] -= amount
        left[path[-1][0]] -= amount
        room[end] -= amount
    return flow


def fill(loads, capacities, total: int) -> np.ndarray:
    """Whole numbers adding up to ``total`` that raise all loads to one share of capacity."""
    loads, capacities = np.array(loads, np.float64), np.maximum(np.array(capacities, np.float64), 1e-9)
    low, high = 0.0, (loads.sum() + total + 1) / capacities.min()
    for _ in range(200):
        level = (low + high) / 2
        if np.maximum(0, level * capacities - loads).sum() <= total:
            low = level
        else:
            high = level
    given = np.floor(np.maximum(0, low * capacities - loads)).astype(np.int64)
    rest = total - int(given.sum())
    each = np.full(len(given), rest // len(given))
    each[np.argsort((loads + given) / capacities, kind="stable")[: rest % len(given)]] += 1
    return given + each


@dataclass
class Plan:
    """Stretches (old, from, to, new) of bytes, bytes of each new shard, new shards of single rows."""

    stretches: list[tuple[int, int, int, int]]
    capacities: list[int]
    loads: list[int]
    single: dict[tuple[int, int, int], int]

    def moved(self, old: int, low: int, high: int) -> bool:
        return any(o == old != n and a < high and b > low for o, a, b, n in self.stretches)

    def ends(self) -> list[tuple[int, int]]:
        """Places (old, byte) where one stretch ends and another begins."""
        return [(old, low) for old, low, _, _ in self.stretches if low > 0]

    def settle(self, straddling: list[tuple[int, int, int, int, int]]) -> None:
        """Places rows (size, shard, block, place, first byte) that lie in several stretches."""
        for size, shard, _, _, first in straddling:
            for old, low, high, new in self.stretches:
                if old == shard:
                    self.loads[new] -= max(0, min(high, first + size) - max(low, first))
        _place(self.loads, self.capacities, [row[:4] for row in straddling], self.single)


def _place(loads, capacities, rows, places) -> None:
    """Rows (size, shard, block, place), largest first: home while they fit, else the emptiest shard."""
    waiting = []
    for size, shard, block, place in sorted(rows, key=lambda c: (-c[0], *c[1:])):
        if shard < len(loads) and loads[shard] + size <= max(capacities[shard], size):
            loads[shard] += size
            places[shard, block, place] = shard
        else:
            waiting.append((size, shard, block, place))
    roomy = [(load - capacity, j) for j, (load, capacity) in enumerate(zip(loads, capacities))]
    heapq.heapify(roomy)
    for size, shard, block, place in waiting:
        lack, j = heapq.heappop(roomy)
        places[shard, block, place] = j
        loads[j] += size
        heapq.heappush(roomy, (lack + size, j))


def plan(held: dict[int, int], whole: list[tuple[int, int, int, int]], capacities: list[int]) -> Plan:
    """``held``: bytes by old shard; ``whole``: rows (size, shard, block, place) as large as a
    new shard, which ``held`` leaves out."""
    n = len(capacities)
    loads, places = [0] * n, {}
    _place(loads, capacities, whole, places)
    olds = sorted(held)
    given = fill(loads, capacities, sum(held.values()))
    cost = [[0 if old == new else 1 for new in range(n)] for old in olds]
    flow = min_cost_flow([held[old] for old in olds], given, cost) if olds else np.zeros((0, n))
    stretches = []
    for old, amounts in zip(olds, flow):
        at = 0
        for new in sorted(np.flatnonzero(amounts).tolist(), key=lambda new: (new != old, new)):
            stretches.append((old, at, at + int(amounts[new]), new))
            at += int(amounts[new])
    aims = [load + int(more) for load, more in zip(loads, given)]
    return Plan(stretches, aims, list(aims), places)


def sizes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")


@dataclass
class Layout:
    """Where shards lie, all their bytes, and the size from which a row fills a new shard."""

    folder: str
    schema: T.StructType
    total: int
    whole: int


def lay_out(docs: DataFrame, shard: Column, n_old: int, n_new: int, folder: str, text: str = "text") -> Layout:
    """Writes the old layout."""
    shard = F.least(F.greatest(F.coalesce(shard.cast("int"), F.lit(0)), F.lit(0)), F.lit(n_old - 1))
    rows = docs.select(F.struct("*").alias("row"), shard.alias("s_shard"), sizes(F.col(text)).alias("s_size"))
    held = {r[0]: r[1] for r in rows.groupBy("s_shard").agg(F.sum("s_size")).collect()}
    total = sum(held.values())
    whole = max(1, -(-total // n_new))
    block_bytes = max(LEAST_BLOCK, min(MOST_BLOCK, total // BLOCKS))
    blocks = F.array(*(F.lit(max(1, -(-held.get(s, 0) // block_bytes))) for s in range(n_old)))
    placed = rows.withColumn(
        "s_block",
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.element_at(blocks, F.col("s_shard") + 1)).cast("int"),
    )
    order = Window.partitionBy("s_shard", "s_block").orderBy(F.desc("s_size"), F.xxhash64("row"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    flowing = F.when(F.col("s_size") < whole, F.col("s_size")).otherwise(0)
    laid = placed.withColumn("s_place", F.row_number().over(order) - 1).withColumn(
        "s_start", F.coalesce(F.sum(flowing).over(before), F.lit(0))
    )
    laid.write.partitionBy("s_shard", "s_block").option("compression", "zstd").parquet(folder)
    return Layout(folder, laid.schema, total, whole)


def _read(spark: SparkSession, folder: str, paths: list[str], schema) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", folder).schema(schema).parquet(*paths)


def reshard(spark: SparkSession, layout: Layout, new_folder: str, capacities: list[int]) -> DataFrame:
    """The new layout: (row, s_shard, s_size, piece, s_place) of every row, read from its files.

    ``piece`` names the file group a row lies in: a kept block, or what a shard got from a block.
    """
    folder, schema, whole = layout.folder, layout.schema, layout.whole
    path = lambda key: f"{folder}/s_shard={key[0]}/s_block={key[1]}"
    old = spark.read.schema(schema).parquet(folder)
    flowing = F.when(F.col("s_size") < whole, F.col("s_size")).otherwise(0)
    # one row per block, as in the list of files that the driver holds anyway
    blocks = [
        (r["s_shard"], r["s_block"], r["held"])
        for r in old.groupBy("s_shard", "s_block").agg(F.sum(flowing).alias("held")).collect()
    ]
    large = [
        (r["s_size"], r["s_shard"], r["s_block"], r["s_place"])
        for r in old.where(F.col("s_size") >= whole)
        .select("s_size", "s_shard", "s_block", "s_place").collect()
    ]
    lines, starts = {}, {}
    for shard, block, held in sorted(blocks):
        starts[shard, block] = lines.get(shard, 0)
        lines[shard] = starts[shard, block] + held
    at = spark.createDataFrame([(*k, v) for k, v in starts.items()], "b_shard int, b_block int, b_start long")
    here = (F.col("s_shard") == F.col("b_shard")) & (F.col("s_block") == F.col("b_block"))
    chosen = plan(lines, large, capacities)

    # rows in which a stretch ends, from the blocks in which one does
    ends = spark.createDataFrame(chosen.ends(), "e_shard int, e_at long")
    cut = {
        (shard, block) for shard, block, held in blocks for end in chosen.ends()
        if end[0] == shard and starts[shard, block] < end[1] < starts[shard, block] + held
    }
    first, size = F.col("b_start") + F.col("s_start"), F.col("s_size")
    straddling = (
        _read(spark, folder, [path(key) for key in sorted(cut)], schema)
        .where(size < whole).join(F.broadcast(at), here)
        .join(
            F.broadcast(ends),
            (F.col("s_shard") == F.col("e_shard")) & (F.col("e_at") > first) & (F.col("e_at") < first + size),
            "left_semi",
        )
        .select("s_size", "s_shard", "s_block", "s_place", first.alias("first")).collect()
    )
    chosen.settle([tuple(row) for row in straddling])
    touched = {key[:2] for key, new in chosen.single.items() if new != key[0]}
    touched |= {
        (shard, block) for shard, block, held in blocks
        if chosen.moved(shard, starts[shard, block], starts[shard, block] + held)
    }
    kept = _read(spark, folder, [path(b[:2]) for b in sorted(blocks) if b[:2] not in touched], schema)
    affected = _read(spark, folder, [path(key) for key in sorted(touched)], schema)

    # small tables: blocks, stretches (fewer than old times new shards), rows placed one by one
    ways = spark.createDataFrame(chosen.stretches, "w_shard int, w_from long, w_to long, w_new int")
    fixed = spark.createDataFrame(
        [(*k, v) for k, v in chosen.single.items()], "c_shard int, c_block int, c_place int, c_new int"
    )
    inside = (first >= F.col("w_from")) & (first < F.col("w_to"))
    sent = (
        affected.join(F.broadcast(at), here)
        .join(F.broadcast(ways), (F.col("s_shard") == F.col("w_shard")) & (size < whole) & inside, "left")
        .join(
            F.broadcast(fixed),
            (F.col("s_shard") == F.col("c_shard")) & (F.col("s_block") == F.col("c_block"))
            & (F.col("s_place") == F.col("c_place")), "left",
        )
        .select(
            "row", "s_size", "s_place", F.concat_ws("-", F.lit("got"), "s_shard", "s_block").alias("piece"),
            F.coalesce("c_new", "w_new", "s_shard").alias("s_shard"),
        )
    )
    sent.write.partitionBy("s_shard").option("compression", "zstd").parquet(new_folder)
    got = spark.read.schema(sent.schema).parquet(new_folder)
    return kept.select(
        "row", "s_shard", "s_size", F.concat_ws("-", F.lit("block"), "s_block").alias("piece"), "s_place"
    ).unionByName(got)


def slots(rows: DataFrame) -> DataFrame:
    """Rows with ``slot``: gapless within a shard, in order of piece and place.

    Pieces are numbered first, so that no task sorts a whole shard.
    """
    counted = rows.groupBy(F.col("s_shard").alias("p_shard"), F.col("piece").alias("p")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("p_shard").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    first = counted.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    within = Window.partitionBy("s_shard", "piece").orderBy("s_place")
    return (
        rows.withColumn("k", F.row_number().over(within) - 1)
        .join(first, (F.col("s_shard") == F.col("p_shard")) & (F.col("piece") == F.col("p")))
        .withColumn("slot", (F.col("first") + F.col("k")).cast("long"))
        .drop("k", "first", "p_shard", "p", "n")
    )


def equal_shares(spark: SparkSession, docs: DataFrame, shard: Column, n_old: int, n_new: int) -> DataFrame:
    """Documents laid out in ``n_old`` shards and moved to ``n_new`` of near equal size."""
    folder = work_folder(spark, "shards-old")
    layout = lay_out(docs, shard, n_old, n_new, folder)
    each, rest = divmod(layout.total, n_new)
    capacities = [each + (j < rest) for j in range(n_new)]
    return reshard(spark, layout, work_folder(spark, "shards-new"), capacities)


OLD, NEW = 32, 40


def op1_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    old = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(OLD))
    rows = equal_shares(spark, docs, old, OLD, NEW)
    narrow = stored(
        rows.select(
            F.col("row.doc_id").alias("doc_id"), sizes(F.col("row.text")).alias("size"),
            F.crc32(F.coalesce("row.text", F.lit(""))).alias("text_crc32"),
            "s_shard", "piece", "s_place",
        ),
        "shard-slots",
    )
    return slots(narrow).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("s_shard").alias("shard"),
        "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
