"""Exact top-k search by integer inner product, with a KD-tree in every shard.

Rows are dealt to shards by row, so that no value makes a shard hot. A shard's task builds a
KD-tree: median splits along the widest side, and tight bounding boxes. A query walks the tree
best first: the box that could hold the largest inner product comes next, and the walk ends when
no box can reach the query's k-th score. Every query first searches its home shard; the k-th
score found there goes along to all other shards, where boxes below it are never opened.

Queries travel in blocks of bounded size, so a task holds one shard and one block.

Components are turned into floor(scale * x). Defined cases: vectors that are null or hold null
or non-finite components take no part; vectors meet only vectors of their own length; ties go to
the smaller id, null ids last; repeated rows are rows of their own; scores that no long can hold
stop at its ends; a query with fewer than k candidates gets all; extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import stored, table, workers

LEAST_SHARDS, LEAF = 12, 64
# Rows of a shard and queries of a block: larger where there are more, so that less travels.
LEAST_ROWS, MOST_ROWS = 8192, 131_072
FOUND = "query long, query_id long, vec_id long, score long"
LONG = 2**63 - 1


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def whole_numbers(rows: pa.Table, scale: int) -> np.ndarray:
    """Rows of floor(scale * x): exact as doubles where all sums stay exact, else as objects."""
    flat = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(flat * scale).reshape(rows.num_rows, -1)
    if x.size and np.abs(x).max() ** 2 * x.shape[1] >= 2.0**52:
        return np.array([[int(c) for c in row] for row in x], dtype=object)
    return x


class KdTree:
    """Boxes of nodes in arrays; a leaf knows its rows."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x, self.low, self.high, self.child, self.rows = x, [], [], [], []
        waiting = [(np.arange(len(x)), self._add(x))]
        while waiting:
            rows, node = waiting.pop()
            if len(rows) <= leaf:
                self.rows[node] = rows
                continue
            axis = int(np.argmax(self.high[node] - self.low[node]))
            order = rows[np.argsort(x[rows, axis], kind="stable")]
            halves = order[: len(order) // 2], order[len(order) // 2 :]
            self.child[node] = tuple(self._add(x[half]) for half in halves)
            waiting += zip(halves, self.child[node])
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _add(self, x: np.ndarray) -> int:
        self.low.append(x.min(axis=0))
        self.high.append(x.max(axis=0))
        self.child.append(None)
        self.rows.append(None)
        return len(self.low) - 1

    def search(self, q: np.ndarray, ids: np.ndarray, k: int, least, own: int = -1) -> list:
        """(score, -id, row) of the k best; ``least`` is a score that k rows elsewhere reach."""
        bounds = self.high @ np.maximum(q, 0) + self.low @ np.minimum(q, 0)
        heap, best = [(-bounds[0], 0)], []
        while heap:
            bound, node = heapq.heappop(heap)
            if least is not None and -bound < least:
                break
            if self.child[node]:
                for child in self.child[node]:
                    if least is None or bounds[child] >= least:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            rows = self.rows[node]
            scores = self.x[rows] @ q
            if scores.dtype == object:
                scores = np.clip(scores, -LONG - 1, LONG)
            for i in range(len(rows)) if least is None else np.flatnonzero(scores >= least):
                row = int(rows[i])
                if row == own:
                    continue
                entry = (int(scores[i]), -int(ids[row]), row)
                if len(best) < k:
                    heapq.heappush(best, entry)
                else:
                    heapq.heappushpop(best, entry)
                if len(best) == k and (least is None or best[0][0] > least):
                    least = best[0][0]
        return best


def _answers(found: list[tuple]) -> pa.Table:
    names = [field.split()[0] for field in FOUND.split(", ")]
    columns = list(zip(*found)) if found else [()] * len(names)
    return pa.table([pa.array(c, pa.int64()) for c in columns], names)


def _ids(rows: pa.Table) -> np.ndarray:
    return rows["vec_id"].fill_null(LONG).to_numpy()


def _found(query: int, query_id: int, ids: np.ndarray, best: list) -> list[tuple]:
    return [
        (query, query_id, None if ids[row] == LONG else int(ids[row]), max(-LONG - 1, min(LONG, score)))
        for score, _, row in best
    ]


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256,
    vector: str = "embedding", vec_id: str = "vec_id", shard_rows: int | None = None,
    block_queries: int | None = None,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best other rows for every query row."""
    workers(vectors.sparkSession)
    total = vectors.count()
    room = min(MOST_ROWS, max(LEAST_ROWS, total // 64))
    shard_rows, block_queries = shard_rows or room, block_queries or room
    shards = max(LEAST_SHARDS, -(-total // shard_rows))
    rows = stored(
        vectors.where(usable(F.col(vector))).select(
            F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"),
            F.col(vector).alias("v"), F.size(vector).alias("dim"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        ).withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")),
        "top-k-rows",
    )

    def at_home(shard: pa.Table) -> pa.Table:
        x, ids = whole_numbers(shard, scale), _ids(shard)
        tree, found = KdTree(x), []
        numbers = shard["row"].to_numpy()
        for i in np.flatnonzero(shard["asks"].to_numpy()):
            best = tree.search(x[i], ids, k, None, own=int(i))
            found += _found(int(numbers[i]), int(ids[i]), ids, best)
        return _answers(found)

    home = stored(rows.groupBy("dim", "shard").applyInArrow(at_home, FOUND), "top-k-home")
    kth = home.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(
        F.col("n") == k
    )
    asking = rows.where("asks").join(kth, F.col("row") == F.col("query"), "left")
    blocks = max(1, -(-rows.where("asks").count() // block_queries))
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")
    travelling = asking.select(
        "row", "vec_id", "v", "dim", "least", F.col("shard").alias("from"), block.alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    ).where("shard <> from")
    standing = rows.select(
        "vec_id", "v", "dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    ).toDF("vec_id", "v", "dim_", "shard_", "block_")

    def abroad(shard: pa.Table, queries: pa.Table) -> pa.Table:
        if not shard.num_rows or not queries.num_rows:
            return _answers([])
        x, ids, found = whole_numbers(shard, scale), _ids(shard), []
        q = whole_numbers(queries, scale)
        if x.dtype != q.dtype:
            x, q = (np.array([[int(c) for c in r] for r in a], dtype=object) for a in (x, q))
        tree = KdTree(x)
        asked = zip(*(queries[c].to_pylist() for c in ("row", "vec_id", "least")))
        for i, (query, query_id, least) in enumerate(asked):
            found += _found(query, query_id, ids, tree.search(q[i], ids, k, least))
        return _answers(found)

    away = standing.groupBy("dim_", "shard_", "block_").cogroup(
        travelling.groupBy("dim", "shard", "block")
    ).applyInArrow(abroad, FOUND)
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return (
        home.unionByName(away).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op6_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 50 == 0)


OP6_SQL = """
with v as (
  select row_number() over () as n, vec_id,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.n, q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) as bigint) as score
  from v q join v c on q.n <> c.n and len(q.e) = len(c.e) where q.vec_id % 50 = 0),
ranked as (
  select query_id, vec_id, score,
    cast(row_number() over (partition by n order by score desc, vec_id nulls last) as integer) as rank
  from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""
