"""Near-duplicate vectors by a forest of random-projection trees.

Equal vectors count as one with a weight. Every tree cuts space by random hyperplanes at the
median; a vector that lies within a margin of a cut goes to both sides. Vectors that share a leaf
are compared, in double precision; a pair is counted in the smallest leaf number that it shares
in the whole forest, so no pair counts twice and none needs to be written. Links of a leaf become
stars (each vector to the smallest of its connected part), and the stars of all leaves are united.

The hyperplanes are fitted on at most ``sample`` vectors (default 20,000, those with the
smallest hashed row numbers in share); every vector is filed and compared. A cut that would send
nine tenths of a node to one side, as in a cluster of near copies, is not made. A leaf with more
than ``block`` vectors is compared block by block in tasks of their own, all of it.

Defined cases: vectors that are null, empty or zero or hold null or non-finite components link
with nothing; vectors link only with vectors of their own length; repeated rows are rows of
their own; a null id belongs to a component but never names it unless all ids are null; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import stored, table, workers
from wattline.llm.graph import components
from wattline.llm.topk import usable

SIMILAR, TREES, MARGIN, LEAF, SAMPLE, BLOCK = 0.9, 6, 0.4, 1024, 20_000, 2048
FOUND = "node long, links long, root long"


class Tree:
    """Cuts of one tree: node n has children 2n + 1 and 2n + 2."""

    def __init__(self, x: np.ndarray, total: int, margin: float, leaf: int, rng):
        depth = max(0, int(np.ceil(np.log2(max(1, total) / leaf) * 1.4)))
        self.directions = rng.standard_normal((depth, x.shape[1]))
        self.directions /= np.linalg.norm(self.directions, axis=1, keepdims=True)
        self.margin, self.cuts = margin, {}
        least = max(16, leaf * len(x) / max(1, total))
        waiting = [(0, 0, np.arange(len(x)))]
        while waiting:
            node, level, rows = waiting.pop()
            if level == depth or len(rows) <= least:
                continue
            place = x[rows] @ self.directions[level]
            cut = float(np.median(place))
            left, right = rows[place <= cut + margin], rows[place >= cut - margin]
            if max(len(left), len(right)) > 0.9 * len(rows):
                continue
            self.cuts[node] = cut
            waiting += [(2 * node + 1, level + 1, left), (2 * node + 2, level + 1, right)]

    def leaves(self, x: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(leaf, rows) of all leaves that rows of ``x`` fall into."""
        found, waiting = [], [(0, 0, np.arange(len(x)))]
        while waiting:
            node, level, rows = waiting.pop()
            if not len(rows):
                continue
            cut = self.cuts.get(node)
            if cut is None:
                found.append((node, rows))
                continue
            place = x[rows] @ self.directions[level]
            waiting.append((2 * node + 1, level + 1, rows[place <= cut + self.margin]))
            waiting.append((2 * node + 2, level + 1, rows[place >= cut - self.margin]))
        return found


def unit(rows) -> np.ndarray:
    """Rows of a list column as unit vectors in double precision; all of one length."""
    column = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of huge or tiny components stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def forest(sample: dict[int, np.ndarray], totals: dict[int, int], similar: float, trees: int, margin: float, leaf: int, seed: int):
    """Trees for every vector length seen in the sample."""
    grown = {}
    for dim, x in sorted(sample.items()):
        rng = np.random.default_rng([seed, dim])
        # the margin is a share of the usual distance, along one direction, of a pair at the limit
        usual = (2 - 2 * similar) ** 0.5 / dim**0.5
        grown[dim] = [Tree(x, totals[dim], margin * usual, leaf, rng) for _ in range(trees)]
    return grown


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each vertex's connected part."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, label[a], low)
        np.minimum.at(after, label[b], low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    return label


def _compare(rows: pa.Table, similar: float) -> pa.Table:
    """Links within a leaf, or between two blocks of a large one."""
    leaf, first, second = (rows[c][0].as_py() for c in ("leaf", "first", "second"))
    node = rows["node"].to_numpy()
    rows = rows.take(pa.array(np.argsort(node, kind="stable")))
    node, weight = rows["node"].to_numpy(), rows["weight"].to_numpy()
    own = rows["own"].to_numpy()
    lists = rows["leaves"].combine_chunks()
    ends, all_leaves = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy()
    x = unit(rows["v"])
    links = np.zeros(len(node), np.int64)
    pairs_a, pairs_b = [], []
    for start in range(0, len(node), 256):
        some = np.arange(start, min(start + 256, len(node)))
        near = x[some] @ x[start:].T >= similar
        i, j = np.nonzero(near)
        i, j = some[i], j + start
        keep = i < j
        if first != second:
            keep &= own[i] != own[j]
        i, j = i[keep], j[keep]
        pairs_a.append(i)
        pairs_b.append(j)
        for k in np.unique(i):
            others_ = j[i == k]
            mine = all_leaves[ends[k] : ends[k + 1]]
            # the smallest leaf both have: leaves are sorted, so it is their first common one
            smaller = mine[mine < leaf]
            if len(smaller):
                lengths = ends[others_ + 1] - ends[others_]
                places = np.repeat(ends[others_], lengths) + (
                    np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                )
                earlier = np.isin(all_leaves[places], smaller)
                seen = np.bincount(np.repeat(np.arange(len(others_)), lengths), earlier, len(others_)) > 0
                others_ = others_[~seen]
            links[k] += weight[others_].sum()
            links[others_] += weight[k]
    roots = _roots(len(node), np.concatenate(pairs_a or [[]]).astype(int), np.concatenate(pairs_b or [[]]).astype(int))
    said = (links > 0) | (roots != np.arange(len(node)))
    return pa.table(
        [pa.array(node[said]), pa.array(links[said]), pa.array(node[roots][said])],
        [field.split()[0] for field in FOUND.split(", ")],
    )


def near_duplicates(
    vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", similar: float = SIMILAR,
    trees: int = TREES, margin: float = MARGIN, leaf: int = LEAF, sample: int = SAMPLE,
    block: int = BLOCK, seed: int = 23,
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    spark = vectors.sparkSession
    workers(spark)
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"),
        (usable(F.col(vector)) & F.exists(vector, lambda x: x != 0)).alias("usable"),
    ).withColumn("hash", F.xxhash64("v"))
    good = rows.where("usable")
    equal = stored(
        good.groupBy("hash", "v")
        .agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id()),
        "near-distinct",
    )
    totals = {r["dim"]: r["n"] for r in equal.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).collect()}
    n = sum(totals.values())
    share = F.pmod(F.xxhash64("node"), F.lit(2**31)) / F.lit(float(2**31))
    chosen = equal.where(share < 0.95 * sample / n) if n > sample else equal
    by_length: dict[int, list] = {}
    for r in chosen.select("node", "v").limit(sample).collect():
        by_length.setdefault(len(r["v"]), []).append((r["node"], r["v"]))
    fitted = {
        dim: unit(pa.array([v for _, v in sorted(found)], pa.list_(pa.float64())))
        for dim, found in by_length.items()
    }
    grown = forest(fitted, totals, similar, trees, margin, leaf, seed)

    def file(batches):
        for batch in batches:
            lengths = batch["v"].value_lengths().to_numpy()
            for dim in np.unique(lengths):
                part = batch.filter(pa.array(lengths == dim))
                x, found = unit(part["v"]), [[] for _ in range(part.num_rows)]
                number = 0
                for tree in grown.get(int(dim), ()):
                    for node, members in tree.leaves(x):
                        for i in members:
                            found[i].append(number + node)
                    number += 2 ** 40
                found = [sorted(f) or [0] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [part["node"], part["v"], part["weight"], pa.array(lengths[lengths == dim], pa.int32()),
                     pa.array(found, pa.list_(pa.int64()))],
                    ["node", "v", "weight", "dim", "leaves"],
                )

    kind = equal.schema["v"].dataType.simpleString()
    filed = stored(
        equal.select("node", "v", "weight").mapInArrow(
            file, f"node long, v {kind}, weight long, dim int, leaves array<long>"
        ),
        "near-filed",
    )
    full = filed.select("dim", F.explode("leaves").alias("leaf")).groupBy("dim", "leaf").agg(
        F.ceil(F.count("*") / block).cast("int").alias("blocks")
    ).where("blocks > 1").select(F.col("dim").alias("d"), F.col("leaf").alias("l"), "blocks")
    placed = filed.select("*", F.explode("leaves").alias("leaf")).join(
        full, (F.col("dim") == F.col("d")) & (F.col("leaf") == F.col("l")), "left"
    ).withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    meeting = placed.select(
        "node", "v", "weight", "dim", "leaves", "leaf", "own",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).withColumn("first", F.least("own", "other")).withColumn("second", F.greatest("own", "other"))
    found = stored(
        meeting.groupBy("dim", "leaf", "first", "second")
        .applyInArrow(lambda rows: _compare(rows, similar), FOUND),
        "near-links",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "near-parts")
    named = (
        equal.select("hash", "v", "node", "weight", "least")
        .join(links.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
        .join(parts, F.col("node") == F.col("id"), "left")
        .withColumn("part", F.coalesce("root", "node"))
    )
    named = stored(
        named.select("hash", "v", "part", "least", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
        "near-named",
    )
    names = named.groupBy(F.col("part").alias("p")).agg(F.min("least").alias("component_id"))
    answers = named.join(names, F.col("part") == F.col("p")).select("hash", "v", "n_links", "component_id")
    linked = good.join(answers, ["hash", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op10_near_vectors(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP10_SQL = """
with recursive v as (
  select vec_id, row_number() over () as n, cast(embedding as double[]) as e,
    embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0 as usable
  from embeddings),
links as (
  select a.n as a, b.n as b from v a join v b on a.n <> b.n and len(a.e) = len(b.e)
  where a.usable and b.usable and list_cosine_similarity(a.e, b.e) >= 0.9),
reached as (
  select n as a, n as b from v union select r.a, l.b from reached r join links l on r.b = l.a),
parts as (
  select r.a as n, min(v.vec_id) as component_id from reached r join v on r.b = v.n group by r.a)
select v.vec_id, (select count(*) from links l where l.a = v.n) as n_links, p.component_id,
  v.vec_id is not distinct from p.component_id as kept
from v join parts p on v.n = p.n
"""
