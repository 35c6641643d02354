"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of the whole text are cut into at most ``BINS`` bins per feature. Every tree grows
level by level from gradient and hessian sums per bin. The forest is flattened into arrays, and
numpy walks all rows of a batch down all levels of a tree at once.

Fitting uses at most ``sample`` labelled rows (default 20,000), the ones whose hashed id is
smallest in share; nothing else is bounded. Labels whose crc32(doc_id as text) is divisible by
``HELD_OUT`` are never learned from. Doc_id, language, source and labels are no features.

Defined cases: a null text counts as empty, and an empty text gets a score like any other; a
label that is null or neither 0 nor 1 is ignored; without usable labels every score is 0.5, with
one class only every score is near that class; repeated rows stay; an input column named like an
output column is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import extended, others, table, workers

OUTPUTS = ("held_out", "score", "predicted")
HELD_OUT, SAMPLE, BINS, TREES, DEPTH, RATE = 5, 20_000, 64, 60, 4, 0.2
CUT = 0.3

# Classes of bytes whose shares are features; bytes of no class come last.
CLASSES = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r",
    b"\n", b".,;:", b"!?", b"#$%&*@^~", b"|_=+<>", b"'\"()-[]{}/\\`", bytes(range(128, 256)),
)
_CLASS = np.full(256, len(CLASSES), np.uint8)
for _n, _members in enumerate(CLASSES):
    _CLASS[list(_members)] = _n
N_FEATURES = len(CLASSES) + 1 + 11


def statistics(text: str | None) -> list[float]:
    """The features of one whole text."""
    raw = (text or "").encode()
    size = max(1, len(raw))
    shares = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=len(CLASSES) + 1) / size
    words, lines = raw.split(), raw.split(b"\n")
    n, n_lines = max(1, len(words)), len(lines)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    different, line_set = set(words), set(lines)
    return [
        *shares,
        np.log1p(len(raw)),
        lengths.sum() / n,
        lengths.max(initial=0) / n,
        np.count_nonzero(lengths <= 3) / n,
        lengths.std() if len(words) else 0.0,
        len(different) / n,
        len(different) / n**0.5,
        sum(map(eq, words, words[1:])) / n,
        len(line_set) / n_lines,
        sum(map(len, line_set)) / size,
        np.log1p(len(words) / n_lines),
    ]


@dataclass
class Forest:
    """Trees as arrays: a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        rows, total = np.arange(len(x)), np.full(len(x), self.base)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                below = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(below, self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def _cuts(column: np.ndarray) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1]))


def grow(
    x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
    ridge: float = 1.0, least: float = 2.0,
) -> Forest:
    """Fits log-loss trees; ``least`` is the hessian that both sides of a split need."""
    rate_of_one = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(rate_of_one / (1 - rate_of_one)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def add() -> int:
        me = len(feature)
        feature.append(0), threshold.append(np.inf), left.append(me), right.append(me), value.append(0.0)
        return me

    cuts = [_cuts(x[:, f]) for f in range(x.shape[1])] if len(y) else []
    binned = [np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)]
    total = np.full(len(y), base)
    for _ in range(trees if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        roots.append(add())
        level, place = [roots[-1]], np.zeros(len(y), np.int64)  # place: node within its level
        node = np.full(len(y), roots[-1])
        for _ in range(depth):
            best = [(0.0, None, None)] * len(level)
            on = place >= 0
            for f, bins in enumerate(binned):
                shape = (len(level), BINS)
                slot = place[on] * BINS + bins[on]
                gs = np.cumsum(np.bincount(slot, g[on], shape[0] * BINS).reshape(shape), axis=1)
                hs = np.cumsum(np.bincount(slot, h[on], shape[0] * BINS).reshape(shape), axis=1)
                ga, ha = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (ga - gs) ** 2 / (ha - hs + ridge) - ga**2 / (ha + ridge)
                gain[(hs < least) | (ha - hs < least)] = 0
                at = gain[:, : len(cuts[f])].argmax(axis=1) if len(cuts[f]) else None
                for k in range(len(level)) if at is not None else ():
                    if gain[k, at[k]] > best[k][0] + 1e-12:
                        best[k] = (gain[k, at[k]], f, int(at[k]))
            following, new_place = [], np.full(len(y), -1)
            for k, (_, f, at) in enumerate(best):
                if f is None:
                    continue
                me, mine = level[k], place == k
                feature[me], threshold[me] = f, cuts[f][at]
                left[me], right[me] = add(), add()
                for child, side in ((left[me], binned[f] <= at), (right[me], binned[f] > at)):
                    node[mine & side] = child
                    new_place[mine & side] = len(following)
                    following.append(child)
            level, place = following, new_place
            if not level:
                break
        gs, hs = np.bincount(node, g, len(feature)), np.bincount(node, h, len(feature))
        for leaf in np.unique(node):
            value[leaf] = float(-rate * gs[leaf] / (hs[leaf] + ridge))
        total += np.array(value)[node]
    return Forest(
        np.array(feature, np.int32), np.array(threshold, np.float64), np.array(left, np.int32),
        np.array(right, np.int32), np.array(value, np.float64), np.array(roots, np.int32), depth, base,
    )


def held_out(doc_id: str):
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text) % HELD_OUT == 0


def _sampled(labels: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` labels to learn from: those with the smallest hashed ids."""
    usable = labels.where(F.col("quality").isin(0, 1) & ~held_out("doc_id")).select("doc_id", "quality")
    n = usable.count()
    if n > sample:
        share = F.pmod(F.xxhash64("doc_id"), F.lit(2**31)) / F.lit(float(2**31))
        usable = usable.where(share < 0.95 * sample / n)
    return usable.limit(sample)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE) -> Forest:
    """Learns from ``labels`` (doc_id, quality) and the texts of the same ids.

    Only the sampled labels are broadcast and only their statistics come to the driver.
    """
    workers(docs.sparkSession)
    chosen = F.broadcast(_sampled(labels, sample).withColumnRenamed("doc_id", "_id"))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(chosen, "_id")

    def features(batches):
        for batch in batches:
            found = [statistics(t.as_py()) for t in batch["_text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], batch["quality"].cast(pa.int32()), pa.array(found, pa.list_(pa.float64()))],
                ["_id", "quality", "x"],
            )

    id_type = docs.schema[doc_id].dataType.simpleString()
    found = rows.mapInArrow(features, f"_id {id_type}, quality int, x array<double>")
    read = found.limit(sample).collect()  # an id may repeat in the documents
    read.sort(key=lambda r: (str(r["_id"]), r["quality"], r["x"]))
    x = np.array([r["x"] for r in read], np.float64).reshape(-1, N_FEATURES)
    return grow(x, np.array([r["quality"] for r in read], np.float64))


def score(docs: DataFrame, forest: Forest, text: str = "text", doc_id: str = "doc_id", keep_text: bool = False) -> DataFrame:
    """Input columns (the text only if asked for) with ``held_out``, ``score``, ``predicted``."""
    workers(docs.sparkSession)
    columns = others(docs, OUTPUTS if keep_text else (*OUTPUTS, text))
    rows = docs.select(*columns, F.col(text).alias("_text"), held_out(doc_id).alias("held_out"))
    schema = extended(rows.drop("_text").schema, "score double, predicted int")

    def scores(batches):
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch["_text"]], np.float64)
            found = forest.score(x.reshape(-1, N_FEATURES))
            rest = batch.drop_columns(["_text"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(found), pa.array((found >= CUT).astype(np.int32))],
                [*rest.schema.names, "score", "predicted"],
            )

    return rows.mapInArrow(scores, schema)


def op2_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
