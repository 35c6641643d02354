"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed ``fraction`` of all hashes. A document whose
shingles leave fewer than ``least`` there keeps its ``least`` smallest hashes, so that short
documents can be compared too; one with no more shingles than that keeps them all. The limit
up to which a sketch is complete follows from what it holds. Two sketches are compared below the
smaller of their limits, where both are complete, which gives unbiased estimates of the Jaccard
index and of containment for documents of any two sizes. The sketch of a union is the union of
sketches below the smallest limit.

``fingerprint`` is the number of distinct shingles, a colon, and the kept hashes in ascending
order, 8 bytes each, in base 64. Equal texts have equal fingerprints.

Defined cases: a null text is an empty one; a text without words has no shingles and the
fingerprint ``0:``, two such are alike (1), one is unlike any other (0); a text with fewer words
than a shingle is one shingle. Rows that share an id follow each other in the order in which
they are read, a null id comes after all others, the only row of a table follows itself, and an
empty table gives no rows. Extra columns are kept by ``fingerprints`` and ignored elsewhere.
"""

from __future__ import annotations

import base64
import hashlib
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import others, partitions, table, workers
from wattline.llm.shingles import shingle_set

WIDTH, FRACTION, LEAST = 5, 1 / 8, 32
# cut points of the order of documents come from so many sampled keys per range
SAMPLED = 64
WHOLE = np.uint64(2**64 - 1)


@dataclass(frozen=True)
class Sketch:
    """Distinct shingles, the kept hashes in order, and the limit up to which none is missing."""

    n: int
    kept: np.ndarray
    limit: np.uint64

    @property
    def text(self) -> str:
        return f"{self.n}:{base64.b64encode(self.kept.astype('<u8').tobytes()).decode()}"


def threshold(fraction: float) -> np.uint64:
    return np.uint64(min(2**64 - 1, int(fraction * 2**64)))


def _limit(n: int, kept: np.ndarray, fraction: float, least: int) -> np.uint64:
    if len(kept) == n:
        return WHOLE
    return kept[-1] if len(kept) <= least else threshold(fraction)


def sketch(text: str | None, width: int = WIDTH, fraction: float = FRACTION, least: int = LEAST) -> Sketch:
    hashes = shingle_set(text, width)
    below = int(np.searchsorted(hashes, threshold(fraction), "right"))
    kept = hashes[: max(below, least)]
    return Sketch(len(hashes), kept, _limit(len(hashes), kept, fraction, least))


def parsed(fingerprint: str, fraction: float = FRACTION, least: int = LEAST) -> Sketch:
    """The sketch that a fingerprint holds."""
    n, _, held = fingerprint.partition(":")
    kept = np.frombuffer(base64.b64decode(held), "<u8").astype(np.uint64)
    return Sketch(int(n), kept, _limit(int(n), kept, fraction, least))


def _common(x: Sketch, y: Sketch) -> tuple[int, int, int]:
    """Hashes of x, of y and of both below the smaller limit."""
    limit = min(x.limit, y.limit)
    a, b = (s.kept[: np.searchsorted(s.kept, limit, "right")] for s in (x, y))
    return len(a), len(b), len(np.intersect1d(a, b, assume_unique=True))


def likeness(x: Sketch, y: Sketch) -> float:
    """Estimated Jaccard index."""
    a, b, both = _common(x, y)
    return both / (a + b - both) if a + b else 1.0


def containment(x: Sketch, y: Sketch) -> float | None:
    """Estimated share of the shingles of x that y has; None where x keeps none so low."""
    a, _, both = _common(x, y)
    return both / a if a else None


def merged(x: Sketch, y: Sketch) -> Sketch:
    """Sketch of the union of both; ``n`` is estimated where it is not complete."""
    limit = min(x.limit, y.limit)
    kept = np.union1d(x.kept, y.kept)
    kept = kept[: np.searchsorted(kept, limit, "right")]
    n = len(kept) if limit == WHOLE else round(len(kept) * 2**64 / (int(limit) + 1))
    return Sketch(n, kept, limit)


def fingerprints(
    docs: DataFrame, text: str = "text", width: int = WIDTH, fraction: float = FRACTION, least: int = LEAST
) -> DataFrame:
    """Input columns, the text aside, with ``fingerprint``."""
    workers(docs.sparkSession)
    rows = docs.select(*others(docs, ("fingerprint", text)), F.col(text).alias("_text"))
    schema = rows.drop("_text").withColumn("fingerprint", F.lit("")).schema

    def made(batches):
        for batch in batches:
            found = [sketch(t.as_py(), width, fraction, least).text for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.string())], [*batch.schema.names[:-1], "fingerprint"]
            )

    return rows.mapInArrow(made, schema)


def compared(
    pairs: DataFrame, x: str, y: str, fraction: float = FRACTION, least: int = LEAST
) -> DataFrame:
    """Input columns with ``likeness`` and ``containment`` (of x in y) of two fingerprints."""
    rows = pairs.select(
        *others(pairs, ("likeness", "containment")), F.col(x).alias("_x"), F.col(y).alias("_y")
    )
    schema = rows.drop("_x", "_y").select(
        "*", F.lit(0.0).alias("likeness"), F.lit(None).cast("double").alias("containment")
    ).schema

    def measured(batches):
        for batch in batches:
            both = [
                [parsed(s or "0:", fraction, least) for s in batch.column(i).to_pylist()]
                for i in (batch.num_columns - 2, batch.num_columns - 1)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-2],
                    pa.array([likeness(a, b) for a, b in zip(*both)], pa.float64()),
                    pa.array([containment(a, b) for a, b in zip(*both)], pa.float64()),
                ],
                schema.names,
            )

    return rows.mapInArrow(measured, schema)


KEY_DDL = "struct<last:boolean,place:bigint,mark:bigint>"


def _ordered(docs: DataFrame, doc_id: str, text: str, ranges: int) -> DataFrame:
    """(part, guest, key, doc_id, text): rows of each range of the descending order of ids.

    Rows of a range stand together and the first row of the next range is among them as its
    ``guest``, so every row meets the one that follows it, and the last of all meets the first.
    The cut points are keys of a bounded sample. They fix which rows stand together and no
    result. Ids are read twice for them, texts are shuffled once. A mark of the place where a
    row was read completes the order, so rows that share an id are divided like all others.
    """
    spark = docs.sparkSession
    number = F.col(doc_id).cast("long")
    key = F.struct(
        number.isNull().alias("last"), F.coalesce(F.bitwise_not(number), F.lit(0).cast("long")).alias("place"),
        F.monotonically_increasing_id().alias("mark"),
    ).alias("key")
    keys = docs.select(key)
    total = keys.count()
    drawn = keys.sample(min(1.0, 1.2 * SAMPLED * ranges / max(1, total)), 7).collect()
    drawn = sorted((tuple(row.key) for row in drawn))
    cuts = drawn[:: max(1, len(drawn) // ranges)][1:]
    # the number of cuts at or before a key, by halving steps
    literal = F.from_json(
        F.lit(json.dumps([dict(zip(("last", "place", "mark"), cut)) for cut in cuts])), f"array<{KEY_DDL}>"
    )
    halves = [2**i for i in reversed(range(len(cuts).bit_length()))] or [1]
    part = F.aggregate(
        F.array(*map(F.lit, halves)), F.lit(0),
        lambda at, step: F.when(F.get(literal, at + step - 1) <= F.col("key"), at + step).otherwise(at),
    )
    firsts = keys.withColumn("part", part).groupBy("part").agg(F.min("key").alias("first")).orderBy("part").collect()
    before = {row.part: firsts[i - 1].part for i, row in enumerate(firsts)}
    opening = [dict(zip(("last", "place", "mark"), row.first)) | {"before": before[row.part]} for row in firsts]
    known = F.from_json(
        F.lit(json.dumps(opening)), "array<struct<last:boolean,place:bigint,mark:bigint,before:int>>"
    )
    numbers = {row.part: i for i, row in enumerate(firsts)}
    at = F.from_json(F.lit(json.dumps([numbers.get(i) for i in range(len(cuts) + 1)])), "array<int>")
    own = F.get(known, F.get(at, F.col("part")))
    first = F.struct(own["last"].alias("last"), own["place"].alias("place"), own["mark"].alias("mark"))
    once = F.array(F.struct(F.col("part"), F.lit(0).alias("guest")))
    twice = F.concat(once, F.array(F.struct(own["before"].alias("part"), F.lit(1).alias("guest"))))
    return (
        docs.select(key, number.alias("doc_id"), F.col(text).alias("text")).withColumn("part", part)
        .select("key", "doc_id", "text", F.inline(F.when(F.col("key") == first, twice).otherwise(once)))
        .repartition("part")
        .sortWithinPartitions("part", "guest", "key")
        .select("part", "guest", "doc_id", "text")
    )


EDITED_DDL = (
    "doc_id long, n_chars long, edited_text string, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, in_edited double, in_next double"
)


def edited(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH,
    fraction: float = FRACTION, least: int = LEAST, ranges: int | None = None, with_text: bool = False,
) -> DataFrame:
    """Fingerprints of every document and of its edited text, compared with each other and with
    the next document's.

    The edited text has the last half of its code points replaced by the first as many of the
    next document by descending id; the first follows the last. A task holds two texts at a time
    beside its batch. ``edited_text`` is null unless ``with_text``. ``docs`` is read three times
    and has to give its rows in the same places each time, as files do.
    """
    spark = docs.sparkSession
    workers(spark)

    def row(own, follows):
        doc_id, whole, known = own
        half = len(whole) // 2
        changed = whole[: len(whole) - half] + follows[1][:half]
        new = sketch(changed, width, fraction, least)
        return (
            doc_id, len(whole), changed if with_text else None, hashlib.sha256(changed.encode()).hexdigest(),
            known.text, new.text, likeness(known, new), likeness(known, follows[2]),
            containment(known, new), containment(known, follows[2]),
        )

    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 4, *[pa.float64()] * 4]
    names = [field.split()[0] for field in EDITED_DDL.split(", ")]

    def follow(batches):
        waiting = None
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                guest, whole = batch["guest"][i].as_py(), batch["text"][i].as_py() or ""
                now = (batch["doc_id"][i].as_py(), whole, sketch(whole, width, fraction, least))
                if waiting is not None:
                    rows.append(row(waiting, now))
                waiting = None if guest else now
            columns = zip(*rows) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    dealt = _ordered(docs, doc_id, text, ranges or 4 * partitions(spark))
    return dealt.mapInArrow(follow, EDITED_DDL)


def op13_fingerprints(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return edited(docs).drop("edited_text")
