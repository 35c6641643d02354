"""Audits how the filters of a corpus interact, in every order in which they may run.

1. One pass over the texts gives each document a mask of the filters it fails. The texts go no
   further: documents are then a few bytes each.
2. Documents of a part (a language, say) with the same mask are one cell: at most ``2**k`` cells
   per part for ``k`` filters, counted before anything is shuffled.
3. Per part, a walk in Gray-code order goes through all sets of filters, switching one filter
   at a time. Every cell keeps a counter of the active filters it fails; a cell leaves the
   survivors when its counter leaves zero, and comes back when it returns to zero. The survivors
   of all ``2**k`` states are stored.
4. Every step of every order is a difference of two such states.

Defined cases: a null text is an empty one, a null part is the empty string, a null id is no
smaller than any other, documents without a label are neither good nor toxic, of several labels
of an id any that says so counts, repeated rows count each, and an empty table has no parts.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import WORD, stored, table

STEP_DDL = (
    "part string, filter_order string, step int, filter string, kept long, removed long, "
    "redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def survivors(masks: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """Survivors of every set of active filters: ``2**k`` rows of as many numbers as ``counts``.

    ``masks`` has the filters that each cell fails as bits, ``counts`` a row of numbers a cell.
    """
    found = np.zeros((2**k, counts.shape[1]), np.int64)
    failing = np.zeros(len(masks), np.int64)
    now, state = counts.sum(axis=0), 0
    found[0] = now
    for number in range(1, 2**k):
        switched = (number & -number).bit_length() - 1
        touched = masks >> switched & 1 == 1
        state ^= 1 << switched
        if state >> switched & 1:
            now = now - counts[touched & (failing == 0)].sum(axis=0)
            failing[touched] += 1
        else:
            failing[touched] -= 1
            now = now + counts[touched & (failing == 0)].sum(axis=0)
        found[state] = now
    return found


def steps(states: np.ndarray, letters: str) -> list[tuple]:
    """All steps of all orders as differences of the states; columns of a state: documents,
    good and toxic ones."""
    everything, rows = len(states) - 1, []
    total = dict.fromkeys(letters, 0)
    for order in permutations(range(len(letters))):
        before = 0
        for number, place in enumerate(order, 1):
            bit = 1 << place
            after = before | bit
            removed, good, toxic = (int(x) for x in states[before] - states[after])
            redundant = int(states[0][0] - states[bit][0]) - removed
            alone = int(states[everything ^ bit][0] - states[everything][0])
            total[letters[place]] += removed
            rows.append((
                "".join(letters[i] for i in order), number, letters[place], int(states[after][0]),
                removed, redundant, alone, good, toxic,
            ))
            before = after
    return [(*row, total[row[2]]) for row in rows]


def audit(flags: DataFrame, letters: str, part: str, good: str, toxic: str) -> DataFrame:
    """One row per part, order of the filters and step.

    ``flags`` has one boolean column per letter, true for documents that fail that filter, the
    part, and two booleans that say which documents are good and toxic. Null counts as false.
    """
    failed = sum((F.coalesce(F.col(c), F.lit(False)).cast("int") * 2**i for i, c in enumerate(letters)), F.lit(0))
    cells = flags.groupBy(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), failed.alias("mask")).agg(
        F.count("*").alias("n"), F.count_if(F.col(good)).alias("good"), F.count_if(F.col(toxic)).alias("toxic")
    )

    def walk(cells: pa.Table) -> pa.Table:
        counts = np.stack([cells[name].to_numpy() for name in ("n", "good", "toxic")], axis=1)
        states = survivors(cells["mask"].to_numpy().astype(np.int64), counts, len(letters))
        columns = list(zip(*steps(states, letters)))
        kinds = [pa.string(), pa.int32(), pa.string()] + [pa.int64()] * 7
        own = pa.array([cells["part"][0].as_py()] * len(columns[0]), pa.string())
        return pa.table(
            [own, *(pa.array(c, kind) for c, kind in zip(columns, kinds))],
            [field.split()[0] for field in STEP_DDL.split(", ")],
        )

    return cells.groupBy("part").applyInArrow(walk, STEP_DDL)


def text_flags(text: Column) -> dict[str, Column]:
    """Failures that show in the text alone: few words, few distinct words, many capitals, marks."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    n = F.size(words)
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def repeats(rows: DataFrame, doc_id: str, digest: str, name: str) -> DataFrame:
    """Adds whether a row's text occurs with a smaller id.

    The smallest id of each text is found with partial minima. It comes back by id and text, so
    that a text which a third of all rows hold is met by one row, not by all of them.
    """
    least = rows.groupBy(F.col(digest).alias("_text")).agg(F.min(doc_id).alias("_least")).where("_least is not null")
    first = least.select("_text", "_least", F.lit(True).alias("_first"))
    met = (F.col(doc_id) == F.col("_least")) & (F.col(digest) == F.col("_text"))
    return rows.join(first, met, "left").withColumn(
        name, F.col("_first").isNull() & F.col(doc_id).isNotNull()
    ).drop("_text", "_least", "_first")


def op12_filter_audit(spark, sf_dir):
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    text = F.coalesce("text", F.lit(""))
    flags = text_flags(text)
    rows = stored(
        docs.select(
            "doc_id", "lang", F.unhex(F.sha2(text, 256)).alias("digest"),
            *(failed.alias(name) for name, failed in flags.items()),
        ),
        "audit-flags",
    )
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    known = repeats(rows, "doc_id", "digest", "E").join(marked, F.col("doc_id") == F.col("labelled"), "left")
    return audit(known, "ABCDE", "lang", "good", "toxic")


OP12_SQL = r"""
with d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
l as (select doc_id as i, max(quality = 1) as good, max(toxic = 1) as toxic from labels group by 1),
f as (
  select part,
    (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::int
    + 8 * regexp_matches(t, '[#$%&*|]')::int
    + 16 * coalesce(doc_id > min(doc_id) over (partition by t), false)::int as mask,
    coalesce(good, false) as good, coalesce(toxic, false) as toxic
  from d left join l on l.i = d.doc_id),
c as (
  select part, mask, count(*) as n, count(*) filter (good) as g, count(*) filter (toxic) as x
  from f group by part, mask),
k as (select i, 'ABCDE'[i + 1] as letter, 1 << i as bit from range(5) r(i)),
o as (
  select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order
  from k a, k b, k c, k d, k e
  where a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s as (
  select filter_order, k.i + 1 as step, filter_order[k.i + 1] as filter,
    1 << (ascii(filter_order[k.i + 1]) - 65) as bit,
    list_sum(list_transform(range(0, k.i), lambda j: 1 << (ascii(filter_order[j + 1]) - 65))) as before
  from o, k),
r as (
  select part, filter_order, step, filter,
    sum(case when mask & (bit | coalesce(before, 0)::int) = 0 then n else 0 end) as kept,
    sum(case when mask & coalesce(before, 0)::int = 0 and mask & bit <> 0 then n else 0 end) as removed,
    sum(case when mask & coalesce(before, 0)::int <> 0 and mask & bit <> 0 then n else 0 end) as redundant,
    sum(case when mask = bit then n else 0 end) as unique_fails,
    sum(case when mask & coalesce(before, 0)::int = 0 and mask & bit <> 0 then g else 0 end) as good_lost,
    sum(case when mask & coalesce(before, 0)::int = 0 and mask & bit <> 0 then x else 0 end) as toxic_lost
  from c, s group by part, filter_order, step, filter)
select part, filter_order, step::int as step, filter, kept::bigint as kept, removed::bigint as removed,
  redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost,
  toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, filter))::bigint as shapley
from r
"""
