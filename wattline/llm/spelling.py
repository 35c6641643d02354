"""Groups spelling variants of a corpus vocabulary with an index of variable-length grams.

1. Words are counted per task and added up; only words that occur ``least`` times go on.
2. Gram dictionary: every gram of ``shortest`` code points is in it; a gram is extended by a code
   point, up to ``longest``, where it is frequent, that is where it stands at more than one of
   ``share`` positions of the vocabulary. So at most ``share`` grams of a length are frequent and
   only those are held on the driver and sent to tasks.
3. A word, with marks at both ends, has at every position the gram that the dictionary gives
   there. A gram depends on its own code points alone, so one edit changes only grams over the
   edited place. The longest run of grams from the first to the last over any place is the
   word's bound of affected grams: a near word shares at least ``grams - bound`` grams with it,
   some of the first ones and some of the last ones.
4. Lists are merged on that threshold: a word stands in the lists of its first ``i`` and last
   ``t - i`` grams, for every ``i``. It asks at its own threshold and can be found at each lower
   one a near word may have. Two near words meet at the smaller of their thresholds. Thresholds
   over ``MOST`` count as ``MOST``, so the lists of a word stay few and short however long it is.
5. Words that meet are verified by edit distance inside the join; only near pairs leave it.

Defined cases: null texts have no words, a null id counts as an empty one, repeated rows count
each, words of any length are compared whole, and an empty table gives no rows. Extra columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import LOWER, UPPER, partitions, stored, table, workers

# The letters of a word, and marks that are not letters.
LETTERS = "A-Za-zÀ-ÿ"
START, END = "\x02", "\x03"
LOWERED = str.maketrans(UPPER, LOWER)
SHORTEST, LONGEST, SHARE = 3, 4, 20_000
FLUSH, MOST = 200_000, 12


def lowered(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(LOWERED)


def damaged(doc_id, run: str, one_in: int = 31) -> str:
    """The run without one code point for one in ``one_in`` digests of id and run."""
    digest = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if digest % one_in:
        return run
    at = digest % len(run)
    return run[:at] + run[at + 1 :]


def _flushed(counts: Counter, names: tuple[str, str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names
    )


def count_words(
    docs: DataFrame, min_length: int, least: int = 2, text: str = "text", doc_id: str = "doc_id",
    change=None,
) -> DataFrame:
    """(word, n) of all words of at least ``min_length`` code points.

    Words are lower-cased runs of letters. ``change`` gets the id and a run and returns the word
    it counts as, which is no longer than the run. A run is looked at once per document, and a
    task holds a bounded number of counts.
    """
    workers(docs.sparkSession)
    run = re.compile(f"[{LETTERS}]{{{min_length},}}")

    def count(batches):
        waiting = Counter()
        for batch in batches:
            for i, whole in zip(batch["id"].to_pylist(), batch["text"]):
                own = Counter()
                for found, n in Counter(run.findall(whole.as_py() or "")).items():
                    own[lowered(found)] += n
                for found, n in own.items():
                    word = change(i, found) if change else found
                    if len(word) >= min_length:
                        waiting[word] += n
                if len(waiting) >= FLUSH:
                    yield _flushed(waiting, ("word", "n"))
                    waiting = Counter()
        yield _flushed(waiting, ("word", "n"))

    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


def frequent_grams(
    words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, share: int = SHARE
) -> frozenset[str]:
    """Grams that the dictionary extends: at most ``share`` of every length below ``longest``."""

    def count(batches):
        waiting = Counter()
        for batch in batches:
            for word in batch["word"].to_pylist():
                marked = START + word + END
                for size in range(shortest, longest):
                    waiting.update(marked[p : p + size] for p in range(len(marked) - size + 1))
                if len(waiting) >= FLUSH:
                    yield _flushed(waiting, ("gram", "n"))
                    waiting = Counter()
        yield _flushed(waiting, ("gram", "n"))

    positions = words.agg(F.sum(F.length("word"))).first()[0] or 0
    counted = words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(
        F.sum("n").alias("n")
    )
    often = counted.where(F.col("n") > max(8, positions // share)).select("gram")
    return frozenset(often.toArrow()["gram"].to_pylist())


def decomposed(word: str, frequent: frozenset[str], shortest: int, longest: int):
    """Marked word, (start, stop) of its gram at every position, and its bound of affected grams.

    Grams count as affected by an edit from the first to the last one over its place, so that
    the others are the first and the last ones of the word.
    """
    marked = START + word + END
    last, grams, most = len(marked) - shortest, [], 0
    for start in range(last + 1):
        stop = start + shortest
        while stop < min(start + longest, len(marked)) and marked[start:stop] in frequent:
            stop += 1
        grams.append((start, stop))
    for place in range(1, len(word) + 1):
        earliest = max(0, place - longest + 1)
        first = next((p for p in range(earliest, min(place, last) + 1) if grams[p][1] > place), place)
        most = max(most, min(place, last) - first + 1)
    return marked, grams, most


def list_keys(word: str, frequent: frozenset[str], shortest: int, longest: int, min_length: int):
    """(key, own) of the lists that hold a word; own ones are of its own threshold."""
    marked, grams, affected = decomposed(word, frequent, shortest, longest)
    n = len(grams)
    # grams a word of min_length shares at least: as many as it has, less the longest gram
    lowest = min_length + 3 - shortest - longest
    own = min(MOST, n - affected)
    for threshold in range(min(own, max(lowest, n - 1 - longest)), own + 1):
        for first in range(threshold + 1):
            head = marked[: grams[first - 1][1]] if first else ""
            tail = marked[grams[n - threshold + first][0] :] if first < threshold else ""
            key = xxhash.xxh3_64_intdigest(f"{first},{threshold}\x00{head}\x00{tail}")
            yield key - 2**63, threshold == own


def near_words(
    words: DataFrame, min_length: int, shortest: int = SHORTEST, longest: int = LONGEST,
    share: int = SHARE,
) -> DataFrame:
    """(a, a_n, b, b_n) of all pairs of distinct words that differ by exactly one edit.

    ``words`` (word, n) are distinct and of at least ``min_length`` code points.
    """
    if min_length + 2 - shortest < longest:
        raise ValueError("words this short may share no gram: take shorter grams")
    spark = words.sparkSession
    workers(spark)
    frequent = frequent_grams(words, shortest, longest, share)

    def lists(batches):
        for batch in batches:
            at, keys, owned = [], [], []
            for i, word in enumerate(batch["word"].to_pylist()):
                for key, own in list_keys(word, frequent, shortest, longest, min_length):
                    at.append(i)
                    keys.append(key)
                    owned.append(own)
            chosen = batch.take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), *chosen.columns, pa.array(owned, pa.bool_())],
                ["key", *batch.schema.names, "own"],
            )

    # few bytes but much work a word, so that sizes of partitions say little
    dealt = words.select("word", "n").repartition(partitions(spark), "word")
    held = dealt.mapInArrow(lists, "key long, word string, n long, own boolean")
    asking = held.where("own").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    asked = held.select(F.col("key").alias("k"), F.col("word").alias("b"), F.col("n").alias("b_n"), "own")
    near = (
        (F.col("key") == F.col("k")) & (~F.col("own") | (F.col("a") < F.col("b")))
        & (F.abs(F.length("a") - F.length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1)
    )
    return asking.join(asked, near).select("a", "a_n", "b", "b_n").distinct()


def last_forms(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last.

    A step from every word takes twice as many forms each round, so rounds grow with the
    logarithm of the longest chain. A form is at least as frequent as its word times a factor
    over one, so chains are short and never close.
    """
    now = links.select("word", F.col("form").alias("root"))
    while True:
        ahead = now.toDF("at", "next")
        now = stored(
            now.join(ahead, F.col("root") == F.col("at"), "left")
            .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-roots",
        )
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.drop("moved")


def spelling_variants(words: DataFrame, min_length: int, factor: int = 10, **grams) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of ``words`` (word, n).

    The form is the most frequent near word (ties: the smallest) if it is at least ``factor``
    times as frequent, with ``factor`` over one.
    """
    words = stored(words.select("word", "n"), "spelling-words")
    near = stored(near_words(words, min_length, **grams), "spelling-near")
    sides = near.select("a", "a_n", "b", "b_n").unionByName(near.select(
        F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")
    ))
    best = sides.groupBy("a", "a_n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), "b")).alias("best")
    )
    good = -F.col("best.less") >= factor * F.col("a_n")
    found = stored(
        best.select(
            F.col("a").alias("near_word"), "n_near", F.when(good, F.col("best.b")).alias("form"),
            F.when(good, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = last_forms(found.where("form is not null").select(F.col("near_word").alias("word"), "form"))
    named = found.join(roots.toDF("w", "root"), F.col("near_word") == F.col("w"), "left").drop("w")
    return words.join(named, F.col("word") == F.col("near_word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        "form", "form_n", F.coalesce("root", "word").alias("root"),
    )


def op11_spelling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling_variants(count_words(docs, 7, 2, change=damaged), 7)
