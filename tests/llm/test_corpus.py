"""Stages of the corpus pipeline against plain versions."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wattline.llm import mixing, ngram_join
from wattline.llm.common import table

from . import frames
from .test_text import plain_order_selection


def plain_kept(rows, width=5, percent=80):
    """Ids that are the smallest of their component; ids are unique."""
    sets = [frames.shingles(r.text, width) for r in rows]
    links = [
        (i, j) for i, s in enumerate(sets) for j in range(i)
        if s and 100 * len(s & sets[j]) >= percent * len(s | sets[j])
    ]
    least = frames.least_linked([r.doc_id for r in rows], links)
    return sorted(r.doc_id for r, c in zip(rows, least) if r.doc_id == c)


def test_near_duplicates_share_five_words(spark, sf_dir):
    def changed(n, *at):
        return " ".join("other" + str(k) if k in at else f"w{n}x{k}" for k in range(n))

    # one changed word, and two far apart; below 0.9 on three words
    rows = [(1, changed(55)), (2, changed(55, 27)), (3, changed(100)), (4, changed(100, 30, 70)), (5, changed(40, 20)), (6, changed(40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()]
    assert sorted(kept) == plain_kept(docs.collect()) == [1, 3, 5, 6]
    docs = table(spark, sf_dir, "documents")
    kept = [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()]
    assert sorted(kept) == plain_kept(docs.collect())


@pytest.mark.parametrize("weight", [1.0, 0.1, 0.02, 1e-6])
def test_buckets_of_keys_stay_small_for_any_weight(spark, weight):
    keys = spark.range(20_000).select(mixing.sample_key(F.col("id"), F.lit("a"), F.lit(weight), 17).alias("key"))
    found = keys.select("key", mixing._bucket(F.col("key")).alias("bucket")).orderBy("key").collect()
    buckets = [r.bucket for r in found]
    assert buckets == sorted(buckets)
    assert max(map(buckets.count, set(buckets))) <= 30


def test_mixing_of_long_words_follows_the_keys(spark):
    rows = [(i, "x" * (2000 + 37 * (i % 50)) + " y" * (i % 3), f"s{i % 2}") for i in range(300)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.doc_id: r.copies for r in found} == plain_order_selection(found)


@pytest.mark.parametrize("ids", ["one", "null", "equal"])
def test_mixing_meets_targets_whatever_repeats(spark, ids):
    """Half of the rows share an id or have none, with texts of their own or all the same."""
    def text(i):
        return "five words are in this" if ids == "equal" else f"five words are in {i}"

    rows = [((None if ids == "null" else 7) if i % 2 else i, text(i) if i % 2 else f"a {i} c d e", f"s{i % 6 // 2}", i) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, edge long")
    found = mixing.mix(docs.repartition(6))
    assert {"doc_id", "text", "source", "edge"} <= set(found.columns)
    found = found.collect()
    assert sorted(r.edge for r in found) == list(range(6000))
    taken = defaultdict(int)
    for r in found:
        taken[r.source] += r.taken
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
    goals = {r.source: r.target for r in found}
    assert sum(goals.values()) == pytest.approx(30_000)
    for source, goal in goals.items():
        assert abs(taken[source] - goal) <= 2.5
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted((str(r.doc_id), r.text, r.taken) for r in again) == sorted((str(r.doc_id), r.text, r.taken) for r in found)


def test_bins_hold_the_copies_of_crowded_shingles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BIN_ROWS", 1000)
    members = spark.range(600).select(F.lit(7).cast("long").alias("token"), F.col("id").alias("sid"))
    sizes = [r["count"] for r in ngram_join._meetings(members, 2).groupBy("bin").count().collect()]
    assert sum(sizes) == 600 * 300 and max(sizes) <= 3000
    assert ngram_join._meetings(members.where("false"), 2).count() == 0


def test_rows_that_share_an_id_are_decided_by_their_texts(spark, sf_dir):
    base = [f"a{k}" for k in range(60)]
    near = base[:30] + ["changed"] + base[31:]
    far = [f"z{k}" for k in range(60)]
    rows = [(1, base), (5, far), (5, near), (7, ["same"]), (7, ["same"]), (9, ["one"]), (9, ["two"]), (3, []), (3, [])]
    own = [f"l{k}" for k in range(60)]
    rows += [(8, own), (8, own[:30] + ["changed"] + own[31:]), (None, ["same"])]
    docs = spark.createDataFrame([(i, " ".join(words)) for i, words in rows], "doc_id long, text string")
    kept = [(r.doc_id, r.text.split()) for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()]
    assert sorted((i, w) for i, w in kept if i not in (8, None)) == [
        (1, base), (3, []), (5, far), (7, ["same"]), (9, ["one"]), (9, ["two"]),
    ]
    assert [i for i, _ in kept].count(8) == 1 and (None, ["same"]) in kept
