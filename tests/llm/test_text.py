"""Tokens, quality, mixing and n-gram join against plain versions."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wattline.llm import bpe, mixing, ngram_join, quality, token_counts
from wattline.llm.common import table
from wattline.llm.shingles import shingle_set
from wattline.llm.vocabularies import load, public_path

from . import frames

WORDS, BYTES = public_path("word_bpe_49k.json"), public_path("byte_bpe_50k.json")
TEXTS = st.text(st.sampled_from(list("abeinth'sre!. 1\n\t\x1c\x85\xa0é́İΣ中<|>")), max_size=60)


def plain_ids(text, path=WORDS):
    return load(path).encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_tokens_equal_the_library(text):
    ids = plain_ids(text)
    assert bpe.codec(WORDS).encode(text).tolist() == ids
    assert bpe.codec(WORDS).decode(ids) == load(WORDS).decode(ids, skip_special_tokens=False)
    assert token_counts.counter(BYTES).count(text) == len(plain_ids(text, BYTES))


@settings(max_examples=200, deadline=None)
@given(st.text("abenths!Ã©", min_size=1, max_size=300), st.integers(1, 20))
def test_tree_concatenation_equals_whole_merging(symbols, leaf):
    encode = bpe.codec(WORDS).leaf
    assert bpe.tree_tokens(symbols, encode, leaf) == encode(symbols)
    parts = [symbols[i : i + leaf] for i in range(0, len(symbols), leaf)]
    assert bpe.joined([(p, encode(p)) for p in parts], encode) == encode(symbols)


@pytest.mark.parametrize("spread", [10, 5000, bpe.SPREAD])
def test_encoding_of_awkward_rows(spark, spread):
    docs = frames.awkward_docs(spark)
    found = bpe.encode(docs, WORDS, spread=spread)
    assert {"doc_id", "size", "_row", "ids", "decoded"} <= set(found.columns)
    rows = found.collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert r.ids == plain_ids(texts[r.doc_id])
        assert r.decoded == load(WORDS).decode(r.ids, skip_special_tokens=False)
    again = bpe.decode(found.drop("decoded"), WORDS).collect()
    assert sorted(r.decoded for r in again) == sorted(r.decoded for r in rows)
    assert bpe.encode(frames.empty_docs(spark), WORDS).count() == 0


def test_registered_encoding(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    for r in bpe.op7_bpe(spark, sf_dir).collect():
        ids = plain_ids(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = load(WORDS).decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_token_counts(spark, sf_dir):
    docs = frames.awkward_docs(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = token_counts.count_tokens(docs, BYTES).collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = texts[r.doc_id] or ""
        n = len(plain_ids(text, BYTES))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(text.encode()), n > 512)
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    for r in token_counts.op8_token_counts(spark, sf_dir).collect():
        assert r.n_tokens == len(plain_ids(texts[r.doc_id], BYTES))
    assert token_counts.count_tokens(frames.empty_docs(spark), BYTES).count() == 0


def walk(forest, x):
    """One row down every tree."""
    total = forest.base
    for node in forest.roots:
        while forest.left[node] != node:
            below = x[forest.feature[node]] <= forest.threshold[node]
            node = forest.left[node] if below else forest.right[node]
        total += forest.value[node]
    return 1 / (1 + math.exp(-total))


def test_forest_traversal_and_fit():
    rng = np.random.default_rng(2)
    x = rng.random((600, quality.N_FEATURES))
    y = ((x[:, 3] > 0.5) ^ (x[:, 7] > 0.3)).astype(float)
    forest = quality.grow(x[:400], y[:400])
    scores = forest.score(x)
    assert np.allclose(scores, [walk(forest, row) for row in x])
    assert ((scores[400:] > 0.5) == y[400:]).mean() > 0.9
    assert quality.grow(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]
    assert quality.grow(x[:9], np.ones(9)).score(x[:1])[0] > 0.9


def test_quality_on_held_out_rows(spark):
    rows = quality.op2_quality(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50
    assert all(r.predicted == (r.score >= quality.CUT) and 0 <= r.score <= 1 for r in rows)
    right = [r.predicted == labels[r.doc_id] for r in held]
    assert sum(right) / len(right) > 0.95


def test_quality_of_awkward_rows(spark, sf_dir):
    docs = frames.awkward_docs(spark)
    labels = spark.createDataFrame([(1, 0, 0), (3, 1, 0), (2, None, 0), (None, 1, 0), (5, 1, None), (7, 2, 1)], "doc_id long, quality int, toxic int")
    rows = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    none = quality.fit(docs, labels.where("false"))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(frames.empty_docs(spark), none).count() == 0


def plain_targets(sizes, cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, open_ = {}, set(names)
    rest = sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if rest * weight[s] / total > cap * sizes[s]}
        if not over:
            target |= {s: rest * weight[s] / total for s in open_}
            break
        target |= {s: float(cap * sizes[s]) for s in over}
        rest -= sum(cap * sizes[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("made", ["made", "awkward"])
def test_mixing(spark, made):
    docs = frames.made_docs(spark, 600) if made == "made" else frames.awkward_docs(spark)
    found = mixing.mix(docs)
    assert {"doc_id", "_row", "size"} <= set(found.columns)
    rows = found.collect()
    assert len(rows) == docs.count()
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.size == len(frames.words(r.text))
        assert r.taken == r.size * r.copies and r.copies <= 3
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    target = plain_targets(dict(sizes))
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
    for source, goal in target.items():
        assert abs(taken[source] - goal) <= largest[source] / 2 + 1
    again = sorted((str(r.doc_id), r.taken) for r in mixing.mix(docs.repartition(5)).collect())
    assert again == sorted((str(r.doc_id), r.taken) for r in rows)
    assert mixing.mix(frames.empty_docs(spark)).count() == 0


def plain_order_selection(rows, seed=17):
    """Documents whose middle word lies within the fractional budget, in key order."""
    by_source = defaultdict(list)
    for r in rows:
        digest = hashlib.md5(f"{seed}:{r.doc_id}:{r.text}".encode()).hexdigest()
        u = (int(digest[:13], 16) + 1) / (2**52 + 1)
        weight = 1 / (1 + abs(len(r.text) / max(1, r.size) - 6))
        by_source[r.source].append((-math.log(u) / weight, r.doc_id, r.size))
    copies = {}
    for source, docs in by_source.items():
        size = sum(d[2] for d in docs)
        goal = next(r.target for r in rows if r.source == source)
        epochs = min(3, int(goal // size))
        at = 0
        for _, doc_id, n in sorted(docs):
            copies[doc_id] = epochs + (at + n / 2 <= goal - epochs * size)
            at += n
    return copies


def test_mixing_follows_the_keys(spark):
    rows = mixing.mix(frames.made_docs(spark, 500)).collect()
    copies = plain_order_selection(rows)
    assert {r.doc_id: r.copies for r in rows if r.size} == {r.doc_id: copies[r.doc_id] for r in rows if r.size}


def plain_join(rows, width=3, percent=90):
    sets = [frames.shingles(r.text, width) for r in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    links = set()
    for i, s in enumerate(sets):
        for j in {j for x in s for j in holders[x] if j > i}:
            if 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                links.add((i, j))
    least = frames.least_linked([r.doc_id for r in rows], links)
    return sorted((str(r.doc_id), len(s), str(c)) for r, s, c in zip(rows, sets, least))


@pytest.mark.parametrize("block,heavy,crowd", [(2048, 100_000, 10_000), (2048, 0, 32), (16, 10, 3), (16, 0, 1)])
def test_ngram_join(spark, block, heavy, crowd):
    docs = frames.made_docs(spark, 400).unionByName(frames.awkward_docs(spark).withColumn("doc_id", _shift()))
    found = ngram_join.similar_documents(docs, block=block, heavy=heavy, crowd=crowd).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == plain_join(docs.collect())


def _shift():
    from pyspark.sql import functions as F

    return F.col("doc_id") + 1000


def test_pairs_are_written_where_groups_meet_first(spark):
    """Random postings, each shingle in a bin of its own: the same pairs, near copies once."""
    rng = random.Random(5)
    held = {g: sorted(rng.sample(range(1, 25), 12)) for g in range(30)}
    held |= {g: held[0] for g in range(30, 36)}
    crowded, dense = {3, 4, 11, 12, 20}, {g: g % 3 == 0 for g in held}
    postings = [
        (t, pos, g, t in crowded, dense[g]) for g, tokens in held.items() for pos, t in enumerate(tokens)
    ]
    met = spark.createDataFrame(postings, "token long, pos long, gid long, crowded boolean, dense boolean")
    rows = ngram_join._remembering(met).selectExpr(
        "*", "gid as sid", "gid div 2 as part", "20L as n", "cast(repeat('a', 32) as binary) as narrow",
        "0 as own", "0 as first", "0 as second",
    ).toArrow()
    forgetful = rows
    for i in range(ngram_join.EARLIER):
        at = forgetful.schema.get_field_index(f"earlier{i}")
        forgetful = forgetful.set_column(at, f"earlier{i}", pa.array([0] * rows.num_rows, pa.int64()))

    def pairs(table):
        bins = [ngram_join._cross(table.filter(pc.field("token") == t), 70) for t in range(1, 25)]
        return [(a, b) for found in bins for a, b in zip(found["a"].to_pylist(), found["b"].to_pylist())]

    every, once = pairs(forgetful), pairs(rows)
    assert set(once) == set(every) and len(set(every)) > 200
    assert len(once) < len(every)
    copies = [(a, b) for a, b in once if a >= 30]
    assert len(copies) == len(set(copies)) == 12


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
def test_similar_sets_have_kept_shingles_in_common(percent):
    """As many as a group must share to go on, in any order of the shingles."""
    rng, found = random.Random(percent), 0
    assert all(
        ngram_join.common_length(n, percent) <= ngram_join.common_length(n + 1, percent) for n in range(1, 3000)
    )
    for _ in range(3000):
        n = rng.randint(1, 120)
        more = rng.randint(0, n * (100 - percent) // percent + 1)
        x, y = range(n), set(rng.sample(range(n), n - rng.randint(0, min(n, more)))) | {n + k for k in range(more)}
        if 100 * len(y.intersection(x)) < percent * len(y.union(x)):
            continue
        found += 1
        rank = rng.sample(range(n + more), n + more)
        kept = [set(sorted(z, key=rank.__getitem__)[: ngram_join.kept_length(len(z), percent)]) for z in (x, y)]
        common = len(kept[0] & kept[1])
        assert common >= max(ngram_join.common_length(len(z), percent) for z in (x, y))
    assert found > 100


def test_groups_that_share_too_little_go_no_further(spark, monkeypatch):
    """Texts that share a passage each with another one, far from similar, and one near pair."""
    texts = []
    for i in range(200):
        own = [f"t{i}w{k}" for k in range(60)]
        texts.append(own + [f"p{i // 2}x{k}" for k in range(6)])
    texts.append(texts[0][:64] + ["changed"])
    kept = {}
    stored = ngram_join.stored

    def counted(df, label):
        out = stored(df, label)
        kept[label] = out
        return out

    monkeypatch.setattr(ngram_join, "stored", counted)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    found = ngram_join.similar_documents(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == plain_join(docs.collect())
    assert kept["ngram-met"].select("gid").distinct().count() == 2


def test_stars_leave_out_groups_of_other_sizes(spark, monkeypatch):
    """Long and short texts of the same words meet often; only those of like sizes are compared."""
    base = [f"w{k}" for k in range(120)]
    texts = [base[: 30 + 9 * (i % 10)] + [f"own{i}"] for i in range(60)]
    tried = []
    near = ngram_join._near

    def counted(pairs, sets, percent):
        size = {r.sid: r.n for r in sets.collect()}
        tried.append([(size[r.a], size[r.b]) for r in pairs.collect()])
        return near(pairs, sets, percent)

    monkeypatch.setattr(ngram_join, "_near", counted)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    found = ngram_join.similar_documents(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == plain_join(docs.collect())
    assert tried[0] and all(100 * min(pair) >= 90 * max(pair) for pair in tried[0])


@pytest.mark.parametrize("value", [None, "5GB"])
def test_the_join_leaves_the_session_as_it_was(spark, value):
    """Filters of join keys are for the texts alone: elsewhere each costs stages and driver memory."""
    name = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    try:
        assert ngram_join.similar_documents(frames.awkward_docs(spark)).count() == 16
        assert spark.conf.get(name, None) == value
    finally:
        spark.conf.unset(name)


def test_ngram_join_lower_limit_and_empty(spark):
    docs = frames.made_docs(spark, 200, seed=8)
    found = ngram_join.similar_documents(docs, percent=70, block=32).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == plain_join(docs.collect(), percent=70)
    assert ngram_join.similar_documents(frames.empty_docs(spark)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(list("abcAB \t\n")), max_size=80), st.integers(1, 5))
def test_shingle_sets(text, width):
    assert len(shingle_set(text, width)) == len(frames.shingles(text, width))
