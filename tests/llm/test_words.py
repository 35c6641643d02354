"""Spelling variants, filter audit and fingerprints against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattline.llm import filter_audit, fingerprints, spelling
from wattline.llm.common import table

from . import frames

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_counts(rows, min_length=7):
    counts = Counter()
    for r in rows:
        for run in RUN.findall(r.text or ""):
            low = run.translate(frames.LOWER)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{low}".encode())
            if h % 31 == 0:
                k = h % len(low)
                low = low[:k] + low[k + 1 :]
            if len(low) >= min_length:
                counts[low] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    at = next((i for i, x in enumerate(a) if x != b[i]), len(a))
    return len(b) == len(a) + 1 and a[at:] == b[at + 1 :]


def plain_variants(counts):
    near, holes = defaultdict(set), defaultdict(set)
    for w in counts:
        for k in range(len(w) + 1):
            holes[w[:k], w[k + 1 :], "replaced"].add(w) if k < len(w) else None
            holes[w[:k], w[k:], "added"].add(w)
            if k < len(w):
                holes[w[:k], w[k + 1 :], "added"].add(w)
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, n, len(near[w]), form[w], counts.get(form[w]), root))
    return sorted(rows, key=str)


def variants(df):
    return sorted(((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()), key=str)


def test_registered_spelling(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").collect()
    expected = plain_variants(plain_counts(rows))
    assert len(expected) > 1000 and any(r[3] for r in expected)
    assert variants(spelling.op11_spelling(spark, sf_dir)) == expected


@pytest.mark.parametrize("shortest,longest,share", [(3, 4, 20_000), (2, 5, 50), (3, 6, 30), (3, 3, 10)])
def test_near_words_of_a_dense_vocabulary(spark, shortest, longest, share):
    r = random.Random(5)
    words = {"".join(r.choice("abé") for _ in range(r.randint(7, 9))) for _ in range(900)}
    words |= {"a" * k for k in range(7, 14)} | {"ab" * 2000, "ab" * 2000 + "c", "x" + "ab" * 2000, "ab" * 1000 + "q" + "ab" * 1000}
    counts = {w: r.choice([2, 3, 25, 400, 5000]) for w in sorted(words)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = spelling.spelling_variants(frame, 7, shortest=shortest, longest=longest, share=share)
    assert variants(found) == plain_variants(counts)


def test_too_long_grams_are_refused(spark):
    with pytest.raises(ValueError):
        spelling.near_words(spark.createDataFrame([], "word string, n long"), 5, 3, 5)


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=7, max_size=16), st.integers(0, 16), st.sampled_from("abc"), st.sampled_from("idr"), st.integers(0, 3))
def test_near_words_meet(word, at, letter, kind, seed):
    at %= len(word)
    other = word[:at] + ("" if kind == "d" else letter) + (word[at:] if kind == "i" else word[at + 1 :])
    if other == word or len(other) < 7:
        return
    r = random.Random(seed)
    for longest in (3, 4, 5, 6):
        frequent = frozenset("".join(r.choice("abc") for _ in range(r.randint(3, 5))) for _ in range(40))
        lists = [dict(spelling.list_keys(w, frequent, 3, longest, 7)) for w in (word, other)]
        assert any(lists[0][k] or lists[1][k] for k in lists[0].keys() & lists[1].keys())


def test_spelling_of_awkward_rows(spark):
    docs = frames.awkward_docs(spark).unionByName(
        spark.createDataFrame([(None, "Zebrafish ZEBRAFISH zebrafishx Ünïcödeé×÷ ünïcödeé×÷", None, None, None, "", 1)] * 3, frames.DOCS)
    )
    found = spelling.spelling_variants(spelling.count_words(docs, 7, change=spelling.damaged), 7)
    assert variants(found) == plain_variants(plain_counts(docs.collect()))
    assert spelling.spelling_variants(spelling.count_words(frames.empty_docs(spark), 7), 7).count() == 0


def test_chains_of_forms(spark):
    links = [(f"w{k}", f"w{k + 1}") for k in range(21)] + [("a", "w7"), ("b", "c")]
    found = {r.word: r.root for r in spelling.last_forms(spark.createDataFrame(links, "word string, form string")).collect()}
    assert found == {**{f"w{k}": "w21" for k in range(21)}, "a": "w21", "b": "c"}


def plain_audit(rows, labels):
    """Applies the filters one after the other, in every order."""
    good = {x.doc_id for x in labels if x.quality == 1 and x.doc_id is not None}
    toxic = {x.doc_id for x in labels if x.toxic == 1 and x.doc_id is not None}
    least, docs = {}, defaultdict(list)
    for r in rows:
        if r.doc_id is not None:
            least[r.text or ""] = min(least.get(r.text or "", r.doc_id), r.doc_id)
    for r in rows:
        text = r.text or ""
        words = frames.WORD.findall(text)
        failed = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": r.doc_id is not None and least[text] < r.doc_id,
        }
        docs[r.lang or ""].append(({k for k, v in failed.items() if v}, r.doc_id in good, r.doc_id in toxic))
    out = []
    for part, found in docs.items():
        made, total = [], Counter()
        for order in permutations("ABCDE"):
            left = found
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[0]]
                left = [d for d in left if letter not in d[0]]
                total[letter] += len(gone)
                fails = sum(letter in d[0] for d in found)
                made.append((
                    part, "".join(order), step, letter, len(left), len(gone), fails - len(gone),
                    sum(d[0] == {letter} for d in found), sum(d[1] for d in gone), sum(d[2] for d in gone),
                ))
        out += [(*m, total[m[3]]) for m in made]
    return sorted(out)


def audited(docs, labels):
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "lang", text.alias("digest"), *(c.alias(k) for k, c in filter_audit.text_flags(text).items()))
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    known = filter_audit.repeats(rows, "doc_id", "digest", "E").join(marked, F.col("doc_id") == F.col("labelled"), "left")
    return filter_audit.audit(known, "ABCDE", "lang", "good", "toxic")


def test_registered_audit(spark, sf_dir):
    rows, labels = (table(spark, sf_dir, name).collect() for name in ("documents", "labels"))
    found = filter_audit.op12_filter_audit(spark, sf_dir)
    assert sorted(map(tuple, found.collect())) == plain_audit(rows, labels)
    assert found.columns == [f.split()[0] for f in filter_audit.STEP_DDL.split(", ")]


def test_audit_of_awkward_rows(spark):
    docs = frames.awkward_docs(spark).unionByName(frames.made_docs(spark, 120).withColumn("doc_id", F.col("doc_id") + 5))
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (4, None, 1), (9, 1, None), (50, 1, 1)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, audited(docs, labels).collect())) == plain_audit(docs.collect(), labels.collect())
    assert audited(frames.empty_docs(spark), labels).count() == 0
    assert audited(docs.limit(0), labels.where("false")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 31), st.integers(0, 9)), max_size=40))
def test_walk_stores_every_state(cells):
    masks = np.array([m for m, _ in cells], np.int64)
    counts = np.array([[n, n // 2, 1] for _, n in cells], np.int64).reshape(-1, 3)
    states = filter_audit.survivors(masks, counts, 5)
    for state in range(32):
        assert states[state].tolist() == counts[masks & state == 0].sum(axis=0).tolist()


def plain_sketch(text, width=5, fraction=1 / 8, least=32):
    hashes = sorted(int(h) for h in fingerprints.shingle_set(text, width))
    kept = [h for i, h in enumerate(hashes) if h <= int(fraction * 2**64) or i < least]
    limit = 2**64 if len(kept) == len(hashes) else kept[-1] if len(kept) <= least else int(fraction * 2**64)
    return len(hashes), kept, limit


def plain_likeness(x, y):
    low = min(x[2], y[2])
    a, b = ({h for h in s[1] if h <= low} for s in (x, y))
    return len(a & b) / len(a | b) if a | b else 1.0


def check_edited(found, rows):
    """Against a plain walk through the ids in descending order; ids are unique or null."""
    order = sorted(rows, key=lambda r: (r.doc_id is None, -(r.doc_id or 0)))
    got = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    for own, after in zip(order, order[1:] + order[:1]):
        text, other = own.text or "", after.text or ""
        half = len(text) // 2
        new = text[: len(text) - half] + other[:half]
        r = got[own.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        plain, changed = plain_sketch(text), plain_sketch(new)
        assert fingerprints.parsed(r.fingerprint).kept.tolist() == plain[1]
        assert fingerprints.parsed(r.edited_fingerprint).kept.tolist() == changed[1]
        assert r.near_edited == plain_likeness(plain, changed)
        assert r.near_next == plain_likeness(plain, plain_sketch(other))


def test_registered_fingerprints(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").collect()
    found = fingerprints.op13_fingerprints(spark, sf_dir).collect()
    check_edited(found, rows)
    by_text = defaultdict(set)
    texts = {r.doc_id: r.text for r in rows}
    for r in found:
        by_text[texts[r.doc_id]].add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


@pytest.mark.parametrize("ranges", [1, 3, 40, 500])
def test_fingerprints_of_awkward_rows(spark, tmp_path, ranges):
    rows = {r.doc_id: r for r in frames.awkward_docs(spark).collect()}
    docs = spark.createDataFrame(list(rows.values()) + frames.made_docs(spark, 90).withColumn("doc_id", F.col("doc_id") * 7919 - 10**6).collect(), frames.DOCS)
    docs.repartition(5).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    check_edited(fingerprints.edited(docs, ranges=ranges).collect(), docs.collect())
    with_text = fingerprints.edited(docs, ranges=ranges, with_text=True).collect()
    assert all(hashlib.sha256(r.edited_text.encode()).hexdigest() == r.edited_sha256 for r in with_text)
    assert fingerprints.edited(docs.where("false")).count() == 0
    alone = fingerprints.edited(docs.where("doc_id = 4")).collect()
    assert [(r.doc_id, r.near_next) for r in alone] == [(4, 1.0)]
    kept = fingerprints.fingerprints(docs.withColumn("fingerprint", F.lit(3)))
    assert set(kept.columns) == set(docs.columns) - {"text"} | {"fingerprint"} and kept.count() == docs.count()


def test_rows_that_share_an_id_follow_each_other(spark, tmp_path):
    texts = [f"own words of row {k} and a few more to tell" for k in range(60)]
    rows = [(7 if k % 3 else k, t) for k, t in enumerate(texts)] + [(7, "equal")] * 30
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    found = fingerprints.edited(docs, ranges=12, with_text=True).collect()
    assert sorted((r.doc_id, r.n_chars) for r in found) == sorted((i, len(t)) for i, t in rows)
    # every text is the next one of exactly one row: its start ends one edited text
    ends = Counter(r.edited_text[-(r.n_chars // 2) :] for r in found if r.n_chars > 10)
    assert ends.most_common(1)[0][1] <= 31 and len(ends) > 40


def test_estimates_are_near_the_truth():
    r = random.Random(3)
    for size in (20, 200, 3000):
        words = [f"w{r.randrange(10**6)}" for _ in range(size)]
        half = words[: size // 2]
        whole, part = (" ".join(w) for w in (words, half))
        x, y = fingerprints.sketch(part), fingerprints.sketch(whole)
        true = len(frames.shingles(part, 5)) / len(frames.shingles(whole, 5))
        assert abs(fingerprints.likeness(x, y) - true) < 0.2
        assert fingerprints.containment(x, y) == 1.0
        both = fingerprints.merged(x, y)
        assert both.kept.tolist() == y.kept[: len(both.kept)].tolist()


def test_compared_fingerprints(spark):
    docs = frames.awkward_docs(spark).dropDuplicates(["doc_id"])
    pairs = fingerprints.fingerprints(docs).withColumn("other", F.col("fingerprint")).withColumn("likeness", F.lit("clash"))
    rows = fingerprints.compared(pairs, "fingerprint", "other").collect()
    assert len(rows) == docs.count() and all(r.likeness == 1.0 for r in rows)
