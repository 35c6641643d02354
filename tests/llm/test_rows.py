"""Shards, urls, archives and vectors against plain versions, and the pipeline."""

import gzip
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from verification.compare import difference, duck
from wattline.llm import graph, near_vectors, quality, sharding, topk, url_filters, warc
from wattline.llm.common import stored, table
from wattline.llm.queries import ORACLE, QUERIES
from wattline.session import work_folder

from . import frames
from .test_text import plain_ids, plain_join, plain_order_selection, walk

VECTORS = "vec_id long, embedding array<float>, label int, rank int"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_registered_query_equals_sql(spark, sf_dir, name):
    count, text = difference(spark, duck(sf_dir), QUERIES[name], ORACLE[name], sf_dir)
    assert not text and count


def test_flow_moves_the_fewest_bytes():
    rng = np.random.default_rng(1)
    for _ in range(40):
        n, m = rng.integers(1, 7, 2)
        supply = rng.integers(0, 60, n)
        demand = sharding.fill(rng.integers(0, 20, m), rng.integers(1, 9, m), int(supply.sum()))
        assert demand.sum() == supply.sum() and (demand >= 0).all()
        flow = sharding.min_cost_flow(supply, demand, [[int(i != j) for j in range(m)] for i in range(n)])
        assert (flow >= 0).all() and (flow.sum(1) == supply).all() and (flow.sum(0) == demand).all()
        assert np.trace(flow) == sum(min(a, b) for a, b in zip(supply, demand))


def test_flow_with_other_costs_is_least():
    supply, demand = [3, 2], [1, 2, 2]
    cost = [[4, 1, 3], [1, 5, 2]]
    found = sharding.min_cost_flow(supply, demand, cost)
    best = min(
        4 * a + b + 3 * (3 - a - b) + (1 - a) + 5 * (2 - b) + 2 * (2 - (3 - a - b))
        for a in range(2) for b in range(3) if 0 <= 3 - a - b <= 2
    )
    assert (found * cost).sum() == best


def shards_of(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.s_shard].append(r)
    return by


@pytest.mark.parametrize("kind", ["hot", "awkward", "empty"])
def test_resharding(spark, kind):
    docs = {"hot": frames.made_docs, "awkward": frames.awkward_docs, "empty": frames.empty_docs}[kind](spark)
    old = F.when(F.col("doc_id") % 3 != 1, 0).otherwise(F.col("doc_id") % 7)  # shard 0 is hot
    rows = sharding.slots(sharding.equal_shares(spark, docs, old, 7, 5)).collect()
    assert sorted(map(str, (r.row for r in rows))) == sorted(map(str, docs.select(F.struct("*").alias("row")).toPandas()["row"]))
    loads = [sum(r.s_size for r in found) for found in shards_of(rows).values()]
    for found in shards_of(rows).values():
        assert sorted(r.slot for r in found) == list(range(len(found)))
    if kind == "hot":
        assert len(loads) == 5 and max(loads) - min(loads) <= max(r.s_size for r in rows)
    for r in rows:
        assert r.s_size == len((r.row.text or "").encode()) + 16


def test_unmoved_blocks_keep_their_files(spark):
    docs = frames.made_docs(spark)
    folder = work_folder(spark, "old")
    layout = sharding.lay_out(docs, F.col("doc_id") % 4, 4, 4, folder)
    held = [r[1] for r in sorted(spark.read.parquet(folder).groupBy("s_shard").agg(F.sum("s_size")).collect(), key=lambda r: int(r[0]))]
    new = work_folder(spark, "new")
    rows = sharding.reshard(spark, layout, new, held).collect()
    assert len(rows) == 400 and all(r.piece.startswith("block") for r in rows)


def test_straddling_rows_are_placed_one_by_one():
    # shard 0 keeps 40 of its 90 bytes, 10 go to shard 1 and 40 to shard 2; a row lies in all three stretches
    chosen = sharding.plan({0: 90, 1: 30}, [], [40, 40, 40])
    assert sorted(b - a for o, a, b, n in chosen.stretches if o == n) == [30, 40]
    assert chosen.ends() == [(0, 40), (0, 50)]
    chosen.settle([(35, 0, 0, 1, 35)])
    assert chosen.single == {(0, 0, 1): 2} and chosen.loads == [35, 30, 55]
    # a row that fills a shard stays there, the others share the rest alike
    chosen = sharding.plan({0: 10, 1: 20}, [(90, 0, 0, 0)], [40, 40, 40])
    assert chosen.single == {(0, 0, 0): 0} and chosen.capacities == [90, 15, 15]


def bytes_moved(rows, old):
    """Bytes in another shard than before, the least of all layouts of equal bytes, bytes by new shard."""
    before, after = defaultdict(int), defaultdict(int)
    moved = 0
    for key, size, shard in rows:
        before[old(key)] += size
        after[shard] += size
        moved += size * (old(key) != shard)
    mean = sum(after.values()) / sharding.NEW
    return moved, sum(max(0, held - mean) if shard < sharding.NEW else held for shard, held in before.items()), after


def test_registered_sharding(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    rows = sharding.op1_sharding(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
    moved, least, after = bytes_moved(
        [(r.doc_id, r["size"], r.shard) for r in rows], lambda i: zlib.crc32(str(i).encode()) % sharding.OLD
    )
    largest, total = max(r["size"] for r in rows), sum(r["size"] for r in rows)
    assert len(after) == sharding.NEW
    assert max(after.values()) - min(after.values()) <= largest
    # a stretch ends in at most one row, and there are fewer ends than shards
    assert moved <= least + largest * (sharding.OLD + sharding.NEW) and moved <= total * 0.45
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = rest[:cut].translate(frames.LOWER), rest[cut:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fit = [
        (len(h + p), len(h), h + p, v) for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, max(fit)[2], max(fit)[3]) if fit else (host, path, None, "allow")


def test_url_rules(spark):
    r = random.Random(4)
    hosts = ["com", "a.com", "b.a.com", "net", "x.net", "A.com", "", "com.", "a..com", "a.com:80", "u@a.com"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/en/x/y", "/EN/", "/%é/中"]
    rules = [(r.choice(["allow", "block"]), h, p) for h in ("com", "a.com", "b.a.com", "net") for p in ("/", "/en/", "/en/x", "")]
    urls = [s + r.choice(hosts) + r.choice(paths) + r.choice(["", "?q=/en/", "#://x"]) for s in ("http://", "", "//", "://") for _ in range(120)]
    urls += [None, "", "://", "x", "http://a.com/en/\nline"] + ["http://a.com/en/x"] * 200
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    found = url_filters.judge(frame, spark.createDataFrame(rules, "verdict string, host string, path string")).collect()
    assert len(found) == len(urls)
    for row in found:
        assert (row.host, row.path, row.rule, row.verdict) == plain_verdict(urls[row.page_id], rules)
    no_rules = spark.createDataFrame([], "verdict string, host string, path string")
    assert {r.verdict for r in url_filters.judge(frame, no_rules).collect()} == {"allow"}
    assert url_filters.judge(frame.where("false"), no_rules).count() == 0


def test_url_filters_use_no_python(spark, sf_dir):
    plan = url_filters.op3_url_filters(spark, sf_dir)._jdf.queryExecution().toString()
    assert not [w for w in ("Python", "Pandas", "Arrow", "ExistingRDD") if w in plan]


PAGES = "page_id long, url string, html string, captured string"


def test_archives(spark):
    big, other = "<p>é\r\n\r\nWARC/1.1\r\n" * 80, "y" * 1000
    rows = [
        (1, "http://a.com/1%20x", big, "2020-01-02T00:00:00Z"), (7, "http://b.com/\n%0A?q", big, "2020-01-01T00:00:00Z"),
        (3, None, big, "2020-01-01T00:00:00Z"), (None, "x", big, "2020-01-01T00:00:00Z"), (4, "http://a.com/1%20x", other, "2020-01-01T00:00:00Z"),
        (5, "", None, "2020-01-01T00:00:00Z"), (6, "http://a.com", "", "2020-01-01T00:00:00Z"), (8, "http://中.com", "z" * 999, "2020-01-01T00:00:00Z"),
        (9, "u", "z" * 999, "2020-01-01T00:00:00Z"), (7, "http://b.com/\n%0A?q", big, "2020-01-01T00:00:00Z"),
    ]
    folder = work_folder(spark, "warc")
    warc.write(spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("clash")).repartition(3), folder)
    found = warc.history(stored(warc.runs(spark, folder), "runs")).collect()
    assert len(found) == len(rows)
    assert [warc._sort_key(tuple(r)) for r in found] == sorted(warc._sort_key(tuple(r)) for r in found)
    expected = []
    for page_id, url, html, captured in rows:
        raw = (html or "").encode()
        revisit = html == big and page_id != 7
        expected.append((page_id, url or "", captured, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", 7 if revisit else None))
    got = [(r.page_id, r.url or "", r.captured, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_no_archives(spark):
    folder = work_folder(spark, "warc")
    warc.write(spark.createDataFrame([], PAGES), folder)
    assert warc.history(stored(warc.runs(spark, folder), "runs")).count() == 0


def test_loser_tree():
    r = random.Random(1)
    for k in range(9):
        runs = [sorted(r.randrange(20) for _ in range(r.randrange(12))) for _ in range(k)]
        assert list(warc.merged(runs, lambda x: (x,))) == sorted(x for run in runs for x in run)


def test_damaged_record_is_found():
    header = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Date: d\r\nWARC-Payload-Digest: sha1:0\r\nContent-Length: 1\r\n\r\n"
    with pytest.raises(ValueError):
        warc._run("a", gzip.decompress(gzip.compress(header + b"x\r\n\r\n")))


def awkward_vectors(spark):
    """Clusters, equal vectors, ties, bad vectors, other lengths, a null id, repeated rows."""
    rng = np.random.default_rng(6)
    rows = []
    centre = rng.standard_normal(8)
    for i in range(300):
        if i % 3 == 0:
            x = centre + 0.02 * rng.standard_normal(8)
        elif i % 3 == 1:
            x = centre + 0.45 * rng.standard_normal(8)
        else:
            x = np.round(rng.standard_normal(8), 1)
        rows.append((i, [float(v) for v in x], i % 4, i))
    rows += [(i, rows[2][1], 0, 0) for i in range(300, 330)]
    rows += [(330, None, 0, 0), (331, [], 0, 0), (332, [0.0] * 8, 0, 0), (333, [1.0, None] * 4, None, 0)]
    rows += [(334, [float("nan")] * 8, 0, 0), (335, [float("inf")] * 8, 0, 0), (350, [1.0, 2.0], 0, 0), (337, [2.0, 4.1], 0, 0)]
    rows += [(None, rows[0][1], 0, 0), rows[50], rows[50], (400, [3e20] * 8, 0, 0), (401, [-3e20] * 8, 0, 0)]
    return spark.createDataFrame(rows, VECTORS)


def fine(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


def test_top_k(spark):
    vectors = awkward_vectors(spark)
    rows = [(r.vec_id, [int(np.floor(256 * float(np.float32(x)))) for x in r.embedding]) for r in vectors.collect() if fine(r.embedding)]
    expected = []
    for q, (query, v) in enumerate(rows):
        if query is None or query % 50:
            continue
        scored = [
            (-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), i is None, i or 0, i)
            for c, (i, w) in enumerate(rows) if c != q and len(w) == len(v)
        ]
        expected += [(query, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored)[:5])]
    for shard_rows, block in ((8192, 8192), (20, 2)):
        found = topk.top_k(vectors, F.col("vec_id") % 50 == 0, shard_rows=shard_rows, block_queries=block)
        got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()]
        assert sorted(map(str, got)) == sorted(map(str, expected))
    assert topk.top_k(vectors.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def plain_links(vectors, similar=0.9):
    rows = vectors.collect()
    links, n_links = [], [0] * len(rows)
    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if not (fine(a.embedding) and fine(b.embedding)) or len(a.embedding) != len(b.embedding):
                continue
            x, y = np.array(a.embedding, float), np.array(b.embedding, float)
            if x.any() and y.any() and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= similar:
                links.append((i, j))
                n_links[i] += 1
                n_links[j] += 1
    least = frames.least_linked([r.vec_id for r in rows], links)
    return sorted(str((r.vec_id, n, c, r.vec_id == c)) for r, n, c in zip(rows, n_links, least))


@pytest.mark.parametrize("leaf,block", [(1024, 2048), (64, 16)])
def test_near_vectors(spark, leaf, block):
    vectors = awkward_vectors(spark)
    found = near_vectors.near_duplicates(vectors, leaf=leaf, block=block, trees=10).collect()
    got = sorted(str((r.vec_id, r.n_links, r.component_id, r.kept)) for r in found)
    assert got == plain_links(vectors)
    assert near_vectors.near_duplicates(vectors.where("false")).count() == 0


def test_recall_of_the_forest(spark):
    """Pairs right at the limit, among many unrelated vectors."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    base, side = x[:500], rng.standard_normal((500, 64))
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    near = 0.902 * base + (1 - 0.902**2) ** 0.5 * side
    rows = [(i, [float(c) for c in v], 0, 0) for i, v in enumerate(np.concatenate([x, near]))]
    found = near_vectors.near_duplicates(spark.createDataFrame(rows, VECTORS), leaf=256).where("vec_id >= 20000").collect()
    hits = sum(r.component_id <= r.vec_id - 20_000 for r in found)
    assert hits >= 0.95 * 500


def test_components_end_with_the_stars(spark, monkeypatch):
    """No round only shows that nothing moves: stars are written once, a chain until it is one."""
    written = []
    stored = graph.stored
    monkeypatch.setattr(graph, "stored", lambda df, label: written.append(label) or stored(df, label))
    stars = [(v, v % 5) for v in range(5, 60)] + [(3, 3), (0, 10), (10, 0)]
    found = {x.id: x.root for x in graph.components(spark.createDataFrame(stars, "a long, b long"), "t").collect()}
    assert found == {v: v % 5 for v in range(5, 60)} and len(written) == 1
    edges = [[(1, 2), (2, 3)], [(2, 1), (3, 2), (4, 3), (5, 4)], [(3, 1), (3, 2)]]
    for chain in edges:
        found = {x.id: x.root for x in graph.components(spark.createDataFrame(chain, "a long, b long"), "t").collect()}
        assert found == {v: 1 for v in range(2, max(max(e) for e in chain) + 1)}


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 440)] + [(500, k) for k in range(501, 560)]
    found = {x.id: x.root for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    least = frames.least_linked(list(range(600)), edges)
    assert [found.get(i, i) for i in range(600)] == least
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    rows = docs.collect()
    forest = quality.fit(docs, labels)
    kept = [r for r in rows if walk(forest, quality.statistics(r.text)) >= quality.CUT]
    least = {i: c for i, _, c in plain_join(kept, corpus_pipeline.WIDTH, corpus_pipeline.PERCENT)}
    unique = [r for r in kept if least[str(r.doc_id)] == str(r.doc_id)]
    now = docs
    for name, stage in corpus_pipeline.STAGES[:2]:
        now = stored(stage(spark, now, sf_dir), name)
        assert now.columns == docs.columns
    assert sorted(now.collect()) == sorted(unique)
    from wattline.llm import mixing

    copies = plain_order_selection(mixing.mix(now).collect())
    sized = {r.doc_id for r in unique if frames.words(r.text)}
    expected = sorted((r.doc_id, len(plain_ids(r.text))) for r in unique for _ in range(copies[r.doc_id]) if r.doc_id in sized)
    got = sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, sf_dir).collect() if r.doc_id in sized)
    assert got == expected


@pytest.mark.parametrize("kind", ["awkward", "empty"])
def test_pipeline_of_awkward_tables(spark, kind, sf_dir):
    docs = frames.awkward_docs(spark) if kind == "awkward" else frames.empty_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stored(stage(spark, docs, sf_dir), name)
        assert name == "encoding" or docs.columns == columns
