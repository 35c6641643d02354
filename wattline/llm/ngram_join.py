"""Jaccard join of documents on word shingles: a grouped prefix join.

1. Shingles that repeat within stretches of the corpus are counted over all documents; the
   ``heavy`` most frequent go last in the order of shingles, the others are ordered by hash. A
   set's prefix is as many of its first shingles as two similar sets cannot both do without; it
   is kept together with a third more shingles that follow. Equal sets become one row. Sets with
   equal kept shingles and size become one group.
2. Kept shingles are counted exactly, over the groups. Two similar sets have ``common_length``
   of them in common, so a group that holds fewer shared ones goes no further (``_possible``); the
   rest is counted once more. A shingle that more than ``crowd`` groups
   hold is crowded (a passage that documents far apart share, or a group of near copies).
3. Crowded shingles go last in a second order. A group with a whole prefix of other shingles
   among its kept ones is light, the others are dense. Two light groups need to meet at other
   shingles only, by the second order; pairs with a dense group meet by the first order, where
   light groups take part with their crowded shingles. Both orders are complete, so no link is
   lost, and a passage makes no pairs among documents that have enough else.
4. Groups meet at prefix shingles that at least two groups hold. First every group is paired
   with those of up to ``HUBS`` of a shingle's groups whose sizes allow it, and the members of a group with one of them. Pairs pass if their
   sizes allow it and the bitmaps of both sets differ in no more bits than two similar sets can;
   passing pairs are verified on the sets themselves. The links give components.
5. Then group pairs at shingles that hold several components are expanded to all their members.
   Member pairs of different components that pass the size, position and bitmap filters are
   verified too. Pairs within a component need no look, so a group of near copies costs about
   as many pairs as it has members, and no link between different texts is lost. A posting
   remembers the ``EARLIER`` shingles before it; a pair that meets at one of them is written
   there, not again.

Texts are read twice for shingles; sets are made again from the texts of passing pairs only.

Defined cases: null and wordless texts have 0 shingles and link with nothing; a text with fewer
words than a shingle is one shingle; repeated rows are equal sets; a null id never names a
component unless all its ids are null; extra columns are ignored. Two sets are taken for equal
when 128 bits of their shingles' sums agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import partitions, stored, table, workers
from wattline.llm.graph import components
from wattline.llm.shingles import M1, M2, mixed, shingle_set

WIDTH, PERCENT = 3, 90
HEAVY, FLUSH, LOCAL = 300_000, 4_000_000, 2
# earlier meeting places that a posting remembers
EARLIER = 4
CROWD, HUBS, BLOCK, BIN_ROWS = 32, 8, 2048, 50_000
# bits of the bitmap of every set, and of the second one of sets from a size on
NARROW, WIDE = 256, ((512, 4096), (128, 1024))
FILTER_FROM = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
U = np.uint64
# products of the multipliers, so that the two sums that name a set are unlike
M11, M22 = (U(int(m) * int(m) % 2**64) for m in (M1, M2))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def needed(both, percent: int):
    """Least intersection of two similar sets whose sizes add up to ``both``."""
    return -(-percent * both // (100 + percent))


def kept_length(n: int, percent: int) -> int:
    """Shingles that are kept: the prefix and a third more, so that crowded ones can be left out."""
    prefix = prefix_length(n, percent)
    return min(n, prefix + prefix // 3 + 4)


def common_length(n: int, percent: int) -> int:
    """Kept shingles that a set of ``n`` has in common with any set similar to it, at least.

    Of two similar sets take the one whose kept shingles end first: the other set keeps all those
    of them that it holds, and it holds all but one less than a prefix. That one may be the
    smaller one, of ``percent`` of n; the number never falls as sizes grow.
    """
    least = -(-percent * n // 100)
    return kept_length(least, percent) - prefix_length(least, percent) + 1


def heavy_shingles(docs: DataFrame, width: int, heavy: int) -> np.ndarray:
    """The most frequent shingles, rarest first.

    A task counts the documents that hold each shingle, a bounded number of shingles at a time,
    and reports those it met ``LOCAL`` times or more; the reports of all tasks are added up.
    """

    def count(batches):
        waiting, size = [], 0

        def report():
            token, n = np.unique(np.concatenate(waiting), return_counts=True)
            often = n >= LOCAL
            return pa.RecordBatch.from_arrays(
                [pa.array(token[often].view(np.int64)), pa.array(n[often])], ["token", "n"]
            )

        for batch in batches:
            for text in batch["_text"]:
                found = shingle_set(text.as_py(), width)
                waiting.append(found)
                size += len(found)
                if size >= FLUSH:
                    yield report()
                    waiting, size = [], 0
        if waiting:
            yield report()

    counted = docs.select("_text").mapInArrow(count, "token long, n long").groupBy("token").agg(
        F.sum("n").alias("n")
    ).where(F.col("n") >= 2 * LOCAL)
    most = counted.orderBy(F.desc("n"), "token").limit(heavy).toArrow()
    return most["token"].to_numpy().view(U)[::-1]


class Order:
    """Global order of shingles: by hash, heavy ones last."""

    def __init__(self, heavy: np.ndarray):
        by_hash = np.argsort(heavy, kind="stable")
        self.tokens, self.ranks = heavy[by_hash], (by_hash + 1).astype(np.int32)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(heavy >> U(44)).astype(np.int64)] = True

    def prefix(self, tokens: np.ndarray, length: int) -> np.ndarray:
        """The first ``length`` of sorted ``tokens``."""
        rank = np.zeros(len(tokens), np.int32)
        if len(self.tokens):
            at = np.flatnonzero(self.maybe[(tokens >> U(44)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.tokens, tokens[at]), len(self.tokens) - 1)
            rank[at] = np.where(self.tokens[place] == tokens[at], self.ranks[place], 0)
        light = tokens[rank == 0]
        if len(light) >= length:
            return light[:length]
        dark = np.flatnonzero(rank)
        return np.concatenate([light, tokens[dark[np.argsort(rank[dark])]]])[:length]


def _sum(x: np.ndarray, factor) -> int:
    return int(mixed(x * factor).sum(dtype=U).view(np.int64)) if len(x) else 0


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


SIGNED = (
    "k1 long, k2 int, doc_id long, n long, f1 long, f2 long, g1 long, g2 long, "
    "prefix array<long>, bitmap binary"
)


def _bitmap(tokens: np.ndarray) -> bytes:
    """Parities of the shingles that fall on each bit."""
    found, place = b"", mixed(tokens * M2)
    for bits in (NARROW, *[bits for size, bits in WIDE if len(tokens) >= size][:1]):
        odd = np.bincount((place >> U(32)).astype(np.int64) % bits, minlength=bits) & 1
        found += np.packbits(odd.astype(np.uint8)).tobytes()
    return found


def signed(docs: DataFrame, order: Order, width: int, percent: int) -> DataFrame:
    """Per document: set size, two sums that name the set and its kept shingles, these, bitmap."""

    def sign(batches):
        for batch in batches:
            rows = []
            for text in batch["_text"]:
                tokens = shingle_set(text.as_py(), width)
                n = len(tokens)
                prefix = order.prefix(tokens, kept_length(n, percent)) if n else tokens
                placed = prefix + np.arange(len(prefix), dtype=U) * M1 + U(n)
                rows.append((
                    n, _sum(tokens, M1), _sum(tokens, M11), _sum(placed, M2), _sum(placed, M22),
                    prefix.view(np.int64), _bitmap(tokens),
                ))
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int64()), pa.binary()]
            made = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(
                [batch["k1"], batch["k2"], batch["doc_id"], *made],
                [field.split()[0] for field in SIGNED.split(", ")],
            )

    return docs.mapInArrow(sign, SIGNED)


def _segments(key: np.ndarray):
    """For sorted keys: for each distance, the rows whose key is that of the row so far on."""
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    left = np.repeat(np.r_[start[1:], len(key)], np.diff(np.r_[start, len(key)])) - np.arange(len(key)) - 1
    rows, distance = np.arange(len(key)), 1
    while True:
        rows = rows[left[rows] >= distance]
        if not len(rows):
            return
        yield rows, rows + distance
        distance += 1


def _passing(rows: dict[str, np.ndarray], percent: int):
    """Pairs of rows of one shingle and block pair that pass all filters, earlier row first."""
    n, pos, own = rows["n"], rows["pos"], rows["own"]
    for i, j in _segments(rows["key"]):
        keep = (own[i] != own[j]) | rows["inner"][i]
        small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        least = needed(small + large, percent)
        # holds at the first common shingle: no more than the rest of either set can follow
        same = rows["group"][i] == rows["group"][j]
        keep &= same | ~rows["crowded"][i] | rows["dense"][i] | rows["dense"][j]
        keep &= (100 * small >= percent * large) & (rows["part"][i] != rows["part"][j])
        keep &= same | (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= least)
        i, j, most = i[keep], j[keep], (small + large - 2 * least)[keep]
        if len(i):
            apart = np.bitwise_count(rows["bits"][i] ^ rows["bits"][j]).sum(axis=1)
            i, j = i[apart <= most], j[apart <= most]
            met = np.zeros(len(i), bool)
            for x in rows["earlier"]:
                for y in rows["earlier"]:
                    met |= (x[i] == y[j]) & (x[i] != 0)
            yield i[~met], j[~met]


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.Table:
    both = np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)
    both = np.unique(both, axis=0) if len(a) else both
    return pa.table([pa.array(both[:, 0], pa.int64()), pa.array(both[:, 1], pa.int64())], ["a", "b"])


def _cross(rows: pa.Table, percent: int) -> pa.Table:
    """Pairs of a bin between components that pass the filters."""
    rows = rows.sort_by([(name, "ascending") for name in ("token", "first", "second")])
    take = lambda name: rows[name].to_numpy()
    same = np.ones(rows.num_rows, bool)
    for name in ("token", "first", "second"):
        same[1:] &= take(name)[1:] == take(name)[:-1]
    same[:1] = False
    narrow = b"".join(rows["narrow"].to_pylist())
    columns = {
        "key": np.cumsum(~same), "n": take("n"), "pos": take("pos"), "own": take("own"),
        "inner": take("first") == take("second"), "group": take("gid"), "part": take("part"),
        "crowded": take("crowded").astype(bool), "dense": take("dense").astype(bool),
        "bits": np.frombuffer(narrow, np.uint64).reshape(-1, NARROW // 64),
        "earlier": [take(f"earlier{i}") for i in range(EARLIER)],
    }
    sid, found = take("sid"), [(np.empty(0, int), np.empty(0, int))]
    found += _passing(columns, percent)
    i, j = (np.concatenate(side) for side in zip(*found))
    return _pairs(sid[i], sid[j])


def _meetings(members: DataFrame, block: int) -> DataFrame:
    """Members of each shingle dealt to bins; those of a crowded shingle in pairs of blocks."""
    spark = members.sparkSession
    counted = members.groupBy(F.col("token").alias("t")).agg(
        F.count("*").alias("held"), F.ceil(F.count("*") / block).cast("int").alias("blocks")
    )
    crowded = counted.where("blocks > 1").select("t", "blocks")
    # every member is copied once per block of its shingle
    copies = counted.agg(F.sum(F.col("held") * F.col("blocks"))).first()[0] or 0
    bins = max(partitions(spark), copies // BIN_ROWS)
    return (
        members.join(crowded, F.col("token") == F.col("t"), "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
        .select(
            *members.columns, "own",
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
        )
        .withColumn("first", F.least("own", "other")).withColumn("second", F.greatest("own", "other"))
        .drop("other")
        .withColumn("bin", F.pmod(F.xxhash64("token", "first", "second"), F.lit(bins)))
    )


def _needed_sets(docs: DataFrame, sets: DataFrame, sids: DataFrame, width: int) -> DataFrame:
    """(sid, tokens) of some sets, made again from one text each and stored."""
    wanted = stored(
        sets.join(sids, "sid").select("sid", "n", F.col("k.k1").alias("w1"), F.col("k.k2").alias("w2")),
        "ngram-wanted",
    ).where("n > 0")
    texts = docs.select("k1", "k2", "_text").dropDuplicates(["k1", "k2"])
    found = texts.join(
        wanted.hint("shuffle_hash"), (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2"))
    ).select("sid", "_text")

    def make(batches):
        for batch in batches:
            made = [shingle_set(t.as_py(), width).view(np.int64) for t in batch["_text"]]
            yield pa.RecordBatch.from_arrays([batch["sid"], pa.array(made, pa.list_(pa.int64()))], ["sid", "tokens"])

    conf = docs.sparkSession.conf
    before = conf.get(FILTER_FROM, None)
    # lets Spark filter the texts by the wanted keys before it shuffles them; in this job only, as
    # each such filter is a stage of its own and a megabyte that the driver sends along with tasks
    conf.set(FILTER_FROM, "0")
    try:
        return stored(found.mapInArrow(make, "sid long, tokens array<long>"), "ngram-tokens")
    finally:
        conf.unset(FILTER_FROM) if before is None else conf.set(FILTER_FROM, before)


def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and bitmaps leave it open that they are similar."""
    size = sets.select("sid", "n", "bitmap")
    both = (
        pairs.join(size.toDF("a", "n", "x"), "a").join(size.toDF("b", "m", "y"), "b")
        .where(100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
    )

    def passing(batches):
        for batch in batches:
            total = batch["n"].to_numpy() + batch["m"].to_numpy()
            most = total - 2 * needed(total, percent)
            keep = [_apart(x, y) <= k for x, y, k in zip(batch["x"].to_pylist(), batch["y"].to_pylist(), most)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(passing, "a long, b long")


def _folded(bitmap: bytes, size: int) -> int:
    """A bitmap of fewer bytes: parities of places that fall together."""
    whole = 0
    for at in range(0, len(bitmap), size):
        whole ^= int.from_bytes(bitmap[at : at + size])
    return whole


def _apart(x: bytes, y: bytes) -> int:
    """Most bits by which the bitmaps that both sets have differ."""
    cut = NARROW // 8
    most = (int.from_bytes(x[:cut]) ^ int.from_bytes(y[:cut])).bit_count()
    size = min(len(x), len(y)) - cut
    return max(most, (_folded(x[cut:], size) ^ _folded(y[cut:], size)).bit_count()) if size else most


def _verified(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets are similar."""
    left = tokens.toDF("a", "x")
    right = tokens.toDF("b", "y")
    common = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a").join(right, "b")
        .select("a", "b", common.alias("i"), (F.size("x") + F.size("y")).alias("both"))
        .where(100 * F.col("i") >= percent * (F.col("both") - F.col("i")))
        .select("a", "b")
    )


def _members(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()


def row_key(doc_id, text):
    """Two hashes that name a row by id and text."""
    return F.xxhash64(doc_id, text), F.hash(doc_id, text)


def _prefix_kept(n, percent: int):
    """``prefix_length`` and ``kept_length`` of a column."""
    prefix = n - F.ceil(percent * n / 100) + 1
    return prefix, F.least(n, prefix + F.floor(prefix / 3) + 4)


def _shared(postings: DataFrame) -> DataFrame:
    """(t, c): shingles that several groups hold, and those at which the members of one meet."""
    inner = F.max(((F.col("pos") == 0) & (F.col("members") > 1)).cast("int"))
    return (
        postings.groupBy(F.col("token").alias("t")).agg(F.count("*").alias("c"), inner.alias("m"))
        .where("c > 1 or m = 1").select("t", "c")
    )


def _possible(postings: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Postings (with c, the groups of the shingle) of groups that can have a similar one.

    Those hold ``common_length`` shingles that others hold too. Of other groups the first posting
    stays if they have several members, which meet there.
    """
    prefix, kept = _prefix_kept(F.ceil(percent * F.col("n") / 100), percent)
    held = F.sum((F.col("c") > 1).cast("int")).over(Window.partitionBy("gid"))
    return (
        postings.join(groups.select("gid", "n"), "gid")
        .withColumn("_held", held)
        .where((F.col("_held") >= kept - prefix + 1) | (F.col("pos") == 0) & (F.col("members") > 1))
        .drop("_held")
    )


def _placed_postings(met: DataFrame, percent: int) -> DataFrame:
    """Postings by which groups meet: (token, pos, gid, crowded, dense).

    ``met`` (gid, n, pos, token, crowded) holds the kept shingles that groups share. ``pos`` then
    counts the uncrowded shingles before one, a bound of its place in both orders.
    """
    of_group = Window.partitionBy("gid")
    earlier = of_group.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    prefix, kept = _prefix_kept(F.col("n"), percent)
    crowded = F.col("crowded").cast("int")
    placed = (
        met.withColumn("rank", F.col("pos") - F.coalesce(F.sum(crowded).over(earlier), F.lit(0)))
        .withColumn("dense", kept - F.sum(crowded).over(of_group) < prefix)
    )
    by_first, by_second = F.col("pos") < prefix, ~F.col("crowded") & (F.col("rank") < prefix)
    return placed.where(F.when(F.col("dense") | F.col("crowded"), by_first).otherwise(by_second)).select(
        "token", F.col("rank").alias("pos"), "gid", "crowded", "dense"
    )


def _remembering(met: DataFrame) -> DataFrame:
    """Adds the shingles of a group's ``EARLIER`` postings before each one; 0 for none.

    Postings of a group have one order, so of the shingles at which two groups meet one has no
    other before it that both remember, and there the pair is written. A pair passes at an
    earlier shingle if it does at a later one, as positions only grow; but two light groups meet
    at uncrowded shingles only, so those never refer to a crowded one.
    """
    of_group = Window.partitionBy("gid").orderBy("pos", "token")

    def earlier(i: int):
        hidden = ~F.col("crowded") & F.lag("crowded", i, False).over(of_group)
        return F.when(hidden, F.lit(0)).otherwise(F.lag("token", i, 0).over(of_group)).cast("long")

    return met.select("*", *[earlier(i + 1).alias(f"earlier{i}") for i in range(EARLIER)])


def _stars(met: DataFrame) -> DataFrame:
    """(gid, hub): every group with the hubs of its shingles. Light groups skip crowded ones."""
    of_use = met.where("not crowded or dense").select("token", "gid")
    least = (F.min_by("gid", F.xxhash64("gid", F.lit(i))) for i in range(HUBS))
    hubs = of_use.groupBy(F.col("token").alias("t")).agg(F.count("*").alias("c"), F.array(*least).alias("hubs")).where("c > 1")
    return (
        of_use.join(hubs, F.col("token") == F.col("t"))
        .select("gid", F.explode(F.array_distinct("hubs")).alias("hub")).where("gid <> hub").distinct()
    )


def similar_documents(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH,
    percent: int = PERCENT, heavy: int = HEAVY, crowd: int = CROWD, block: int = BLOCK, keys: bool = False,
) -> DataFrame:
    """doc_id, n_shingles and component_id for every row.

    With ``keys`` also k1 and k2 (``row_key``), and part, a number of the component: null
    without shingles.
    """
    workers(docs.sparkSession)
    key = F.col(doc_id).cast("long")
    k1, k2 = row_key(key, F.col(text))
    keyed = docs.select(
        k1.alias("k1"), k2.alias("k2"),
        key.alias("doc_id"), F.col(text).alias("_text"),
    )
    order = Order(heavy_shingles(keyed, width, heavy))
    rows = stored(signed(keyed, order, width, percent), "ngram-signed")
    equal = rows.where("n > 0").groupBy("n", "f1", "f2").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("copies"),
        F.min(F.struct("k1", "k2")).alias("k"), F.first("g1").alias("g1"), F.first("g2").alias("g2"),
        F.first("bitmap").alias("bitmap"),
    )
    equal = stored(equal.withColumn("sid", F.monotonically_increasing_id()), "ngram-equal")
    groups = stored(
        equal.groupBy("g1", "g2").agg(
            F.count("*").alias("members"), F.min(F.struct("sid", "k")).alias("lead"), F.min("n").alias("n")
        ).withColumn("gid", F.monotonically_increasing_id()),
        "ngram-groups",
    )
    sets = stored(equal.join(groups.select("g1", "g2", "gid"), ["g1", "g2"]).drop("g1", "g2"), "ngram-sets")
    # prefixes are long: one of each group goes on
    prefixes = rows.where("n > 0").select("k1", "k2", "prefix").dropDuplicates(["k1", "k2"])
    leads = groups.select(
        F.col("lead.k.k1").alias("k1"), F.col("lead.k.k2").alias("k2"), "gid", "members"
    )
    prefixes = stored(prefixes.join(leads, ["k1", "k2"]).select("gid", "members", "prefix"), "ngram-prefixes")
    postings = prefixes.select("gid", "members", F.posexplode("prefix").alias("pos", "token"))
    # twice, as groups that go leave shingles unshared
    for _ in range(2):
        met = postings.select("gid", "members", "pos", "token").join(_shared(postings), F.col("token") == F.col("t")).drop("t")
        postings = stored(_possible(met, groups, percent), "ngram-possible")
    met = postings.withColumn("crowded", F.col("c") > crowd)
    met = stored(_placed_postings(met, percent), "ngram-met")
    lead = groups.select("gid", F.col("lead.sid").alias("sid"), "n")
    stars = (
        _stars(met)
        .join(lead.toDF("gid", "a", "n"), "gid").join(lead.toDF("hub", "b", "m"), "hub")
        .where(100 * F.least("n", "m") >= percent * F.greatest("n", "m")).select("a", "b")
        .unionByName(
            sets.select("gid", F.col("sid").alias("a")).join(lead.select("gid", F.col("sid").alias("b")), "gid")
            .where("a <> b").select("a", "b")
        )
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    tried = stored(_near(stars, sets, percent), "ngram-tried")
    tokens = _needed_sets(keyed, sets, _members(tried), width)
    links = stored(_verified(tried, tokens, percent), "ngram-links")
    parts = components(links, "ngram-parts")
    placed = stored(
        sets.select("sid", "gid", "n", F.substring("bitmap", 1, NARROW // 8).alias("narrow"))
        .join(parts, F.col("sid") == F.col("id"), "left")
        .select("sid", "gid", "n", "narrow", F.coalesce("root", "sid").alias("part")),
        "ngram-placed",
    )
    span = placed.groupBy("gid").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    mixed_tokens = (
        met.join(span, "gid").groupBy(F.col("token").alias("t"))
        .agg(
            F.min("low").alias("low"), F.max("high").alias("high"),
            # light groups meet each other elsewhere; members of a group meet at its first shingle
            F.max(~F.col("crowded") | F.col("dense") | (F.col("low") < F.col("high"))).alias("of_use"),
        )
        .where("low <> high and of_use").select("t")
    )
    open_rows = stored(
        _remembering(met.join(mixed_tokens, F.col("token") == F.col("t")).drop("t")).join(placed, "gid"),
        "ngram-open",
    )
    crossing = _meetings(open_rows, block).groupBy("bin").applyInArrow(
        lambda t: _cross(t, percent), "a long, b long"
    ).distinct()
    crossing = stored(_near(crossing.join(tried, ["a", "b"], "left_anti"), sets, percent), "ngram-crossing")
    fresh = _members(crossing).join(tokens.select("sid"), "sid", "left_anti")
    tokens = tokens.unionByName(_needed_sets(keyed, sets, fresh, width))
    found = links.unionByName(_verified(crossing, tokens, percent))
    parts = components(found, "ngram-parts")
    named = stored(
        sets.select("n", "f1", "f2", "sid", "least").join(parts, F.col("sid") == F.col("id"), "left")
        .select("n", "f1", "f2", "least", F.coalesce("root", "sid").alias("part")),
        "ngram-named",
    )
    names = named.groupBy(F.col("part").alias("p")).agg(F.min("least").alias("component_id"))
    answers = named.join(names, F.col("part") == F.col("p")).select("n", "f1", "f2", "component_id", "part")
    more = ("k1", "k2", "part") if keys else ()
    return (
        rows.where("n > 0").select("k1", "k2", "doc_id", "n", "f1", "f2").join(answers, ["n", "f1", "f2"])
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id", *more)
        .unionByName(
            rows.where("n = 0").withColumn("part", F.lit(None).cast("long"))
            .select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), *more)
        )
    )


def op4_ngram_join(spark, sf_dir):
    return similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP4_SQL = r"""
with recursive d as (
  select row_number() over () as k, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select k, unnest(list_distinct(case
    when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) as g
  from d),
n as (select k, count(*) as n from s group by k),
pairs as (
  select a.k as a, b.k as b, count(*) as i from s a join s b on a.g = b.g and a.k < b.k group by a.k, b.k),
links as (
  select a, b from pairs join n x on x.k = a join n y on y.k = b where 100 * i >= 90 * (x.n + y.n - i)),
ways as (select a, b from links union all select b, a from links),
reached as (select k as a, k as b from d union select r.a, e.b from reached r join ways e on r.b = e.a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id
from d left join n on n.k = d.k
join (select r.a, min(x.doc_id) as component_id from reached r join d x on x.k = r.b group by r.a) c on c.a = d.k
"""
