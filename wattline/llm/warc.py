"""Writes pages as WARC archives, reads them back, and merges their capture indexes.

Records are written by Spark's text writer as gzip-compressed WARC/1.1 files: a page whose
payload equals that of a page with a larger id becomes a revisit record without a body. Reading
parses every archive by content length. The index of an archive is a run: its captures sorted
by url key and time. Runs are cut into ranges of the key; in each range a loser tree merges the
k runs that reach into it, so the ranges in order are one global capture history.

Defined cases: a null payload is empty; payloads under ``least`` bytes are never revisits; of
repeated rows with the largest id all are responses; null ids come back null and are smaller
than all others; a url is escaped where it holds control characters; an empty table makes no
record.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import partitions, stored, table, workers
from wattline.session import work_folder

LEAST = 1000
RECORDS_PER_FILE = 2000
RUN_SCHEMA = (
    "url_key string, captured string, page_id long, run string, place long, url string, "
    "record_type string, refers_to long, payload_digest string, payload_bytes long"
)
ORDER = ("url_key", "captured", "page_id", "run", "place")
END = "\r\n\r\n"


def records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """One column ``value`` with a WARC record per page (page_id, url, html, captured)."""
    known = pages.select(
        "page_id", "url", "captured", F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn(
        "n", F.octet_length("html")
    )
    twice = (
        known.where(F.col("n") >= least).groupBy(F.col("digest").alias("d"))
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("k"))
        .where("k > 1 and keeper is not null").drop("k")
    )
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), "%", "%25")
    for code in (*range(32), 127):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    header = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">")),
        F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), url)),
        F.concat(F.lit("WARC-Date: "), F.col("captured")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("n").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("keeper").cast("string"), F.lit(">"))),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, "0").otherwise(F.col("n").cast("string"))),
    )
    body = F.when(revisit, "").otherwise(F.col("html"))
    return known.join(twice, F.col("digest") == F.col("d"), "left").select(
        F.concat(header, F.lit(END), body).alias("value")
    )


def write(pages: DataFrame, folder: str, least: int = LEAST) -> None:
    """Archives of all pages in ``folder``, on storage that all executors share."""
    records(pages, least).write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE
    ).text(folder)


def url_key(url: str | None) -> str:
    """Host labels in reverse, then the rest of the url."""
    host, slash, rest = re.sub(r"^[^/?#]*?://", "", url or "").partition("/")
    return ",".join(reversed(host.lower().split("."))) + ")" + slash + rest


def parse(content: bytes):
    """(place, fields, payload) of each record of an archive."""
    place, end = 0, END.encode()
    while place < len(content):
        head = content.index(end, place)
        fields = dict(
            line.split(": ", 1) for line in content[place:head].decode().split("\r\n")[1:]
        )
        start = head + len(end)
        stop = start + int(fields["Content-Length"])
        if content[stop : stop + len(end)] != end:
            raise ValueError(f"record at {place} has no end")
        yield place, fields, content[start:stop]
        place = stop + len(end)


def _number(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def _run(name: str, content: bytes) -> list[tuple]:
    """The captures of an archive in index order."""
    run = []
    for place, fields, payload in parse(content):
        response = fields["WARC-Type"] == "response"
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if response and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"record at {place} of {name} is damaged")
        url = unquote(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None
        length = len(payload) if response else int(fields["WARC-Payload-Length"])
        run.append((
            url_key(url), fields["WARC-Date"], _number(fields["WARC-Record-ID"]), name, place, url,
            fields["WARC-Type"], _number(fields.get("WARC-Refers-To")), digest, length,
        ))
    return sorted(run, key=_sort_key)


def _sort_key(row: tuple) -> tuple:
    return (row[0], row[1], row[2] is not None, row[2] or 0, *row[3:5])


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = [field.split()[0] for field in RUN_SCHEMA.split(", ")]
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Index rows of every archive in a folder, each archive's rows in index order."""
    workers(spark)
    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("path", "content")

    def indexed(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                data = gzip.decompress(content.as_py())
                if data:
                    yield _table(_run(path.as_py().rpartition("/")[2], data))

    return files.mapInArrow(indexed, RUN_SCHEMA)


def merged(sorted_runs: list[list], key):
    """K-way merge by a tree of losers: each pop replays one path from leaf to root."""
    k = len(sorted_runs)
    if not k:
        return
    after = [0] * k

    def head(i):
        # runs that are used up lose against all others; ties go to the earlier run
        return (0, key(sorted_runs[i][after[i]]), i) if after[i] < len(sorted_runs[i]) else (1, (), i)

    heads = [head(i) for i in range(k)]
    losers, winners = [0] * k, [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if heads[a] < heads[b] else (b, a)
    best = winners[1] if k > 1 else 0
    while heads[best][0] == 0:
        yield sorted_runs[best][after[best]]
        after[best] += 1
        heads[best] = head(best)
        node = (best + k) // 2
        while node:
            if heads[losers[node]] < heads[best]:
                losers[node], best = best, losers[node]
            node //= 2


def history(index: DataFrame) -> DataFrame:
    """All captures in order of url key, time and id: partition after partition."""
    spark = index.sparkSession
    workers(spark)
    ranges = max(partitions(spark), index.count() // 200_000)

    def merge(batches):
        open_runs: dict[str, list[list]] = {}
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                own = open_runs.setdefault(row[3], [[]])
                if own[-1] and _sort_key(row) < _sort_key(own[-1][-1]):
                    own.append([])  # parts of a run may arrive out of order
                own[-1].append(row)
        waiting = []
        for row in merged([r for own in open_runs.values() for r in own], _sort_key):
            waiting.append(row)
            if len(waiting) == 10_000:
                yield _table(waiting)
                waiting = []
        if waiting:
            yield _table(waiting)

    order = [F.col(name).asc_nulls_first() for name in ORDER]
    return index.repartitionByRange(ranges, *order).mapInArrow(merge, RUN_SCHEMA)


def op5_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    # the pages have no capture times: ids count seconds
    seconds = F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))
    pages = pages.withColumn(
        "captured", F.date_format(F.timestamp_seconds(seconds + 1_600_000_000), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    folder = work_folder(spark, "warc")
    write(pages, folder)
    captures = history(stored(runs(spark, folder), "warc-runs"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
    sha1(coalesce(html, '')) as payload_digest
  from pages),
k as (
  select payload_digest as d, max(page_id) as keeper from p where payload_bytes >= 1000
  group by 1 having count(*) > 1),
j as (select p.*, k.keeper from p left join k on p.payload_digest = k.d)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when keeper is not null and page_id is distinct from keeper then 'revisit' else 'response' end
    as record_type,
  case when keeper is not null and page_id is distinct from keeper then keeper end as refers_to
from j
"""
