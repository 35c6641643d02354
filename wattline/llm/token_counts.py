"""Counts the tokens of whole texts without making token ids.

Byte-pair merging of one pre-token keeps its symbols in a linked list and all adjacent pairs
that can merge in a heap. The pair of lowest rank is popped and merged until none is left; the
count is the number of initial symbols less the number of merges. Equal pre-tokens are counted
once per worker. Special tokens of the vocabulary count one each where a text holds their string.

Defined cases: a null or empty text has 0 tokens; repeated rows stay; an input column named
like an output column is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import others, table, workers
from wattline.llm.vocabularies import LATIN, Recent, byte_symbols, load, public_path

OUTPUTS = ("n_bytes", "n_tokens", "over_limit")

# The characters that the vocabulary's split pattern takes for white space.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# A text falls into these chunks at places where the split pattern always ends a pre-token.
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
CHUNKS, PIECES_KEPT = 250_000, 100_000  # answers that a worker keeps, twice as many at most
# Fixed value: the split pattern itself.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def merged_count(symbols, ranks: dict) -> int:
    """Number of symbols left of one pre-token when no pair can merge any more."""
    n = len(symbols)
    parts, before, after = list(symbols), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [
        (rank, i, pair)
        for i, pair in enumerate(zip(parts, parts[1:]))
        if (rank := ranks.get(pair)) is not None
    ]
    heapq.heapify(heap)
    left = n
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i]
        if j >= n or parts[i] != pair[0] or parts[j] != pair[1]:
            continue
        parts[i], parts[j] = pair[0] + pair[1], ""
        left -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            pair = (parts[i], parts[k])
            if (rank := ranks.get(pair)) is not None:
                heapq.heappush(heap, (rank, i, pair))
        h = before[i]
        if h >= 0:
            pair = (parts[h], parts[i])
            if (rank := ranks.get(pair)) is not None:
                heapq.heappush(heap, (rank, h, pair))
    return left


class Counter:
    """Token counts under one vocabulary."""

    def __init__(self, path: str):
        self.split = load(path).pre_tokenizer.pre_tokenize_str
        with open(path, encoding="utf-8") as file:
            read = json.load(file)
        pairs = (m.split(" ") if isinstance(m, str) else m for m in read["model"]["merges"])
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(pairs)}
        special = [t["content"] for t in read["added_tokens"]]
        special.sort(key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.symbols = byte_symbols()
        self.chunks, self.pieces = Recent(self._chunk, CHUNKS), Recent(self._piece, PIECES_KEPT)

    def _chunk(self, chunk: str) -> int:
        if LATIN.fullmatch(chunk):
            return sum(map(self.pieces.__getitem__, PIECES.findall(chunk)))
        return sum(merged_count(piece, self.ranks) for piece, _ in self.split(chunk))

    def _piece(self, piece: str) -> int:
        return merged_count([*map(self.symbols.__getitem__, piece.encode())], self.ranks)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        segments = self.special.split(text) if self.special else [text]
        get = self.chunks.__getitem__
        return len(segments) - 1 + sum(
            sum(map(get, CHUNK.findall(segment)))
            if len(segment) < 1_000_000
            else sum(get(found.group()) for found in CHUNK.finditer(segment))
            for segment in segments
        )


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(
    docs: DataFrame, vocabulary: str, text: str = "text", limit: int = 512
) -> DataFrame:
    """Input columns (the text aside) with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``vocabulary`` is the path of a byte-level BPE file, the same on every executor.
    """
    workers(docs.sparkSession)
    columns = others(docs, (*OUTPUTS, text))
    rows = docs.select(
        *columns,
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("_text"),
    )
    schema = rows.drop("_text").withColumn("n_tokens", F.lit(0).cast("long")).schema

    def counts(batches):
        count = counter(vocabulary).count
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = pa.array([count(t.as_py()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], found], [*batch.schema.names[:-1], "n_tokens"]
            )

    return rows.mapInArrow(counts, schema).withColumn("over_limit", F.col("n_tokens") > limit)


def op8_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_path("byte_bpe_50k.json"))
