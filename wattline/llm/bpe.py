"""Encodes whole texts to BPE ids and decodes them, long unsplit text by tree concatenation.

The vocabulary's own normalizer and splitter cut a text into pre-tokens; byte pairs merge
within a pre-token only. A pre-token longer than a leaf is halved, the halves are encoded on
their own, and the ids around the join are encoded again in a growing window until the window
and both halves share a token: at the same place, of the same length, with the same id. As
neighbours that are right pairwise make a right whole, the joined ids are exactly those of the
unhalved pre-token.

Texts longer than ``spread`` characters are cut into pieces that become rows of their own: runs
of whole pre-tokens, and leaves of long pre-tokens. Tasks encode pieces in parallel; the pieces
of one text then meet again, the leaves by tree concatenation.

Defined cases: a null or empty text has no ids and decodes to an empty text; special strings
inside a text are their special token, as the library does by default; repeated rows stay; an
input column named like an output column is replaced.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import extended, others, table, workers
from wattline.llm.vocabularies import LATIN, Recent, byte_symbols, load, public_path

OUTPUTS = ("ids", "decoded")
LEAF = 16
PIECE = 16_384
SPREAD = 65_536
RUNS, PIECES_KEPT = 200_000, 60_000  # answers that a worker keeps, twice as many at most
RUN = re.compile(r"[^ \t\n\r\x0b\x0c]+")


def leaf_tokens(model, suffix: int, symbols: str) -> list[tuple[int, int]]:
    """(id, number of symbols) of each token; the last symbol counts as the end of a word."""
    found = [(t.id, len(t.value)) for t in model.tokenize(symbols)]
    if suffix and found:
        found[-1] = (found[-1][0], found[-1][1] - suffix)
    return found


def _places(tokens, start: int) -> dict:
    """Index of each token by its place and id."""
    found = {}
    for i, (token, length) in enumerate(tokens):
        found[start, token, length] = i
        start += length
    return found


def concatenate(left, right, symbols: str, cut: int, encode) -> list[tuple[int, int]]:
    """Tokens of ``symbols`` from the tokens of its parts before and after ``cut``."""
    reach = 2
    while True:
        tail, head = left[-reach:], right[:reach]
        a, b = cut - sum(n for _, n in tail), cut + sum(n for _, n in head)
        window = encode(symbols[a:b])
        # the last token of the window or of the left part may wrongly end a word there
        inner = _places(window[:-1], a)
        first, kept, last, rest = 0, [], len(window), []
        if a > 0:
            known = [(inner[k], i) for k, i in _places(tail[:-1], a).items() if k in inner]
            first = known[0][0] + 1 if known else None
            kept = left[: len(left) - len(tail) + known[0][1] + 1] if known else []
        if b < len(symbols):
            known = [(inner[k], i) for k, i in _places(head, cut).items() if k in inner]
            last = known[-1][0] + 1 if known else None
            rest = right[known[-1][1] + 1 :] if known else []
        if first is not None and last is not None and first <= last:
            return kept + window[first:last] + rest
        reach *= 2


def tree_tokens(symbols: str, encode, leaf: int = LEAF) -> list[tuple[int, int]]:
    """Tokens of a pre-token of any length."""
    if len(symbols) <= leaf:
        return encode(symbols)
    half = len(symbols) // 2
    return concatenate(
        tree_tokens(symbols[:half], encode, leaf), tree_tokens(symbols[half:], encode, leaf),
        symbols, half, encode,
    )


def joined(parts: list[tuple[str, list]], encode) -> list[tuple[int, int]]:
    """Tree concatenation of neighbouring leaves, each with its symbols and tokens."""
    while len(parts) > 1:
        pairs = [
            (a + b, concatenate(x, y, a + b, len(a), encode))
            for (a, x), (b, y) in zip(parts[::2], parts[1::2])
        ]
        parts = pairs + parts[len(parts) - len(parts) % 2 :]
    return parts[0][1]


class Codec:
    """Encodes and decodes under one vocabulary."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        self.suffix = len(self.model.end_of_word_suffix or "")
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {token.content: i for i, token in added.items()}
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.special_text = re.compile(f"({'|'.join(names)})") if names else None
        size = self.tokenizer.get_vocab_size()
        self.texts = [self.tokenizer.id_to_token(i) for i in range(size)]
        self.runs, self.pieces = Recent(self._run, RUNS), Recent(self._piece, PIECES_KEPT)
        self.symbols = byte_symbols()
        self.pattern = _plain_pattern(path)

    def leaf(self, symbols: str):
        return leaf_tokens(self.model, self.suffix, symbols)

    def pretokens(self, run: str):
        """(special id or None, symbols) of each pre-token of a run without white space."""
        for part in self.special_text.split(run) if self.special_text else [run]:
            if part in self.special:
                yield self.special[part], ""
            elif part:
                normal = self.tokenizer.normalizer.normalize_str(part)
                for symbols, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
                    yield None, symbols

    def _piece(self, piece: str) -> bytes:
        symbols = "".join(map(self.symbols.__getitem__, piece.encode()))
        return _packed(i for i, _ in tree_tokens(symbols, self.leaf))

    def _run(self, run: bytes) -> bytes:
        """Ids of a run without white space, four bytes each."""
        text = run.decode()
        if (
            self.pattern and LATIN.fullmatch(text)
            and not (self.special_text and self.special_text.search(text))
        ):
            return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text.lower())))
        ids: list[int] = []
        for special, symbols in self.pretokens(text):
            ids += [special] if special is not None else [i for i, _ in tree_tokens(symbols, self.leaf)]
        return _packed(ids)

    def encode(self, text: str | None) -> np.ndarray:
        runs = (text or "").encode().split()
        return np.frombuffer(b"".join(map(self.runs.__getitem__, runs)), np.int32)

    def decode(self, ids) -> str:
        return " ".join(map(self.texts.__getitem__, ids))


def _packed(ids) -> bytes:
    return np.fromiter(ids, np.int32).tobytes()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _plain_pattern(path: str):
    """The split pattern, if the vocabulary only composes, lower-cases and keeps its matches."""
    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    normal = (read["normalizer"] or {}).get("normalizers", [])
    split = (read["pre_tokenizer"] or {}).get("pretokenizers", [])
    if [n["type"] for n in normal] != ["NFC", "Replace", "Lowercase"] or len(split) != 2:
        return None
    first, second = split
    if first.get("behavior") != "Removed" or not first.get("invert") or second["type"] != "ByteLevel":
        return None
    return regex.compile(first["pattern"]["Regex"])


def _pieces(read: Codec, text: str):
    """(kind, symbols): 0 whole pre-tokens, 1 a leaf of a long one, 2 its last leaf."""
    waiting, length = [], 0
    for run in RUN.finditer(text):
        for special, symbols in read.pretokens(run.group()):
            if len(symbols) > PIECE:
                if waiting:
                    yield 0, " ".join(waiting)
                    waiting, length = [], 0
                leaves = range(0, len(symbols), PIECE)
                for start in leaves:
                    yield 1 + (start == leaves[-1]), symbols[start : start + PIECE]
                continue
            waiting.append(symbols if special is None else f"\0{special}")
            length += len(symbols) + 1
            if length > PIECE:
                yield 0, " ".join(waiting)
                waiting, length = [], 0
    yield 0, " ".join(waiting)


def _spread(long: DataFrame, vocabulary: str, out_schema) -> DataFrame:
    """Texts cut into pieces, pieces encoded wherever there is room, and put together."""
    n = len(long.columns) - 1
    names = [f"c{i}" for i in range(n)]
    whole = long.toDF(*names, "text").withColumn("row", F.monotonically_increasing_id())
    cut_schema = extended(whole.drop("text").schema, "pos int, kind int, symbols string")
    coded_schema = extended(cut_schema, "ids array<int>, lengths array<int>")

    def cut(batches):
        read = codec(vocabulary)
        for batch in batches:
            rest = batch.drop_columns(["text"])
            for i in range(batch.num_rows):
                row = rest.slice(i, 1)
                for pos, (kind, symbols) in enumerate(_pieces(read, batch["text"][i].as_py())):
                    yield pa.RecordBatch.from_arrays(
                        [*row.columns, pa.array([pos], pa.int32()), pa.array([kind], pa.int32()), pa.array([symbols])],
                        [*row.schema.names, "pos", "kind", "symbols"],
                    )

    def encode(batches):
        read = codec(vocabulary)
        for batch in batches:
            ids, lengths = [], []
            for kind, symbols in zip(batch["kind"].to_pylist(), batch["symbols"].to_pylist()):
                if kind:
                    tokens = tree_tokens(symbols, read.leaf)
                else:
                    tokens = []
                    for piece in symbols.split(" ") if symbols else ():
                        tokens += [(int(piece[1:]), 0)] if piece[0] == "\0" else tree_tokens(piece, read.leaf)
                ids.append([i for i, _ in tokens])
                lengths.append([k for _, k in tokens])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(lengths, pa.list_(pa.int32()))],
                [*batch.schema.names, "ids", "lengths"],
            )

    def together(rows: pa.Table) -> pa.Table:
        read = codec(vocabulary)
        rows = rows.sort_by("pos")
        ids, leaves = [], []
        for kind, symbols, found, lengths in zip(*(rows[c].to_pylist() for c in ("kind", "symbols", "ids", "lengths"))):
            if not kind:
                ids += found
                continue
            leaves.append((symbols, list(zip(found, lengths))))
            if kind == 2:
                ids += [i for i, _ in joined(leaves, read.leaf)]
                leaves = []
        first = rows.slice(0, 1)
        return pa.table(
            [*(first[c] for c in names), pa.array([ids], pa.list_(pa.int32())), pa.array([read.decode(ids)])],
            names=out_schema.names,
        )

    pieces = whole.mapInArrow(cut, cut_schema).repartition("row", "pos")
    return pieces.mapInArrow(encode, coded_schema).groupBy("row").applyInArrow(together, out_schema)


def encode(docs: DataFrame, vocabulary: str, text: str = "text", spread: int = SPREAD) -> DataFrame:
    """Input columns (the text aside) with ``ids`` and ``decoded``, the text of those ids.

    ``vocabulary`` is the path of a BPE file whose splitter drops white space, the same on
    every executor.
    """
    workers(docs.sparkSession)
    columns = others(docs, (*OUTPUTS, text))
    rows = docs.select(*columns, F.col(text).alias("_text"))
    schema = extended(rows.drop("_text").schema, "ids array<int>, decoded string")
    long = F.coalesce(F.length("_text"), F.lit(0)) > spread
    keep = len(columns)

    def whole(batches):
        read = codec(vocabulary)
        for batch in batches:
            found = [read.encode(t.as_py()) for t in batch.column(keep)]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, np.int32), *found]))
            decoded = pa.array([read.decode(f.tolist()) for f in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:keep], ids, decoded], schema.names)

    return rows.where(~long).mapInArrow(whole, schema).unionByName(
        _spread(rows.where(long), vocabulary, schema)
    )


def decode(rows: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Input columns with the text of an id column."""

    @F.pandas_udf("string")
    def text(found):
        read = codec(vocabulary)
        return found.map(lambda x: read.decode(x) if x is not None else "")

    return rows.withColumn(out, text(ids))


def digests(coded: DataFrame) -> DataFrame:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of encoded rows."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op7_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(encode(docs, public_path("word_bpe_49k.json")))
