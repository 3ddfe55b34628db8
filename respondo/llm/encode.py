"""Encoding of every document with a public byte-level BPE vocabulary.

Two tiers. Texts are cut into pre-tokens; pre-tokens that are whole vocabulary entries are resolved
through a minimal perfect hash, a whole Arrow batch at a time. The others are merged from bytes with a
heap over a linked list: the pair of lowest rank, leftmost on ties, is merged until none is left, which
takes n log n steps even for one pre-token as long as its text.

The vocabulary has a fixed size (50,256 entries), so the tables are built once on the driver and
broadcast. Every partition is encoded on its own: no shuffle."""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import spread
from .perfect_hash import PerfectHash

#: Fixed value of the public vocabulary: how text falls into pre-tokens.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Distinct pre-tokens a Python worker remembers between batches, then starts afresh.
REMEMBERED = 1 << 18


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, lines))}


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token, by a heap of adjacent pairs over linked bytes."""
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    end = list(range(1, n + 1))  # of the part that begins here; 0 once it is swallowed
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if middle == 0 or middle >= n or end[middle] != stop:
            continue  # one of the two parts has changed since
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            rank = ranks.get(piece[i : end[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        left = before[i]
        if left >= 0:
            rank = ranks.get(piece[left:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, left, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class Encoder:
    """Encodes batches of texts; holds the perfect hash, the ranks and the pre-tokens met so far."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PRE_TOKENS):
        self.ranks = ranks
        self.whole = PerfectHash(list(ranks), list(ranks.values()))
        self.split = regex.compile(pattern).findall
        self.known: dict[str, list[int]] = {}

    def __getstate__(self):
        return self.ranks, self.whole, self.split.__self__.pattern

    def __setstate__(self, state):
        self.ranks, self.whole, pattern = state
        self.split, self.known = regex.compile(pattern).findall, {}

    def _learn(self, pieces: list[str]) -> None:
        raw = [piece.encode("utf-8") for piece in pieces]
        for piece, data, found in zip(pieces, raw, self.whole.lookup(raw).tolist()):
            self.known[piece] = [found] if found >= 0 else merge_bytes(data, self.ranks)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of each text; of an empty or null text, none."""
        cut = [self.split(text) if text else [] for text in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = {piece for pieces in cut for piece in pieces if piece not in self.known}
        if new:
            self._learn(list(new))
        known = self.known
        return [[i for piece in pieces for i in known[piece]] for pieces in cut]


def default_vocabulary() -> str:
    return os.environ.get("RESPONDO_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.tiktoken"


def encode_documents(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, ids): the token ids of each row's text, without special tokens.

    `vocabulary` is the path of the rank file on the driver. An empty text and a null text give an empty
    list, a null or repeated key is kept as it is, one row out for each row in; other columns, whatever
    their names, play no part. Strings of special tokens in a text are ordinary text."""
    encoder = Encoder(read_ranks(vocabulary or default_vocabulary()))
    shared = df.sparkSession.sparkContext.broadcast(encoder)
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = shared.value.encode
        for batch in batches:
            ids = encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[key, "ids"])

    return spread(df.select(F.col(key), F.col(text).cast("string"))).mapInArrow(run, schema)


def count_tokens(df: DataFrame, keep: list[str], text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(keep..., n_tokens long): the number of tokens of each row's text, 0 where it is empty or null."""
    encoder = Encoder(read_ranks(vocabulary or default_vocabulary()))
    shared = df.sparkSession.sparkContext.broadcast(encoder)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = shared.value.encode
        for batch in batches:
            sizes = [len(ids) for ids in encode(batch.column(len(keep)).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(sizes, pa.int64())], names=[*keep, "n_tokens"])

    return spread(df.select(*keep, F.col(text).cast("string").alias("_text"))).mapInArrow(run, schema)
