"""Encoding with a public byte-level BPE vocabulary.

Merging keeps the symbols of a piece in a doubly linked list and the possible merges in a priority queue by rank; a
queue entry whose symbols have since been merged away is stale and skipped. So a piece of n bytes takes n log n steps,
however long it is. Decoding concatenates the vocabulary's byte strings.

Defined cases: null and empty text have an empty list; strings that look like special tokens are ordinary text; bytes
the vocabulary lacks don't occur, as every single byte is in it.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed value: the pattern that splits text into pieces before merging, as the vocabulary's files define it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where the vocabulary files lie; a parameter of every function that reads them.
TOKENIZERS = "/opt/tokenizers"
#: Pieces whose ids a task remembers, and the longest that it remembers.
CACHED, CACHED_BYTES = 200_000, 64


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a .tiktoken file: a base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    symbol = [piece[i : i + 1] for i in range(n)]
    before = list(range(-1, n - 1))
    after = [*range(1, n), -1]
    queue = [(rank, i, 1, 1) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(queue)
    while queue:
        _, i, left, right = heapq.heappop(queue)
        j = after[i]
        # lengths tell a live pair: a symbol only grows, and one merged away has none
        if j < 0 or len(symbol[i]) != left or len(symbol[j]) != right:
            continue
        joined = symbol[i] + symbol[j]
        symbol[i], symbol[j] = joined, b""
        k = after[i] = after[j]
        after[j] = -1
        if k >= 0:
            before[k] = i
            rank = ranks.get(joined + symbol[k])
            if rank is not None:
                heapq.heappush(queue, (rank, i, len(joined), len(symbol[k])))
        h = before[i]
        if h >= 0:
            rank = ranks.get(symbol[h] + joined)
            if rank is not None:
                heapq.heappush(queue, (rank, h, len(symbol[h]), len(joined)))
    out, i = [], 0
    while i >= 0:
        out.append(ranks[symbol[i]])
        i = after[i]
    return out


def encoder(ranks: dict[bytes, int]):
    """text -> ids, remembering the ids of short pieces."""
    import regex

    pieces = regex.compile(PATTERN).findall
    known: dict[str, list[int]] = {}

    def encode(text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        for p in pieces(text):
            ids = known.get(p)
            if ids is None:
                ids = merge(p.encode(), ranks)
                if len(p) <= CACHED_BYTES:
                    if len(known) >= CACHED:
                        known.clear()
                    known[p] = ids
            out += ids
        return out

    return encode


def encode(df: DataFrame, id_: str, text: str, vocabulary: str = "byte_bpe_50k", tokenizers: str = TOKENIZERS) -> DataFrame:
    """id, ids. The driver reads the vocabulary and broadcasts it: 50,256 entries, about a megabyte, whatever the data."""
    spark = df.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(str(Path(tokenizers) / f"{vocabulary}.tiktoken")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(ranks.value)
        for b in batches:
            ids = [of(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    kind = df.schema[id_].dataType.simpleString()
    return df.select(id_, text).mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_)


def decode(df: DataFrame, id_: str, ids: str, vocabulary: str = "byte_bpe_50k", tokenizers: str = TOKENIZERS) -> DataFrame:
    """id, text: the inverse of ``encode`` (null and empty both come back as the empty text; unknown ids add nothing)."""
    spark = df.sparkSession
    strings = spark.sparkContext.broadcast({i: s for s, i in read_ranks(str(Path(tokenizers) / f"{vocabulary}.tiktoken")).items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = strings.value
        for b in batches:
            texts = [b"".join(of.get(i, b"") for i in x or ()).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    kind = df.schema[id_].dataType.simpleString()
    return df.select(id_, ids).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_)
