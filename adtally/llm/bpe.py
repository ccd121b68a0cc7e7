"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Merging a pre-token: its bytes are a doubly linked list; every adjacent pair
that the ranks know puts its position in the bucket of its rank. A bitmap of
three levels marks the ranks with a bucket; find-first-set from the top gives
the lowest one in constant time. Positions of a bucket are taken in ascending
order; an entry is stale, and skipped, if its pair has changed since. Every
merge costs constant time, so a pre-token of a million bytes is as cheap per
byte as a short one.

Whole texts are encoded by :class:`~adtally.llm.pieces.PieceCoder`, each
different piece once. Defined results: a null text is empty and has no ids;
repeated rows give repeated rows; an empty table gives an empty result; further
columns are ignored. Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import ranges, steps
from adtally.llm.pieces import PieceCoder


class RankQueue:
    """Buckets of positions by rank, with a three-level bitmap (64-way) over the ranks."""

    __slots__ = ("buckets", "words", "groups", "top")

    def __init__(self):
        self.buckets: dict[int, list[int]] = {}
        self.words: dict[int, int] = {}
        self.groups: dict[int, int] = {}
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heapq.heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        word = rank >> 6
        group = word >> 6
        self.words[word] = self.words.get(word, 0) | 1 << (rank & 63)
        self.groups[group] = self.groups.get(group, 0) | 1 << (word & 63)
        self.top |= 1 << group

    def pop(self) -> tuple[int, int]:
        """The lowest rank and the first position in its bucket."""
        group = (self.top & -self.top).bit_length() - 1
        bits = self.groups[group]
        word = group << 6 | (bits & -bits).bit_length() - 1
        bits = self.words[word]
        rank = word << 6 | (bits & -bits).bit_length() - 1
        bucket = self.buckets[rank]
        position = heapq.heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.words[word] &= self.words[word] - 1
            if not self.words[word]:
                self.groups[group] &= self.groups[group] - 1
                if not self.groups[group]:
                    self.top &= self.top - 1
        return rank, position

    def __bool__(self) -> bool:
        return self.top != 0


def merge(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the known pair of lowest rank, leftmost first, is merged until none is left."""
    whole = ranks.get(token)
    if whole is not None:
        return [whole]
    n = len(token)
    get = ranks.get
    after = list(range(1, n + 1))  # start of the next part; n: none
    before = list(range(-1, n - 1))
    queue = RankQueue()
    pair_rank = [-1] * n  # of the pair that begins here now
    for i in range(n - 1):
        r = get(token[i:i + 2])
        if r is not None:
            pair_rank[i] = r
            queue.push(r, i)
    while queue:
        rank, i = queue.pop()
        if pair_rank[i] != rank:
            continue  # stale
        j = after[i]
        k = after[j]
        after[i] = k
        pair_rank[i] = pair_rank[j] = -1
        if k < n:
            before[k] = i
            r = get(token[i:after[k]])
            if r is not None:
                pair_rank[i] = r
                queue.push(r, i)
        h = before[i]
        if h >= 0:
            r = get(token[h:k])
            pair_rank[h] = -1 if r is None else r
            if r is not None:
                queue.push(r, h)
    out, i = [], 0
    while i < n:
        out.append(ranks[token[i:after[i]]])
        i = after[i]
    return out


class Vocabulary:
    """Ranks of a .tiktoken file (``token in base64, space, rank`` per line)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.split = regex.compile(pattern).findall
        self.coder = PieceCoder(self.encode_pieces)
        self.known: dict[str, list[int]] = {}
        size = max(self.ranks.values()) + 1
        lengths = np.zeros(size, np.int64)
        for token, rank in self.ranks.items():
            lengths[rank] = len(token)
        self.token_at = np.concatenate([[0], np.cumsum(lengths)])
        joined = bytearray(int(self.token_at[-1]))
        for token, rank in self.ranks.items():
            joined[self.token_at[rank]:self.token_at[rank] + len(token)] = token
        self.token_bytes = np.frombuffer(bytes(joined), np.uint8)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > 200_000:
            self.known.clear()
        ids: list[int] = []
        ends = [0]
        for piece in pieces:
            for token in self.split(piece):
                got = self.known.get(token)
                if got is None:
                    got = merge(token.encode(), self.ranks)
                    if len(token) < 64:
                        self.known[token] = got
                ids += got
            ends.append(len(ids))
        return np.array(ids, np.uint32), np.diff(ends)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the ids' tokens, and how many each has."""
        ids = ids.astype(np.int64)
        lengths = self.token_at[ids + 1] - self.token_at[ids]
        return self.token_bytes[ranges(self.token_at[ids], lengths)], lengths


_LOADED: dict[tuple[str, str], Vocabulary] = {}


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """Kept per worker, as reading the ranks takes longer than a small task."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Vocabulary(path, pattern)
    return _LOADED[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) of each row's text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for batch in batches:
            for part in steps(batch, "text", 1 << 21):
                ids, at = vocab.coder.ids(part.column("text"))
                raw = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([raw[4 * a: 4 * b] for a, b in zip(at[:-1], at[1:])], pa.binary())], names=["doc_id", "ids"])

    return _rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, text of rows (doc_id, ids) as written by :func:`encode_documents`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for batch in batches:
            texts = [vocab.decode(np.frombuffer(x or b"", "<u4"))[0].tobytes().decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, then decodes the ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for batch in batches:
            for part in steps(batch, "text", 1 << 21):
                ids, at = vocab.coder.ids(part.column("text"))
                raw = memoryview(ids.astype("<u4").tobytes())
                decoded, lengths = vocab.decode(ids)
                sums = np.concatenate([[0], np.cumsum(lengths)])[at]
                decoded = memoryview(decoded)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(at), pa.int64()),
                     pa.array([hashlib.sha256(raw[4 * a: 4 * b]).hexdigest() for a, b in zip(at[:-1], at[1:])], pa.string()),
                     pa.array([hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(sums[:-1], sums[1:])], pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


