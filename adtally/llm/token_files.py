"""Token ids in binary files of patched frame-of-reference blocks.

Documents are dealt out by ascending id; every task encodes its texts as the
tokenizers library does by default (an added token such as <|endoftext|> in a
text gets its own id), appends the end id to each and writes shard files of bounded size to the shared folder
(under a temporary name, renamed when whole: a task that runs again writes the
same files again). A shard holds its documents' ids and counts, an index of
where every block begins, and the blocks: 256 ids less the block's least, packed
at the bit width that a percentile of them needs; the low bits of the others are
packed as well, their high bits stand in an exception list.

Layout of a shard, little-endian: ``PFR1``; documents, ids, blocks, payload
bytes (4 x u64); document ids (i64 each); null flags (u8 each); id counts (u32
each); block starts in the payload (u64 each); the payload. A block: least
(u32), width (u8), unused (u8), exceptions (u16), packed values (4 x width u64),
exception places (u8 each), their high bits (u32 each). The last block is
filled up with its last id.

Defined results: a null text is empty (its ids are the end id alone); null ids
come first; rows of one id are ordered by a hash of the text; an empty table
gives no files and an empty result; further columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.common import importable, materialize, ranges, steps, text_bytes
from adtally.llm.pieces import PieceCoder
from adtally.session import scratch_path

BLOCK = 256
#: The width is that of this percentile of a block's values.
PERCENTILE = 90
#: A shard is closed when it holds this many ids.
SHARD_TOKENS = 1 << 21
#: Bytes of text encoded at a time: different pieces are looked up once for each step.
_STEP = 4 << 20
_LANES = 64
_HEAD = np.dtype([("least", "<u4"), ("width", "u1"), ("unused", "u1"), ("exceptions", "<u2")])


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(n, 256) values below 2**width -> (n, 4 * width) words."""
    lanes = values.reshape(-1, _LANES).T.astype(np.uint64)
    out = np.zeros((width, lanes.shape[1]), np.uint64)
    for j in range(_LANES):
        word, bit = divmod(j * width, 64)
        out[word] |= lanes[j] << np.uint64(bit)
        if bit + width > 64:
            out[word + 1] |= lanes[j] >> np.uint64(64 - bit)
    return np.ascontiguousarray(out.T).reshape(len(values), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    lanes = np.ascontiguousarray(words.reshape(-1, width).T)
    out = np.empty((_LANES, lanes.shape[1]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(_LANES):
        word, bit = divmod(j * width, 64)
        v = lanes[word] >> np.uint64(bit)
        if bit + width > 64:
            v = v | lanes[word + 1] << np.uint64(64 - bit)
        out[j] = v & mask
    return np.ascontiguousarray(out.T).reshape(len(words), BLOCK)


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(start of each block in the payload, payload) of a sequence of ids below 2**32."""
    if not len(ids):
        return np.zeros(0, np.uint64), b""
    blocks = -(-len(ids) // BLOCK)
    full = np.full(blocks * BLOCK, ids[-1], np.uint32)
    full[:len(ids)] = ids
    full = full.reshape(blocks, BLOCK)
    least = full.min(axis=1)
    rest = full - least[:, None]
    at = BLOCK * PERCENTILE // 100
    width = _bit_length(np.partition(rest, at, axis=1)[:, at])
    odd = (rest.astype(np.uint64) >> width[:, None].astype(np.uint64)) > 0
    exceptions = odd.sum(axis=1)
    size = _HEAD.itemsize + 32 * width + 5 * exceptions
    starts = np.concatenate([[0], np.cumsum(size)])
    payload = np.zeros(int(starts[-1]), np.uint8)
    head = np.zeros(blocks, _HEAD)
    head["least"], head["width"], head["exceptions"] = least, width, exceptions
    payload[starts[:-1, None] + np.arange(_HEAD.itemsize)] = head.view(np.uint8).reshape(blocks, -1)
    for w in np.unique(width[width > 0]).tolist():
        of = np.flatnonzero(width == w)
        packed = _pack(rest[of] & np.uint32((1 << w) - 1), w)
        payload[starts[of, None] + _HEAD.itemsize + np.arange(32 * w)] = packed.astype("<u8").view(np.uint8).reshape(len(of), -1)
    row, place = np.nonzero(odd)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    list_at = (starts[:-1] + _HEAD.itemsize + 32 * width)[row]
    payload[list_at + nth] = place
    high = (rest[row, place] >> width[row].astype(np.uint32)).astype("<u4")
    payload[(list_at + exceptions[row] + 4 * nth)[:, None] + np.arange(4)] = high.view(np.uint8).reshape(-1, 4)
    return starts[:-1].astype(np.uint64), payload.tobytes()


def decode_blocks(payload: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``starts`` (any of them, in any order)."""
    starts = starts.astype(np.int64)
    if not len(starts):
        return np.zeros(0, np.uint32)
    head = np.ascontiguousarray(payload[starts[:, None] + np.arange(_HEAD.itemsize)]).view(_HEAD).ravel()
    width, exceptions = head["width"].astype(np.int64), head["exceptions"].astype(np.int64)
    out = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        of = np.flatnonzero(width == w)
        packed = np.ascontiguousarray(payload[starts[of, None] + _HEAD.itemsize + np.arange(32 * w)]).view("<u8")
        out[of] = _unpack(packed, w).astype(np.uint32)
    list_at = starts + _HEAD.itemsize + 32 * width
    row = np.repeat(np.arange(len(starts)), exceptions)
    place = payload[ranges(list_at, exceptions)]
    high = payload[ranges(list_at + exceptions, 4 * exceptions)].view("<u4")
    out[row, place] |= high << width[row].astype(np.uint32)
    return (out + head["least"][:, None]).ravel()


def pack_shard(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    starts, payload = encode_blocks(ids)
    known = np.array([x if x is not None else 0 for x in doc_ids], "<i8")
    null = np.array([x is None for x in doc_ids], np.uint8)
    return b"".join([b"PFR1", struct.pack("<4Q", len(known), len(ids), len(starts), len(payload)), known.tobytes(),
                     null.tobytes(), counts.astype("<u4").tobytes(), starts.astype("<u8").tobytes(), payload])


class Shard:
    """Reader of one shard; ``tokens(a, b)`` decodes only the blocks it needs."""

    def __init__(self, content: bytes):
        if content[:4] != b"PFR1":
            raise ValueError("not a token shard")
        docs, self.n_tokens, blocks, size = struct.unpack_from("<4Q", content, 4)
        at = 36

        def read(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(content, kind, n, at)
            at += out.nbytes
            return out

        known, null = read("<i8", docs), read("u1", docs)
        self.doc_ids = [None if z else x for x, z in zip(known.tolist(), null.tolist())]
        self.counts, self.starts, self.payload = read("<u4", docs).astype(np.int64), read("<u8", blocks), read("u1", size)

    def tokens(self, a: int, b: int) -> np.ndarray:
        first = a // BLOCK
        got = decode_blocks(self.payload, self.starts[first: -(-b // BLOCK)])
        return got[a - first * BLOCK: b - first * BLOCK]


class TextCoder:
    """Ids of whole texts as the tokenizer gives them (add_special_tokens=False).

    Its added tokens are found in a text first, as the library does; the
    stretches between them are encoded by pieces, each as a text of its own. If
    an added token takes white space or word borders into account, or they are of
    two kinds, or stand in normalized text, a text that may hold one goes through
    the library whole.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.pieces = PieceCoder(lambda pieces: _encode(tokenizer, pieces))
        added = tokenizer.get_added_tokens_decoder()
        self.number = {t.content: i for i, t in added.items()}
        self.normalized = tokenizer.normalizer is not None and any(t.normalized for t in added.values())
        # tokens that are not normalized go before those that are
        self.plain = not any(t.lstrip or t.rstrip or t.single_word for t in added.values()) and len({t.normalized for t in added.values()}) < 2
        # the leftmost, and of those the longest
        self.search = re.compile("|".join(map(re.escape, sorted(self.number, key=len, reverse=True)))) if added else None

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text's begin, with the end)."""
        if self.normalized:
            return self._joined([self._whole(t or "") for t in texts.to_pylist()])
        raw = text_bytes(texts)[0].tobytes() if self.search else b""
        if not any(t.encode() in raw for t in self.number):
            return self.pieces.ids(texts)
        values = [t or "" for t in texts.to_pylist()]
        if not self.plain:
            flat, at = self.pieces.ids(texts)
            return self._joined([self._whole(t) if self.search.search(t) else flat[a:b] for t, a, b in zip(values, at, at[1:])])
        stretches, numbers, last = [], [], []
        for text in values:
            at = 0
            for m in self.search.finditer(text):
                stretches.append(text[at:m.start()])
                numbers.append(self.number[m.group()])
                at = m.end()
            stretches.append(text[at:])
            numbers.append(-1)  # no token after a text's last stretch
            last.append(len(stretches))
        flat, at = self.pieces.ids(pa.array(stretches, pa.string()))
        after = np.array(numbers, np.int64)
        token = after >= 0
        ends = np.concatenate([[0], np.cumsum(np.diff(at) + token)])
        out = np.empty(int(ends[-1]), np.uint32)
        out[ranges(ends[:-1], np.diff(at))] = flat
        out[ends[1:][token] - 1] = after[token]
        return out, ends[np.concatenate([[0], np.array(last, np.int64)])]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    @staticmethod
    def _joined(each: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([np.zeros(0, np.uint32), *each]), np.concatenate([[0], np.cumsum([len(x) for x in each], dtype=np.int64)])


_CODERS: dict[str, TextCoder] = {}


def coder(path: str) -> TextCoder:
    if path not in _CODERS:
        # one core per task, as Spark has scheduled it
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _CODERS[path] = TextCoder(Tokenizer.from_file(path))
    return _CODERS[path]


_PLAIN = re.compile(r" ?\S+").fullmatch
_ALL_PLAIN = re.compile(r"(?: ?\S+\n)* ?\S+").fullmatch
_TOGETHER = 500


def _encode(tokenizer, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the pieces, how many each has). Pieces without white space but a
    leading space are encoded many at a time, with a line feed between them: it
    is a match of its own there, and its id marks where a piece ends."""
    feed = tokenizer.encode("\n", add_special_tokens=False).ids
    texts, plain, rest = [], [], []
    for k in range(0, len(pieces), _TOGETHER):
        lot, places = pieces[k: k + _TOGETHER], range(k, min(k + _TOGETHER, len(pieces)))
        text = "\n".join(lot)
        if len(feed) != 1:
            rest += places
        elif text.count("\n") == len(lot) - 1 and _ALL_PLAIN(text):
            texts.append(text)
            plain += places
        else:
            fits = [i for i in places if _PLAIN(pieces[i])]
            rest += [i for i in places if not _PLAIN(pieces[i])]
            if fits:
                texts.append("\n".join([pieces[i] for i in fits]))
                plain += fits
    flat = [np.zeros(0, np.uint32)]
    for coded in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
        flat += [np.array(coded.ids, np.uint32), np.array(feed, np.uint32)]
    flat = np.concatenate(flat)
    mark = flat == feed[0] if texts else np.zeros(0, bool)
    flat, counts = flat[~mark], np.diff(np.flatnonzero(mark), prepend=-1) - 1
    if not rest:
        return flat, counts
    single = [np.array(coded.ids, np.uint32) for coded in tokenizer.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False)]
    lengths = np.concatenate([counts, np.fromiter(map(len, single), np.int64, len(single))])
    back = np.argsort(plain + rest)
    return np.concatenate([flat, *single])[ranges((np.cumsum(lengths) - lengths)[back], lengths[back])], lengths[back]


def _store(folder: str, name: str, content: bytes) -> None:
    fs, base = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    fs.create_dir(base, recursive=True)
    temporary = f"{base}/.{name}.{TaskContext.get().taskAttemptId()}"
    with fs.open_output_stream(temporary) as out:
        out.write(content)
    fs.move(temporary, f"{base}/{name}")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards to ``folder`` (a shared path or URI); returns the
    manifest, a row per shard: name, n_docs, n_tokens, start (ids before it)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, partition, seq = coder(tokenizer), TaskContext.get().partitionId(), 0
        ids, counts, names, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal seq, held
            name = f"part-{partition:06d}-{seq:06d}.pfor"
            _store(folder, name, pack_shard(names, np.concatenate(counts), np.concatenate(ids)))
            row = pa.RecordBatch.from_pydict({"name": [name], "n_docs": [len(names)], "n_tokens": [held]})
            ids.clear(), counts.clear(), names.clear()
            seq, held = seq + 1, 0
            return row

        for batch in batches:
            for part in steps(batch, "text", _STEP):
                got, at = encode.ids(part.column("text"))
                out = np.full(len(got) + part.num_rows, end_id, np.uint32)
                own = np.ones(len(out), bool)
                own[at[1:] + np.arange(part.num_rows)] = False
                out[own] = got
                ids.append(out), counts.append(np.diff(at) + 1), names.extend(part.column("doc_id").to_pylist())
                held += len(out)
                if held >= SHARD_TOKENS:
                    yield close()
        if names:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")
    manifest = materialize(ordered.mapInArrow(run, "name string, n_docs long, n_tokens long"), "token-manifest")
    before = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard, not per document
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (binary, little-endian u32) of every document in the files."""
    return _read(manifest, folder, "ids binary", lambda ids: ids.tobytes(), pa.binary())


def read_token_checksums(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    return _read(manifest, folder, "ids_crc32 long", zlib.crc32, pa.int64())


def _read(manifest: DataFrame, folder: str, field: str, digest, kind: pa.DataType) -> DataFrame:
    column = field.split()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                shard = Shard(content.as_py())
                ids = shard.tokens(0, shard.n_tokens).astype("<u4")
                at = np.concatenate([[0], np.cumsum(shard.counts)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path.rsplit("/", 1)[-1]] * len(shard.doc_ids), pa.string()), pa.array(shard.doc_ids, pa.int64()), pa.array(at[:-1], pa.int64()),
                     pa.array(shard.counts, pa.int64()), pa.array([digest(ids[a:b]) for a, b in zip(at[:-1], at[1:])], kind)],
                    names=["name", "doc_id", "within", "n_tokens", column])

    spark = manifest.sparkSession
    if not manifest.take(1):
        files = spark.createDataFrame([], "path string, content binary")
    else:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfor").load(folder).select("path", "content")
    rows = files.mapInArrow(run, f"name string, doc_id long, within long, n_tokens long, {field}")
    return rows.join(manifest.select("name", F.col("start").alias("_before")), "name").select(
        "doc_id", (F.col("_before") + F.col("within")).alias("start"), "n_tokens", column)


def token_checksums(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write token files to a new shared folder and read them back, a row per document."""
    spark = docs.sparkSession
    importable(spark)
    folder = scratch_path(spark, "token-files")
    manifest = materialize(write_token_files(docs, folder, tokenizer, end_id), "token-starts")
    return read_token_checksums(manifest, folder)
