"""Alignment of two tokenizers by inverted bitmaps of token pairs.

A text's tokens under A and under B are cut into groups at the byte offsets at
which tokens of both end; an A token and a B token whose bytes overlap are
linked. The score of a pair is in how many documents it is linked.

Inverted index: documents are numbered in chunks of up to 65,536; for each pair
of ids and chunk there is a compressed bitmap of the documents that link it
(sorted 16-bit numbers, or plain bits where these are shorter), and multiplicity
planes, one for each bit of how many more links than one a document has. The
bitmaps of a pair are merged over its chunks, which share no document, by adding
their popcounts: document counts from the first, link counts from the planes. The
postings of each chunk then meet the counts of their pairs and hand them back to
their documents, plane by plane, weighted by what the plane stands for.

Texts are encoded by their different pieces, cut where neither tokenizer looks
across: before a single space, and around a single line feed, between characters
that are no white space; between a letter or digit and a punctuation mark that no
entry of B has after one (``Aligner`` looks through the vocabulary of B). Pieces
start and end on a group border, so a text's groups and links are those of its
pieces, one after the other.

Defined results: a text that is null, empty, or whose joined token bytes under
either tokenizer differ from a space and the text has no tokens: zeros and ''.
Whole texts are taken; a text longer than a chunk's bytes is a chunk of its own
and is held by one task. Repeated rows are documents of their own. The id column
keeps its type; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import os
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.common import importable, materialize, ranges, steps, text_bytes
from adtally.llm.pieces import _ALNUM, _INK, _LATIN, _LEAD2, _LEAD3, _STARTS
from adtally.llm.token_files import _encode

#: Bytes of text and documents of a chunk (documents: numbers of 16 bits).
CHUNK_BYTES, CHUNK_DOCS = 12 << 20, 1 << 16
#: Different pieces kept by a worker, in each of two generations.
CACHE_PIECES = 120_000
#: Bits of an id in a sort key.
ID_BITS = 24

_PLAIN = re.compile(r" ?\S+").fullmatch
_TOGETHER = 500


def cut_places(raw: np.ndarray, offsets: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Ascending byte positions at which a new piece starts, text starts included.
    marks: which bytes start a piece after a letter or digit."""
    cut = np.zeros(len(raw) + 1, bool)
    if len(raw) > 2:
        tail = (raw & 0xC0) == 0x80
        ends = _INK[raw]  # the last byte of a character that is no white space
        ends[1:] |= tail[1:] & _LEAD2[raw[:-1]]
        ends[2:] |= tail[2:] & _LEAD3[raw[:-2]]
        alone = ends[:-2] & _STARTS[raw[2:]]  # one byte between two such characters
        cut[1:-2] = ((raw[1:-1] == 32) | (raw[1:-1] == 10)) & alone
        cut[2:-1] |= (raw[1:-1] == 10) & alone
        word = _ALNUM[raw]  # the last byte of a letter or digit
        word[1:] |= (raw[:-1] == 0xC3) & _LATIN[raw[1:]]
        cut[1:-1] |= marks[raw[1:]] & word[:-1]
    cut[offsets] = True
    cut[len(raw)] = False
    return np.flatnonzero(cut)


class _Bytes:
    """The bytes of every id of a vocabulary."""

    def __init__(self, entries: list[bytes]):
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        self.lengths = np.fromiter(map(len, entries), np.int64, len(entries))
        self.starts = np.cumsum(self.lengths) - self.lengths

    def of(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[ranges(self.starts[ids], self.lengths[ids])]


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself
    if it is printable Latin-1, else the next free one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Encodes pieces with both tokenizers and aligns them; keeps what is common."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task, as Spark has scheduled it
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        alphabet, n = byte_alphabet(), self.a.get_vocab_size()
        names = [self.a.id_to_token(i) or "" for i in range(n)]
        self.bytes_a = _Bytes([bytes(alphabet[c] for c in s) if all(c in alphabet for c in s) else s.encode() for s in names])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = _Bytes([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
        if max(n, len(pieces)) >= 1 << ID_BITS:
            raise ValueError("a vocabulary is too large for the sort key")
        self.feed = self.b.encode("\n")[1:]
        across = [p for i, p in enumerate(pieces) if "▁" in p[1:] and p.strip("▁") or "\n" in p]
        if len(self.feed) != 1 or across:
            raise ValueError("tokenizer B merges across spaces or line feeds")
        # A ends a match before every punctuation mark but the apostrophe.
        joined = {y for i, p in enumerate(pieces) if not self.b.is_byte(i) for x, y in zip(p, p[1:]) if x.isalnum()}
        self.marks = np.zeros(256, bool)
        self.marks[[ord(c) for c in string.punctuation if c != "'" and c not in joined]] = True
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def _ids_b(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``token_files._encode`` for A: plain pieces together, each after a line
        feed, the others each by itself after one, which keeps the library from
        putting a space before a piece that has none."""
        feed, out = self.feed[0], [None] * len(pieces)
        plain = [i for i, p in enumerate(pieces) if _PLAIN(p)]
        lots = [plain[k: k + _TOGETHER] for k in range(0, len(plain), _TOGETHER)]
        for lot, ids in zip(lots, self.b.encode(["\n" + "\n".join([pieces[i] for i in lot]) for lot in lots], num_threads=1)):
            ids = np.array(ids, np.int64)
            at = np.flatnonzero(ids == feed)
            for i, x, y in zip(lot, (at + 1).tolist(), [*at[1:].tolist(), len(ids)]):
                out[i] = ids[x:y]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self.b.encode(["\n" + pieces[i] for i in rest], num_threads=1)):
            out[i] = np.array(ids[2:], np.int64)  # without the space before the feed, and it
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))

    def _align(self, pieces: list[str]) -> list[tuple]:
        """(tokens of A, of B, groups, their text, sorted link keys) of each piece; n_a is -1 if bytes differ."""
        raw = [p.encode() for p in pieces]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        ids_a, count_a = _encode(self.a, pieces)
        ids_a = ids_a.astype(np.int64)
        ids_b, count_b = self._ids_b(pieces)
        owner_a, owner_b = np.repeat(np.arange(len(pieces)), count_a), np.repeat(np.arange(len(pieces)), count_b)
        length_a, length_b = self.bytes_a.lengths[ids_a], self.bytes_b.lengths[ids_b]
        good = (np.bincount(owner_a, length_a, len(pieces)) == size) & (np.bincount(owner_b, length_b, len(pieces)) == size)
        joined = np.frombuffer(b"".join([r for r, g in zip(raw, good.tolist()) if g]), np.uint8)
        owner = np.repeat(np.flatnonzero(good), size[good])
        for table, ids, of in ((self.bytes_a, ids_a, owner_a), (self.bytes_b, ids_b, owner_b)):
            good_now = good.copy()
            good_now[owner[table.of(ids[good[of]]) != joined]] = False
            joined, owner, good = joined[good_now[owner]], owner[good_now[owner]], good_now
        keep_a, keep_b = good[owner_a], good[owner_b]
        ids_a, ids_b = ids_a[keep_a], ids_b[keep_b]
        end_a, end_b, end = np.cumsum(length_a[keep_a]), np.cumsum(length_b[keep_b]), np.cumsum(size[good])
        # Between two neighbouring ends lies the overlap of one A and one B token, and
        # each overlap is one such stretch.
        stretch = np.union1d(end_a, end_b)
        links = (ids_a[np.searchsorted(end_a, stretch)] << ID_BITS) | ids_b[np.searchsorted(end_b, stretch)]
        link_to = np.searchsorted(stretch, end, "right").tolist()
        group = np.intersect1d(end_a, end_b, assume_unique=True)
        text_a, text_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        to_a, to_b = np.searchsorted(end_a, group, "right").tolist(), np.searchsorted(end_b, group, "right").tolist()
        groups = [",".join(text_a[i:j]) + "|" + ",".join(text_b[k:m]) for i, j, k, m in zip([0, *to_a], to_a, [0, *to_b], to_b)]
        group_to = np.searchsorted(group, end, "right").tolist()
        out: list = [(-1, 0, 0, "", b"")] * len(pieces)
        n_a, n_b, links = count_a.tolist(), count_b.tolist(), links.astype("<i8").tobytes()
        for i, x, y, g, h in zip(np.flatnonzero(good).tolist(), [0, *link_to], link_to, [0, *group_to], group_to):
            out[i] = (n_a[i], n_b[i], h - g, ";".join(groups[g:h]), links[8 * x: 8 * y])
        return out

    def pieces(self, different: list[str]) -> list[tuple]:
        found = list(map(self.young.get, different))
        missing = [i for i, x in enumerate(found) if x is None]
        unknown = []
        for i in missing:
            found[i] = self.old.get(different[i])
            if found[i] is None:
                unknown.append(i)
        for k in range(0, len(unknown), 20_000):
            lot = unknown[k: k + 20_000]
            for i, made in zip(lot, self._align([different[i] for i in lot])):
                found[i] = made
        self.young.update((different[i], found[i]) for i in missing if len(different[i]) < 64)
        if len(self.young) > CACHE_PIECES:
            self.young, self.old = {}, self.young
        return found


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _aligned(tool: Aligner, texts: pa.Array) -> tuple[dict[str, list], np.ndarray, np.ndarray, np.ndarray]:
    """Per text n_a, n_b, n_groups, n_links, groups_sha256; and the links of the
    texts: which text, link key, how often (a key may come several times)."""
    n = len(texts)
    spaced = pa.array([" " + t if t else "" for t in texts.to_pylist()], pa.large_string()).cast(pa.string())
    raw, offsets = text_bytes(spaced)
    names = ("n_a", "n_b", "n_groups", "n_links")
    if not len(raw):
        return {c: np.zeros(n, np.int64) for c in names} | {"groups_sha256": [""] * n}, *(np.zeros(0, np.int64),) * 3
    starts = cut_places(raw, offsets, tool.marks)
    bounds = np.append(starts, len(raw)).astype(np.int32)
    coded = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(raw)).dictionary_encode()
    number = coded.indices.to_numpy()
    known = tool.pieces(coded.dictionary.to_pylist())
    per = np.array([x[:3] for x in known], np.int64).reshape(-1, 3)
    flat = np.frombuffer(b"".join([x[4] for x in known]), "<i8")
    many = np.fromiter((len(x[4]) >> 3 for x in known), np.int64, len(known))
    begin = np.cumsum(many) - many
    first = np.searchsorted(starts, offsets)
    owner = np.repeat(np.arange(n), np.diff(first))
    bad = np.bincount(owner, per[number, 0] < 0, n) > 0
    sums = [np.where(bad, 0, np.bincount(owner, v[number], n)).astype(np.int64) for v in (*per.T, many)]
    said, order = [x[3] for x in known], number.tolist()
    digests = ["" if b or i == j else hashlib.sha256(";".join([said[k] for k in order[i:j]]).encode()).hexdigest()
               for i, j, b in zip(first[:-1].tolist(), first[1:].tolist(), bad.tolist())]
    seen, times = np.unique(owner[~bad[owner]] * len(known) + number[~bad[owner]], return_counts=True)
    which = seen % len(known)
    keys = flat[ranges(begin[which], many[which])]
    return dict(zip(names, sums)) | {"groups_sha256": digests}, np.repeat(seen // len(known), many[which]), keys, np.repeat(times, many[which])


def _postings(doc: np.ndarray, key: np.ndarray, times: np.ndarray, n_docs: int) -> Iterator[dict]:
    """The bitmaps of a chunk, by plane: 0 for the documents of a pair, p for bit
    p - 1 of the number of its further links in a document."""
    both = (key.astype(np.uint64) << np.uint64(16)) | doc.astype(np.uint64)
    order = np.argsort(both, kind="stable")
    both = both[order]
    new = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
    more = np.add.reduceat(times[order], new) - 1 if len(new) else np.zeros(0, np.int64)
    linked = both[new]
    yield _plane(linked, 0, n_docs)
    for bit in range(int(more.max(initial=0)).bit_length()):
        yield _plane(linked[(more >> bit) & 1 == 1], bit + 1, n_docs)


def _plane(linked: np.ndarray, plane: int, n_docs: int) -> dict:
    """A row for each pair in ``linked`` (sorted: pair, then 16 bits of document)."""
    key, doc = linked >> np.uint64(16), (linked & np.uint64(0xFFFF)).astype("<u2")
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    at = np.append(start, len(key))
    card = np.diff(at)
    dense = 2 * card > (n_docs + 7) // 8
    packed = doc.tobytes()
    bits = [packed[2 * i: 2 * j] for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
    for i in np.flatnonzero(dense).tolist():
        plain = np.zeros(n_docs, bool)
        plain[doc[at[i]: at[i + 1]]] = True
        bits[i] = np.packbits(plain, bitorder="little").tobytes()
    pair = key[start].astype(np.int64)
    return {"plane": np.full(len(start), plane, np.int32), "a": (pair >> ID_BITS).astype(np.int32), "b": (pair & ((1 << ID_BITS) - 1)).astype(np.int32),
            "card": card, "dense": dense, "bits": bits}


_POSTING = "plane int, a int, b int, card long, dense boolean, bits binary"
_DOC = "local int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def pair_index(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, postings), written to the shared folder. Documents: chunk, local
    (number in it), doc_id and what the text alone tells. Postings: chunk, plane, a,
    b, card (popcount), dense, bits."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, task, seq = aligner(path_a, path_b), TaskContext.get().partitionId(), 0
        ids, docs, links, held, size = [], [], [], 0, 0

        def table(columns: dict, n: int) -> Iterator[pa.RecordBatch]:
            chunk = pa.array(np.full(n, (task << 32) | seq), pa.int64())
            made = [chunk if f.name == "chunk" else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in out]
            whole = pa.RecordBatch.from_arrays(made, schema=out)
            yield from (whole.slice(i, 50_000) for i in range(0, n, 50_000))

        def close() -> Iterator[pa.RecordBatch]:
            columns = {c: [x for d in docs for x in d[c]] for c in docs[0]}
            yield from table(columns | {"local": np.arange(held), "doc_id": pa.concat_arrays(ids)}, held)
            doc, key, times = (np.concatenate(x) for x in zip(*links))
            for part in _postings(doc, key, times, held):
                yield from table(part, len(part["bits"]))

        out = None
        for batch in batches:
            if out is None:
                fixed = pa.schema([("plane", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("card", pa.int64()), ("dense", pa.bool_()), ("bits", pa.binary()), ("local", pa.int32()),
                                   *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string())])
                out = pa.schema([("chunk", pa.int64()), batch.schema.field("doc_id"), *fixed])
            for part in steps(batch, "text"):
                bytes_now = part.column("text").nbytes
                if held and (held + part.num_rows > CHUNK_DOCS or size + bytes_now > CHUNK_BYTES):
                    yield from close()
                    ids, docs, links, held, size, seq = [], [], [], 0, 0, seq + 1
                own, doc, key, times = _aligned(tool, part.column("text"))
                ids.append(part.column("doc_id")), docs.append(own), links.append((doc + held, key, times))
                held, size = held + part.num_rows, size + bytes_now
        if held:
            yield from close()

    importable(docs.sparkSession)
    both = materialize(rows.mapInArrow(run, f"chunk long, doc_id {kind}, {_POSTING}, {_DOC}"), "alignment")
    documents = both.where("plane IS NULL").select("chunk", "local", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return documents, both.where("plane IS NOT NULL").select("chunk", "plane", "a", "b", "card", "dense", "bits")


def pair_counts(postings: DataFrame) -> DataFrame:
    """a, b, n_docs, n_links, best (n_docs is the highest of its a). The bitmaps of a
    pair share no document, so the popcount of their union is the sum of theirs."""
    first = F.col("plane") == 0
    weight = F.when(first, F.lit(1)).otherwise(F.pow(F.lit(2), F.col("plane") - 1)).cast("long")
    counts = postings.groupBy("a", "b").agg(F.sum(F.when(first, F.col("card")).otherwise(0)).alias("n_docs"), F.sum(F.col("card") * weight).alias("n_links"))
    highest = F.max("n_docs").over(Window.partitionBy("a"))  # as many rows as B has ids, at most
    return counts.withColumn("best", F.col("n_docs") == highest)


def _handed_back(documents: pa.Table, postings: pa.Table) -> pa.Table:
    """The scores of the documents of one chunk from its postings."""
    n = documents.num_rows
    best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if postings.num_rows:
        plane = postings.column("plane").to_numpy().astype(np.int64)
        weight = np.where(plane == 0, 1, 1 << np.maximum(plane - 1, 0))
        count, top = postings.column("n_docs").to_numpy() * weight, postings.column("best").to_numpy() * weight
        dense = postings.column("dense").to_numpy()
        bits = postings.column("bits")
        short = bits.filter(pa.array(~dense)).to_pylist()
        docs = np.frombuffer(b"".join(short), "<u2")
        many = np.fromiter((len(x) >> 1 for x in short), np.int64, len(short))
        np.add.at(best, docs, np.repeat(top[~dense], many))
        np.add.at(total, docs, np.repeat(count[~dense], many))
        for raw, c, t in zip(bits.filter(pa.array(dense)).to_pylist(), count[dense].tolist(), top[dense].tolist()):
            on = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little", count=n).astype(bool)
            best[on] += t
            total[on] += c
    local = documents.column("local").to_numpy()
    return documents.drop_columns(["chunk", "local"]).append_column("n_best", pa.array(best[local])).append_column("count_sum", pa.array(total[local]))


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum of every row."""
    documents, postings = pair_index(docs, path_a, path_b, id_col, text_col)
    counts = materialize(pair_counts(postings), "alignment-counts")
    scored = postings.join(counts.drop("n_links"), ["a", "b"]).select(F.col("chunk").alias("of_chunk"), "plane", "dense", "bits", "n_docs", "best")
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return documents.groupBy("chunk").cogroup(scored.groupBy("of_chunk")).applyInArrow(_handed_back, schema)
