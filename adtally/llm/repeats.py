"""Removal of long repeated byte strings by column-wise suffix sorting.

A byte goes if it lies in a string of ``LENGTH`` bytes that starts anywhere else
in the collection, the same document included. Every window (each start of such
a string) is assigned to its anchor, the place in it whose 64-byte hash is least
(leftmost of equals): equal windows have equal anchors at equal distance.
Consecutive windows of one anchor form a read, the bytes they cover. Reads that
occur more than once are repeated whole and need no sorting; the different reads
of an anchor, laid out with the anchor in the same column, are sorted by the
column-wise construction for collections of strings (M. Bauer, A. Cox, G.
Rosone, "Lightweight algorithms for constructing and inverting the BWT of string
collections", 2013): from the last column to the first, one symbol of every read
is put in front of its suffix, and the order of all suffixes and the common
prefixes of neighbours are updated from those of the round before. As reads are
aligned, equal windows enter in the same round, so only that round's order is
kept; a window is repeated if a neighbour shares ``LENGTH`` bytes. A collection
larger than memory allows has its columns in a temporary file that is read
sequentially, one column a round.

Spark deals the reads out by anchor: a task holds one block of anchors at a
time. Copies of a document are one text from the start.

Defined results: a null text is empty; texts shorter than LENGTH lose nothing;
repeated rows are documents of their own (each is repeated in the other); null
ids stay; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import materialize, sized_broadcast, steps
from adtally.llm.words import _CODES, mix, powers

LENGTH = 400
#: Bytes of an anchor.
ANCHOR = 64
#: Window starts of one vectorised step; longer texts are taken in pieces.
_PIECE = 1 << 18
#: Reads sorted together, unless one anchor has more, and bytes of columns kept in memory.
_BLOCK_READS, _BLOCK_BYTES = 8192, 64 << 20
_POSITION = np.uint64((1 << 24) - 1)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of values[i:i + width] for every whole window."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1: width - 1 + n])


def _pieces(offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(texts, their begins, begin, end) of stretches of the bytes to take at a
    time: several short texts, or a part of a long one with LENGTH - 1 bytes more."""
    t, total = 0, len(offsets) - 1
    while t < total:
        size = offsets[t + 1] - offsets[t]
        if size > _PIECE:
            for begin in range(offsets[t], offsets[t + 1] - LENGTH + 1, _PIECE):
                yield np.array([t]), np.array([begin]), begin, min(begin + _PIECE + LENGTH - 1, offsets[t + 1])
            t += 1
            continue
        end = max(int(np.searchsorted(offsets, offsets[t] + _PIECE, "right")) - 1, t + 1)
        yield np.arange(t, end), offsets[t:end], int(offsets[t]), int(offsets[end])
        t = end


def reads(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Of texts laid one after the other: (text, start in it, windows, distance
    from the start to the anchor, anchor hash, read hash) of every read."""
    for texts, begins, begin, end in _pieces(offsets):
        part = raw[begin:end]
        if len(part) < LENGTH:
            continue
        fore, back = powers(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_CODES[part] * fore[:len(part)], out=sums[1:])
        grams = len(part) - ANCHOR + 1
        hashes = mix((sums[ANCHOR:] - sums[:grams]) * back[:grams])
        place = np.arange(grams, dtype=np.uint64)
        least = _sliding_min((hashes & ~_POSITION) | place, LENGTH - ANCHOR + 1)
        anchor = (least & _POSITION).astype(np.int64)
        # windows that lie in one text
        ends = np.minimum(offsets[texts + 1], end) - begin
        starts = begins - begin
        of = np.searchsorted(starts, np.arange(len(anchor)), "right") - 1
        whole = np.arange(len(anchor)) + LENGTH <= ends[of]
        at = np.flatnonzero(whole)
        if not len(at):
            continue
        new = np.ones(len(at), bool)
        new[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (of[at[1:]] != of[at[:-1]]) | (np.diff(at) != 1)
        first = np.flatnonzero(new)
        s, n = at[first], np.diff(np.append(first, len(at)))
        stop = s + n - 1 + LENGTH
        read = mix((sums[stop] - sums[s]) * back[s] + n.astype(np.uint64))
        yield texts[of[s]], s + begin - offsets[texts[of[s]]], n, anchor[s] - s, hashes[anchor[s]].view(np.int64), read.view(np.int64)


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from adtally.llm.common import text_bytes

    for batch in batches:
        for part in steps(batch, "text"):
            raw, offsets = text_bytes(part.column("text"))
            for text, s, n, off, anchor, read in reads(raw, offsets):
                yield pa.RecordBatch.from_arrays(
                    [part.column("fp").take(pa.array(text)), pa.array(s, pa.int64()), pa.array(n, pa.int32()), pa.array(off, pa.int32()),
                     pa.array(anchor), pa.array(read)], names=["fp", "s", "n", "off", "anchor", "read"])


def _cut_reads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the reads asked for, from rows (fp, text, asked)."""
    for batch in batches:
        for fp, text, asked in zip(batch.column("fp").to_pylist(), batch.column("text").to_pylist(), batch.column("asked").to_pylist()):
            raw = text.encode()
            for lot in range(0, len(asked), 20_000):
                rows = asked[lot: lot + 20_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([fp] * len(rows), pa.string()), pa.array([r["s"] for r in rows], pa.int64()), pa.array([r["n"] for r in rows], pa.int32()),
                     pa.array([r["off"] for r in rows], pa.int32()), pa.array([r["anchor"] for r in rows], pa.int64()),
                     pa.array([raw[r["s"]: r["s"] + r["n"] - 1 + LENGTH] for r in rows], pa.binary())], names=["fp", "s", "n", "off", "anchor", "bytes"])


def repeated_windows(strings: list[bytes], off: np.ndarray, n: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For aligned reads sorted by ``group``: (reads, most windows) of booleans,
    whether the window at that start also begins another read's window."""
    count = len(strings)
    length = np.array([len(x) for x in strings])
    left, right = int(off.max()), int((length - off).max())
    width = left + right
    file = tempfile.TemporaryFile() if count * width > _BLOCK_BYTES else None
    columns = np.zeros((width, count), np.uint8) if file is None else np.memmap(file, np.uint8, "w+", shape=(width, count))
    for lot in range(0, count, 4096):
        rows = range(lot, min(lot + 4096, count))
        block = np.zeros((len(rows), width), np.uint8)
        for i, j in enumerate(rows):
            block[i, left - off[j]: left - off[j] + length[j]] = np.frombuffer(strings[j], np.uint8)
        columns[:, lot: lot + len(rows)] = block.T
    out = np.zeros((count, int(n.max())), bool)
    order = np.arange(count)
    common = np.zeros(count + 1, np.int64)  # common[i]: of order[i - 1] and order[i]; the last is a border
    first, last = left - off, left - off + length
    for c in range(width - 1, -1, -1):
        here = (c >= first[order]) & (c < last[order])
        key = group[order] * 257 + np.where(here, columns[c][order].astype(np.int64) + 1, 0)
        if np.any(key[1:] < key[:-1]):
            moved = np.argsort(key, kind="stable")
            order, key, here = order[moved], key[moved], here[moved]
            same = np.flatnonzero((key[1:] == key[:-1]) & here[1:]) + 1
            pairs = np.empty(2 * len(same), np.int64)
            pairs[::2], pairs[1::2] = moved[same - 1] + 1, moved[same] + 1
            after = np.zeros(count + 1, np.int64)
            if len(same):
                after[same] = np.minimum.reduceat(common, pairs)[::2] + 1
            common = after
        else:
            same = np.zeros(count + 1, bool)
            same[1:-1] = (key[1:] == key[:-1]) & here[1:]
            common = np.where(same, common + 1, 0)
        long = common >= LENGTH
        found = order[long[:-1] | long[1:]]
        at = c - first[found]
        ok = at < n[found]
        out[found[ok], at[ok]] = True
    if file is not None:
        file.close()
    return out


def _sort_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges (fp, start, stop) of repeated window starts, from reads sorted by anchor."""
    held: list[tuple] = []

    def flush() -> Iterator[pa.RecordBatch]:
        anchors = np.array([r[4] for r in held])
        group = np.cumsum(np.concatenate([[0], anchors[1:] != anchors[:-1]]))
        flags = repeated_windows([r[5] for r in held], np.array([r[3] for r in held]), np.array([r[2] for r in held]), group)
        edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, start = np.nonzero(edge == 1)
        _, stop = np.nonzero(edge == -1)
        base = np.array([r[1] for r in held])[row]
        yield pa.RecordBatch.from_arrays([pa.array([held[i][0] for i in row], pa.string()), pa.array(base + start, pa.int64()), pa.array(base + stop, pa.int64())],
                                         names=["fp", "start", "stop"])
        held.clear()

    for batch in batches:
        for r in zip(*(batch.column(c).to_pylist() for c in ("fp", "s", "n", "off", "anchor", "bytes"))):
            if len(held) >= _BLOCK_READS and r[4] != held[-1][4]:
                yield from flush()
            held.append(r)
    if held:
        yield from flush()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n_removed, n_spans, kept_sha256 and the kept bytes' text of rows (fp, text, ranges)."""
    for batch in batches:
        out: dict[str, list] = {"n_removed": [], "n_spans": [], "kept_sha256": []}
        for text, got in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
            raw, removed, spans = text.encode(), 0, removed_spans([(r["start"], r["stop"]) for r in got])
            kept, at = hashlib.sha256(), 0
            for a, b in spans:
                kept.update(raw[at:a])
                removed, at = removed + b - a, b
            kept.update(raw[at:])
            for k, v in zip(out, (removed, len(spans), kept.hexdigest())):
                out[k].append(v)
        yield pa.RecordBatch.from_arrays([batch.column("fp"), pa.array(out["n_removed"], pa.int64()), pa.array(out["n_spans"], pa.int64()),
                                          pa.array(out["kept_sha256"], pa.string())], names=["fp", *out])


def removed_spans(starts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal byte runs covered by the windows that start in the given ranges."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(starts):
        b += LENGTH - 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.md5(text.cast("binary")).alias("fp"), text.alias("text"))


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(fp, start, stop): ranges of window starts of the different texts that are
    repeated, copies of a whole text aside. fp is the md5 of the text."""
    rows = _rows(docs, id_col, text_col).where(F.octet_length("text") >= LENGTH)
    # of the copies of a text the first stands for all
    several = materialize(rows.groupBy("fp").agg(F.count("*").alias("c"), F.min("doc_id").alias("keep")).where("c > 1")
                          .select(F.col("fp").alias("_fp"), "keep"), "repeat-copies")
    rows = rows.join(sized_broadcast(several), (F.col("fp") == F.col("_fp")) & ~F.col("doc_id").eqNullSafe(F.col("keep")), "left_anti")
    runs = materialize(rows.select("fp", "text").mapInArrow(_read_rows, "fp string, s long, n int, off int, anchor long, read long"), "reads")
    place = F.struct("fp", "s", "n", "off")
    kinds = materialize(runs.groupBy("anchor", "read").agg(F.min(place).alias("one"), F.max(place).alias("other"))
                        .select("anchor", "read", "one", (F.col("one") != F.col("other")).alias("again")), "read-kinds")
    again = kinds.where("again").select("anchor", "read")
    whole = runs.join(again, ["anchor", "read"], "left_semi").select("fp", F.col("s").alias("start"), (F.col("s") + F.col("n")).alias("stop"))
    shared = kinds.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor")
    asked = materialize(kinds.join(shared, "anchor", "left_semi").select("one.*", "anchor")
                        .groupBy("fp").agg(F.collect_list(F.struct("s", "n", "off", "anchor")).alias("asked")), "asked")
    texts = rows.select("fp", "text").join(sized_broadcast(asked.select("fp")), "fp", "left_semi").dropDuplicates(["fp"])
    cut = texts.join(asked, "fp").mapInArrow(_cut_reads, "fp string, s long, n int, off int, anchor long, bytes binary")
    sorted_reads = cut.repartition("anchor").sortWithinPartitions("anchor")
    found = sorted_reads.mapInArrow(_sort_blocks, "fp string, start long, stop long")
    return materialize(whole.unionByName(found).distinct(), "repeated")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = _rows(docs, id_col, text_col)
    ranges = repeated_ranges(docs, id_col, text_col)
    marked = materialize(ranges.groupBy("fp").agg(F.collect_list(F.struct("start", "stop")).alias("ranges")), "marked")
    copies = rows.groupBy("fp").agg(F.count("*").alias("copies"))
    texts = rows.select("fp", "text").join(sized_broadcast(marked.select("fp")), "fp", "left_semi").dropDuplicates(["fp"])
    cut = texts.join(marked, "fp").mapInArrow(_digest, "fp string, n_removed long, n_spans long, kept_sha256 string")
    narrow = rows.select("doc_id", "fp", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("_sha"))
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    joined = narrow.join(copies, "fp").join(cut, "fp", "left")
    return joined.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "_sha")).alias("kept_sha256"))
