"""Benchmark decontamination by spaced-seed hashing.

A spaced seed is a fixed mask over consecutive words; words under a 0 are
ignored, so a window still matches after substitutions there. All windows of
the benchmark items are hashed under each mask; the documents' windows are
hashed in the same way, those whose hash cannot be a benchmark hash are left
out by a bitmap of fixed size, and the rest meet the benchmark hashes in a
join. Around the hits of one alignment (document, item, shift) the item words
that some hit certifies as equal are counted; an alignment with enough of them
is a leak.

The bitmap is the only thing that is broadcast; its size is bounded whatever
the benchmark's size. It never drops a true hit: the join behind it decides.

Defined results: null texts are empty; words are lower-case alphanumeric runs;
an item shorter than the longest mask leaks where all its words stand in a row
(gaps would leave too few to tell it from common speech), one without words never;
texts of any length are taken whole, in steps; repeated rows and repeated items are reported once; null ids are kept
as null. An empty table on either side gives an empty result. Further columns
are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import materialize, old_names, own_names, sized_broadcast, steps
from adtally.llm.words import mix, word_hashes

#: The masks, of six words each.
MASKS = ("111111", "110110101", "101011011", "1110010011")
SPAN = max(map(len, MASKS))
#: Number of the mask of no words; a short item's mask has its length added.
WHOLE = 100
#: An item leaks if one alignment certifies this many of its words, or this
#: share of a short item.
LEAK_WORDS, LEAK_SHARE = 12, 0.6
#: log2 of the bitmap's bits: 2**26 bits are 8 MB.
BITMAP_LOG2 = 26
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def mask_hashes(words: np.ndarray, first: np.ndarray, short: tuple[int, ...] = ()) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(mask number, text of each window, word position in it, hash). ``short``:
    lengths of short items, each a mask of all its words, numbered ``WHOLE`` and on."""
    n = np.diff(first)
    for number, mask in [*enumerate(MASKS), *((WHOLE + k, "1" * k) for k in short)]:
        size = len(words) - len(mask) + 1
        if size <= 0:
            continue
        acc = np.full(size, number + 1, np.uint64)
        for odd, j in zip(itertools.cycle(_ODD), (j for j, c in enumerate(mask) if c == "1")):
            acc += words[j: j + size] * odd
            acc ^= acc >> np.uint64(29)
        text = np.repeat(np.arange(len(n)), n)[:size]
        whole = np.arange(size) + len(mask) <= first[1:][text]
        at = np.flatnonzero(whole)
        yield number, text[at], at - first[text[at]], mix(acc[at])


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch, "text"):
            words, first = word_hashes(part.column("text"))
            n = np.diff(first)
            lengths = tuple(int(k) for k in np.unique(n[(n > 0) & (n < SPAN)]))
            for number, text, at, h in mask_hashes(words, first, lengths):
                ok = n[text] == number - WHOLE if number >= WHOLE else n[text] >= SPAN
                text, at, h = text[ok], at[ok], h[ok]
                yield pa.RecordBatch.from_arrays(
                    [part.column("item_id").take(pa.array(text)), pa.array(n[text], pa.int32()), pa.array(np.full(len(at), number), pa.int32()),
                     pa.array(at, pa.int32()), pa.array(h.view(np.int64))],
                    names=["item_id", "item_words", "mask", "item_at", "hash"])


def _doc_windows(bitmap, short: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        shift = np.uint64(64 - BITMAP_LOG2)
        for batch in batches:
            for part in steps(batch, "text"):
                words, first = word_hashes(part.column("text"))
                found = []
                for _, text, at, h in mask_hashes(words, first, short):
                    slot = h >> shift
                    hit = np.flatnonzero((bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1)
                    found.append((text[hit], at[hit], h[hit]))
                if not found:
                    continue
                text, at, h = (np.concatenate(x) for x in zip(*found))
                ids = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(ids), part.column("fp").take(ids), pa.array(at, pa.int32()), pa.array(h.view(np.int64))],
                    names=["doc_id", "fp", "at", "hash"])
    return run


def _bitmap(hashes: DataFrame) -> bytes:
    """Bitmap of the hashes' leading bits. The bits of a byte are joined on the
    executors; the driver gets at most one small row for each byte of the map."""
    slot = F.shiftrightunsigned("hash", 64 - BITMAP_LOG2)
    out = np.zeros(1 << (BITMAP_LOG2 - 3), np.uint8)
    filled = (hashes.withColumn("slot", slot)
              .select(F.shiftright("slot", 3).cast("int").alias("byte"), F.expr("cast(shiftleft(1, cast(slot % 8 as int)) as int)").alias("bit"))
              .groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow())
    out[filled.column("byte").to_numpy()] = filled.column("bits").to_numpy().astype(np.uint8)
    return out.tobytes()


def text_key(column: Column) -> Column:
    return F.md5(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and leaked item: doc_id, fp (md5 of the text),
    item_id, first_word (of the aligned item in the document), matched_words,
    item_words; of several alignments the best, then the first."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text")).distinct()
    windows = materialize(items.mapInArrow(_item_windows, "item_id long, item_words int, mask int, item_at int, hash long"), "item-windows")
    short = tuple(sorted(r[0] for r in windows.where(F.col("mask") >= WHOLE).select("item_words").distinct().collect()))  # below SPAN
    bitmap = spark.sparkContext.broadcast(_bitmap(windows.select("hash").distinct()))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("fp"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    met = rows.mapInArrow(_doc_windows(bitmap, short), "doc_id long, fp string, at int, hash long")
    masks = [*enumerate(MASKS), *((WHOLE + k, "1" * k) for k in short)]
    offsets = F.create_map(*[x for i, m in masks for x in (F.lit(i), F.array(*[F.lit(j) for j, c in enumerate(m) if c == "1"]))])
    hits = (met.join(sized_broadcast(windows), "hash")
            .select("doc_id", "fp", "item_id", "item_words", (F.col("at") - F.col("item_at")).alias("first_word"),
                    F.explode(F.transform(offsets[F.col("mask")], lambda j: j + F.col("item_at"))).alias("certified")))
    words = (hits.groupBy("doc_id", "fp", "item_id", "item_words", "first_word", "certified").agg(F.lit(1).alias("one"))
             .groupBy("doc_id", "fp", "item_id", "item_words", "first_word").agg(F.count("*").alias("matched_words")))
    enough = F.when(F.col("item_words") < SPAN, F.col("item_words")).otherwise(F.least(F.lit(LEAK_WORDS), F.ceil(F.col("item_words") * F.lit(LEAK_SHARE))))
    return (words.where(F.col("matched_words") >= enough)
            .groupBy("doc_id", "fp", "item_id")
            .agg(F.max(F.struct("matched_words", (-F.col("first_word")).alias("at"), "item_words")).alias("best"))
            .select("doc_id", "fp", "item_id", (-F.col("best.at")).alias("first_word"),
                    F.col("best.matched_words").alias("matched_words"), F.col("best.item_words").alias("item_words")))


def drop_leaking(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that leak an item of ``benchmark``."""
    leaks = materialize(benchmark_leaks(docs, benchmark, id_col, text_col)
                        .select(F.col("doc_id").alias("_leak_id"), F.col("fp").alias("_leak_fp")).distinct(), "leaks")
    renamed, names = own_names(docs)
    same = (text_key(F.col(names[text_col])) == F.col("_leak_fp")) & F.col(names[id_col]).eqNullSafe(F.col("_leak_id"))
    return old_names(renamed.join(sized_broadcast(leaks), same, "left_anti"), names)
