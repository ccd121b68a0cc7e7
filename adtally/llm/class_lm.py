"""Class-based bigram language model with exchange clustering (Brown et al.).

P(word | word before) = P(class | class before) * P(word | class). A text's score
is the sum of log10 of it over its words and one end; the first word follows an end.

Words are clustered by exchange: a word moves to the class in which the
likelihood of the training text, sum N(c, d) log N(c, d) - sum N(c) log N(c) over
both margins, is greatest. What moves as one is a unit: each word that is at
least one in ``1 / UNIT_RATE`` of the training tokens (so there are at most that
many, whatever the corpus) and there ``UNIT_LEAST`` times, and of the rarer words those with the same last
three bytes modulo ``FORMS``. Every word is in a unit, known or not, and so in a
class; every training token counts. Units' bigrams are counted over the whole
corpus once and kept as a row per unit with its neighbours (at most two for each
unit); a round moves the units whose turn it is, each in its own task against the
class counts of the round's start, and the class counts are summed anew.

Then every rarer training word is a unit of its own: the classes before and after
all its occurrences are gathered by word, it leaves its form and moves to the class
of the greatest gain, all words against the same class counts. No word is left to
its form but those that are not in the training text. The bigrams of classes are
counted anew over the texts with every word in its own class.

Counts and classes of words stay in a distributed table. Those of frequent words go
to the tasks with the units; the rarer words of a chunk of texts are written as
postings (word, its places), joined with the table by word, and sent back to the chunk.

Smoothing: emissions (n + 0.5) / (N(class) + 0.5 * (different words of it + 1)),
so that every class keeps room for a word it has not seen; transitions are mixed
with the classes' own shares, at a weight of as many tokens as there are classes.

Words are told apart by 64-bit hashes: among a billion different words two fall
together with a chance of 3 in 100.

Defined results: a null text is empty and has only its end; a null id trains.
Whole texts are taken; one longer than a chunk is a chunk of its own, held by one
task. Repeated rows train and are scored one by one. Without training rows every
token has probability 1 in the base and one in all classes in the model. The id
column keeps its type; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import Scratch, batch_bytes, importable, steps, text_bytes
from adtally.llm.words import _CODES, mix, powers

#: Share of the training tokens from which on a word is a unit of its own, and the
#: fewest times it must be there: fewer tell nothing of its neighbours.
UNIT_RATE, UNIT_LEAST = 2.0 ** -16, 5
#: Units of the rarer words, by their last bytes.
FORMS = 1024
#: Classes besides that of the end; rounds of exchange; every unit moves once in TURNS rounds.
CLASSES, ROUNDS, TURNS = 64, 12, 3
#: Bytes of text and texts of a chunk.
CHUNK_BYTES, CHUNK_DOCS = 8 << 20, 1 << 16
#: Different keys that a task holds before it writes their counts, and rows before it packs them.
HELD_KEYS, HELD_ROWS = 1 << 19, 1 << 18
#: Rare words whose gains are computed together.
_WORDS = 256
#: For a word that was not learned from: it stays in the class of its form.
_NO_CLASS = 255

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def held_out(doc_id: Column) -> Column:
    """Whether a document is not learned from: crc32 of its id as text is 1 modulo 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word, its form, first word of each text with the total)."""
    raw, offsets = text_bytes(texts)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    raw = _LOWER[raw]
    ink = ~_SPACE[raw]
    begins, ends = ink.copy(), ink.copy()
    begins[1:] &= ~ink[:-1]
    ends[:-1] &= ~ink[1:]
    edge = offsets[(offsets > 0) & (offsets < len(raw))]
    begins[edge], ends[edge - 1] = ink[edge], ink[edge - 1]
    start, last = np.flatnonzero(begins), np.flatnonzero(ends)
    fore, back = powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_CODES[raw] * fore[:len(raw)], out=sums[1:])
    length = last + 1 - start
    hashes = mix((sums[last + 1] - sums[start]) * back[start] + length.astype(np.uint64))
    tail = raw[last].astype(np.uint64)
    for k in (1, 2):
        tail |= np.where(length > k, raw[np.maximum(last - k, 0)], 0).astype(np.uint64) << np.uint64(8 * k)
    return hashes.view(np.int64), (mix(tail) % np.uint64(FORMS)).astype(np.int64), np.searchsorted(start, offsets)


class _Counter:
    """Counts of 64-bit keys, few enough to be held."""

    def __init__(self):
        self.keys, self.counts, self.new = np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def add(self, keys: np.ndarray) -> None:
        self.new.append(keys)
        if sum(map(len, self.new)) > HELD_KEYS:
            self.settle()

    def settle(self) -> None:
        keys, counts = np.unique(np.concatenate(self.new), return_counts=True) if self.new else (np.zeros(0, np.int64),) * 2
        both, self.new = np.concatenate([self.keys, keys]), []
        self.keys, where = np.unique(both, return_inverse=True)
        self.counts = np.bincount(where, np.concatenate([self.counts, counts]), len(self.keys)).astype(np.int64)

    def take(self, names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
        self.settle()
        whole = pa.RecordBatch.from_arrays([pa.array(self.keys), pa.array(self.counts)], names=list(names))
        self.keys, self.counts = self.keys[:0], self.counts[:0]
        yield from (whole.slice(i, 100_000) for i in range(0, whole.num_rows, 100_000))


def _counted(rows: DataFrame, keys_of, key: str) -> DataFrame:
    """(key, n) over all texts of ``rows``; keys_of(texts) gives the keys of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter()
        for batch in batches:
            for part in steps(batch, "text", 1 << 19):
                counter.add(keys_of(part.column("text")))
                if len(counter.keys) > HELD_KEYS:
                    yield from counter.take((key, "n"))
        yield from counter.take((key, "n"))

    return rows.mapInArrow(run, f"{key} long, n long").groupBy(key).agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Units:
    """Unit 0 is the end, 1 to FORMS the rarer words by form, then the frequent words."""

    words: np.ndarray  # hashes of the frequent words, ascending
    tokens: np.ndarray  # training tokens of every unit
    types: np.ndarray  # different training words of every unit

    def of(self, hashes: np.ndarray, forms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(unit, whether it is a frequent word) of each word."""
        if not len(self.words):
            return forms + 1, np.zeros(len(forms), bool)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        known = self.words[at] == hashes
        return np.where(known, at + FORMS + 1, forms + 1), known


def _sequence(units: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The units of all texts with an end after each text."""
    n = len(first) - 1
    out = np.zeros(len(units) + n, np.int64)
    out[np.arange(len(units)) + np.repeat(np.arange(n), np.diff(first))] = units
    return out


def gains(matrix: np.ndarray, own: int, right: np.ndarray, left: np.ndarray, twice: int) -> np.ndarray:
    """How much the likelihood gains when a unit that was taken out of class ``own``
    is put into each class. matrix: bigrams of classes; right, left: the unit's bigrams
    with the classes after and before it, ``twice`` of them with itself."""
    def g(x):
        return x * np.log(np.maximum(x, 1))

    after, before = right.copy(), left.copy()
    after[own] -= twice
    before[own] -= twice
    rest = matrix.copy()
    rest[own] -= after
    rest[:, own] -= before
    rest[own, own] -= twice
    d, e = np.flatnonzero(after), np.flatnonzero(before)
    out = (g(rest[:, d] + after[d]) - g(rest[:, d])).sum(1) + (g(rest[e] + before[e][:, None]) - g(rest[e])).sum(0)
    # The cell of a class with itself gets both sides at once.
    diagonal = np.diagonal(rest)
    out += g(diagonal + after + before + twice) - g(diagonal + after) - g(diagonal + before) + g(diagonal)
    rows, columns = matrix.sum(1), matrix.sum(0)
    rows[own] -= right.sum()
    columns[own] -= left.sum()
    return out - g(rows + right.sum()) + g(rows) - g(columns + left.sum()) + g(columns)


def word_gains(matrix: np.ndarray, own: np.ndarray, right: np.ndarray, left: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """``gains`` of many words at once, a row for each."""
    def g(x):
        return x * np.log(np.maximum(x, 1))

    word = np.arange(len(own))
    after, before = right.astype(float), left.astype(float)
    after[word, own] -= twice
    before[word, own] -= twice
    diagonal = np.repeat(np.diagonal(matrix)[None], len(own), 0)
    diagonal[word, own] -= after[word, own] + before[word, own] + twice
    out = g(diagonal + after + before + twice[:, None]) - g(diagonal + after) - g(diagonal + before) + g(diagonal)
    for bigrams, moved, other in ((matrix.T, after, before), (matrix, before, after)):
        i, d = np.nonzero(moved)
        if len(i):
            n, cell = moved[i, d], np.arange(len(i))
            rest = bigrams[d]
            rest[cell, own[i]] -= n
            inside = d == own[i]
            rest[inside] -= other[i[inside]]
            rest[cell[inside], own[i[inside]]] -= twice[i[inside]]
            start = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
            out[i[start]] += np.add.reduceat(g(rest + n[:, None]) - g(rest), start)
    for margin, n in ((matrix.sum(1), right.sum(1)), (matrix.sum(0), left.sum(1))):
        rest = np.repeat(margin[None], len(own), 0)
        rest[word, own] -= n
        out += g(rest) - g(rest + n[:, None])
    return out


def likelihood(matrix: np.ndarray) -> float:
    """The part of the training text's log likelihood that the classes decide."""
    def g(x):
        return float((x * np.log(np.maximum(x, 1))).sum())

    return g(matrix) - g(matrix.sum(0)) - g(matrix.sum(1))


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where a new key begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _lists(values: np.ndarray, start: np.ndarray) -> pa.Array:
    """The bytes of every run of ``values``, without a Python object for each."""
    offsets = (np.append(start, len(values)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _values(lists: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(the values of all of the lists one after the other, how many each has)."""
    raw, offsets = text_bytes(lists)
    values = raw.view(kind)
    return values, np.diff(offsets) // values.itemsize


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bigrams as lists of neighbours: a row for each unit that a task holds bigrams
    of, with the neighbours (twice the unit, odd if it comes before) and counts."""
    keys, counts = [], []

    def close() -> pa.RecordBatch:
        pair, n = np.concatenate(keys), np.concatenate(counts)
        before, after = pair >> 32, pair & ((1 << 32) - 1)
        unit, other, n = np.concatenate([before, after]), np.concatenate([after * 2, before * 2 + 1]), np.concatenate([n, n])
        order = np.lexsort((other, unit))
        unit, other, n = unit[order], other[order].astype("<u4"), n[order].astype("<i8")
        start = _runs(unit)
        keys.clear(), counts.clear()
        return pa.RecordBatch.from_arrays([pa.array(unit[start], pa.int64()), _lists(other, start), _lists(n, start)], names=["unit", "other", "n"])

    for batch in batches:
        keys.append(batch.column("pair").to_numpy()), counts.append(batch.column("n").to_numpy())
        if sum(map(len, keys)) > HELD_ROWS:
            yield close()
    if keys:
        yield close()


def _neighbours(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(unit, neighbours, whether they come before it, counts) of every row."""
    for unit, near in zip(batch.column("unit").to_pylist(), batch.column("near").to_pylist()):
        other = np.frombuffer(b"".join([x["other"] for x in near]), "<u4").astype(np.int64)
        yield unit, other >> 1, (other & 1).astype(bool), np.frombuffer(b"".join([x["n"] for x in near]), "<i8")


def class_matrix(contexts: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Training bigrams of classes."""
    size = CLASSES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(size * size, np.int64)
        for batch in batches:
            for unit, other, before, n in _neighbours(batch):
                np.add.at(cells, int(classes[unit]) * size + classes[other[~before]].astype(np.int64), n[~before])
        used = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(cells[used])], names=["cell", "n"])

    matrix = np.zeros(size * size)
    for cell, n in contexts.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():  # a row per pair of classes
        matrix[cell] = n
    return matrix.reshape(size, size)


def _moves(contexts: DataFrame, classes: np.ndarray, matrix: np.ndarray, turn: int) -> list:
    """(unit, new class) of the units of this turn that change."""
    size = CLASSES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            moved = []
            for unit, other, before, n in _neighbours(batch):
                if unit == 0 or int(mix(np.array([unit], np.uint64))[0] % np.uint64(TURNS)) != turn:
                    continue
                own = int(classes[unit])
                right = np.bincount(classes[other[~before]], n[~before], size)
                left = np.bincount(classes[other[before]], n[before], size)
                gain = gains(matrix, own, right, left, int(n[(other == unit) & ~before].sum()))
                best = 1 + int(np.argmax(gain[1:]))
                if gain[best] > gain[own] + 1e-6:
                    moved.append((unit, best))
            yield pa.RecordBatch.from_pydict({"unit": [m[0] for m in moved], "to": [m[1] for m in moved]}, pa.schema([("unit", pa.int64()), ("to", pa.int64())]))

    return contexts.mapInArrow(run, "unit long, to long").collect()  # at most a row per unit


def exchange(contexts: DataFrame, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of every unit, bigrams of classes). Units start in turn by their
    tokens; of all rounds the classes with the greatest likelihood stay."""
    classes = np.zeros(len(tokens), np.int16)
    order = np.argsort(-tokens[1:], kind="stable")
    classes[1:][order] = 1 + np.arange(len(order)) % CLASSES
    best = None
    for turn in range(ROUNDS + 1):
        matrix = class_matrix(contexts, classes)
        if best is None or likelihood(matrix) > best[0]:
            best = likelihood(matrix), classes, matrix
        if turn < ROUNDS and matrix.any():
            classes = classes.copy()
            for unit, to in _moves(contexts, classes, matrix, turn % TURNS):
                classes[unit] = to
    return best[1], best[2]


def _grouped(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """(different keys, for each of ``values`` the bytes of every key's ones), in the order of the first."""
    order = np.lexsort((values[0], keys))
    keys = keys[order]
    start = _runs(keys)
    return keys[start], [_lists(x[order], start) for x in values]


def _homes(rows: DataFrame, units: Units, classes: np.ndarray, matrix: np.ndarray) -> DataFrame:
    """word, n, class of every training word that is no unit: the class of the greatest gain."""
    size = CLASSES + 1

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def close() -> pa.RecordBatch:
            word, (near,) = _grouped(*(np.concatenate(x) for x in zip(*held)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(word), near], names=["word", "near"])

        for batch in batches:
            for part in steps(batch, "text", 1 << 19):
                hashes, forms, first = words(part.column("text"))
                hashes = hashes & ~np.int64(FORMS - 1) | forms
                unit, known = units.of(hashes, forms)
                cls = classes[_sequence(unit, first)].astype(np.int64)
                owner = np.repeat(np.arange(part.num_rows), np.diff(first))
                at = (np.arange(len(hashes)) + owner)[~known]
                again = np.zeros(len(hashes), np.int64)
                again[:-1] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
                before = np.where(at > 0, cls[at - 1], 0)
                held.append((hashes[~known], (before | cls[at + 1] << 7 | again[~known] << 14).astype("<u2")))
                total += len(at)
                if total > HELD_ROWS:
                    yield close()
                    total = 0
        if held:
            yield close()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(of_codes: np.ndarray, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
            first = _runs(of_codes)
            many = np.diff(np.append(first, len(of_codes)))
            for lot in range(0, len(first), _WORDS):
                word, n = of_codes[first[lot: lot + _WORDS]], many[lot: lot + _WORDS]
                code, of = codes[first[lot]: first[lot] + n.sum()].astype(np.int64), np.repeat(np.arange(len(n)), n)
                left, right = (np.bincount(of * size + c, minlength=len(n) * size).reshape(-1, size) for c in (code & 127, code >> 7 & 127))
                own = classes[(word & (FORMS - 1)) + 1].astype(np.int64)
                twice = np.bincount(of, code >> 14, len(n))
                gain = word_gains(matrix, own, right, left, twice)
                best = 1 + np.argmax(gain[:, 1:], 1)
                row = np.arange(len(n))
                best = np.where(gain[row, best] > gain[row, own] + 1e-6, best, own)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n), pa.array(best, pa.int32())], names=["word", "n", "class"])

        last, codes = [], []  # of the last word, which may go on in the next batch
        for batch in batches:
            code, many = _values(batch.column("near"), "<u2")
            word = np.repeat(batch.column("word").to_numpy(), many)
            cut = int(np.searchsorted(word, word[-1])) if len(word) else 0
            if cut or last and len(word) and last[-1][-1] != word[-1]:
                yield from close(np.concatenate([*last, word[:cut]]), np.concatenate([*codes, code[:cut]]))
                last, codes = [], []
            if len(word):
                last.append(word[cut:]), codes.append(code[cut:].copy())
        if last:
            yield from close(np.concatenate(last), np.concatenate(codes))

    # Sorted instead of collected: a task has few rows of a word, so lists made before the shuffle save nothing.
    near = rows.mapInArrow(contexts, "word long, near binary").repartition("word").sortWithinPartitions("word")
    return near.mapInArrow(settle, "word long, n long, class int")


@dataclass(frozen=True)
class Classes:
    """What is learned before the bigrams of the final classes are counted."""

    units: Units
    classes: np.ndarray  # of every unit; a form's is that of its words that were not learned from
    vocabulary: DataFrame  # word, n, class of the rarer training words
    share: np.ndarray  # training tokens of every class
    types: np.ndarray  # different training words of every class
    n_tokens: int  # training tokens, ends included
    n_types: int  # different ones


@dataclass(frozen=True)
class ClassModel(Classes):
    transition: np.ndarray  # log10 P(class | class before)
    emission: np.ndarray  # log10 of the class's denominator


def _cluster(docs: DataFrame, text_col: str) -> Classes:
    """The classes of all words of ``docs``."""
    importable(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def hashed(texts: pa.Array) -> np.ndarray:
        # The form is kept in the key's last bits until the counts are summed.
        hashes, forms, _ = words(texts)
        return hashes & ~np.int64(FORMS - 1) | forms

    scratch = Scratch(docs.sparkSession, "lm-train")
    vocabulary = scratch.table(_counted(rows, hashed, "word"), "words")
    ends = rows.count()
    total, n_types = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_tokens = total + ends
    frequent = F.col("n") >= max(UNIT_LEAST, UNIT_RATE * n_tokens)
    top = np.array(sorted(vocabulary.where(frequent).collect()), np.int64).reshape(-1, 2)  # at most 1 / UNIT_RATE rows
    tokens, kinds = np.zeros(FORMS + 1, np.int64), np.zeros(FORMS + 1, np.int64)
    tokens[0], kinds[0] = ends, min(ends, 1)
    for form, n, different in vocabulary.where(~frequent).groupBy(F.col("word").bitwiseAND(FORMS - 1)).agg(F.sum("n"), F.count("*")).collect():
        tokens[form + 1], kinds[form + 1] = n, different
    scratch.drop("words")
    units = Units(top[:, 0].copy(), np.concatenate([tokens, top[:, 1]]), np.concatenate([kinds, np.ones(len(top), np.int64)]))

    def bigrams(texts: pa.Array) -> np.ndarray:
        hashes, forms, first = words(texts)
        unit, _ = units.of(hashes & ~np.int64(FORMS - 1) | forms, forms)
        after = _sequence(unit, first)
        return np.concatenate([[0], after[:-1]]) << 32 | after

    pairs = scratch.table(_counted(rows, bigrams, "pair"), "bigrams")
    lists = pairs.mapInArrow(_packed, "unit long, other binary, n binary").groupBy("unit")
    contexts = scratch.table(lists.agg(F.collect_list(F.struct("other", "n")).alias("near")), "contexts")
    scratch.drop("bigrams")
    classes, matrix = exchange(contexts, units.tokens)
    scratch.drop("contexts")
    rare = scratch.table(_homes(rows, units, classes, matrix), "homes")
    own = np.concatenate([[0], np.arange(FORMS + 1, len(units.tokens))])
    share, types = (np.bincount(classes[own], x[own], CLASSES + 1) for x in (units.tokens, units.types))
    for c, n, different in rare.groupBy("class").agg(F.sum("n"), F.count("*")).collect():  # a row per class
        share[c] += n
        types[c] += different
    return Classes(units, classes, rare, share, types, n_tokens, n_types + min(ends, 1))


def _fitted(found: Classes, classed: DataFrame) -> ClassModel:
    """The model of the bigrams of classes in ``classed`` training texts."""
    size = CLASSES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(size * size, np.int64)
        for batch in batches:
            for part in steps(batch, "classes", 1 << 19):
                after = text_bytes(part.column("classes"))[0].astype(np.int64)
                cells += np.bincount(np.concatenate([[0], after[:-1]]) * size + after, minlength=size * size)
        used = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(cells[used])], names=["cell", "n"])

    matrix = np.zeros(size * size)
    for cell, n in classed.select("classes").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():  # a row per pair of classes
        matrix[cell] = n
    matrix = matrix.reshape(size, size)
    prior = (found.share + 0.5) / (found.n_tokens + 0.5 * size)
    transition = np.log10((matrix + size * prior) / (matrix.sum(1, keepdims=True) + size))
    return ClassModel(**vars(found), transition=transition, emission=np.log10(found.share + 0.5 * (found.types + 1)))


def train(docs: DataFrame, text_col: str = "text") -> ClassModel:
    """Learn from every row of ``docs``."""
    with batch_bytes(docs.sparkSession):
        found = _cluster(docs, text_col)
        return _fitted(found, _classed(docs.select(F.lit(0).alias("doc_id"), F.col(f"`{text_col}`").alias("text")), found, "doc_id", "text"))


def _by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings with the count and class of their word, all that a task holds of a
    chunk in one row: for each occurrence its place, the count and the class."""
    held, size = [], 0

    def close() -> pa.RecordBatch:
        chunk, (n, cls, places) = _grouped(*(np.concatenate(x) for x in zip(*held)))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), places, n, cls], names=["of_chunk", "places", "n", "cls"])

    for batch in batches:
        places, many = _values(batch.column("places"), "<u4")
        held.append((np.repeat(batch.column("of_chunk").to_numpy(), many), np.repeat(batch.column("n").to_numpy().astype("<i8"), many),
                     np.repeat(batch.column("cls").to_numpy().astype(np.uint8), many), places.copy()))
        size += int(many.sum())
        if size > HELD_ROWS:
            yield close()
            size = 0
    if held:
        yield close()


def _classed(docs: DataFrame, model: Classes, id_col: str, text_col: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, log_n (sum of the log10 of counts and a
    half), classes (a byte for every token, the end included) of every row."""
    importable(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), held_out(F.col(f"`{id_col}`")).alias("held_out"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    units, classes = model.units, model.classes.astype(np.uint8)
    # Of the end and of frequent words; the postings bring those of the rarer ones.
    count = units.tokens.copy()
    count[1: FORMS + 1] = 0
    log_count = np.log10(count + 0.5)
    log_count[1: FORMS + 1] = 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq, out = TaskContext.get().partitionId(), 0, None
        kept, sums, postings, held, size, length = [], [], [], 0, 0, 0

        def table(columns: dict, n: int) -> Iterator[pa.RecordBatch]:
            columns["chunk"] = np.full(n, (task << 32) | seq)
            whole = pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in out], schema=out)
            yield from (whole.slice(i, 50_000) for i in range(0, n, 50_000))

        def close() -> Iterator[pa.RecordBatch]:
            ids = {c: pa.concat_arrays([k[c] for k in kept]) for c in ("doc_id", "held_out")}
            yield from table(ids | {"local": np.arange(held)} | {c: np.concatenate([s[c] for s in sums]) for c in ("n_tokens", "n_known", "log_n")}
                             | {"classes": [x for s in sums for x in s["classes"]]}, held)
            word, (places,) = _grouped(*(np.concatenate(x) for x in zip(*postings)))
            yield from table({"word": word, "places": places}, len(word))

        for batch in batches:
            if out is None:
                out = pa.schema([("chunk", pa.int64()), ("local", pa.int32()), batch.schema.field("doc_id"), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                                 ("log_n", pa.float64()), ("classes", pa.binary()), ("word", pa.int64()), ("places", pa.binary())])
            for part in steps(batch, "text", 1 << 19):
                bytes_now = part.column("text").nbytes
                if held and (held + part.num_rows > CHUNK_DOCS or size + bytes_now > CHUNK_BYTES):
                    yield from close()
                    kept, sums, postings, held, size, length, seq = [], [], [], 0, 0, 0, seq + 1
                hashes, forms, first = words(part.column("text"))
                hashes = hashes & ~np.int64(FORMS - 1) | forms
                unit, known = units.of(hashes, forms)
                n, seen, many = part.num_rows, _sequence(unit, first), np.diff(first) + 1
                owner = np.repeat(np.arange(n), many)
                cls, ends = classes[seen].tobytes(), np.cumsum(many).tolist()
                sums.append({"n_tokens": many, "n_known": np.bincount(owner, count[seen] > 0, n).astype(np.int64), "log_n": np.bincount(owner, log_count[seen], n),
                             "classes": [cls[i:j] for i, j in zip([0, *ends], ends)]})
                place = np.arange(len(unit)) + np.repeat(np.arange(n), np.diff(first))
                postings.append((hashes[~known], (place[~known] + length).astype("<u4")))
                kept.append({c: part.column(c).take(pa.array(np.arange(n))) for c in ("doc_id", "held_out")})  # a slice would keep the batch's texts
                held, size, length = held + n, size + bytes_now, length + len(seen)
        if held:
            yield from close()

    schema = f"chunk long, local int, doc_id {kind}, held_out boolean, n_tokens long, n_known long, log_n double, classes binary, word long, places binary"
    scratch = Scratch(docs.sparkSession, "lm-score")
    both = scratch.table(rows.mapInArrow(run, schema), "chunks")
    documents = both.where("word IS NULL").drop("word", "places")
    postings = both.where("word IS NOT NULL").select(F.col("chunk").alias("of_chunk"), "word", "places")
    counts = postings.join(model.vocabulary, "word", "left").select("of_chunk", "places", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("class", F.lit(_NO_CLASS)).alias("cls"))
    counts = counts.mapInArrow(_by_chunk, "of_chunk long, places binary, n binary, cls binary")

    def add(documents: pa.Table, postings: pa.Table) -> pa.Table:
        documents = documents.sort_by("local")
        many, total = documents.column("n_tokens").to_numpy(), documents.num_rows
        token = np.frombuffer(bytearray(b"".join(documents.column("classes").to_pylist())), np.uint8)
        place, n, cls = (np.frombuffer(b"".join(postings.column(c).to_pylist()), t) for c, t in (("places", "<u4"), ("n", "<i8"), ("cls", np.uint8)))
        learned = cls != _NO_CLASS
        token[place[learned]] = cls[learned]
        # Equal counts together, so that the sum of a text does not depend on the order of rows.
        order = np.argsort(n, kind="stable")
        ends = np.cumsum(many)
        doc, n = np.searchsorted(ends, place[order], "right"), n[order]
        raw, ends = token.tobytes(), ends.tolist()
        made = {"n_known": documents.column("n_known").to_numpy() + np.bincount(doc, n > 0, total).astype(np.int64),
                "log_n": documents.column("log_n").to_numpy() + np.bincount(doc, np.log10(n + 0.5), total),
                "classes": pa.array([raw[i:j] for i, j in zip([0, *ends], ends)], pa.binary())}
        return pa.table({c: made.get(c, documents.column(c)) for c in names})

    names = ["doc_id", "held_out", "n_tokens", "n_known", "log_n", "classes"]
    classed = documents.groupBy("chunk").cogroup(counts.groupBy("of_chunk")).applyInArrow(
        add, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, log_n double, classes binary")
    classed = scratch.table(classed, "classed")
    scratch.drop("chunks")
    return classed


def _scored(classed: DataFrame, model: ClassModel) -> DataFrame:
    base, trained = float(np.log10(model.n_tokens + 0.5 * (model.n_types + 1))), model.n_tokens
    transition, emission = model.transition, model.emission

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "classes", 1 << 19):
                many, log_n = part.column("n_tokens").to_numpy(), part.column("log_n").to_numpy()
                cls = np.frombuffer(b"".join(part.column("classes").to_pylist()), np.uint8)
                owner = np.repeat(np.arange(part.num_rows), many)
                flows = transition[np.concatenate([[0], cls[:-1]]), cls]  # a text follows the end of another one
                made = {"train_tokens": pa.array(np.full(part.num_rows, trained)), "base_score": pa.array(log_n - many * base),
                        "score": pa.array(log_n + np.bincount(owner, flows - emission[cls], part.num_rows))}
                yield pa.RecordBatch.from_arrays([made[c] if c in made else part.column(c) for c in names], names=names)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kind = classed.schema["doc_id"].dataType.simpleString()
    return classed.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(docs: DataFrame, model: ClassModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    with batch_bytes(docs.sparkSession):
        classed = _classed(docs, model, id_col, text_col)
    return _scored(classed, model)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the documents that are not held out and score all."""
    with batch_bytes(docs.sparkSession):
        found = _cluster(docs.where(~held_out(F.col(f"`{id_col}`"))), text_col)
        classed = _classed(docs, found, id_col, text_col)
        model = _fitted(found, classed.where("NOT held_out"))
    return _scored(classed, model)


def perplexity(scored: DataFrame, column: str = "score") -> DataFrame:
    """A row per held_out: the perplexity of all its tokens together."""
    per_token = F.sum(column) / F.sum("n_tokens")
    return scored.groupBy("held_out").agg(F.pow(F.lit(10.0), -per_token).alias("perplexity"))
