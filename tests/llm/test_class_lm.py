"""op13: class-based bigram model: counts and base by hand, exchange by its objective."""

import collections
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF01

from adtally.llm import class_lm

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _tokens(text):
    return [w.translate(LOWER) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")] + ["\n"]


def _held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def _check(rows, scored):
    counts = collections.Counter()
    for doc_id, text in rows:
        if not _held(doc_id):
            counts.update(_tokens(text))
    total, types = sum(counts.values()), len(counts)
    want = []
    for doc_id, text in rows:
        tokens = _tokens(text)
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (types + 1))) for t in tokens)
        want.append((doc_id, _held(doc_id), len(tokens), sum(counts[t] > 0 for t in tokens), total, base))
    got = sorted(scored, key=lambda r: (str(r["doc_id"]), r["n_tokens"], r["base_score"]))
    want.sort(key=lambda r: (str(r[0]), r[2], r[5]))
    assert len(got) == len(want)
    for r, w in zip(got, want):
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:5]
        assert r["base_score"] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert r["score"] < 0


def test_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    scored = class_lm.score_documents(docs).collect()
    _check([(r["doc_id"], r["text"]) for r in docs.collect()], scored)
    per = lambda c, h: sum(r[c] for r in scored if r["held_out"] == h) / sum(r["n_tokens"] for r in scored if r["held_out"] == h)
    # better than single words also on documents that were not learned from
    assert per("score", True) > per("base_score", True) + 0.1 and per("score", False) > per("base_score", False) + 0.1
    by = {r["held_out"]: r["perplexity"] for r in class_lm.perplexity(spark.createDataFrame(scored)).collect()}
    assert by[True] == pytest.approx(10 ** -per("score", True))


def test_edges(spark, monkeypatch):
    rows = [(1, None), (2, ""), (3, " \t\n\x0b "), (4, "Word WORD word Été été"), (None, "no id"), (5, "a" * 50_000), (6, "x y " * 40_000), (6, "x y " * 40_000),
            (7, "unseen only here"), (8, "non breaking　space"), *[(100 + i, f"w{i} common words {i % 3}") for i in range(60)]]
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, word int, chunk string").repartition(4)
    _check(rows, class_lm.score_documents(docs).collect())
    monkeypatch.setattr(class_lm, "CHUNK_DOCS", 2)
    monkeypatch.setattr(class_lm, "HELD_KEYS", 10)
    _check(rows, class_lm.score_documents(docs).collect())


def test_no_rows_and_no_training_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert class_lm.score_documents(empty).collect() == []
    held = next(i for i in range(100) if _held(i))
    (row,) = class_lm.score_documents(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (True, 3, 0, 0)
    assert row["base_score"] == pytest.approx(0, abs=1e-12)
    assert row["score"] == pytest.approx(-3 * math.log10(class_lm.CLASSES + 1))


def _matrix(seq, classes):
    out = np.zeros((class_lm.CLASSES + 1,) * 2)
    np.add.at(out, (classes[seq[:-1]], classes[seq[1:]]), 1)
    return out


def test_gains_are_differences_of_the_likelihood():
    rng = np.random.default_rng(1)
    seq, classes = rng.integers(0, 40, 5000), rng.integers(0, class_lm.CLASSES + 1, 40)
    matrix, size = _matrix(seq, classes), class_lm.CLASSES + 1
    for unit in (0, 7, 39):
        after, before = seq[1:][seq[:-1] == unit], seq[:-1][seq[1:] == unit]
        gain = class_lm.gains(matrix, int(classes[unit]), np.bincount(classes[after], minlength=size).astype(float),
                              np.bincount(classes[before], minlength=size).astype(float), int((after == unit).sum()))
        for to in range(size):
            moved = classes.copy()
            moved[unit] = to
            change = class_lm.likelihood(_matrix(seq, moved)) - class_lm.likelihood(matrix)
            assert gain[to] - gain[classes[unit]] == pytest.approx(change, abs=1e-6)


def test_exchange_finds_classes_that_are_there(spark, monkeypatch):
    # texts of two vocabularies that never mix
    monkeypatch.setattr(class_lm, "CLASSES", 4)
    rnd = random.Random(2)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{rnd.randrange(40)}" for _ in range(60))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = class_lm.train(docs)
    hashes, forms, _ = class_lm.words(pa.array([" ".join(f"{v}{k}" for v in "ab" for k in range(40))]))
    unit, known = model.units.of(hashes & ~np.int64(class_lm.FORMS - 1) | forms, forms)
    assert known.all()
    classes = model.classes[unit]
    assert not set(classes[:40]) & set(classes[40:])
    assert np.allclose((10.0 ** model.transition).sum(1), 1)
    share = collections.Counter(model.classes[unit].tolist())
    assert sum(share.values()) == 80


def test_probabilities_of_a_class_add_up(spark):
    rows = [(i, f"one two three {i}") for i in range(50)]
    model = class_lm.train(spark.createDataFrame(rows, "doc_id long, text string"))
    tokens, types = model.units.tokens, model.units.types
    assert tokens.sum() == model.n_tokens == 250 and types.sum() == model.n_types == 54
    for c in set(model.classes.tolist()):
        inside = model.classes == c
        assert 10 ** model.emission[c] == pytest.approx(tokens[inside].sum() + 0.5 * (types[inside].sum() + 1))


def test_words_as_by_the_pattern():
    texts = ["", "a", " a b ", "x\ty\x0bz\x0c", "é É", None, "end", "start"]
    hashes, _, first = class_lm.words(pa.array(texts))
    want = [_tokens(t)[:-1] for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat))


def test_gains_of_words_are_those_of_units():
    rng = np.random.default_rng(3)
    seq, classes, size = rng.integers(0, 30, 3000), rng.integers(0, class_lm.CLASSES + 1, 30), class_lm.CLASSES + 1
    matrix, rows = _matrix(seq, classes), []
    for unit in range(30):
        after, before = seq[1:][seq[:-1] == unit], seq[:-1][seq[1:] == unit]
        rows.append((np.bincount(classes[after], minlength=size), np.bincount(classes[before], minlength=size), int((after == unit).sum())))
    right, left, twice = (np.array(x) for x in zip(*rows))
    got = class_lm.word_gains(matrix, classes, right, left, twice)
    for unit in range(30):
        want = class_lm.gains(matrix, int(classes[unit]), right[unit].astype(float), left[unit].astype(float), int(twice[unit]))
        assert np.allclose(got[unit], want, atol=1e-6)


def _rare_rows():
    # texts of two vocabularies that never mix, a fifth of their words too rare for units of their own
    rnd = random.Random(4)
    return [(i, " ".join(f"{'ab'[i % 2]}{rnd.randrange(150)}ring" if rnd.random() < 0.2 else f"{'ab'[i % 2]}{rnd.randrange(6)}" for _ in range(20))) for i in range(600)]


def test_every_rare_word_moves_to_its_own_class(spark, monkeypatch):
    # all rare words have one form: by form, those of both vocabularies would be in one class
    monkeypatch.setattr(class_lm, "CLASSES", 4)
    monkeypatch.setattr(class_lm, "UNIT_LEAST", 50)
    rows = _rare_rows()
    model = class_lm.train(spark.createDataFrame(rows, "doc_id long, text string"))
    counts = collections.Counter(t for _, text in rows for t in _tokens(text))
    hashes, forms, _ = class_lm.words(pa.array([" ".join(counts)]))
    by_hash = dict(zip((hashes & ~np.int64(class_lm.FORMS - 1) | forms).tolist(), [w for w in counts if w != "\n"]))
    found = {by_hash[r["word"]]: r for r in model.vocabulary.collect()}
    rare = {w for w, n in counts.items() if n < 50 and w != "\n"}
    assert set(found) == rare and len(rare) > 100
    assert all(r["n"] == counts[w] for w, r in found.items())
    of = {v: {r["class"] for w, r in found.items() if w.startswith(v)} for v in "ab"}
    assert not of["a"] & of["b"]
    # the bigrams of classes are those of the texts with every word in its own class
    assert model.share.sum() == model.n_tokens == sum(counts.values()) and model.types.sum() == model.n_types == len(counts)
    assert np.allclose((10.0 ** model.transition).sum(1), 1)


def test_scores_by_hand(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "CHUNK_DOCS", 7)
    monkeypatch.setattr(class_lm, "HELD_ROWS", 20)
    rows = [*_rare_rows(), (1001, "aa same same same"), (1002, "never learned from a0ring"), (1003, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = class_lm.train(docs.where(~class_lm.held_out(class_lm.F.col("doc_id"))))
    home = {r["word"]: (r["class"], r["n"]) for r in model.vocabulary.collect()}

    def known(text):
        hashes, forms, _ = class_lm.words(pa.array([text], pa.string()))
        hashes = hashes & ~np.int64(class_lm.FORMS - 1) | forms
        unit, frequent = model.units.of(hashes, forms)
        out = [(int(model.classes[u]), int(model.units.tokens[u])) if f else home.get(h, (int(model.classes[u]), 0)) for h, u, f in zip(hashes.tolist(), unit.tolist(), frequent.tolist())]
        return [*out, (0, int(model.units.tokens[0]))]

    size, n = class_lm.CLASSES + 1, model.n_tokens
    matrix = np.zeros((size, size))
    for doc_id, text in rows:
        if not _held(doc_id):
            before = 0
            for c, _ in known(text):
                matrix[before, c] += 1
                before = c
    share = matrix.sum(0)
    prior = (share + 0.5) / (n + 0.5 * size)
    flow = np.log10((matrix + size * prior) / (matrix.sum(1, keepdims=True) + size))
    want = {}
    for doc_id, text in rows:
        before, total = 0, 0.0
        for c, k in known(text):
            total += flow[before, c] + math.log10((k + 0.5) / (share[c] + 0.5 * (model.types[c] + 1)))
            before = c
        want[doc_id] = total
    for scored in (class_lm.score(docs, model).collect(), class_lm.score_documents(docs).collect()):
        assert {r["doc_id"]: r["score"] for r in scored} == pytest.approx(want, rel=1e-9)


def test_packing_makes_no_object_for_each_key():
    # every key once: the memory of the arrays alone, not of a Python object for each key
    n = 200_000
    words = np.random.default_rng(5).permutation(n).astype(np.int64)
    pairs = pa.RecordBatch.from_arrays([pa.array(words << 32 | (words + 1)), pa.array(np.ones(n, np.int64))], names=["pair", "n"])
    chunk = pa.RecordBatch.from_arrays([pa.array(words), pa.array([w.tobytes()[:4] for w in words], pa.binary()), pa.array(np.ones(n, np.int64)), pa.array(np.ones(n, np.int32))],
                                       names=["of_chunk", "places", "n", "cls"])
    for pack, batch, arrays in ((class_lm._packed, pairs, 35e6), (class_lm._by_chunk, chunk, 25e6)):
        tracemalloc.start()
        rows = sum(b.num_rows for b in pack(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows >= n
        assert peak < arrays
    key, (places,) = class_lm._grouped(np.array([7, 3, 7]), np.array([2, 1, 0], "<u4"))
    assert key.tolist() == [3, 7] and [np.frombuffer(x, "<u4").tolist() for x in places.to_pylist()] == [[1], [0, 2]]
    key, (places,) = class_lm._grouped(np.zeros(0, np.int64), np.zeros(0, "<u4"))
    assert len(key) == len(places) == 0


def test_batches_to_python_are_small(spark, monkeypatch):
    limits, write = [], class_lm.Scratch.table
    monkeypatch.setattr(class_lm.Scratch, "table", lambda self, df, name: limits.append(spark.conf.get(BATCH_BYTES)) or write(self, df, name))
    before = spark.conf.get(BATCH_BYTES)
    docs = spark.createDataFrame([(i, f"one two three {i}") for i in range(20)], "doc_id long, text string")
    class_lm.score(docs, class_lm.train(docs)).collect()
    class_lm.score_documents(docs).collect()
    assert len(limits) >= 8 and all(int(x) <= 4 << 20 for x in limits)
    assert spark.conf.get(BATCH_BYTES) == before


def test_a_word_may_go_on_in_the_next_batch(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "UNIT_LEAST", 50)
    monkeypatch.setattr(class_lm, "HELD_ROWS", 20)  # many rows of a word
    rows = _rare_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = class_lm.train(docs).vocabulary.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    counts = collections.Counter(t for _, text in rows for t in _tokens(text))
    assert len({r["word"] for r in found}) == len(found)
    assert sorted(r["n"] for r in found) == sorted(n for w, n in counts.items() if n < 50 and w != "\n")
