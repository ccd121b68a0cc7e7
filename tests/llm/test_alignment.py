"""op11: alignment of two tokenizers against the libraries on whole texts."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF001
from tokenizers import Tokenizer

from adtally.llm import alignment
from adtally.llm.common import importable

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")


def _brute(rows):
    """What the documents' rows should be: two pointers over the tokens of each text."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    alphabet, out, held = alignment.byte_alphabet(), [], collections.Counter()
    for doc_id, text in rows:
        row = dict.fromkeys(COLUMNS[:4], 0) | {"doc_id": doc_id, "groups_sha256": ""}
        links, groups = [], []
        out.append((row, links))
        if not text:
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        whole = (" " + text).encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            continue
        i = j = done_a = done_b = 0
        group = ([], [])
        while i < len(ids_a):
            links.append((ids_a[i], ids_b[j]))
            end_a, end_b = done_a + len(bytes_a[i]), done_b + len(bytes_b[j])
            if end_a <= end_b:
                group[0].append(ids_a[i])
                i, done_a = i + 1, end_a
            if end_b <= end_a:
                group[1].append(ids_b[j])
                j, done_b = j + 1, end_b
            if end_a == end_b:
                groups.append("|".join(",".join(map(str, g)) for g in group))
                group = ([], [])
        row |= {"n_a": len(ids_a), "n_b": len(ids_b), "n_groups": len(groups), "n_links": len(links), "groups_sha256": hashlib.sha256(";".join(groups).encode()).hexdigest()}
        held.update(set(links))
    highest = collections.Counter()
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    for row, links in out:
        row |= {"n_best": sum(held[p] == highest[p[0]] for p in links), "count_sum": sum(held[p] for p in links)}
    return [tuple(row[c] for c in ("doc_id", *COLUMNS)) for row, _ in out]


def _texts():
    odd = [None, "", " ", "\n", "a  b\n\nc  ", "ﬁ ½ é \x00x ▁y <s> <0x41> 　z\r\n", "<|endoftext|> x<|endoftext|>", "日本語 テキスト  x",
           "x" * 20_000, "it's we'll  don't\tx y\n z", "▁", "a ▁b", "\U0001f600 \U0001f600\U0001f600 ok", "a \nb", "\x85 q", "x>y a.b,c;d", "same words twice same words twice", "same words twice same words twice",
           "long " * 30_000]
    rnd = random.Random(5)
    parts = [" ", "\n", "a", "b", "é", "the", " the", "1", "'s", "▁", "-", ".", ",", ">", "  ", "日", " "]
    return odd + ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 40))) for _ in range(300)]


def test_every_text_as_by_the_libraries(spark):
    importable(spark)
    rows = list(enumerate(_texts())) + [(None, "no id at all"), (7, "repeated id")]
    rows += [(1000 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    docs = spark.createDataFrame([(i, t, "x", 0, "y") for i, t in rows], "doc_id long, text string, chunk string, a int, bits string")
    got = [tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in alignment.align_documents(docs.repartition(3), A, B).collect()]
    assert sorted(got, key=str) == sorted(_brute(rows), key=str)


def test_small_chunks_give_the_same(spark, monkeypatch):
    rows = [(i, f"the cat sat {i % 7} the cat, the dog the the {'word ' * (i % 5)}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, alignment.align_documents(docs, A, B).collect()))
    monkeypatch.setattr(alignment, "CHUNK_DOCS", 3)
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 100)
    assert sorted(map(tuple, alignment.align_documents(docs, A, B).collect())) == want


def test_empty_table_and_text_ids(spark):
    assert alignment.align_documents(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []
    row = alignment.align_documents(spark.createDataFrame([("k", "one text")], "doc_id string, text string"), A, B).first()
    assert row["doc_id"] == "k" and row["n_links"] == row["n_best"] == row["count_sum"] > 0


def test_planes_hold_the_multiplicities():
    rnd = np.random.default_rng(3)
    doc, key, times = rnd.integers(0, 50, 4000), rnd.integers(0, 30, 4000), rnd.integers(1, 9, 4000)
    total = collections.Counter()
    for d, k, t in zip(doc.tolist(), key.tolist(), times.tolist()):
        total[k, d] += t
    back = collections.Counter()
    for rows in alignment._postings(doc, key, times, 50):
        for plane, b, card, dense, bits in zip(rows["plane"], rows["b"], rows["card"], rows["dense"], rows["bits"]):
            docs = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little", count=50)) if dense else np.frombuffer(bits, "<u2")
            assert len(docs) == card
            for d in docs.tolist():
                back[int(b), d] += 1 if plane == 0 else 1 << (int(plane) - 1)
    assert back == total


def test_link_counts_of_pairs(spark):
    docs = spark.createDataFrame([(1, "the the the"), (2, "the"), (3, None)], "doc_id long, text string")
    _, postings = alignment.pair_index(docs, A, B)
    counts = alignment.pair_counts(postings).collect()
    assert [(r["n_docs"], r["n_links"], r["best"]) for r in counts] == [(2, 4, True)]


def test_a_model_that_merges_across_spaces_is_refused(monkeypatch):
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "id_to_piece", lambda self, i: "a▁b")
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "is_byte", lambda self, i: False)
    with pytest.raises(ValueError):
        alignment.Aligner(A, B)
