"""The piece cache of op3_token_files and op6_bpe: cost of pieces seen before, and same ids at any cache size."""

import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from adtally.llm import pieces, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _least_seconds(f):
    took = []
    for _ in range(5):
        begin = time.process_time()
        f()
        took.append(time.process_time() - begin)
    return min(took)


def test_known_pieces_cost_little_more_than_finding_them():
    rnd = random.Random(1)
    words = pa.array([" " + "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(150_000)])
    texts = pa.array(["".join(words[k: k + 500].to_pylist()) for k in range(0, len(words), 500)])
    coder = pieces.PieceCoder(lambda p: (np.arange(len(p), dtype=np.uint32), np.ones(len(p), np.int64)))
    coder.ids(texts)
    assert _least_seconds(lambda: coder.ids(texts)) < 10 * _least_seconds(words.dictionary_encode)  # 13 to 22 times before


def _texts():
    rnd = random.Random(2)
    parts = ["a", "Z9", " word", "  ", "\n", "\n\n", "\t", "'s", ".", "-", "é", "×", "ß", "\u0085", " ", "　", "漢字", "😀", "é", "\x00", " thing" * 20, "y" * 90]
    return ["".join(rnd.choices(parts, k=rnd.randint(0, 40))) for _ in range(300)] + ["", None, "q" * 70 + " " + "q" * 70]


@pytest.mark.parametrize("cache", [0, 20, 10_000])
def test_same_ids_with_a_cache_of_any_size(monkeypatch, cache):
    monkeypatch.setattr(pieces, "CACHE_PIECES", cache)
    library, coder, texts = Tokenizer.from_file(PATH), token_files.TextCoder(Tokenizer.from_file(PATH)), _texts()
    for _ in range(2):
        for k in range(0, len(texts), 50):
            ids, at = coder.ids(pa.array(texts[k: k + 50], pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [library.encode(t or "", add_special_tokens=False).ids for t in texts[k: k + 50]]


def test_long_pieces_are_not_kept():
    coder = token_files.TextCoder(Tokenizer.from_file(PATH))
    coder.ids(pa.array(["a" * 5000 + " b " + "c" * 63 + " " + "d" * 64]))
    kept = coder.pieces.young
    assert max(map(len, kept.number)) < 64 and len(kept.number) == len(kept.begin) == len(kept.lengths)
    assert len(kept.flat) == kept.lengths.sum() < 64


def test_pieces_encoded_together_keep_their_order():
    library = Tokenizer.from_file(PATH)
    for lot in (["a", "b ", " c", "\n", " ", "a b", "é"], ["\n"], ["", "a"], ["x"] * 1200 + ["  "] + [" why"] * 700):
        ids, counts = token_files._encode(library, lot)
        each = [library.encode(p, add_special_tokens=False).ids for p in lot]
        assert ids.tolist() == sum(each, []) and counts.tolist() == list(map(len, each))
