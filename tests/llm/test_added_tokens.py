"""op3_token_files against the unmodified library on texts that hold added tokens."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import AddedToken, Tokenizer

from adtally.llm import token_files
from adtally.llm.common import importable

PATH = public_tokenizers.path("byte_bpe_50k.json")
END = "<|endoftext|>"


def _same(coder, library, texts):
    ids, at = coder.ids(pa.array(texts, pa.string()))
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([END, END[:-1], "|>", " ", "\n", "a", "it's", "x.y", "é", "  "]), max_size=8).map("".join) | st.none(), max_size=5))
def test_added_tokens_are_the_librarys(texts):
    _same(token_files.coder(PATH), Tokenizer.from_file(PATH), texts)


@pytest.mark.parametrize("token", [AddedToken("<x>", lstrip=True, rstrip=True), AddedToken("ab", single_word=True), AddedToken("<|endoftext|>>"),
                                   AddedToken("<|endoftext|>>", normalized=False)])
def test_other_kinds_of_added_tokens(token):
    library = Tokenizer.from_file(PATH)
    library.add_tokens([token])
    _same(token_files.TextCoder(library), library, ["a <x> b", "ab cab ab.", "a" + END + "> b" + END, None, "plain text"])


def test_token_files_with_an_added_token(spark):
    importable(spark)
    library, at = Tokenizer.from_file(PATH), 0
    texts = ["first text", f"one {END} two{END}{END}\nthree", END, "", "last text"]
    got = {r["doc_id"]: r for r in token_files.token_checksums(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH).collect()}
    for d, text in enumerate(texts):
        ids = library.encode(text, add_special_tokens=False).ids + [0]
        assert (got[d]["start"], got[d]["n_tokens"], got[d]["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
