"""Every operator on nulls, empty and long texts, ties, repeated rows, clashing names and empty tables."""

import public_tokenizers
import pytest

from adtally.llm import bpe, decontam, html_text, near_dups, pii, quality, repeats, secrets, token_files, url_filter
from adtally.llm.common import importable

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, fp string, key string, _t string, band long, host string, at int, _text string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000)) + " " + "a" * 100_000
SAME = "one two three four five six seven eight nine ten eleven twelve " * 30


def _row(doc_id, text, source="s"):
    return (doc_id, text, "en", source, None if text is None else len(text), "x", "y", "z", 7, "h", 3, "t")


ROWS = [_row(1, SAME), _row(1, SAME), _row(2, SAME), _row(3, None), _row(None, "lonely text with a null id"), _row(4, ""),
        _row(5, LONG), _row(6, "\n \t", None), _row(None, None, None), _row(7, "caf\u00e9 \U0001f600 +1 (555) 123-4567 a@b.co")]
OPERATORS = {
    "secrets": lambda d: secrets.find_secrets(d),
    "token_files": lambda d: token_files.token_checksums(d, TOKENIZER),
    "near_dups": lambda d: near_dups.near_duplicate_classes(d),
    "bpe": lambda d: bpe.round_trip_digests(d, RANKS, public_tokenizers.PATTERN),
    "quality": lambda d: quality.quality(d),
    "pii": lambda d: pii.find_spans(d),
    "repeats": lambda d: repeats.remove_repeats(d),
}


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    return spark.createDataFrame(ROWS, COLUMNS)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_a_row_for_every_row(docs, name):
    got = OPERATORS[name](docs).select("doc_id").collect()
    assert sorted(str(r[0]) for r in got) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, docs, name):
    assert OPERATORS[name](docs.limit(0)).collect() == []


def test_near_duplicate_classes_of_edges(docs):
    got = {(r["doc_id"], r["class_id"]) for r in near_dups.near_duplicate_classes(docs).collect()}
    assert {(1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (6, 6), (7, 7)} <= got


def test_near_duplicates_keep_one_row_and_all_columns(docs):
    kept = near_dups.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and 5 in ids and 7 in ids


def test_quality_keeps_columns_and_rows(docs):
    kept = quality.keep_documents(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {5}  # the others are short or repeat themselves


def test_repeated_rows_are_repeats_of_each_other(docs):
    rows = repeats.remove_repeats(docs).where("doc_id in (1, 2)").collect()
    assert len(rows) == 3 and all(r["n_removed"] == r["n_bytes"] == len(SAME) and r["n_spans"] == 1 for r in rows)


def test_redaction_of_edges(docs):
    out = {(r["doc_id"], r["text"], r["n_chars"]) for r in pii.redact(docs).where("doc_id in (3, 4, 7)").collect()}
    assert out == {(3, None, None), (4, "", 0), (7, "caf\u00e9 \U0001f600 [PHONE] [EMAIL]", 22)}


def test_decontamination_of_edges(spark, docs):
    item = " ".join(SAME.split()[:20])
    bench = spark.createDataFrame([(1, item), (1, item), (None, item + " more"), (2, None), (3, ""), (4, "short")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.benchmark_leaks(docs, bench).collect()}
    assert got == {(1, 1), (2, 1), (1, None), (2, None)}
    assert {r["doc_id"] for r in decontam.drop_leaking(docs, bench).collect()} == {None, 3, 4, 5, 6, 7}
    assert decontam.benchmark_leaks(docs, bench.limit(0)).collect() == []
    assert decontam.benchmark_leaks(docs.limit(0), bench).collect() == []
    assert decontam.drop_leaking(docs, bench.limit(0)).count() == len(ROWS)


def test_pages_of_edges(spark):
    importable(spark)
    pages = spark.createDataFrame([(1, None, None), (1, "no scheme", ""), (None, "http://A.b/c", "plain text"), (2, "x://", "<p>" * 3000 + "deep")],
                                  "page_id long, url string, html string")
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in html_text.extract_pages(pages).collect()}
    assert got == {(1, None): ("", 0), (1, "no scheme"): ("", 0), (None, "http://A.b/c"): ("plain text", 10), (2, "x://"): ("deep", 4)}
    assert html_text.extract_pages(pages.limit(0)).collect() == []
    none = spark.createDataFrame([], "entry string")
    judged = url_filter.judge(pages, [("b/", "block")], none)
    assert sorted((str(r["page_id"]), r["host"], r["path"], r["rule"], r["verdict"]) for r in judged.collect()) == [
        ("1", "", "", None, "allow"), ("1", "", "", None, "allow"), ("2", "", "", None, "allow"), ("None", "a.b", "/c", "b/", "block")]
    assert url_filter.judge(pages.limit(0), [("b/", "block")], none).collect() == []
