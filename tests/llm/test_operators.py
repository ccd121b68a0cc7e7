"""Every operator against SQL or a brute-force version of it."""

import base64
import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from adtally.llm import bpe, decontam, html_text, near_dups, pii, queries, repeats, token_files, url_filter
from adtally.llm.common import table

QUERIES = queries.queries()


@pytest.fixture(scope="module")
def texts():
    rows = duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{SF001}/documents.parquet') ORDER BY doc_id").fetchall()
    return dict(rows)


def _by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    rel = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in rel.description]
    got = QUERIES[name](spark, SF001)
    assert sorted(got.columns) == sorted(columns)
    key = lambda t: tuple(str(x) for x in t)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=key) == sorted(rel.fetchall(), key=key)


def test_secret_parts_are_linked_only_in_scope(spark):
    from adtally.llm import secrets

    value = "Ab1" + "xYz9" * 10
    near = f"login = svc_user at https://db.example.org/x with {value}"
    far = near.replace(" with ", " " + "word " * 200)
    rows = _by_id(secrets.find_secrets(spark.createDataFrame([(1, near), (2, far), (3, value)], "doc_id long, text string")))
    assert [s.split(":")[0] for s in rows[1]["spans"].split(",")] == ["identifier", "endpoint", "value"]
    assert [s.split(":")[0] for s in rows[2]["spans"].split(",")] == ["identifier", "endpoint"]
    assert rows[3]["spans"] == ""


def test_many_matches_keep_their_places(spark):
    from adtally.llm import secrets

    text = "".join(f"é{i} token={i:06d} " for i in range(500))
    want = ",".join(f"assign:{m.start()}:{m.end()}" for m in re.finditer(r"token=[0-9]+", text))
    got = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert got["n_assign"] == 500 and got["spans"] == want


def _words(text):
    return re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", text.lower())


def test_leaks_match_alignment_by_brute_force(spark, texts):
    bench = duckdb.sql(f"SELECT item_id, text FROM read_parquet('{SF001}/benchmark.parquet')").fetchall()
    want = set()
    for d, text in texts.items():
        w = _words(text)
        for i, item in bench:
            b = _words(item)
            if any(w[p:p + len(b)] == b for p in range(len(w) - len(b) + 1)):
                want.add((d, i))
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op2_decontaminate"](spark, SF001).collect()}
    assert got == want and want


def test_leaks_tolerate_substitutions(spark):
    rnd = random.Random(1)
    vocabulary = [f"w{i}" for i in range(5000)]
    items = [[rnd.choice(vocabulary) for _ in range(40)] for _ in range(20)]
    docs = []
    for i, item in enumerate(items):
        changed = [f"x{j}" if j % 9 == 4 else w for j, w in enumerate(item)]
        docs.append((i, " ".join([rnd.choice(vocabulary) for _ in range(100)] + changed)))
        docs.append((100 + i, " ".join(item[:6] + [rnd.choice(vocabulary) for _ in range(100)])))
    got = decontam.benchmark_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                                   spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["first_word"]) for r in got} == {(i, i, 100) for i in range(20)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500))
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    starts, payload = token_files.encode_blocks(ids)
    raw = np.frombuffer(payload, np.uint8)
    assert np.array_equal(token_files.decode_blocks(raw, starts)[:len(ids)], ids)
    if len(starts) > 1:  # a block alone, by the index
        assert np.array_equal(token_files.decode_blocks(raw, starts[1:2])[: len(ids) - 256], ids[256:512])


def test_outliers_are_exceptions_not_width():
    ids = np.full(256, 5, np.uint32)
    ids[7] = 50_000
    starts, payload = token_files.encode_blocks(ids)
    assert len(payload) == 8 + 5  # head and one exception; width 0


def test_token_files_against_the_library(spark, texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    got, at = _by_id(QUERIES["op3_token_files"](spark, SF001)), 0
    for d, text in texts.items():
        ids = t.encode(text, add_special_tokens=False).ids + [0]
        want = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert (got[d]["start"], got[d]["n_tokens"], got[d]["ids_crc32"]) == want
        at += len(ids)


def test_near_duplicates_by_brute_force(spark, texts):
    bags = {}
    for d, text in texts.items():
        w = _words(text)
        bags[d] = collections.Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else collections.Counter()
    parent = {d: d for d in texts}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in texts:
        for b in texts:
            if a < b and bags[a].keys() & bags[b].keys():
                if sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values()):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    got = {d: r["class_id"] for d, r in _by_id(QUERIES["op4_near_duplicates"](spark, SF001)).items()}
    assert got == {d: root(d) for d in texts}
    assert len(set(got.values())) < len(got)


def test_a_hub_links_copies_that_differ_from_each_other(spark):
    rnd = random.Random(5)
    base = [f"b{i}" for i in range(300)]
    copies = []
    for i in range(60):
        text = list(base)
        for j in rnd.sample(range(300), 5):
            text[j] = f"c{i}x{j}"
        copies.append((i + 1, " ".join(text)))
    rows = [(0, " ".join(base)), *copies, (999, " ".join(f"z{i}" for i in range(300)))]
    got = {d: r["class_id"] for d, r in _by_id(near_dups.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"))).items()}
    assert got == {d: 0 for d in range(61)} | {999: 999}


def test_signatures_estimate_weighted_similarity():
    rnd = np.random.default_rng(3)
    errors = []
    for _ in range(30):
        keys = rnd.integers(0, 2**63, 200).astype(np.uint64)
        a, b = rnd.integers(0, 6, 200), rnd.integers(0, 6, 200)
        true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        doc = np.concatenate([np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)])
        sig = near_dups.bag_signatures(np.concatenate([keys[a > 0], keys[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), doc, 2, 512)
        errors.append((sig[0] == sig[1]).mean() - true)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.04


def test_digest_array_confirms_strings(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter, "LOCAL_BYTES", 0)  # the way of a list too large for every task
    rows = spark.createDataFrame([("a.b.c", "/x/y"), ("c", ""), ("", "")], "host string, path string")
    listed = spark.createDataFrame([("b.c/",), ("b.c/x/",), ("c",), (None,), ("c",)], "entry string")
    got = {r["host"]: r["entry"] for r in url_filter.matches(rows, listed).collect()}
    assert got == {"a.b.c": "b.c/x/", "c": "c", "": None}
    path = url_filter.build_list(listed).first()["path"]
    array = url_filter.DigestArray(path)
    assert np.all(np.diff(array.keys.astype(float)) > 0)
    # the same digest with another string is no hit
    assert array.probe(array.keys[:1], ["another"]).tolist() == [False]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=12) | st.sampled_from(["  ", " ", "　", "\x1c", "it's", "A1.b", "\n\n", " 'll", "aaaa", "  x", ". .", "<|endoftext|>", "é", "ß,", "\u00d7.", "\u00a0", "\u2003", "\n", "x\ny", "é\né", "語", "я"]), max_size=14))
def test_encoding_is_the_librarys(vocabulary, library, parts):
    text = "".join(parts).encode("utf-8", "ignore").decode()
    ids, at = vocabulary.coder.ids(pa.array([text, None, text]))
    want = library.encode_ordinary(text)
    assert ids.tolist() == want + want and at.tolist() == [0, len(want), len(want), 2 * len(want)]
    assert vocabulary.decode(ids)[0].tobytes() == (text + text).encode()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([" ", "\n", "\t", "a", "B7", "é", "×", "\u00a0", "\u3000", "\x1c", "'", "'s", ".", "$$", "я", "語", "😀", "\u0301", "\u0660"]), max_size=25))
def test_pieces_join_to_the_librarys_ids(parts):
    text = "".join(parts)
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    assert token_files.coder(path).ids(pa.array([text]))[0].tolist() == t.encode(text, add_special_tokens=False).ids


def test_long_pre_tokens(vocabulary, library):
    rnd = random.Random(2)
    for text in ("a" * 20_000, "".join(rnd.choice("abcdeth") for _ in range(20_000)), "中文" * 5000):
        assert bpe.merge(text.encode(), vocabulary.ranks) == library.encode_ordinary(text)


def test_bpe_query_and_documents(spark, texts, library):
    got = _by_id(QUERIES["op6_bpe"](spark, SF001))
    for d, text in texts.items():
        ids = library.encode_ordinary(text)
        assert (got[d]["n_tokens"], got[d]["ids_sha256"], got[d]["decoded_sha256"]) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    back = bpe.decode_documents(bpe.encode_documents(table(spark, SF001, "documents"), path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == texts


def test_pages_against_their_article(spark):
    import html

    got = {r["page_id"]: r["text"] for r in QUERIES["op7_html_text"](spark, SF001).collect()}
    for page, source in duckdb.sql(f"SELECT page_id, html FROM read_parquet('{SF001}/pages.parquet')").fetchall():
        article = re.search(r"<article>(.*?)(?:</article>|<footer)", source, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)[^>]*>", article)]
        assert got[page] == "\n".join(filter(None, parts))


def test_page_furniture_is_left_out():
    page = """<html><head><title>T</title></head><body><header><a href=/>Home</a></header><div class="cookie-notice">We use cookies</div>
    <div id=main><h1>Head &amp; line</h1><p>First   paragraph<br>of some length, with <a href=x>a link</a> in it.<p>Second paragraph, also long enough.
    <ul><li>point one of the list<li>point two of the list</ul><form><input>Search</form><aside>Also read</aside></div>
    <section class="comments"><p>Nice post, thank you very much!</p></section><div class="ad">Buy</div><footer>&copy; me</footer></body>"""
    assert html_text.main_text(page).split("\n") == [
        "Head & line", "First paragraph of some length, with a link in it.", "Second paragraph, also long enough.", "point one of the list", "point two of the list"]


def test_personal_data_base_by_plain_patterns(spark, texts):
    def luhn(s):
        return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(s))) % 10 == 0

    extra = {10**6: "x@y@z.com a@b.c@d.e 1.2.3.4.5.6.7.8 300.1.1.1 4111-1111 1111 1111 +1 (((2 +33 6 12 34 56 78 9 8 7 6", 10**6 + 1: "9" * 3000 + "@" + "." * 50}
    got = _by_id(pii.find_spans(spark.createDataFrame(list((texts | extra).items()), "doc_id long, text string")))
    for d, text in (texts | extra).items():
        want = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        want += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            digits = re.sub("[ -]", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                want.append(("card", *m.span()))
        want += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        assert got[d]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest(), d


def test_weak_labels_find_more_and_leave_the_rest(spark):
    good = [(i, f"Please call me on 555 {200 + i} 4{100 + i} or email joe{i}@mail.example.com today") for i in range(40)]
    bad = [(100 + i, f"order 111 1111 1111 part {i}") for i in range(20)]
    rows = _by_id(pii.find_spans(spark.createDataFrame(good + bad, "doc_id long, text string")))
    assert all("phone_local" in rows[i]["spans"] for i, _ in good)
    assert all(rows[i]["spans"] == "" for i, _ in bad)


def test_em_learns_reliabilities():
    rnd = random.Random(4)
    counts = collections.Counter()
    for _ in range(4000):
        y = rnd.random() < 0.4
        vote = tuple((1 if (rnd.random() < a) == y else -1) for a in (0.95, 0.9, 0.6, 0.5, 0.5))
        counts["phone_local", vote, int(y) if rnd.random() < 0.1 else -1] += 1
    model = pii.fit([(k, v, z, n) for (k, v, z), n in counts.items()])
    assert model.score("phone_local", (1, 1, 1, 1, 1)) > 0.9 > 0.2 > model.score("phone_local", (-1, -1, -1, 1, 1))
    assert model.reliability["format"][0] > model.reliability["cue"][0]


def _windows(texts):
    seen = collections.Counter()
    for text in texts:
        raw = text.encode()
        seen.update(raw[k:k + 400] for k in range(len(raw) - 399))
    return seen


def _check_repeats(got, texts):
    seen = _windows(texts.values())
    for d, text in texts.items():
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 399):
            if seen[raw[k:k + 400]] > 1:
                gone[k:k + 400] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        assert (got[d]["n_bytes"], got[d]["n_removed"], got[d]["n_spans"], got[d]["kept_sha256"]) == (
            len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()), d


def test_repeats_by_brute_force(spark, texts):
    _check_repeats(_by_id(QUERIES["op10_repeats"](spark, SF001)), texts)


def test_repeats_in_awkward_texts(spark, monkeypatch):
    rnd = random.Random(9)
    word = lambda n: "".join(rnd.choice("abé ") for _ in range(n))
    passage = word(450)
    texts = {0: "a" * 1500, 1: "ab" * 900, 2: word(700) + passage + word(600), 3: passage[:399] + "Z" + passage[30:] + word(10), 4: word(500), 5: passage, 6: passage[5:420],
             7: "xyz" * 300 + word(20) + "xyz" * 200, 8: word(300), 9: passage + word(100) + passage}
    for i in range(10, 40):  # near copies: many different reads of one anchor
        t = list(texts[2])
        t[rnd.randrange(len(t))] = "#"
        texts[i] = "".join(t)
    _check_repeats(_by_id(repeats.remove_repeats(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))), texts)


def test_long_texts_are_cut_without_losing_windows(monkeypatch):
    rnd = random.Random(11)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(6000)).encode()
    raw, offsets = np.frombuffer(text + text[1000:2500], np.uint8), np.array([0, 6000, 7500])
    whole = [x for part in repeats.reads(raw, offsets) for x in zip(*part)]
    monkeypatch.setattr(repeats, "_PIECE", 700)
    cut = [x for part in repeats.reads(raw, offsets) for x in zip(*part)]
    places = lambda rows: {(t, s + i, s + off, a) for t, s, n, off, a, _ in rows for i in range(n)}
    assert places(whole) == places(cut)


def test_columns_from_a_file_give_the_same(monkeypatch):
    rnd = random.Random(12)
    base = bytes(rnd.choice(b"abc") for _ in range(700))
    strings = [base[:650], base[:300] + b"#" + base[301:650], base[20:680]]
    args = (strings, np.array([200, 200, 180]), np.array([251, 251, 261]), np.zeros(3, int))
    plain = repeats.repeated_windows(*args)
    monkeypatch.setattr(repeats, "_BLOCK_BYTES", 0)
    assert np.array_equal(plain, repeats.repeated_windows(*args)) and plain.any()
