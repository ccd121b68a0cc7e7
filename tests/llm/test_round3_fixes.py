"""Cases that earlier versions of op2, op4, op7 and op9 lost."""

import collections
import math
import random
import time

import pytest

from adtally.llm import decontam, html_text, near_dups, pii
from adtally.llm.common import importable

P = "<p>{} words of a paragraph that is long enough to count as text, number {}</p>"


def _paragraphs(name, n):
    return "".join(P.format(name, i) for i in range(n))


def _text(name, n):
    return [f"{name} words of a paragraph that is long enough to count as text, number {i}" for i in range(n)]


@pytest.mark.parametrize("unit", ["<a ", "<a \"", "<a<b", "<a x=\"y\" ", "<!x", "</", "<script>", "<p>"])
def test_pages_of_open_markup_take_linear_time(unit):
    took = []
    for n in (40_000, 160_000):
        begin = time.process_time()
        html_text.main_text(unit * n)
        took.append(time.process_time() - begin)
    assert took[1] < 10 * max(took[0], 0.05)  # four times the text


def test_five_megabytes_of_open_tags():
    begin = time.process_time()
    assert html_text.main_text("<a " * 1_700_000).startswith("<a <a")
    assert time.process_time() - begin < 15


def test_quotes_in_tags():
    assert html_text.main_text("<article><p title='a > b' x=\"1 > 0\">one</p><p>2 < 3 <b>two</b></p></article>") == "one\n2 < 3 two"
    assert html_text.main_text("<p>a <b x='open> c</p>") == "a <b x='open> c"  # an open quote: text
    assert html_text.main_text("<article><p>a</p><script>if (a < b) '</p>'</script><p>b</p><title>t</title></article>") == "a\nb"


def test_article_in_several_containers():
    page = f"<html><body><div><div>{_paragraphs('first', 4)}</div><div>{_paragraphs('second', 2)}</div></div><div><a href=x>menu one</a> <a href=y>menu two</a></div></body></html>"
    assert html_text.main_text(page).split("\n") == _text("first", 4) + _text("second", 2)


def test_class_names_inside_an_article():
    page = ("<body><div class='entry-header'>site name</div><article><div class='entry-header'><h1>Title</h1></div><div class='side-by-side'><p>Both sides.</p></div>"
            "<div class='ad'>buy</div><div id='comments'><p>first!</p></div><div class='related-work'><p>Related work.</p></div></article></body>")
    assert html_text.main_text(page) == "Title\nBoth sides.\nRelated work."


def test_page_without_article(spark):
    importable(spark)
    page = f"<body><div id='nav'><ul><li><a href=1>one</a><li><a href=2>two</a></ul></div><div class=x>{_paragraphs('body', 5)}</div><footer>end</footer></body>"
    rows = spark.createDataFrame([(1, "u", page, "t", 5, 3)], "page_id long, url string, html string, text string, n_chars int, density int")
    (row,) = html_text.extract_pages(rows).collect()
    assert row["text"].split("\n") == _text("body", 5) and row["n_chars"] == len(row["text"])


def _plain_density(page):
    """Density and density sum of every kept node, by recursion over the counts' definitions."""
    root = html_text.parse(page)
    out = []

    def count(node, link):
        c = t = lc = lt = 0
        for child in node.children:
            if isinstance(child, str):
                n = len("".join(child.split()))
                c, lc = c + n, lc + n * link
            elif not child.dropped:
                a = count(child, link or child.tag == "a")
                c, t, lc, lt = c + a[0], t + a[1] + 1, lc + a[2], lt + a[3] + (child.tag == "a")
        out.append((node, c, t, lc, lt))
        return c, t, lc, lt

    count(root, False)
    body = next((x for x in reversed(out) if x[0].tag == "body"), out[-1])
    share = body[3] / max(body[1], 1)
    density = {}
    for node, c, t, lc, lt in out:
        inner = math.log(c / max(c - lc, 1) * lc + share * c + math.e) if c else 1
        value = math.log(max(c / max(lc, 1) * max(t, 1) / max(lt, 1) if t else c / max(lc, 1), 1.0)) if c else 0
        density[id(node)] = c / max(t, 1) * (value / math.log(inner) if inner > 1 + 1e-9 else value) if c else 0.0
    return root, density


def test_densities_of_small_trees():
    rnd = random.Random(4)
    for _ in range(60):
        def tree(depth):
            if depth == 0 or rnd.random() < 0.3:
                return rnd.choice(["word " * rnd.randrange(1, 9), "<a href=x>link text</a>", "<br>", ""])
            tag = rnd.choice(["div", "p", "ul", "section", "span"])
            return f"<{tag}>" + "".join(tree(depth - 1) for _ in range(rnd.randrange(1, 4))) + f"</{tag}>"

        page = f"<body>{tree(4)}{tree(4)}</body>"
        root, want = _plain_density(page)
        html_text.measure(root)
        for node in html_text._in_order(root):
            assert node.density == pytest.approx(want[id(node)], rel=1e-9, abs=1e-12)
        best, _, chosen = html_text.main_node(root)
        sums = [sum(want[id(c)] for c in n.children if not isinstance(c, str) and not c.dropped) for n in html_text._in_order(root) if n.tag not in ("#root", "html")]
        if max(sums) > 0:
            assert sum(want[id(c)] for c in best.children if not isinstance(c, str) and not c.dropped) == pytest.approx(max(sums))
        assert any(n is best for n in chosen)


def test_candidate_in_a_span_that_begins_far_before():
    text = "x" * 200 + " (555) 123-4567 " + "y" * 400
    at = text.index("(555)")
    assert any(k == "phone_local" for k, _, _ in pii.candidates(text, []))
    taken = [("phone", 0, 500), *[("ip", 10 + 12 * i, 15 + 12 * i) for i in range(12)]]
    assert not [c for c in pii.candidates(text, taken) if c[1] >= at - 1 and c[2] <= 500]


def test_short_items_leak_as_a_whole(spark):
    importable(spark)
    docs = spark.createDataFrame([(1, "before " + "alpha beta gamma delta epsilon zeta eta" + " after"), (2, "alpha beta gamma delta OTHER zeta eta"), (3, "the quick one"), (4, "the quick"), (5, None)],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(1, "Alpha beta gamma, delta epsilon zeta eta!"), (2, "quick one"), (3, ""), (4, "...")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["first_word"], r["matched_words"]) for r in decontam.benchmark_leaks(docs, bench).collect()}
    assert got == {(1, 1, 1, 7), (3, 2, 1, 2)}
    assert {r["doc_id"] for r in decontam.drop_leaking(docs, bench).collect()} == {2, 4, 5}
    long = "word " * 300_000 + "alpha beta gamma delta epsilon zeta eta"
    assert decontam.benchmark_leaks(spark.createDataFrame([(1, long)], "doc_id long, text string"), bench).first()["first_word"] == 300_000


def _bag(text):
    w = text.split()
    return collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def _similar(a, b):
    both = sum((a & b).values())
    return both >= 0.8 * (sum(a.values()) + sum(b.values()) - both)


def _family(rnd, n, changes, words=300):
    base = [f"b{i}" for i in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        for j in rnd.sample(range(words), changes):
            own[j] = f"c{i}x{j}"
        out.append(own)
    return out


def test_family_below_the_threshold_makes_few_rows(spark, monkeypatch):
    """Texts at about 0.68 to each other, with pairs at 0.8 and more among them."""
    importable(spark)
    rows, seen = {}, []
    whole = near_dups.materialize

    def counted(df, name):
        out = whole(df, name)
        if name == "crossing":
            seen.append(out.count())
        return out

    monkeypatch.setattr(near_dups, "materialize", counted)
    for n in (200, 400):
        rnd = random.Random(n)
        family = _family(rnd, n, 6)
        for k in range(0, 20):  # a partner each for twenty of them
            twin = list(family[k])
            for j in rnd.sample(range(300), 3):
                twin[j] = f"t{k}x{j}"
            family.append(twin)
        texts = [" ".join(w) for w in family]
        bags = [_bag(t) for t in texts]
        parent = list(range(len(texts)))

        def root(d):
            while parent[d] != d:
                d = parent[d]
            return d

        for a in range(len(texts)):
            for b in range(a):
                if _similar(bags[a], bags[b]):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
        seen.clear()
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r["doc_id"]: r["class_id"] for r in near_dups.near_duplicate_classes(df).collect()}
        assert [got[d] for d in range(len(texts))] == [root(d) for d in range(len(texts))]
        rows[n] = sum(seen)
    # pairs that agree are near the threshold, not all n * n / 2
    assert rows[400] < 4000
