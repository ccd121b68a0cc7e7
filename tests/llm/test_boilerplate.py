"""Line frequency of op8_quality on planted hosts."""

import random

import pytest

from adtally.llm import quality

RND = random.Random(8)
COMMON = [f"common{i}" for i in range(60)]
LONG = "https://example.org/" + "a" * 80
FOOTER = "all rights reserved by the owner of this page"


def _prose(n, words=COMMON):
    return "\n".join(" ".join(RND.choice(words) for _ in range(12)) for _ in range(n))


@pytest.fixture(scope="module")
def gone(spark):
    rows = []
    # each text holds the line with the longest word of all
    rows += [(i, f"{_prose(5)}\n{LONG} read more\n{_prose(2)}", "long") for i in range(30)]
    # a hot host: its longest words come again and again, each in a line of two words
    rows += [(1000 + i, f"{_prose(5)}\nby longestname{i % 20:020d}\n{FOOTER}", "hot") for i in range(600)]
    # near copies of one page: one word changed in each
    page = _prose(12).split(" ")
    for i in range(300):
        text = list(page)
        text[RND.randrange(len(text))] = f"changed{i}"
        rows.append((5000 + i, " ".join(text) + "\n" + FOOTER, "copies"))
    # the line and nothing else, and exact copies, are one text each
    rows += [(7000 + i, FOOTER + " " * i, "alone") for i in range(40)]
    rows += [(8000 + i, f"{page}\n{FOOTER}", "exact") for i in range(40)]
    got = quality.boilerplate_words(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    return {(r["host"], r["doc_id"]): r["boilerplate_words"] for r in got.collect()}


def test_a_line_with_the_longest_word_is_boilerplate(gone):
    assert all(gone.get(("long", i)) == 3 for i in range(30))


def test_a_line_of_a_hot_host_is_boilerplate(gone):
    assert all(gone.get(("hot", 1000 + i)) == 9 + 2 for i in range(600))


def test_copies_are_no_evidence(gone):
    assert {h for h, _ in gone} == {"long", "hot"}
