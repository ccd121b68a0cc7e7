"""op7_html_text: blocks of an article that are links."""

import pytest

from adtally.llm import html_text

LONG = "A paragraph of the article that is long enough to be the densest text of this page by far."


@pytest.mark.parametrize("tag", ["article", "main"])
def test_linked_blocks_of_an_article_stay(tag):
    page = (f"<html><body><nav><ul><li><a href=/>Home</a></ul></nav><{tag}><h2><a href=x>Linked heading</a></h2><p>{LONG}</p>"
            f"<p><a href=y>A paragraph that is one link</a></p><p>{LONG}</p><ul><li><a href=1>Reference one</a></li><li><a href=2>Reference two</a></li></ul></{tag}></body></html>")
    assert html_text.main_text(page).split("\n") == ["Linked heading", LONG, "A paragraph that is one link", LONG, "Reference one", "Reference two"]


def test_linked_heading_and_paragraph_without_an_article_stay():
    page = f"<body><div><h2><a href=x>Linked heading</a></h2><p>{LONG}</p><p><a href=y>A link</a></p><p>{LONG}</p></div></body>"
    assert html_text.main_text(page).split("\n") == ["Linked heading", LONG, "A link", LONG]
