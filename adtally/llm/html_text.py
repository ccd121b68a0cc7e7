"""Main text of web pages by composite text density.

Every node of a page's tree gets the density of F. Sun, D. Song, L. Liao ("DOM
based content extraction via text density", 2011): characters per tag, adjusted
by how much of the text stands in links,

    density = C / T * log_b(C / LC * T / LT),
    b = ln(C / NC * LC + LCb / Cb * C + e)

with C characters, T tags, LC and LT those in links, NC = C - LC, and Cb, LCb
those of the body (counts below one are one). A node's density sum is the sum of
its children's densities; the node with the greatest one holds the main text.
The least density on the path from the body to that node is the threshold. All
blocks of an article or main element stay. Where there is none, elements beside the
path to the chosen node stay too if they reach the threshold (an article in several
containers); in what is chosen containers and lists that are less dense and hold more link than other text go
(unmarked menus), while headings and paragraphs always stay.

Elements that are never main text by their kind (scripts, styles, forms, menus,
headers and footers of the page, sidebars) and those whose class or id says so
(adverts, notices, reader comments) are left out before densities are computed;
inside an article only a whole class name counts (``header`` in ``entry-header`` does not).

Text is cut at block elements; references are decoded, white space in a block
becomes one space, blocks are joined by a line feed. Defined results: a null or
empty page has the text ''; a page without tags is one block; a page of any length
is parsed whole, in time proportional to it; ids are cast to long; repeated rows give
repeated rows; null ids and urls stay; further columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript textarea template iframe svg title".split())
_BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
_ENDS_P = _BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt", "body", "html"}
#: An opening tag closes an open element of these kinds, up to the border.
_IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}
_NEVER = frozenset("nav aside form button select option dialog menu head noscript script style template iframe svg textarea title footer object audio video canvas".split())
_NAMED = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notice|popup|modal|newsletter|subscribe|"
                    r"comments?|replies|disqus|sidebar|side|nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|header|masthead|"
                    r"footer|related|recommend\w*|share|sharing|social|widget|toolbar|login|signup|search)(?:$|[\s_-])", re.I)
#: Of the names above, those of what may also stand inside an article, as a whole
#: word of a class or id: adverts, notices, forms, menus and reader comments.
_NAMED_INSIDE = re.compile(r"(?:^|\s)(?:ads?|ad[_-]\S+|advert\w*|sponsor(?:ed)?|cookies?|consent|notice|popup|modal|newsletter|subscribe|"
                           r"comments?|comment-list|replies|disqus|sidebar|nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|login|signup)(?:$|\s)", re.I)
_SKIPPED = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_NAME = re.compile(r"[A-Za-z]")
_NAME_END = re.compile(r"[\s/>]")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_SPACE = re.compile(r"\s+")


#: Text by their kind, also if they are one link.
_TEXT = frozenset("h1 h2 h3 h4 h5 h6 hgroup p pre blockquote figcaption dd dt".split())


class Node:
    __slots__ = ("tag", "children", "dropped", "in_article", "chars", "tags", "link_chars", "link_tags", "density")

    def __init__(self, tag: str, dropped: bool = False, in_article: bool = False):
        self.tag, self.dropped, self.in_article = tag, dropped, in_article
        self.children: list[Node | str] = []


def _unwanted(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in _NEVER or (tag == "header" and not inside_article):
        return True
    if tag in ("html", "body", "article", "main") or not attributes:
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id") and (_NAMED_INSIDE if inside_article else _NAMED).search(value):
            return True
        if name == "role" and value.lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert"):
            return True
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            return True
    return False


class _Ahead:
    """Where a pattern next matches; asked at ascending places, it goes over the
    page once in all."""

    def __init__(self, pattern: re.Pattern, page: str):
        self.pattern, self.page, self.found = pattern, page, -1

    def __call__(self, at: int) -> int:
        if self.found < at:
            m = self.pattern.search(self.page, at)
            self.found = m.start() if m else len(self.page)
        return self.found


def _tokens(page: str) -> Iterator[tuple[int, int, str | None, bool, str]]:
    """(begin, end, tag or None for what is no element, whether it closes one,
    attributes) of all markup, in time proportional to the page. A ``<`` of which the tag
    ends nowhere outside quotes is text."""
    stop_after, name_end = _Ahead(_STOP, page), _Ahead(_NAME_END, page)
    bad: set[int] = set()  # quotes after which no tag ends
    at, last = 0, page.rfind(">")
    while (begin := page.find("<", at)) >= 0:
        at = begin + 1
        skipped = _SKIPPED.match(page, begin)
        if skipped:
            at = skipped.end()
            yield begin, at, None, False, skipped.group()
            continue
        closes = page.startswith("/", at)
        if at > last or not _NAME.match(page, at + closes):
            continue
        named = name_end(at + closes)
        stop, walked = stop_after(named), []
        while stop < len(page) and stop not in bad and page[stop] != ">":
            walked.append(stop)
            quoted = page.find(page[stop], stop + 1)
            found = _STOP.search(page, quoted + 1) if quoted >= 0 else None
            stop = found.start() if found else len(page)
        if stop < len(page) and stop not in bad:
            at = stop + 1
            yield begin, at, page[begin + 1 + closes: named].lower(), closes, page[named:stop]
        else:
            bad.update(walked)


def parse(page: str) -> Node:
    """The page's tree; end tags that HTML lets one leave out are supplied."""
    root = Node("#root")
    open_nodes = [root]
    ends: dict[str, _Ahead] = {}

    def raw_end(tag: str, at: int) -> int:
        """After the end tag of an element whose content is no markup."""
        if tag not in ends:
            ends[tag] = _Ahead(re.compile(rf"</{tag}\s*>", re.I), page)
        close = ends[tag](at)
        return page.find(">", close) + 1 if close < len(page) else len(page)

    done = 0
    for begin, end, tag, closing, attributes in _tokens(page):
        if begin < done:
            continue  # in the raw text of an element
        if begin > done:
            open_nodes[-1].children.append(html.unescape(page[done:begin]))
        done = end
        if tag is None:
            if attributes.startswith("<![CDATA["):
                open_nodes[-1].children.append(attributes[9:].removesuffix("]]>"))
            continue
        if closing:
            for i in range(len(open_nodes) - 1, 0, -1):
                if open_nodes[i].tag == tag:
                    del open_nodes[i:]
                    break
                if open_nodes[i].tag in ("article", "body") and tag not in _BLOCK:
                    break  # a stray end tag does not close a container
            continue
        closes, border = _IMPLIED.get(tag, ({"p"} if tag in _ENDS_P else (), _BLOCK - {"p"}))
        if closes:
            for i in range(len(open_nodes) - 1, 0, -1):
                if open_nodes[i].tag in border:
                    break
                if open_nodes[i].tag in closes:
                    del open_nodes[i:]
                    break
        inside = open_nodes[-1].in_article
        node = Node(tag, _unwanted(tag, attributes, inside), inside or tag == "article")
        open_nodes[-1].children.append(node)
        if tag in _RAW:
            done = raw_end(tag, end)
        elif tag not in _VOID and not attributes.rstrip().endswith("/"):
            open_nodes.append(node)
    if done < len(page):
        open_nodes[-1].children.append(html.unescape(page[done:]))
    return root


def _in_order(root: Node) -> list[Node]:
    """Kept nodes, parents before children (no recursion: pages can be deep)."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped)
    return out


def measure(root: Node) -> None:
    """Counts of every kept node and its density."""
    nodes = _in_order(root)
    in_link = {id(root): False}
    for node in nodes:
        for child in node.children:
            if isinstance(child, Node):
                in_link[id(child)] = in_link[id(node)] or child.tag == "a"
    for node in reversed(nodes):
        link = in_link[id(node)]
        node.chars = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        node.link_chars = node.chars if link else 0
        node.tags = node.link_tags = 0
        for child in node.children:
            if isinstance(child, Node) and not child.dropped:
                node.chars += child.chars
                node.link_chars += child.link_chars
                node.tags += child.tags + 1
                node.link_tags += child.link_tags + (child.tag == "a")
    body = next((n for n in nodes if n.tag == "body"), root)
    share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        if not c:
            node.density = 0.0
            continue
        base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + share * c + math.e)
        node.density = c / t * math.log(max(c / lc * t / lt, 1.0)) / math.log(max(base, 1 + 1e-9)) if base > 1 + 1e-9 else c / t * math.log(max(c / lc * t / lt, 1.0))


def main_node(root: Node) -> tuple[Node, float, list[Node]]:
    """The subtree of the greatest density sum, the threshold of its path, and the
    nodes that hold main text: that subtree, or, where no article or main element
    holds it, also the elements beside its path that reach the threshold."""
    nodes = _in_order(root)
    parent = {id(c): n for n in nodes for c in n.children if isinstance(c, Node) and not c.dropped}
    body = next((n for n in nodes if n.tag == "body"), root)
    best, most = body, -1.0
    for node in nodes:
        total = sum(c.density for c in node.children if isinstance(c, Node) and not c.dropped)
        if total > most and node.tag not in ("#root", "html"):
            best, most = node, total
    if most <= 0:
        best = body  # no child has text: the text stands in the body itself
    # text next to the children of the densest node belongs to the same article
    node = best
    threshold = node.density
    while id(node) in parent and node is not body:
        node = parent[id(node)]
        threshold = min(threshold, node.density)
        if node.tag in ("article", "main"):
            best = node
    if best.in_article or best.tag == "main":
        return best, threshold, [best]
    path, node = {id(best)}, best
    while node is not body and id(node) in parent:
        node = parent[id(node)]
        path.add(id(node))
    chosen, stack = [], [body]
    while stack:
        node = stack.pop()
        if node is best:
            chosen.append(node)
        elif id(node) in path:
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped)
        elif node.density >= threshold and 2 * node.link_chars <= node.chars and node.chars:
            chosen.append(node)
    return best, threshold, chosen


def blocks(chosen: list[Node], threshold: float) -> list[str]:
    """Texts of the block elements under the chosen nodes in page order;
    ``threshold`` holds outside of articles only."""
    out: list[str] = []
    current: list[str] = []

    def close() -> None:
        text = _SPACE.sub(" ", "".join(current)).strip()
        current.clear()
        if text:
            out.append(text)

    tops = {id(n) for n in chosen}
    stack: list[tuple[Node | str | None, bool]] = [(n, False) for n in reversed(chosen)]
    while stack:
        item, whole = stack.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            current.append(item)
        elif not item.dropped:
            whole = whole or item.in_article or item.tag == "main" or item.tag in _TEXT
            if not whole and id(item) not in tops and item.tag in _BLOCK and item.density < threshold and 2 * item.link_chars > item.chars:
                continue  # a link list outside of an article
            if item.tag == "br":
                current.append(" ")
                continue
            block = item.tag in _BLOCK
            if block:
                close()
                stack.append((None, whole))
            stack.extend((c, whole) for c in reversed(item.children))
    close()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    measure(root)
    _, threshold, chosen = main_node(root)
    return "\n".join(blocks(chosen, threshold))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            texts = [main_text(x) for x in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
