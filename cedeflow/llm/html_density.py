"""Main text of web pages by composite text density."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose start and end also break a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
#: What a start tag ends, if it is open within the nearest of its scope.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
IN_HEAD = frozenset("head title meta link base style script noscript template".split())
#: Elements that never hold main text.
NEVER = frozenset(
    "head script style noscript template nav aside footer form button input select option "
    "textarea label iframe svg canvas object embed dialog menu audio video map".split()
)
#: Words in a class, id or role that mark what surrounds main text.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription share sharing "
    "social related recommended recommendations comment comments disqus replies respond "
    "masthead toolbar widget complementary contentinfo search form alert dialog".split()
)
#: Words that may stand beside a mark, as in ``site-footer``; with any other word a
#: class says something else, as ``related-work`` or ``share-price`` do.
BESIDE_MARKS = frozenset(
    "site page main global top bottom left right inner outer box wrap wrapper container block "
    "section area bar bars unit slot list lists link links item items button buttons icon icons "
    "panel column col row header title heading post posts article articles thread "
    "reader readers user users signup sign up sticky fixed mobile desktop primary secondary "
    "message policy accept google the of and in on us this".split()
)
#: Marks that inside an article may name a part of it, as a call-out or a table's key.
OUTSIDE_ONLY = frozenset(
    "alert social search form related share sharing notice notices banner widget menu "
    "respond replies toolbar overlay dialog".split()
)
COMMENT_MARKS = frozenset("comment comments disqus replies respond".split())
NEGATING = frozenset("no has with without".split())
WORDS = re.compile(r"[a-z0-9]+")
#: Floor of the logarithm that a page without links leaves at zero.
LEAST_BASE = 0.1


def _marked(tag: str, attributes: list[tuple[str, str | None]], inside_article: bool) -> bool:
    """Whether an element is part of what surrounds the main text."""
    if tag in NEVER or (tag == "header" and not inside_article):
        return True
    if tag in ("html", "body", "main"):
        return False
    marks = COMMENT_MARKS if tag == "article" else MARKS
    if inside_article:
        marks -= OUTSIDE_ONLY
    for name, value in attributes:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name in ("class", "id", "role") and value:
            for one in value.split():
                words = WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", one).lower())
                others = (w for w in words if w not in MARKS and not w.isdigit())
                if (
                    not NEGATING.intersection(words[:1])
                    and marks.intersection(words)
                    and BESIDE_MARKS.issuperset(others)
                ):
                    return True
    return False


class _Page(HTMLParser):
    """Elements of a page in order, and its text in pieces."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.around, self.inside = ["html"], [-1], [False], [False]
        self.pieces: list[tuple[int, str | None]] = []
        self.stack = [0]

    def _pop_to(self, depth: int) -> None:
        for node in self.stack[depth:]:
            if self.tags[node] in BLOCKS:
                self.pieces.append((node, None))
                break
        del self.stack[depth:]

    def _close(self, tags: set[str], scope: set[str] | frozenset[str]) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.tags[self.stack[depth]]
            if tag in tags:
                self._pop_to(depth)
                return
            if tag in scope:
                return

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        if tag == "html":
            return
        if tag not in IN_HEAD and "head" in (self.tags[n] for n in self.stack[:3]):
            self._close({"head"}, frozenset())
        if tag in CLOSED_BY:
            self._close(*CLOSED_BY[tag])
        elif tag in BLOCKS:
            self._close({"p"}, BLOCKS - {"p"})
        top = self.stack[-1]
        if tag == "br":
            self.pieces.append((top, " "))
            return
        node = len(self.tags)
        inside = self.inside[top] or tag in ("article", "main")
        self.tags.append(tag)
        self.parents.append(top)
        self.around.append(self.around[top] or _marked(tag, attributes, self.inside[top]))
        self.inside.append(inside)
        if tag in BLOCKS:
            self.pieces.append((node, None))
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attributes)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID or tag in ("html", "body"):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.tags[self.stack[depth]] == tag:
                self._pop_to(depth)
                return
            if tag not in BLOCKS and self.tags[self.stack[depth]] in BLOCKS:
                return  # an inline end tag does not end the block round it

    def handle_data(self, data: str) -> None:
        self.pieces.append((self.stack[-1], data))


def _parsed(html: str) -> _Page:
    page = _Page()
    try:
        page.feed(html)
        page.close()
    except AssertionError:  # a marked section that the parser does not know
        page = _Page()
        page.feed(html.replace("<![", "&lt;!["))
        page.close()
    return page


def _density(chars: int, tags: int, link_chars: int, link_tags: int, link_share: float) -> float:
    """Composite text density: characters a tag, raised where links are few."""
    if not chars:
        return 0.0
    base = math.log(chars * link_chars / max(chars - link_chars, 1) + link_share * chars + math.e)
    weight = math.log(max(chars * tags / (max(link_chars, 1) * max(link_tags, 1)), 1.0))
    return chars / tags * weight / max(math.log(base), LEAST_BASE)


def main_text(html: str | None) -> str:
    """The main text of one page, its blocks joined by a line feed.

    Every element gets its density from the characters, tags, link characters
    and link tags below it, those that surround the main text left out, and the
    sum of its children's densities. The largest sum is the core; the least
    density on the path from it to the body is the threshold; every element from
    the body down that reaches it adds the element of the largest sum within it.
    """
    if not html:
        return ""
    page = _parsed(html)
    n = len(page.tags)
    body = page.tags.index("body") if "body" in page.tags else 0
    chars, link_chars = [0] * n, [0] * n
    linked = [False] * n
    for node in range(1, n):
        linked[node] = page.tags[node] == "a" or linked[page.parents[node]]
    all_chars = all_link_chars = 0
    for node, data in page.pieces:
        if data is None:
            continue
        size = sum(map(len, data.split()))
        all_chars += size
        all_link_chars += size * linked[node]
        if not page.around[node]:
            chars[node] += size
            link_chars[node] += size * linked[node]
    link_share = all_link_chars / max(all_chars, 1)
    tags, link_tags, sums = [0] * n, [0] * n, [0.0] * n
    density = [0.0] * n
    best = list(range(n))
    for node in range(n - 1, -1, -1):
        if page.around[node]:
            continue
        density[node] = _density(
            chars[node], max(tags[node], 1), link_chars[node], link_tags[node], link_share
        )
        if sums[best[node]] <= sums[node]:
            best[node] = node
        up = page.parents[node]
        if up >= 0:
            chars[up] += chars[node]
            link_chars[up] += link_chars[node]
            tags[up] += tags[node] + 1
            link_tags[up] += link_tags[node] + (page.tags[node] == "a")
            sums[up] += density[node]
            if sums[best[node]] > sums[best[up]] or best[up] == up:
                best[up] = best[node]
    threshold, node = density[body], best[body]
    while node not in (body, -1):
        threshold = min(threshold, density[node])
        node = page.parents[node]
    content, reached = [False] * n, [False] * n
    for node in range(n):
        up = page.parents[node]
        reached[node] = (
            not page.around[node]
            and density[node] >= threshold
            and (node in (0, body) or reached[up])
        )
        if reached[node] and node >= body:
            content[best[node]] = True
    blocks: list[str] = []
    current: list[str] = []
    for node in range(1, n):
        content[node] |= content[page.parents[node]]
    for node, data in page.pieces:
        if data is None:
            blocks.append("".join(current))
            current = []
        elif content[node] and not page.around[node]:
            current.append(data)
    blocks.append("".join(current))
    lines = (" ".join(block.split()) for block in blocks)
    return "\n".join(line for line in lines if line)


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, from its whole html.

    Character references are decoded, white space inside a block becomes one
    space, blocks are trimmed and joined in page order by a line feed. A null or
    empty page, and one without main text, gets an empty text. Pages are read
    alone, so repeated rows get equal results; other columns are not read.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            counts = pa.array(map(len, texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), counts],
                ["page_id", "url", "text", "n_chars"],
            )

    ids = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        of, f"page_id {ids}, url string, text string, n_chars long"
    )
