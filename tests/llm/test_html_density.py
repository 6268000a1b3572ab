from __future__ import annotations

import html
import re

import pyarrow.parquet as pq
import pytest

from cedeflow.llm.html_density import main_text, main_texts
from cedeflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _article(page: str) -> str:
    """The blocks between the article's tags, by plain search."""
    inner = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    blocks = [html.unescape(re.sub(r"<[^>]+>", "", b)) for b in re.split(r"</?(?:p|h1)\b[^>]*>", inner)]
    return "\n".join(filter(None, (" ".join(b.split()) for b in blocks)))


def test_query_equals_plain_search(spark):
    pages = {r["page_id"]: r for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    got = QUERIES["op1_html_extraction"](spark, SF).collect()
    assert len(got) == len(pages)
    for row in got:
        assert row.text == _article(pages[row.page_id]["html"])
        assert row.n_chars == len(row.text)


def test_what_surrounds_the_text_is_left_out():
    page = """<html><body class="has-sidebar"><header><h1>Site</h1></header>
    <ul class="menu"><li><a href=x>Home</a></ul><div id="content"><h2>Title &amp; more</h2>
    <div class="post-body"><p>A long  paragraph that is the text, with <a href=y>a link</a>.
    <p>Another one of some length &lt;here&gt;.<ul><li>one<li>two</ul></div>
    <form><p>Your name, please, and all else that we could ask for here</p></form>
    <div class="comments"><p>So many things to say about this text that I go on and on.</p></div>
    </div><div class="cookie-notice">We use cookies</div></body></html>"""
    assert main_text(page) == (
        "Title & more\nA long paragraph that is the text, with a link.\n"
        "Another one of some length <here>.\none\ntwo"
    )


@pytest.mark.parametrize(
    "name, kept",
    [(n, True) for n in ("related-work", "search-results", "form-text", "share-price", "alert", "social", "menu")]
    + [(n, False) for n in ("ad", "ad-1", "comments", "comment-list", "cookie-notice", "sidebar", "newsletter-signup")],
)
def test_class_words_inside_an_article(name, kept):
    page = (f"<body><article><h1>Title</h1><p>The first paragraph of the text.<div class='{name}'>"
            "<p>Another one, of some length.</div><p>And the last.</article><div class='related-posts'>Read on</div>")
    parts = ["Title", "The first paragraph of the text.", *["Another one, of some length."] * kept, "And the last."]
    assert main_text(page) == "\n".join(parts)


def test_empty_table_repeats_and_clashes(frame):
    schema = "page_id long, url string, html string, text int, n_chars string"
    assert main_texts(frame(schema)).collect() == []
    rows = [(1, "u", "<p>a</p>", 3, "x")] * 2 + [(None, None, None, None, None)]
    got = sorted(tuple(r) for r in main_texts(frame(schema, *rows)).collect() if r.page_id)
    assert got == [(1, "u", "a", 1)] * 2


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain &eacute; text", "plain é text"),
        ("<script>a", ""),
        ("<p>a<![if x]>b</p>", "ab"),
        ("<div>" * 3000 + "x", "x"),
        ("<nav>menu</nav>", ""),
    ],
)
def test_odd_pages(page, text):
    assert main_text(page) == text
