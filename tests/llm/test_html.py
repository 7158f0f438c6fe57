"""Main text of pages beside what the pages were made of."""

from __future__ import annotations

import html as entities
import re

import pytest

from ratingloom.llm import html
from ratingloom.llm.queries import LLM_REGISTRY

SF_DIR = "/root/testdata/sf0.001"
LONG = "A long sentence, with commas, that says something; then more. " * 4

PAGES = {
    "<article><h1>T&amp;C</h1><p>a  b\n<b>c</b>d<br>e<p>f</article><footer>x</footer>": "T&C a b cd e f",
    f"<nav><a href=x>Home</a></nav><div id=content><p>{LONG}</p><p>Short.</p></div><div class='side-bar sidebar'>No</div>": f"{LONG.strip()} Short.",
    "<article><p>x</p><div class='ad'>buy</div><aside>s</aside><section class=comments><p>reader</p></section><p>y": "x y",
    "<main><form><p>f</p></form><script>var t='</p>';</script><style>p{}</style><p>&eacute;&#x4e2d;&nbsp;z</p></main>": "é中 z",
    "<body><header>H</header><article><header><h1>Kept</h1></header><p>t</p></article><div class=cookie-notice>c</div>": "Kept t",
    "<ul><li>one<li>two</ul>": "one two",
    "plain": "plain",
    "<article><p>a</p><ul><li><a href=1>all</a></li><li><a href=2>links</a></li></ul></article>": "a",
    "<article><p>a<!-- c --><b>b</article><p hidden>h</p>": "ab",
    "": "",
    "<nav>only</nav>": "",
}


@pytest.mark.parametrize("page", list(PAGES))
def test_page(page):
    assert html.main_text(page)[0] == PAGES[page]


def test_ratios_choose_between_paths():
    page = f"<body><div><span>Menu</span></div><table><tr><td>a</td><td>b</td></tr></table><div class=x><p>{LONG}</p><p>{LONG}</p></div>"
    kept = html.main_text(page)[1]
    assert {b.path.split("/")[-1] for b in kept} == {"p"}


MARKED = {
    f"<div class=body><p>{LONG}</p><p>{LONG}</p></div><article><h3>More</h3><p>Teaser</p></article>": f"{LONG}{LONG}".strip(),
    f"<main><h1>Title</h1><p>{LONG}</p><ul><li>short</ul><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><div class=note>We moved</div></main>": f"Title {LONG}short {LONG * 3}".strip(),
    f"<main><div class=text><h2>Title</h2><p>{LONG}</p><p>{LONG}</p></div><div class=more><p>Teaser</p></div></main>": f"Title {LONG}{LONG}".strip(),
    f"<article><p>{LONG}</p></article><div>Outside, but said.</div>": LONG.strip(),
}


@pytest.mark.parametrize("page", list(MARKED))
def test_the_article_mark_is_one_signal_of_several(page):
    assert html.main_text(page)[0] == MARKED[page]


NAMED = {
    f"<div class='layout has-sidebar'><article><p>{LONG}</p></article></div>": LONG.strip(),
    f"<div class=banner><article><p>{LONG}</p></article></div><div class=ad>Buy</div>": LONG.strip(),
    f"<div class=widget><p>{LONG}</p></div>": LONG.strip(),
    f"<article><div class=post-header><h1>Title</h1></div><p>{LONG}</p><div id=related-work><p>{LONG}</p></div></article>": f"Title {LONG}{LONG}".strip(),
    f"<article><p>Text.</p><div class=post-comments><p>{LONG}</p></div></article><div id=comments><article><p>{LONG}</p></article></div>": "Text.",
    f"<div><p>Text.</p></div><div class='comments-area comments'><p>{LONG}</p></div>": "Text.",
    f"<html><head><title>T</title><meta charset=utf-8><body><p>{LONG}</p></body></html>": LONG.strip(),
    f"<head><title>T</title><script>var p='<p>';</script><p>{LONG}</p>": LONG.strip(),
}


@pytest.mark.parametrize("page", list(NAMED))
def test_names_that_only_resemble_boilerplate(page):
    assert html.main_text(page)[0] == NAMED[page]


def test_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    got = LLM_REGISTRY["op6_main_text"](spark, SF_DIR).collect()
    assert len(got) == len(pages)
    for row in got:
        inside = re.search(r"<article>(.*?)</article>", pages[row.page_id].html, re.S)[1]
        assert row.text == " ".join(entities.unescape(re.sub(r"<[^>]+>", " ", inside)).split())
        assert row.n_chars == len(row.text) and row.url == pages[row.page_id].url


def test_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (3, "u", "<p>y"), (3, "u", "<p>y"), (4, "u", "<div>" * 3000 + "deep"), (5, "u", "<p>" + "w " * 300_000)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "page_id long, url string, html string, text int")
    got = sorted((r.page_id or 0, r.n_chars) for r in html.extract(df).collect())
    assert got == [(0, 1), (1, 0), (2, 0), (3, 1), (3, 1), (4, 4), (5, 599_999)]
    assert html.extract(df.limit(0)).count() == 0
