"""Operator 7 against an independent parse of the given pages, and its time."""

from __future__ import annotations

import time
from html.parser import HTMLParser

import pytest

from aurum.llm import html

BLOCKS = {"p", "h1", "h2", "h3", "ul", "ol", "li", "div", "table", "blockquote", "article"}


class Article(HTMLParser):
    """The blocks within ``<article>``, in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.blocks, self.run = 0, [], []

    def end(self):
        text = " ".join("".join(self.run).split())
        if text:
            self.blocks.append(text)
        self.run = []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag in BLOCKS:
            self.end()
        elif tag == "br" and self.depth:
            self.run.append(" ")

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.end()
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth:
            self.run.append(data)


def plain(page: str) -> str:
    p = Article()
    p.feed(page)
    p.close()
    return "\n".join(p.blocks)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_given_pages_equal_an_independent_parse(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    wanted = {r["page_id"]: plain(r["html"]) for r in pages.collect()}
    found = {r["page_id"]: r["text"] for r in html.extract(pages).collect()}
    assert len(wanted) > 0
    assert [k for k in wanted if found[k] != wanted[k]] == []




LONG = "A long advert text, with commas, and more words than the article has, " * 20


@pytest.mark.parametrize("name", ["ad", "advert", "sponsored", "promo-box"])
def test_adverts_longer_than_the_article_go(name):
    page = f"<body><div class='{name}'><p>{LONG}</p></div><article><p>Short article.</p><div class='{name}'><p>{LONG}</p></div></article></body>"
    assert html.main_text(page) == "Short article."
    assert html.main_text(f"<body><div class='{name}'>{LONG}</div><main><p>Short, main.</p></main></body>") == "Short, main."


def test_lists_notes_and_footers_of_an_article_stay():
    links = "".join(f"<li><a href='{i}'>Reference {i}</a></li>" for i in range(3))
    page = ("<body><nav><ul>" + links + "</ul></nav><div class='alert'>Cookies</div><article><header><h1>Title</h1></header><p>Text, of it.</p><ul>" + links
            + "</ul><div class='alert'>Mind this.</div><footer>By the author</footer><form>Sign up</form></article><footer>(c)</footer></body>")
    assert html.main_text(page).split("\n") == ["Title", "Text, of it.", "Reference 0", "Reference 1", "Reference 2", "Mind this.", "By the author"]


def test_lists_of_links_outside_an_article_go():
    links = "".join(f"<li><a href='{i}'>Menu {i}</a></li>" for i in range(4))
    page = f"<body><div><ul>{links}</ul><p>{LONG}</p><p>{LONG}</p></div></body>"
    assert html.main_text(page) == "\n".join([LONG.strip()] * 2)


@pytest.mark.parametrize("unit", ["<div><a href=x>l</a>", "<div><p>text, of</p>", "<b>", "<b></i>", "<div><b></u>", "<ul><li>x", "<span></p>"])
def test_time_is_in_proportion_to_the_page(unit):
    def seconds(n: int) -> float:
        page = "<article><p>Short.</p></article>" + unit * n
        start = time.perf_counter()
        html.main_text(page)
        return time.perf_counter() - start

    seconds(500)
    small, large = seconds(4_000), seconds(32_000)
    assert large < 1 + 30 * small and large < 5


def test_nested_boxes_of_links_in_a_second():
    page = "<article><p>Short.</p></article>" + "<div><a href=x>l</a>" * 8_000
    start = time.perf_counter()
    assert html.main_text(page) == "Short."
    assert time.perf_counter() - start < 1
