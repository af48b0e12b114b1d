"""Markup as browsers read it: quotes in tags, closing slashes, repeated attributes, class words in articles, huge pages."""

import time

import pytest

from quartermaster.llm import html_extract
from quartermaster.llm.common import prepare


@pytest.mark.parametrize("page, text", [
    ("<p title=don't>a</p><p>it's here</p><p>third</p>", "a\nit's here\nthird"), ('<p data-x=5">text</p>', "text"),
    ('<article><h2 class="header">Title</h2><p class="legal">A legal note</p><div class="share">x</div></article>', "Title\nA legal note"),
    ("<a href=/x/>link</a> rest", "link rest"), ('<p class="a" class="ad">kept</p>', "kept"), ('x &lt; y <i title="a>b">q</i>', "x < y q"),
    ('<p>one</p><div title="never closed', "one"), ("<p class = 'ad' >gone</p><p>stays</p>", "stays"), ("<p>a < b and <3</p>", "a < b and <3"),
    ("<p>a<br/>b</p></em></p>c", "a b\nc")])
def test_tags_by_the_standards_states(page, text):
    assert html_extract.extract(page, []) == text


def test_huge_pages_take_seconds(spark):
    began = time.time()
    cells = "<table>" + "".join(f"<tr><td>cell number {i} here</td></tr>" for i in range(50_000)) + "</table>"
    pages = [(1, "http://a.b/1", cells), (2, "http://a.b/2", "<div>" * 50_000 + "deep text"),
             (3, "http://a.b/3", "<span>" * 50_000 + "<p>t" * 50_000 + "</em>" * 50_000), (4, "http://a.b/4", "<a <a " * 50_000)]
    prepare(spark)
    got = {r["page_id"]: r["text"] for r in html_extract.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[1].count("\n") == 49_999 and got[2] == "deep text" and got[3].count("t") == 50_000 and got[4] == ""
    assert time.time() - began < 60


def test_every_scored_path_votes(spark):
    prepare(spark)
    page = "<div class=a>" + "<p>x y z</p>" * 3 + "</div>" + "".join(f"<div class=c{c}><p>words in here {c}</p></div>" for c in "bcdefg")
    own = html_extract.with_keys(spark.createDataFrame([(1, "http://h/x", page)], "page_id long, url string, html string"), "page_id", "url", "html")
    voted = html_extract.voted_paths(own).first()["voted"]
    assert len(voted) == len(html_extract.path_scores(html_extract.measure(html_extract.parse(page)))) == 7
