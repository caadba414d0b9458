"""Main text of pages: reading of markup, votes of a host, planted pages and the given ones."""

import re
from html import unescape

import pyarrow.dataset as ds
import pytest

from verdancy.llm import html_extract as H

CASES = {
    "<p>a<p>b<i>c</i>&amp;d&nbsp;<br>e": "a\nbc&d e",
    "<div>x<script>var a='</p>'</script>y</div><!-- c > -->z": "xy\nz",
    "<a title='x>y'>k</a> some text": "k some text",
    "a < b": "a < b",
    "<p>un<b>closed": "unclosed",
    '<p attr="un>text</p>more': "text\nmore",
    "<!-- never ended <p>x</p>": "",
    "": "",
    "<title>t</title><style>p{}</style>": "",
    "<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table>": "a\nb\n1\n2\n3",
    "<article><header><h1>T</h1><span>by me</span></header><p>Hello there</p><aside>q</aside><div class='comments'><p>a comment</p></div></article>": "T\nHello there",
    "<form><h1>w</h1><p>in form</p></form>": "w\nin form",
    "<form><input><p>mail</p></form><p>body text</p>": "body text",
    "<div class='page has-sidebar'><article><p>one</p></article></div>": "one",
    "<P CLASS=ad>no</P><P>yes &lt;b&gt; &#233;&#x4e2d;</P>": "yes <b> é中",
    "<div hidden>no</div><div style='display: none'>no</div><p>seen</p>": "seen",
    "<p>ends in a tag <b": "ends in a tag",
    "<article><p>x</p></article></body></html>": "x",
    "<b><p>one</b> two</p>": "one two",
}


@pytest.mark.parametrize("html", CASES)
def test_markup(html):
    assert H.Page(html).text(None) == CASES[html]


@pytest.mark.parametrize("html", ['<a "' * 20_000 + ">", "<" * 50_000, "<!--" * 20_000, "<div>" * 8000, "<p>x" * 10_000, "<b>x" * 20_000 + "</i>" * 20_000, "<div class=ad>" * 1000 + "<h1>x" * 1000])
def test_hostile_pages_end(html):
    page = H.Page(html)
    vote = page.vote()
    assert isinstance(page.text(vote and vote[0]), str)


def around(article):
    return f"<html><body><div class='box-7'><div class=txt-{len(article)}>{article}</div><div class=x>{'words beside the article ' * 9}</div></div></body></html>"


def test_a_short_article_is_found_by_its_host(spark):
    long = "".join(f"<p>{'a paragraph of the article ' * 20}</p>" for _ in range(4))
    rows = [(i, "https://u:p@Host.example:81/a?b", around(long), "x") for i in range(5)] + [(9, "http://host.example/z", around("<p>tiny</p>"), "x"), (10, "nowhere", around("<p>tiny</p>"), "x")]
    rows += [(11, None, "<p>own page</p>", "x"), (12, "http://host.example/", None, "x"), (12, "http://other.example/", "", None), (13, "http://host.example/q", "<main><p>another form</p></main>", "x")]
    got = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    found = {(r.page_id, r.url): (r.text, r.n_chars) for r in got.collect()}
    assert len(found) == len(rows)
    assert found[9, "http://host.example/z"] == ("tiny", 4)
    assert found[10, "nowhere"][0].startswith("words beside") and found[11, None] == ("own page", 8)
    assert found[12, "http://host.example/"] == found[12, "http://other.example/"] == ("", 0)
    assert found[13, "http://host.example/q"][0] == "another form"
    paths = H.host_paths(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert {r.host: (r.path, r.pages) for r in paths}["host.example"] == ("html/body/div.box-0/div.txt-0", 5)


def test_joined_winners_are_those_broadcast(spark, monkeypatch):
    rows = [(i, f"http://h{i % 7}.example/", around(f"<p>{'text of page %d ' % i * (i % 5 * 30 + 1)}</p>")) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    wide = sorted(map(tuple, H.extract(df).collect()))
    monkeypatch.setattr(H, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, H.extract(df).collect())) == wide


def test_every_given_page(spark):
    """The articles of the given pages by a plain pattern: their only blocks are p and h1."""
    pages = {r["page_id"]: r["html"] for r in ds.dataset("/root/testdata/sf0.01/pages.parquet").to_table().to_pylist()}
    got = H.op13_html_extract(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = (" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_no_pages(spark):
    assert H.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
