import html
import re
import time

import pytest
from pyspark.sql import functions as F

from riskweave.llm import html_text as h
from riskweave.llm.queries import op8_html_text

CASES = [
    ("", ""),
    ("   ", ""),
    ("plain text, no tags at all.", "plain text, no tags at all."),
    ("<p>a &lt; b < c &amp;lt; d &eacute;&#x41;&#66;</p>", "a < b < c &lt; d éAB"),
    ("<article><h1>T</h1><p>x <b>y</b>z<br>q<p>open, end", "T\nx yz q\nopen, end"),
    ("<article><p>x<!-- <p>no --><script>'<p>bad</p>'</script> y</p><p>  </p><p>z</p></article>", "x y\nz"),
    ('<nav><a href="/a">One, two.</a></nav><article><p>Body, text.</p><aside><p>Side, bar.</p></aside>'
     '<div class="share-bar">Share, it.</div><form><p>Name, it.</p></form></article><footer>Foot, er.</footer>', "Body, text."),
    ('<div class="content"><h2>Head</h2><p>One two, three. Four.</p><p>Five six; seven.</p></div>'
     '<div id="sidebar"><p>Side, text. More, of it.</p></div>', "Head\nOne two, three. Four.\nFive six; seven."),
    ('<body><main><p>Body text, yes. And on.</p><ul><li>one<li>two</ul><section id="comments"><p>Nice, one. Bye.</p></section></main>',
     "Body text, yes. And on.\none\ntwo"),
    ('<article><p title="a > b">Text, here.</p><p style="display: none">Hidden, part.</p><p hidden>Too, hidden.</p></article>', "Text, here."),
    ("<ARTICLE><P>Upper, case.</P><TABLE><TR><TD>c1<TD>c2</TABLE></ARTICLE>", "Upper, case.\nc1\nc2"),
    ("<article><p>cut &amp", "cut &"),
    ("<p>a</p><!-- never closed <p>b</p>", "a"),
    ("<header><h1>Site, name.</h1></header><article><header><h1>Big title</h1><p>By A. Writer</p></header><p>Body, text.</p>"
     "<footer>Foot, er.</footer></article>", "Big title\nBy A. Writer\nBody, text."),
    ('<article><div class="social-contract"><p>On it, at length.</p></div><p id="form">Form, and matter.</p>'
     '<div class="social-links">Share, it.</div><p class="ad">Buy, now.</p></article>', "On it, at length.\nForm, and matter."),
    ('<article><p title="never closed>Text, here.</p><p>More, of it.</p></article>', "Text, here.\nMore, of it."),
    ("<article><p>x < y, <b and so on", "x < y, <b and so on"),
    ("<article><p>x <b unclosed <!-- no --> after", "x after"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_cases(page, text):
    assert h.extract(page) == text


def test_a_page_without_an_article_element():
    body = "".join(f"<p>Sentence number {i}, with some length to it. And another one, too.</p>" for i in range(8))
    menu = "".join(f'<div class="x{i}"><a href="#">Link {i}</a></div>' for i in range(9))
    page = f"<html><body><div class=top>{menu}</div><div class=story>{body}</div><div class=cookie-banner><p>We set cookies, ok.</p></div></body></html>"
    assert h.extract(page).split("\n") == [f"Sentence number {i}, with some length to it. And another one, too." for i in range(8)]


def test_whole_table_against_a_plain_reading(spark):
    path = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{path}/pages.parquet").collect()}
    rows = op8_html_text(spark, path).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)(?:</article>|<footer|$)", pages[r.page_id], re.DOTALL)[1]
        inner = re.sub(r"<br>", " ", re.sub(r"</?(p|h1)[^>]*>", "\x00", inner))
        inner = re.sub(r"<[a-zA-Z/][^>]*>", "", inner)
        parts = [" ".join(html.unescape(b).split()) for b in inner.split("\x00")]
        assert r.text == "\n".join(b for b in parts if b)
        assert r.n_chars == len(r.text)


def test_odd_rows(spark):
    long = "<article>" + "<p>Some words, and more.</p>" * 20_000
    rows = [(1, "u", None), (2, None, ""), (3, "u", long), (3, "u", long), (None, "u", "<article>a, b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("extra", F.lit(1))
    got = h.main_texts(pages).collect()
    assert [len(r.text) for r in got] == [0, 0, 22 * 20_000 - 1, 22 * 20_000 - 1, 4]
    assert h.main_texts(pages.limit(0)).collect() == []
    clash = h.main_texts(pages.withColumn("text", F.lit("old")).withColumn("c0", F.lit(1)).withColumn("n0", F.lit(2)))
    assert clash.columns == ["page_id", "url", "html", "extra", "c0", "n0", "text"]
    assert [r.text for r in clash.collect()] == [r.text for r in got]


STORY = "".join(f"<p>Sentence number {i}, with some length to it. And another one, too.</p>" for i in range(6))
TEXT = "\n".join(f"Sentence number {i}, with some length to it. And another one, too." for i in range(6))
SIDE = '<div class="sidebar"><p>Side, text.</p></div><section id="comments"><article><p>Nice, one. Bye.</p></article></section>'


@pytest.mark.parametrize(
    "page",
    [
        f'<body><main class="content has-sidebar">{STORY}{SIDE}</main></body>',
        f'<body><div class="site no-sidebar"><article>{STORY}</article>{SIDE}</div></body>',
        f'<body><div id="page-with-comments"><div class="story">{STORY}</div>{SIDE}</div></body>',
        f'<body><form action="/"><nav><a href="/">One, two.</a></nav><div class="story">{STORY}</div>{SIDE}</form></body>',
        f'<body class="x"><form><main>{STORY}</main>{SIDE}</form></body>',
    ],
)
def test_wrappers_whose_name_speaks_of_other_parts(page):
    assert h.extract(page) == TEXT


@pytest.mark.parametrize(
    "page",
    [
        '<a "' * 250_000,
        "<article>" + '<a "' * 250_000 + ">",
        "<p x='\">" * 130_000,
        "<div>" * 100_000 + "deep, text. And more.",
        "".join(f"<div>w{i}, x." for i in range(100_000)),
        "<x>" * 100_000 + "<p>deep, text." + "</x>" * 100_000,
        "<!--" * 200_000,
        "</div>" * 150_000,
    ],
)
def test_long_pages_take_time_by_their_length(page):
    start = time.process_time()
    h.extract(page)
    assert time.process_time() - start < 10
