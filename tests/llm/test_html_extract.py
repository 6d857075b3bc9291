import html
import re

import pytest

from innspark.llm import html_extract as hx
from innspark.llm.common import table

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var a="</p><p>no";</script></head>
<body class=home><header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav>
<div id="cookie-notice">We use cookies, <a href="#">ok</a></div><!-- a <p>comment</p> -->
<div class="post-17 content"><h1>The  title</h1><p>First &lt;b&gt; <b>bold</b>
 text&nbsp;here<p>Second<br>line <a href=x>link</a>.<ul><li>one<li>two</ul>
<div class="ad">Buy now, it is long and would score</div><form><p>Your mail <input name=q></p></form>
<blockquote>Quote &copy; 2024</blockquote><script>x()</script></div>
<div class="comments"><p>A reader says a lot about this, more than the article does, on and on.</p></div>
<aside><p>Related</p></aside><footer><p>Footer text</p></footer></body></html>"""
TEXT = "The title\nFirst <b> bold text here\nSecond line link.\none\ntwo\nQuote © 2024"


def test_page():
    assert hx.extract(PAGE) == TEXT
    assert hx.best_path(PAGE)[0] == "html>body.home>div.content.post-"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("just text", "just text"), ("<p>a<p>b", "a\nb"), ("<p>a < b & c</p>", "a < b & c"),
    ("<article><p>some words</article>tail", "some words"), ("<div><p>open <b>bold<p>next</div>", "open bold\nnext"),
    ("<nav>only a menu</nav>", ""), ("<p title='a>b'>q</p>", "q"), ('<p><a href="x>y</a> z</p>', "y z"),
    ("<script>never closed <p>x", ""), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<article><header><h1>Head</h1></header><p>Body</p></article>", "Head\nBody"), ("<p></p>" * 50, ""),
    ("<div>" * 3000 + "deep", "deep")])
def test_fragments(page, text):
    assert hx.extract(page) == text


BODY = "<p>" + "words of the article " * 9 + "</p>"
SAID = ("words of the article " * 9).strip()


@pytest.mark.parametrize("page, text", [
    (f'<body><div class="content no-sidebar">{BODY}</div><p>end</p>', SAID),
    (f'<div id="page-has-banner"><h1>Head</h1>{BODY}</div>', "Head\n" + SAID),
    (f'<div class="post with-comments">{BODY}<div class="comments"><p>I say</p></div></div>', SAID),
    (f'<form id=aspnetForm><nav>menu</nav>{BODY}<form><p>Your mail</p></form></form>', SAID),
    (f'<article><header class="entry-header"><h1>Head</h1></header>{BODY}</article>', "Head\n" + SAID),
    (f'<div class="widget"><article>{BODY}</article></div><p>more</p>', SAID),
    (f'<article>{BODY}</article><div class="comment-list"><p>{"I say " * 99}</p></div>', SAID),
    (f'<div class="post">{BODY}</div><div class="comments"><p>{"I say " * 60}</p></div>', SAID),
    (f'<div class="notice">{BODY}</div>', SAID),
    (f'<article><div class="banner-text">{BODY}</div><div class="share">x</div></article>', SAID)])
def test_names_drop_no_article(page, text):
    assert hx.extract(page) == text


@pytest.mark.parametrize("page", [
    f'<article><h1>Head</h1><p>Lead</p><div class="entry-content">{BODY}</div></article>',
    f'<main><h1>Head</h1><article><p>Lead</p>{BODY}</article></main>',
    f'<div class="post"><h1>Head</h1><p>Lead</p><div class="entry-content">{BODY}</div></div>',
    f'<article><section class="a"><h1>Head</h1><p>Lead</p></section><section class="b">{BODY}</section></article>',
    f'<article><div class="x"><h1>Head</h1></div><div class="y"><p>Lead</p><div class="z">{BODY}</div></div></article>'])
def test_nested_and_sectioned_articles(page):
    page = f'<body><p>Site</p><div class="box"><p>box</p></div>{page}<div class="zz"><p>after</p></div></body>'
    assert hx.extract(page) == hx.extract(page, hx.best_path(page)[0]) == "Head\nLead\n" + SAID


@pytest.mark.parametrize("page, text", [
    (f'<div class="post">{BODY}</div><div class="replies"><p>{"I say " * 60}</p></div>', SAID),
    (f'<article>{BODY}<section id="responses"><p>I say</p></section></article>', SAID),
    (f'<article>{BODY}<p hidden>not seen</p><div style="display: none"><p>nor this</p></div></article>', SAID),
    (f'<article>{BODY}<svg><title>t</title><text>shape</text></svg><video>no video</video></article>', SAID),
    (f'<article>{BODY}<span style="display:none">x</span><p hiddenish=1>seen</p></article>', SAID + "\nseen")])
def test_what_a_reader_does_not_see(page, text):
    assert hx.extract(page) == text


SIZE = 1_000_000  # 5 MB were tried too: 10 to 25 s for both passes
SHAPES = {
    "nested": lambda n: "<div>x" * (n // 6), "nested classes": lambda n: '<div class="a b c">x' * (n // 20),
    "nested asides": lambda n: '<div class="ad">x' * (n // 17), "blockquotes": lambda n: "<blockquote>x" * (n // 13),
    "unclosed quotes": lambda n: '<a "' * (n // 4), "declarations": lambda n: "<!" * (n // 2),
    "open tags": lambda n: "<p " * (n // 3), "wrong ends": lambda n: "<div>" * (n // 10) + "</li></p>" * (n // 18),
    "siblings": lambda n: "<div>" * 2000 + '<div class="s"><p>x</p></div>' * (n // 29),
    "paragraphs in depth": lambda n: "<section>" * (n // 20) + "<p>y" * (n // 8), "entities": lambda n: "&amp;" * (n // 5),
    "comments": lambda n: "<!-- x -->y" * (n // 11), "attributes": lambda n: "<p " + 'a="b" ' * (n // 6) + ">z",
    "mixed quotes": lambda n: "<b title='\"'>" * (n // 13) + "<i '", "plain": lambda n: "word " * (n // 5)}


@pytest.mark.parametrize("shape", SHAPES)
def test_long_pages_of_any_shape_take_seconds(shape):
    import time
    import tracemalloc

    page = SHAPES[shape](SIZE)
    t0 = time.process_time()
    path = hx.best_path(page)
    hx.extract(page, path[0] if path else None)
    assert time.process_time() - t0 < 20
    small = SHAPES[shape](SIZE // 20)
    tracemalloc.start()
    hx.extract(small)
    assert tracemalloc.get_traced_memory()[1] < 200 * len(small) + 10_000_000
    tracemalloc.stop()


def test_host_consensus(spark):
    good = '<html><body><div class="a{}"><p>{}</p></div><div class="zz"><p>{}</p></div></body></html>'
    rows = [(k, f"http://Host.example/{k}", good.format(k, "main text " * 9, "box " * 3)) for k in range(5)]
    # alone, this page would choose its box
    rows += [(5, "https://u:p@host.example:80/x?y", good.format(5, "short", "box " * 30)),
             (6, None, good.format(6, "short", "box " * 30)), (7, "no url", None), (None, "", "<p>t</p>"),
             (8, "http://host.example/odd", "<article><p>another template</p></article>")]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows],
                                  "page_id long, url string, html string, host string, path string")
    got = {r.page_id: (r.text, r.n_chars) for r in hx.op10_html(pages).collect()}
    assert got[0][0] == ("main text " * 9).strip() and got[5] == ("short", 5)
    assert got[6][0] == ("box " * 30).strip() and got[7] == ("", 0) and got[None] == ("t", 1)
    assert got[8][0] == "another template"
    assert hx.op10_html(pages.limit(0)).count() == 0


def test_sample(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    got = {r.page_id: r for r in hx.op10_html(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<br>", " ", b)).split()) for b in
                  re.split(r"</?(?:p|h\d|li|ul)>", re.sub(r"</?(?:b|i|a)\b[^>]*>", "", inner)))
        text = "\n".join(b for b in blocks if b)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (text, len(text), r.url)
