"""Main text of pages: planted articles and awkward markup."""
import html
import re

from rostrum.llm.html_text import extract_pages, main_text
from rostrum.llm.queries import QUERIES

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><a href=1>One</a><a href=2>Two</a></nav><div id="cookie-notice"><p>We use <b>cookies</b> and you must agree to them all.</p></div>
<div class="sidebar"><p>Popular things that many people read today and tomorrow.</p></div>
%s
<section class="comments"><h3>Comments</h3><p>Nice post! I liked it a lot and here are many words in a comment.</p></section>
<form><p>Your name</p><input name=x></form><footer>&copy; us</footer></body></html>"""
BODY = """<h1>Head &amp; line</h1><p>First long  paragraph of text,
that goes on &#x2014; and on.</p><div class="ad"><p>Buy now!</p></div><!-- no --><p>Second <a href="/a>b">linked</a> para<b>graph</b>.<br>After.
<p>Unclosed <i>one<p>Short.</p><script>var t="</p>";</script><ul><li>Item one<li>Item two</ul>"""
TEXT = ("Head & line\nFirst long paragraph of text, that goes on — and on.\nSecond linked paragraph. After.\nUnclosed one\nShort.\n"
        "Item one\nItem two")


def test_article_marked_or_not():
    for around in ("<article>%s</article>", "<main>%s</main>", '<div class="content">%s</div>'):
        assert main_text(PAGE % (around % BODY)) == TEXT


def test_awkward_pages():
    assert main_text(None) == main_text("") == main_text("<p> </p>") == main_text("<script>x") == ""
    assert main_text("just text") == "just text" and main_text("<p>a < b &amp c</p>") == "a < b & c"
    assert main_text("<article><p>one<article><p>two</article></article></p></div>") == "one\ntwo"
    assert len(main_text("<article>" + "<p>word word</p>" * 5000)) == 5000 * 10 - 1


def test_parts_of_unmarked_pages():
    gap = '<div class="ad"><p>Buy</p><p>this</p><p>now</p></div>'
    title, long, end = "A title of nine", "Words of the first part. " * 20, "The closing section says something. " * 5
    page = (f'<div><p>Home</p>{gap}<h1>{title}</h1><div class="share"><p>a</p><p>b</p><p>c</p></div>' + f"<p>{long}</p>" * 20 + gap
            + f"<p>{end}</p><ul>" + "<li><a href=1>See the other page</a></li>" * 3 + f"</ul><p>{end}</p>{gap}<p>Fin.</p>{gap}<p>{end}</p></div>")
    assert main_text(page) == "\n".join([title, *[long.strip()] * 20, *[end.strip()] * 2, "Fin.", end.strip()])


def test_marks_that_hold_little():
    body = "<p>Text of the page that nobody marked, in a line.</p>" * 30
    want = "\n".join(["Text of the page that nobody marked, in a line."] * 30)
    assert main_text(f"<main></main><div>{body}</div>") == want
    assert main_text(f"<article><p>A teaser of a few words</p></article><div>{body}</div>") == f"A teaser of a few words\n{want}"
    assert main_text(f"<article>{body}</article><p>{'Beside the article. ' * 20}</p>") == want


def test_rows(spark):
    rows = [(1, "u", PAGE % f"<article>{BODY}</article>"), (2, None, None), (None, "v", ""), (1, "u", PAGE % f"<article>{BODY}</article>")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text")
    out = extract_pages(table).collect()
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in out] == [
        (1, "u", TEXT, len(TEXT)), (2, None, "", 0), (None, "v", "", 0), (1, "u", TEXT, len(TEXT))]
    assert extract_pages(table.filter("page_id < 0")).count() == 0


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in QUERIES["op2_html_extraction"](spark, sf).collect():
        page = pages[r.page_id]
        article = page[page.index("<article>") + 9:page.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
