import html
import os
import re

import pytest

from plantmetrics.llm.html_density import extract, main_text

PARAGRAPH = "This is a paragraph with enough words to count as running text of the page, and it goes on."
SHELL = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";if(a<b){}</script></head><body class="has-sidebar">
<header><h2>Site</h2><a href=/>Home</a></header><nav><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></nav>
<div class="cookie-notice">We use cookies to show you more of what we think you like.</div><!-- <p>gone</p> -->
%s<div class="ad">Buy this now while it is still cheap and available to all.</div>
<aside><p>Side text that nobody needs to read in a corpus at all.</p></aside><form><label>Your mail</label><input></form>
<section id=comments><p>A reader says that this is a comment and not a part of the article.</p></section>
<div role="alert">An important notice</div><footer>&copy; Someone &middot; Imprint</footer></body></html>"""


@pytest.mark.parametrize("body", [
    f"<article><h1>A &amp; B</h1><p><b>{PARAGRAPH}<br>{PARAGRAPH}<p>Last&nbsp;&lt;one&gt;</p></article>",
    f"<main><h1>A &amp; B</h1><div><p>{PARAGRAPH}\n {PARAGRAPH}</p></div><div><p>Last &lt;one&gt;</div></main>",
    f"<div class=content><h1>A &amp; B</h1><p>{PARAGRAPH} <a href=x>{PARAGRAPH}</a></p><div class='share'>Tell all</div><p>Last &lt;one&gt;</div>",
])
def test_article_only(body):
    assert main_text(SHELL % body) == f"A & B\n{PARAGRAPH} {PARAGRAPH}\nLast <one>"


def test_threshold_decides_beside_articles():
    story = "".join(f"<p>{i} {PARAGRAPH}</p>" for i in range(4))
    lines = "\n".join(f"{i} {PARAGRAPH}" for i in range(4))
    assert main_text(f"<body><div>{story}<article class=teaser><p>Teaser.</p></article></div></body>") == f"{lines}\nTeaser."
    assert main_text(f"<body><div><article>{story}</article><article>{story}</article></div></body>") == f"{lines}\n{lines}"
    assert main_text(f"<body><article><h1>T</h1><div>{story}</div></article><div><p><a href=x>Other page</a></p></div></body>") == f"T\n{lines}"


@pytest.mark.parametrize("wrapper", [
    "class='layout with-sidebar'", "class='content-sidebar-wrap'", "class='page header-fixed'", "id='page' class='no-comments'",
    "class='elementor-widget post-content'", "class=sidebar", "class='site-header'",
])
def test_wrappers_of_the_page_stay(wrapper):
    for inside in (f"<article><p>{PARAGRAPH}</p></article>", f"<div><p>{PARAGRAPH}</p></div>"):
        assert main_text(f"<body><div {wrapper}>{inside}</div></body>") == PARAGRAPH


@pytest.mark.parametrize("tag", ["math", "object", "label", "canvas"])
def test_text_of_the_article_stays(tag):
    assert main_text(f"<article><p>{PARAGRAPH} <{tag}>x is 1</{tag}> {PARAGRAPH}</p></article>") == f"{PARAGRAPH} x is 1 {PARAGRAPH}"


def test_short_article_beside_long_boilerplate():
    assert main_text(SHELL % "<article><p>Short.</article>") == "Short."


LONG = " ".join([PARAGRAPH] * 5)
OTHER = " ".join(["A reader has quite another view of all this and says so at length."] * 20)


@pytest.mark.parametrize("page, text", [
    (f"<html><head><meta charset=utf-8><title>t</title><body><header><p>Site</p></header><article><p>{LONG}</p></article>", LONG),
    (f"<article><h1>T</h1><p>{LONG} <button>Share<p>{LONG}</p></article>", f"T\n{LONG}\n{LONG}"),
    (f"<body><div><button>Menu<div><p>{LONG}</p><p>{LONG}</p></div></div>", f"{LONG}\n{LONG}"),
    (f"<body><form action=x><nav><a href=y>One</a></nav><div><h1>T</h1><p>{LONG}</p></div><footer>Imprint</footer></form></body>", f"T\n{LONG}"),
    (f"<body><form><div class=sidebar>Side text</div><article><p>{LONG}</p></article></form></body>", LONG),
    (f"<body><nav><ul><li><a href=x>One</a><li><a href=y>Two</a></ul><article><p>{LONG}</p></article></body>", LONG),
    (f"<body><nav><ul><li><a href=x>One</a><li><a href=y>Two</a></ul><div><p>{LONG}</p><p>{LONG}</p></div></body>", f"{LONG}\n{LONG}"),
    (f"<article><p>{LONG}</p><p title='the hidden cost'>{LONG}</p></article>", f"{LONG}\n{LONG}"),
    (f"<body class='no hidden thing' data-x='not hidden =1'><div class='no hidden thing' data-x='not hidden =1'><p>{LONG}</p></div></body>", LONG),
    (f"<body><article><p>{LONG}</p><section id=comments><p>{OTHER}</p></section></article></body>", LONG),
    (f"<body><article><p>{LONG}</p></article><div id=comments><article><p>{OTHER}</p></article></div></body>", LONG),
    (f"<body><div><p>{LONG}</p></div><section class=comments><article><p>{OTHER}</p></article></section></body>", LONG),
    (f"<body><div class=cookie-notice><p>{OTHER}</p></div><div><p>{LONG}</p></div></body>", LONG),
    (f"<body><div class=widget><div><p>{LONG}</p></div></div><form><p>{PARAGRAPH}</p><input></form></body>", LONG),
    (f"<article><p>{LONG}</p><p hidden>x</p><p style='color:red; display : none'>y</p><template><p>z</p></template></article>", LONG),
    (f"<article><p>{LONG}</p><select><option>One<option>Two</select><svg><title>t</title><text>drawn</text></svg></article>", LONG),
    (f"<article><p>{LONG}</p><title-bar>{LONG}</title-bar></article>", f"{LONG}\n{LONG}"),
    ("<body><nav><p>menu</p></nav><footer>Imprint</footer></body>", ""),
])
def test_page_is_not_lost_to_boilerplate(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"), ("<p>x < y", "x < y"), ("<script>never closed", ""),
    ("<div hidden>x</div>", ""), ("<article>cut &am", "cut &am"), ("<article><p>a</p></div></span><p>b", "a\nb"), ("<a href='x", ""),
    ("<article><p>" + "<b>" * 3000 + "deep", "deep"), ("<article>" + "<p>x</p>" * 5000, "\n".join("x" * 5000)),
    ("<nav><p>menu</nav><article><p>text</article>", "text"),
])
def test_defined_cases(page, text):
    assert main_text(page) == text


def test_rows_pass_through(frame):
    pages = frame([(1, "u", "<p>a", "x"), (1, "u", "<p>a", "x"), (None, None, None, None)], "page_id long, url string, html string, text string")
    assert sorted(extract(pages).collect(), key=repr) == sorted([(1, "u", "a"), (1, "u", "a"), (None, None, "")], key=repr)
    assert extract(pages.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test tables are not here")
def test_given_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r.page_id: r.text for r in extract(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()}
    for r in rows:
        article = re.search(r"(?s)<article>(.*?)</article>", r.html)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article))
        lines = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks)
        assert got[r.page_id] == "\n".join(x for x in lines if x)
