"""HTML extraction on pages marked by hand, and on markup that leaves things out."""

from __future__ import annotations

import time

import pytest

from lakeward.llm import html_extract
from lakeward.llm.common import prepare


def alone(body: str) -> str:
    return html_extract.Page(body).text(set())


# Page, and the text that a reader would mark as its article.
GOLDEN = [
    ("""<!doctype html><html><head><title>Rail</title><style>p{margin:0}</style></head><body class="post-template">
<header id="masthead"><a href="/">The Daily</a><ul class="nav"><li>News<li>Sport</ul></header>
<div class="cookie-banner">We use cookies <button>OK</button></div>
<main><article class="post has-sidebar"><header class="entry-header"><h1>New line opens</h1><p class="byline">By A. Writer</p></header>
<p>The first train left at <b>six</b>&nbsp;o&#8217;clock.<p>It was full &mdash; and on time.
<figure><img src=a.jpg alt="train"><figcaption>The train at dawn</figcaption></figure>
<div class="ad-slot ad-300x250">Buy a car</div><h2>What next</h2><ol><li>More trains<li>Fewer cars</ol>
<div class="share-buttons"><a>Tweet</a></div></article>
<aside class="related"><h3>Read also</h3><a>Old line closes</a></aside></main>
<section id="comments"><article><p>Great news!</p></article></section><footer>&copy; Daily</footer></body></html>""",
     "New line opens\n\nBy A. Writer\n\nThe first train left at six o’clock.\n\nIt was full — and on time.\n\nThe train at dawn\n\nWhat next\n\nMore trains\n\nFewer cars"),
    ("""<html><body><form id="aspnetForm" action="?"><input type=hidden name=v><div id=top-menu><a>Home</a> <a>About</a></div>
<div role="main" class="social-science"><h1>Voting &amp; trust</h1><p class='related-work'>Earlier studies agree.</p>
<table><tr><th>Year<th>Share<tr><td>1999<td>40</table><blockquote title=don't>Trust is slow.</blockquote><pre>a
  b</pre></div><div class=newsletter-signup><label>Mail</label><input></div></form></body></html>""",
     "Voting & trust\n\nEarlier studies agree.\n\nYear\n\nShare\n\n1999\n\n40\n\nTrust is slow.\n\na b"),
    ("""<body><nav><a>Index</a></nav><div class="content"><p>No article tag here, just a page of words that says what it has to say.
<p>Two paragraphs of them<br>with a break.<p class="notice">Cookies!<p>The end.</div><div class="sidebar"><ul><li><a>Archive</a></ul></div></body>""",
     "No article tag here, just a page of words that says what it has to say.\n\nTwo paragraphs of them with a break.\n\nThe end."),
]


@pytest.mark.parametrize("page, wanted", GOLDEN, ids=["news", "form", "plain"])
def test_pages_marked_by_hand(page, wanted):
    assert alone(page) == wanted


@pytest.mark.parametrize("page, wanted", [
    ("<body><form id=aspnetForm><article><h1>T</h1><p>Body text</p></article></form>", "T\n\nBody text"),
    ("<article><p class='social-science'>Soc</p><h2 id='related-work'>Related</h2><p>x</p></article>", "Soc\n\nRelated\n\nx"),
    ("<article><p class='share-box'>Share</p><p class=adBanner>Ad</p><p>All of the article</p></article>", "All of the article"),
    ("<p>One<p class=ad>Buy<p>Main text that is long enough to count", "One\n\nMain text that is long enough to count"),
    ("<article><p>long first<p class=notice>Note<p>Short end.</article>", "long first\n\nShort end."),
    ("<p title=don't>Hello</p>", "Hello"),
    ("<p title=\"a > b\" alt='<x>'>Hello</p>", "Hello"),
    ("<ul><li>a<li class=ad>b<li>c<ul><li>d</ul><li>e</ul>", "a\n\nc\n\nd\n\ne"),
    ("<dl><dt>a<dd class=ad>b<dt>c<dd>d</dl>", "a\n\nc\n\nd"),
    ("<p>a<div>b</div>c", "a\n\nb\n\nc"),
    ("<div><p>Real words of the page here</p></div><form><p>Sign up</p></form>", "Real words of the page here"),
])
def test_markup_that_leaves_things_out(page, wanted):
    assert alone(f"<body>{page}") == wanted


def test_headings_that_pages_share_stay(spark):
    prepare(spark)
    rows = [(i, f"http://h.test/{i}", f"<body><article><h1>A{i}</h1><h2>Introduction</h2><p>own {i}</p><h2>Conclusion</h2><p>end {i}</p>"
             f"<div>Printed by us</div></article></body>") for i in range(4)]
    rows += [(9, None, "<p>No url</p>"), (10, "no host", "<p>No host</p>"), (None, "http://h.test/", None)]
    got = html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = {r["page_id"]: r["text"] for r in got}
    assert all(texts[i] == f"A{i}\n\nIntroduction\n\nown {i}\n\nConclusion\n\nend {i}" for i in range(4))
    assert (texts[9], texts[10], texts[None]) == ("No url", "No host", "") and len(got) == len(rows)


def test_deep_and_unclosed_nesting_takes_linear_time():
    def took(page: str) -> float:
        began = time.process_time()
        html_extract.Page(page).text(set())
        return time.process_time() - began

    for make in (lambda n: "<div>" * n + "x" + "</section>" * n, lambda n: "<p><button>" + "<div>" * n + "x", lambda n: "<ul><li>" + "<span>" * n + "<ul>" + "<div>" * n,
                 lambda n: "<table>" + "<tr><td>x" * n, lambda n: "<div a='" * n, lambda n: "<" * n):
        assert took(make(40_000)) < 5
