import itertools
import random
import re
from html import unescape

import pytest

from campuslens.llm import page_text as P

PAGE = """<html><head><title>T</title><style>p{}</style></head><body>
<div id="cookie-notice">We use cookies <button>OK</button></div>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<aside class="sidebar">Related <p>More &amp; more text in the side bar that is rather long, for a side bar.</p></aside>
<main><article class="post"><header class="article-header"><h1>Title&nbsp;here</h1></header>
<p>First <b>bold</b>   text&#33; a &lt; b<br>next line<p>Second, unclosed <!-- no --> one.
<div class="ad">Buy now</div><ul><li>item one<li>item <a href="#">two</a></ul>
<script>var x = "</p><p>no</p>";</script><form><label>Mail</label><input></form>
<blockquote>Quoted.</blockquote><p style="display:none">hidden</p></article>
<section id="comments"><h2>Comments</h2><p>Nice article, I liked it very much, thank you so much for it.</p></section></main>
<div class="newsletter-signup">Subscribe</div><footer>&copy; me</footer></body></html>"""


def test_page_of_many_kinds():
    assert P.main_text(PAGE) == ("Title here\nFirst bold text! a < b next line\nSecond, unclosed one.\n"
                                 "item one\nitem two\nQuoted.")


def test_table_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r.page_id: r for r in P.extract_pages(
        spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()}
    for page in pages:
        body = page.html.split("<article>")[1].split("</article>")[0]
        parts = (re.sub(r"\s+", " ", unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x)))).strip()
                 for x in re.split(r"</?(?:p|h1)>", body))
        want = "\n".join(x for x in parts if x)
        assert got[page.page_id].text == want and got[page.page_id].n_chars == len(want)


LONG = "A paragraph of the article that goes on for a while, as they do. "
KEPT = {  # page -> text
    f'<div class="page has-sidebar"><article><p>{LONG}</p></article></div>': LONG.strip(),
    f'<div class="sidebar-right"><main><p>{LONG}</p></main><div class="sidebar-right"><p>{LONG}{LONG}</p></div></div>': LONG.strip(),
    f'<article><p class="social-history">{LONG}</p><p class="related-work">Two.</p><p class="related">Three.</p></article>':
        f"{LONG.strip()}\nTwo.\nThree.",
    f'<article><p>One <svg width="1"/>two.</p><p>{LONG}</p></article>': f"One two.\n{LONG.strip()}",
    f'<article><p>One <svg><title>t</title><text>no</text></svg>two.</p><svg><path><p>{LONG}</p></article>':
        f"One two.\n{LONG.strip()}",
    f'<body><noscript><article><p>{LONG}</p></article></body>': LONG.strip(),
    f'<article><noscript><p>Enable it</p></noscript><p>{LONG}</p></article>': LONG.strip(),
    f'<article><p>{LONG}<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds.</p></article>':
        f"{LONG}x=2 holds.",
    f'<article><p>See <object data="a">the text</object> here.</p><p>{LONG}</p></article>': f"See the text here.\n{LONG.strip()}",
    "text only": "text only",
    "One &amp; two<br>three": "One & two three",
    f'<main><article><p>{LONG}</p></article><section class="comments-area"><article class="comment"><p>{LONG * 3}</p></article>'
    f'</section></main>': LONG.strip(),
    f'<div id="siteHeader">Head</div><div class="content"><p>{LONG}</p></div><div class="cookieBanner">We use them</div>':
        LONG.strip(),
    f'<article><p>{LONG}</p><script>if (a < b) "</p><p>no"</script><style>p{{}}</style><p>End.</p></article>':
        f"{LONG.strip()}\nEnd.",
}


@pytest.mark.parametrize("page", KEPT)
def test_pages_unlike_the_table(page):
    assert P.main_text(page) == KEPT[page]


@pytest.mark.parametrize("name,kind", [("has-sidebar", 0), ("sidebar", -1), ("sidebar__inner", -1), ("social-history", 0),
                                       ("cookieBanner", -1), ("main-menu", -1), ("post-body", 1), ("loading", 0),
                                       ("with-no-ads", 0), ("ad-slot-1", -1), ("", 0)])
def test_names_count_whole(name, kind):
    assert P.name_kind(name) == kind


def test_long_and_deep_pages():
    many = 20_000
    page = f"<article>{'<div>' * many}{LONG}{'</div>' * many}{f'<p>{LONG}</p>' * many}</article>"
    assert P.main_text(page) == "\n".join([LONG.strip()] * (many + 1))
    assert P.main_text("<noscript>" * many + "x" + "<iframe>" * many) == "x"


def cost(labels, preference, edges):
    return (sum(-p if not x and p < 0 else 0 for x, p in zip(labels, preference))
            + sum(w for i, j, w in edges if labels[i] != labels[j])
            + sum(-p for x, p in zip(labels, preference) if x and p < 0)
            + sum(p for x, p in zip(labels, preference) if not x and p > 0)
            + sum(p for x, p in zip(labels, preference) if not x and p < 0))


@pytest.mark.parametrize("seed", range(60))
def test_cut_is_minimal(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 9)
    preference = [rng.randint(-12, 12) for _ in range(n)]
    edges = [(i, j, rng.randint(1, 9)) for i, j in itertools.combinations(range(n), 2) if rng.random() < 0.4]
    best = min(cost(x, preference, edges) for x in itertools.product([False, True], repeat=n))
    assert cost(P.min_cut(preference, edges), preference, edges) == best


@pytest.mark.parametrize("html", [None, "", "   ", "<", "<p", "<!-- open", "<script>x", "text only", "<p>a</div></p>b",
                                  "<div " * 500, "<p>" * 3000 + "x", "a" * 200_000, "<a href='<p>'>x</a>"])
def test_odd_pages_have_a_result(html):
    assert isinstance(P.main_text(html or ""), str)


def test_odd_rows(spark):
    frame = spark.createDataFrame([(1, "u", None, "t", 1), (1, "u", None, "t", 1), (None, None, PAGE, "t", 1)],
                                  "page_id long, url string, html string, text string, n_chars int")
    rows = P.extract_pages(frame).collect()
    assert [(r.page_id, r.n_chars) for r in rows if r.page_id] == [(1, 0), (1, 0)] and len(rows) == 3
    assert P.extract_pages(frame.limit(0)).count() == 0
