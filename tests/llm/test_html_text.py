import html
import os
import re
import time

import numpy as np
import pytest

from geoquilt.llm import html_text
from geoquilt.llm.queries import op6_block_tree

SF = "/root/testdata/sf0.001"
TABLE = np.array(html_text.LABELLED, float)
TREE = html_text.train(TABLE[:, :-1], TABLE[:, -1])
LONG = "Some longer text of an article that goes on for quite a while, with many words in it so that it counts as such."


def test_tree_learns_its_table():
    assert ((html_text.predict(TREE, TABLE[:, :-1]) >= 0.5) == (TABLE[:, -1] == 1)).mean() > 0.97


def test_held_out_blocks():
    right = 0
    for k in range(6):
        out = np.arange(len(TABLE)) % 6 == k
        tree = html_text.train(TABLE[~out, :-1], TABLE[~out, -1])
        right += ((html_text.predict(tree, TABLE[out, :-1]) >= 0.5) == (TABLE[out, -1] == 1)).sum()
    assert right / len(TABLE) > 0.8


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        (f"<nav><a href='/'>Home</a></nav><header>Site name</header><main><h1>Title &amp; more</h1><p>{LONG}<p>Short.<br>Next</main><footer>(c)</footer>", f"Title & more {LONG} Short. Next"),
        (f"<article><header><h1>T</h1></header><p>{LONG}</p><aside>Also read</aside><form>Name <input></form><p>B&#233;<b>t</b>a&nbsp;x</p></article><section id='comments'><p>{LONG}</p></section>", f"T {LONG} Béta x"),
        (f"<div class='sidebar-left'><p>{LONG}</p></div><div class='cookieNotice'>{LONG}</div><div class='content'><p>{LONG}</p></div>", LONG),
        (f"<article><p>a<script>var x = '<p>no</p>';</script>b</p><style>p{{}}</style><!-- <p>no</p> --><p title=\"a > b\">c</p><div class='ad-slot'>{LONG}</div></article>", "ab c"),
        (f"<article><p>{LONG}</p></div></span><p>tail</article><div class=ad>{LONG}", f"{LONG} tail"),
        (f"<body><div class='content no-sidebar'><p>{LONG}</p></div>", LONG),
        (f"<div id='main' class='has-sidebar'><p>{LONG}</p><p>{LONG}</p></div><div id='sidebar'><p>{LONG}</p></div>", f"{LONG} {LONG}"),
        (f"<div class='hentry tag-news comments-open'><p>{LONG}</p></div><div class='comments'><p>{LONG}</p></div>", LONG),
        (f"<article><p>{LONG}</p><div class='related-work'><p>{LONG}</p></div><div class='related-reading'><a href='/'>One</a><a href='/'>Two</a></div></article>", f"{LONG} {LONG}"),
        (f"<article><p>{LONG} <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p></article>", f"{LONG} x=2"),
        (f"<article><p>{LONG}</p><p hidden>{LONG}</p><p style='display: none'>{LONG}</p><p class=advert>{LONG}</p><h3 class='related'>More of this</h3><p aria-hidden=TRUE>{LONG}</p></article>", LONG),
        (f"<article><p>{LONG} <a class='advert' href='x'>buy this</a>now</p><p>a<span hidden>b<span>c</span></span>d</p></article>", f"{LONG} now ad"),
        (f"<article><p title='x class=advert hidden'>{LONG}</p></article>", LONG),
        (f"<article><p>{LONG}<svg><path d='x'><text>no</text><p>{LONG}</p><video src='x'/><p>{LONG}</p><object>no<b>no</b></object></article>", f"{LONG} {LONG} {LONG}"),
        (f"<article><div>{LONG}<video><source src='x'>no</div><p>{LONG}</p></article>", f"{LONG} {LONG}"),
        (f"<article><ul><li class=ad>{LONG}<li>{LONG}</ul><table><tr><td class=promo>{LONG}<td>{LONG}</table></article>", f"{LONG} {LONG}"),
        (f"<article><h2>A heading of it<p>{LONG}</p></article>", f"A heading of it {LONG}"),
        (f"<article><p>1 < 2 <> 3 <!> {LONG}<!--></p>{LONG}", f"1 < 2 <> 3 {LONG} {LONG}"),
        (f"<article><p>{LONG}<b x='>", LONG),
        (f"<article><p>{LONG}</p><i x='y>{LONG}</i><p>{LONG}</p>", f"{LONG} {LONG} {LONG}"),
        ("<p>unfinished <b", ""),
        ("<article><p>x<script>never closed", "x"),
    ],
)
def test_pages(page, want):
    assert html_text.main_text(page, TREE) == want


def test_operator(spark):
    df = spark.createDataFrame([(1, "u", f"<article>{LONG}</article>", 7), (2, None, None, 8), (1, "u", f"<article>{LONG}</article>", 7)], "page_id long, url string, html string, text int")
    got = html_text.extract(df)
    assert got.columns == ["page_id", "url", "html", "text"] and [r.text for r in got.sort("page_id").collect()] == [LONG, LONG, ""]
    assert html_text.extract(df.limit(0)).count() == 0
    big = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    assert len(html_text.main_text(big, TREE)) == 20_000 * (len(LONG) + 1) - 1


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")
def test_query(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op6_block_tree(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", inner))).split())
        assert r.text == want and r.n_chars == len(want)


@pytest.mark.parametrize("piece", ["<a ", "<!x", "<a b=\"", "<a b='>'", "<a b=\">\"", "</x>", "<b class=ad>", "<svg>", "<script>", "<!--", "<", "<div class='", "<p><button><b hidden>x", "<li><i class='x ad'>", "<a =", "<a class class", "<article><div></p></div>"])
def test_hostile_pages_take_time_by_length(piece):
    page = "<article><div>" + piece * (600_000 // len(piece))
    began = time.process_time()
    html_text.main_text(page, TREE)
    html_text.main_text(page + "</div></x>" * 50_000, TREE)
    assert time.process_time() - began < 12
