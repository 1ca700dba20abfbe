from __future__ import annotations

import html
import math
import re

import pytest
from pyspark.sql import functions as F

from surfrank.llm import html_text
from surfrank.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

PAGE = (
    "<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{{}}</style><script>var a='</p><article>';</script></head>"
    "<body class='sidebar-open'><header><a href='/'>Site</a></header><nav><ul><li><a href='/a'>A</a><li><a href='/b'>B</a></ul></nav>"
    "<div class='cookieNotice'>We use cookies</div>{main}<aside>More</aside><form><label>Mail<input></label></form>"
    "<section id='comments'><article class='comment'><p>First!</p></article></section><footer>&copy; 2020</footer></body></html>"
)


def plain(page: str) -> str:
    """The article of the given tables' pages by patterns, for their few elements."""
    body = re.search(r"<article>(.*)</article>", page, re.DOTALL)[1].replace("<br>", " ")
    blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(filter(None, blocks))


@pytest.mark.parametrize(
    ("main", "text"),
    [
        ("<article><h1>Head</h1><p>One\n two&nbsp;three &lt;b&gt; &#8364;<br>four<p>Five <b>six<p>seven</b></article>", "Head\nOne two three <b> € four\nFive six\nseven"),
        ("<main><h1>Head</h1><article><header><h2>Sub</h2></header><p>Long enough text</p></article></main>", "Sub\nLong enough text"),
        ("<main><h1>A longer head</h1><article>x</article><p>Words of the main element</p></main>", "A longer head\nx\nWords of the main element"),
        ("<article><p>Kept</p><div class='ad'>Buy</div><div class=\"social share\">Share</div><p hidden>no</p><p style='display: none'>no</p></article>", "Kept"),
        ("<div class='post'><p>No article here</p><ul><li>a<li>b <a href=x>c</a></ul><ul><li><a>x</a><li><a>y</a></ul></div>", "No article here\na\nb c"),
        ("<article><div class='post-header banner'><h1>Title</h1></div><p class='commentary'>Kept</p></article>", "Title\nKept"),
        ("<div class='ad'>Unclosed <article><p>Kept</p></article>", "Kept"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table><pre> x\n  y </pre><p title='a>b'>z</p></article>", "a b\nc\nx y\nz"),
        ("<article><!-- <p>no</p> --><p>1 < 2 &amp;&amp; 3 > 2 &am</p><![CDATA[raw &amp;]]></article>", "1 < 2 && 3 > 2 &am\nraw &amp;"),
        ("", ""),
    ],
)
def test_main_text_of_a_page(main, text):
    assert html_text.main_text(PAGE.format(main=main)) == text


def test_broken_and_long_markup_takes_linear_time():
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<nav>x") == ""
    assert html_text.main_text("just text &amp more") == "just text & more"
    deep = "<div>" * 50_000 + "deep" + "</div>" * 20_000
    assert html_text.main_text(f"<article>{deep}</article>") == "deep"
    assert html_text.main_text("<p a=\"'" * 2_000 + ">end") is not None
    many = "".join(f"<p>{i}" for i in range(100_000))
    assert html_text.main_text(f"<article>{many}").count("\n") == 99_999


def _site(spark, pages):
    return spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' as site", "'x' as node", "'x' as low").repartition(3)


def test_style_tree_finds_unnamed_boilerplate(spark):
    """Elements without telling names go by entropy, and only on the host whose pages share them."""
    body = "<div class='x1'>Latest deals of {host}</div><div class='x2'><p>Story {i} of many words</p><p>Ending {i}</p></div><div class='x3'>Made by us</div>"
    pages = [(i, f"http://{h}.example/{i}", f"<body>{body.format(host=h, i=i)}</body>") for h in ("a", "b") for i in range(20)]
    pages += [(100, "http://c.example/", "<body><div class='x1'>Latest deals of a</div><p>Alone</p></body>"), (101, None, None), (102, None, "<p>x</p>")]
    pages += [pages[0], pages[0], (None, "no url", "<p>y</p>")]
    got = sorted((r.page_id is None, r.page_id, r.url, r.text, r.n_chars) for r in html_text.extract(_site(spark, pages)).collect())
    want = sorted(
        (p is None, p, u, t, len(t))
        for p, u, t in [
            *((i, f"http://{h}.example/{i}", f"Story {i} of many words\nEnding {i}") for h in ("a", "b") for i in range(20)),
            *[(0, "http://a.example/0", "Story 0 of many words\nEnding 0")] * 2,
            (100, "http://c.example/", "Latest deals of a\nAlone"), (101, None, ""), (102, None, "x"), (None, "no url", "y"),
        ]
    )
    assert sorted(got, key=str) == sorted(want, key=str)


def test_importance_is_the_entropy_by_hand(spark):
    """20 pages: one text on all, one of two texts, one text each; copies of a page count once."""
    pages = [(i, "http://h.example/", f"<body><i>same</i><b>{'odd' if i % 2 else 'even'}</b><p>the long text {i:09d}</p></body>") for i in range(20)]
    found = html_text.importance(html_text.seen(_site(spark, pages + pages[:5] * 4)))
    got = {r.node: r for r in found.collect()}
    top = html_text._key(None, html_text._look("html", "")[0])
    body = html_text._key(top, html_text._look("body", "")[0])
    of = {t: got[html_text._key(body, html_text._look(t, "")[0])] for t in ("i", "b", "p")}
    assert all(r.pages == 20 for r in got.values())
    assert (of["i"].importance, of["p"].importance) == (0.0, 0.9)
    assert of["b"].content == pytest.approx(1 - math.log(10) / math.log(20)) and of["b"].presentation == 0
    assert got[body].importance == 0 and got[body].layouts == 1


def test_copies_of_an_article_keep_their_text(spark):
    """Near copies all over a host are low by entropy; the article keeps its text."""
    pages = [(i, "http://h.example/", f"<article><p>One text</p><p>for all of them</p></article><p>{'w' * i} tail</p>") for i in range(40)]
    assert {r.text for r in html_text.extract(_site(spark, pages)).collect()} == {"One text\nfor all of them"}


def test_query_equals_patterns_on_the_given_pages(spark):
    pages = {r.page_id: (r.url, plain(r.html)) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op12_html_text"](spark, SF).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == pages and len(got) == len(pages)
    assert all(r.n_chars == len(r.text) for r in got)


def test_empty_table(spark):
    assert html_text.extract(_site(spark, []).filter(F.lit(False))).collect() == []
