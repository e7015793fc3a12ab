import html
import re

import numpy as np
import pytest

from vicinity.llm import pages


@pytest.fixture(scope="module")
def tree():
    return pages.train(*pages.skeletons())


def test_held_out_skeletons(tree):
    rows, labels = pages.skeletons(seed=77)
    assert (tree.predict(rows) == labels).mean() > 0.98


def test_words_and_links_decide_where_no_element_does(tree):
    prose = "this line of prose is quite long and goes on for a good while, as article text does in most cases. " * 3
    page = f"<div><a>home</a></div><div><a>more links here</a></div><p>{prose}</p><p>{prose}</p><div><a>next page</a></div>"
    assert pages.main_text(page, tree) == "\n\n".join([prose.strip()] * 2)


CASES = [
    ("<article><p>a &amp; b &lt;c&gt; &eacute;&#33;</p></article>", "a & b <c> é!"),
    ("<article><p> one\n\t two<br>three <b>fo</b>ur </p>\n<p></p><p>five</article>", "one two three four\n\nfive"),
    ("<nav>menu</nav><article>x<script>var a='</p>';</script><style>p{}</style>y</article><footer>z</footer>", "x\n\ny"),
    ("<article><p title='a > b' data-x=\"<p>\">kept</p><!-- <p>no</p> --></article>", "kept"),
    ("<article><p>1 < 2 and <3</p></article>", "1 < 2 and <3"),
    ("<article><p hidden>no</p><div style='display:none'><p>no</p></div><p>yes</p></article>", "yes"),
    ("<article><p>cut off", "cut off"),
    ("<ARTICLE><P>upper</P></ARTICLE><div id=comments><p>reader says a lot of things in this comment</p></div>", "upper"),
    ("<article><p>a<p>b<li>c</article>", "a\n\nb\n\nc"),
    ("<head><title>t</title><body><article>x</article>", "x"),
    ("<article><textarea>no</textarea><form><p>no no</p></form><select><option>no</select>x</article>", "x"),
    ("plain & simple", ""),
    ("<<<>>> </ <", ""),
    ("", ""),
    (None, ""),
]


@pytest.mark.parametrize("page,want", CASES)
def test_markup(tree, page, want):
    got = pages.main_text(page, tree)
    assert got == want


def prose(n, seed=0):
    return " ".join(f"word{(i * 7 + seed) % 50}" for i in range(n))


MISLEADING = [
    '<div class="content"><div class="legal"><p>{0}</p><p>{1}</p></div></div><div class="footer">imprint and more</div>',
    '<nav><a href="/">home</a></nav><div class="product-search results"><h1>{0}</h1><p>{1}</p></div><footer>imprint</footer>',
    '<div class="product-search results"><p>{0}</p><p>{1}</p></div>',
    '<div id="social-share"><a>x</a></div><div class="header notice"><p>{0}</p><p>{1}</p></div>',
    '<article class="sponsored ad"><p>{0}</p><p>{1}</p></article><div class="comments"><p>nice text, I say</p></div>',
]


@pytest.mark.parametrize("page", MISLEADING)
def test_misleading_names_lose_no_article(tree, page):
    parts = [prose(45), prose(60, 3)]
    assert pages.main_text(page.format(*parts), tree) == "\n\n".join(parts)


def test_parts_beside_an_article_go_by_their_names(tree):
    for name in ("ad", "cookie notice", "related", "sidebar", "comments"):
        page = f'<div class="{name}"><p>{prose(35)}</p></div><div id="content"><h1>a title here</h1><p>{prose(50, 1)}</p><p>{prose(60, 2)}</p></div>'
        assert pages.main_text(page, tree) == f"a title here\n\n{prose(50, 1)}\n\n{prose(60, 2)}"


def test_odd_rows(spark, tree):
    rows = [(1, "u", "<article>a</article>", "clash"), (1, "u", "<article>a</article>", "clash"), (None, None, None, None)]
    rows.append((2, "v", "<article>" + "<p>word</p>" * 20_000 + "</article>", ""))
    rows.append((3, "w", "<div>" * 5000 + "<article>deep</article>", ""))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r.page_id, r.url): r.text for r in pages.extract(frame).collect()}
    assert got[1, "u"] == "a" and got[None, None] == "" and got[2, "v"] == "\n\n".join(["word"] * 20_000) and got[3, "w"] == "deep"
    assert pages.extract(frame).count() == 5 and pages.extract(frame.limit(0)).collect() == []


def test_query_on_the_test_table(spark, sf):
    from vicinity.llm.queries import QUERIES

    table = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op7_page_blocks"](spark, sf).collect()
    assert len(rows) == len(table)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", table[r.page_id], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article).replace("<br>", " "))
        want = [" ".join(html.unescape(p).split()) for p in parts]
        assert r.text == "\n\n".join(w for w in want if w) and r.n_chars == len(r.text)


def test_tree_splits_and_leaves():
    rows = np.array([[0.0, 5.0], [1.0, 5.0], [2.0, 1.0], [3.0, 1.0]] * 5)
    labels = np.array([False, False, True, True] * 5)
    tree = pages.train(rows, labels)
    assert (tree.predict(rows) == labels).all()
    assert pages.train(rows, np.ones(20, bool)).predict(rows).all()
