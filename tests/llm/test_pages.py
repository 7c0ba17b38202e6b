"""Main-text extraction against pages whose article is known."""

from __future__ import annotations

import html
import os
import re

import pytest
from pyspark.sql import functions as F

from cadastra.llm import htmltext
from cadastra.llm import queries as registered

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
WORDS = "the of and to river bridge stone over water old town built years people later market north".split()


def prose(n, start=0):
    return " ".join(WORDS[(start + i * 5) % len(WORDS)] for i in range(n)) + "."


@pytest.fixture(scope="module")
def tree():
    return htmltext.trained()


PARTS = [prose(40), prose(6, 3), prose(75, 1), prose(33, 2)]
ARTICLE = "".join(f"<p>{p}</p>" for p in PARTS)
MENU = "<ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in WORDS[:6]) + "</ul>"
PAGES = {
    "semantic": f"<header><a href=/>Site</a></header><nav>{MENU}</nav><main><article><h1>Old bridge</h1>{ARTICLE}</article></main>"
    f"<aside><p>{prose(30)}</p></aside><footer><p>{prose(12)}</p></footer>",
    "named": f"<div class='navbar'>{MENU}</div><div class=cookie-notice>{prose(20)}<button>OK</button></div>"
    f"<div id='content'><h1>Old bridge</h1>{ARTICLE}<div class='ad-box'>{prose(9)}</div></div>"
    f"<div id='sidebar'>{prose(25)}</div><div class='comments'><p>{prose(50)}</p></div><div id=footer>{prose(10)}</div>",
    "bare": f"<div>{MENU}</div><h1>Old bridge</h1>{ARTICLE}<div><a href=x>About us</a> <a href=y>Contact</a></div>",
    "comments": f"<article><h1>Old bridge</h1>{ARTICLE}</article><section id=comments><article class=comment><p>{prose(80)}</p></article>"
    f"<form><label>Name</label><textarea>Say something</textarea><button>Send</button></form></section>",
    "wrapped": f"<body class='with-sidebar'><div class='has-sidebar'><div class=entry><h1>Old bridge</h1>{ARTICLE}</div></div></body>",
}


@pytest.mark.parametrize("name", PAGES)
def test_customary_layouts(tree, name):
    page = f"<html><head><title>t</title><style>p {{}}</style><script>if (a<b) '</p>'</script></head>{PAGES[name]}</html>"
    assert htmltext.main_text(page, tree) == "\n".join(["Old bridge", *PARTS])


def test_blocks_follow_markup():
    page = (
        "<p>One&amp;two&nbsp; &lt;b&gt;<b> bold</b>\n text<br>next<br> <br>third<!-- <p>no --><p>fourth <script>x='</p>'</script>end"
        "<a href='>'>link <i>in</i></a><ul><li>a<li>b</ul>&#233;"
    )
    blocks = htmltext.blocks_of(page)
    assert [b.text for b in blocks] == ["One&two <b> bold text next", "third", "fourth endlink in", "a", "b", "é"]
    assert [(b.words, b.linked) for b in blocks][2] == (3, 2)


@pytest.mark.parametrize("page", [None, "", " \n", "<", "<!--", "<script>", "<p", "</", '<p class="', "<a", "&", "<p>" * 5000])
def test_broken_pages_do_not_fail(tree, page):
    assert htmltext.main_text(page, tree) in ("", "<", "<p", "</", '<p class="', "<a", "&")


def test_long_page_is_read_whole(tree):
    page = f"<nav>{MENU * 200}</nav><article>" + "".join(f"<p>{prose(30, i)}</p>" for i in range(5000)) + "</article>"
    assert htmltext.main_text(page, tree).count("\n") == 4999


def test_tree_splits_what_one_cut_splits():
    import numpy as np

    rows = np.array([[1.0, 0], [2, 1], [8, 0], [9, 1]])
    tree = htmltext.grown(rows, np.array([False, False, True, True]), least=1)
    assert (tree.feature, tree.limit) == (0, 5.0) and htmltext.verdict(tree, [7, 0]) and not htmltext.verdict(tree, [3, 0])


def test_labelled_pages_are_learned(tree):
    right = total = 0
    for blocks, main in htmltext.labelled_pages():
        for row, label in zip(htmltext.features_of(blocks), main):
            right += htmltext.verdict(tree, row) == label
            total += 1
    assert total > 500 and right / total > 0.97


def test_rows_stay_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGES["semantic"]), (1, "u", PAGES["semantic"]), (None, None, None), (2, "v", "")], "page_id long, url string, html string"
    ).withColumns({"text": F.lit(1), "n_chars": F.lit(2)})
    out = htmltext.extract(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in out.collect()), key=repr)
    whole = "\n".join(["Old bridge", *PARTS])
    assert got == sorted([(1, "u", whole, len(whole))] * 2 + [(0, None, "", 0), (2, "v", "", 0)], key=repr)
    assert htmltext.extract(pages.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_registered_query_gives_the_articles(spark):
    got = {r.page_id: r.text for r in registered.queries()["op11_main_text"](spark, FOLDER).collect()}
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        inner = re.search("<article>(.*?)</article>", page.html, re.S)[1].replace("<br>", " ")
        blocks = [html.unescape(re.sub("<[^>]+>", "", x)) for x in re.split("</?(?:p|h1)>", inner)]
        assert got[page.page_id] == "\n".join(" ".join(b.split()) for b in blocks if b.strip())
