from __future__ import annotations

import random

import pytest

from tripmart.llm import page_tree
from tripmart.llm.page_tree import Reader
from tripmart.llm.site_style import SiteStyle, extract_main_text, importances, low_branches, main_text

PAGES = "page_id long, url string, html string, host string, low string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*row, "extra", "extra") for row in rows], PAGES)


def text_of(page):
    return main_text(*Reader().read(page), frozenset(), SiteStyle())


def test_named_parts_go():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href=/a>A</a></ul></nav><div class="cookie-notice">We use cookies</div>
    <aside>Side</aside><!-- ad > --><div class=ad>Buy</div><article class="post"><header><h1>Title &amp; more</h1></header>
    <p><b>First<br>line<p>Second&nbsp;p<i>ar</i>t &#233;&lt;p&gt;</p><form>Name<input></form><div id="comments"><p>Nice!</p></div>
    <section class="comment-list"><article class="comment">Hm</article></section><footer>by me</footer></article><footer>&copy;</footer>"""
    assert text_of(page) == "Title & more First line Second part é<p>"


def test_wrappers_are_not_what_they_hold():
    page = """<body class="has-sidebar"><div id="siteHeader">Name</div><div class="content no-comments with-sidebar"><article class="post has-menu">
    <div class="article-header"><h1>Title</h1></div><p>Text</p><div class="readerComments">Hm</div></article></div></body>"""
    assert text_of(page) == "Title Text"


def test_pages_without_article_and_odd_markup():
    assert text_of("plain < text & more") == "plain < text & more"
    assert text_of("<p>a<p>b<div>c<span>d</span>e</div>f") == "a b cde f"
    assert text_of("<ul><li><a href=x>One</a><li><a href=y>Two</a><li><a href=z>Three</a></ul><p>Body text</p>") == "Body text"
    assert text_of('<p title="a > b">x</p><p class="unclosed>y</p>') == "x y"
    assert text_of("<div hidden>no</div><div style='display: none'>no</div><div>yes</div>") == "yes"
    assert text_of("<script>never closed <p>x") == "" and text_of("") == "" and text_of("<!-- open") == ""


def test_branches_that_a_site_repeats_go(spark):
    rows = [
        (
            k,
            f"http://www.Site.example:80/{k}",
            f"<div class=top><div>Welcome to the site</div></div><div class=body><p>Story {k} begins</p><p>and ends {k}</p></div><div class=low>Call us</div>",
        )
        for k in range(40)
    ]
    found = {r.page_id: r.text for r in extract_main_text(pages_of(spark, rows)).collect()}
    assert found == {k: f"Story {k} begins and ends {k}" for k in range(40)}
    few = {r.page_id: r.text for r in extract_main_text(pages_of(spark, rows[:5])).collect()}
    assert few == {k: f"Story {k} begins and ends {k}" for k in range(5)}
    alone = extract_main_text(pages_of(spark, rows[3:4])).first()
    assert alone.text == "Welcome to the site Story 3 begins and ends 3 Call us"


@pytest.mark.parametrize("pages", [2, 5, 60])
def test_the_tree_works_without_names(spark, monkeypatch, pages):
    """No class words, no nav, footer and aside, no lists of links, and no header element in the pages: entropy alone tells menus, footers and notices, some with changing entries."""
    monkeypatch.setattr(page_tree, "PART_WORDS", frozenset())
    monkeypatch.setattr(page_tree, "PART_TAGS", page_tree.PART_TAGS - {"nav", "footer", "aside"})
    page = """<body><div class=masthead><a href=/>The Daily Page</a></div><nav><ul>{menu}<li><a href=/t{k}>Topic {k}</a></ul></nav>
    <div class=notice>We use cookies. Read more about it! Visitor number {k}</div><aside class=side><p>Most read stories</p><p>Write to us</p></aside>
    <div class=body><h1>Title of {k}</h1><p>It began on day {k}, and went on for {k} more. On day {k} it was over.</p><p>So number {k} ends.</p></div>
    <footer><p>&copy; Daily Page. All rights reserved. Printed in town. Page {k}</p></footer></body>"""
    menu = "".join(f"<li><a href=/{name}>{name}</a>" for name in ("News", "Sports", "Arts", "Travel", "Science", "Games"))
    rows = [(k, f"http://h.example/{k}", page.format(k=k, menu=menu)) for k in range(pages)]
    low = low_branches(spark.createDataFrame([("h", html) for _, _, html in rows], "host string, html string"), SiteStyle()).first().low
    for _, _, html in rows[:5]:
        elements, blocks = page_tree.Reader().read(html)
        assert not any(own.part for own in elements)
        text = main_text(elements, blocks, frozenset(low), SiteStyle(min_links=10**6))
        k = int(text.split()[2])
        assert text == f"Title of {k} It began on day {k}, and went on for {k} more. On day {k} it was over. So number {k} ends."


def test_copies_alone_on_a_host_stay(spark):
    """All pages of a host are the same: everything repeats, so the tree has no say."""
    rows = [(k, "http://h.example/", "<nav>Menu</nav><div><h1>Head</h1><p>Same text</p></div>") for k in range(4)]
    assert {r.text for r in extract_main_text(pages_of(spark, rows)).collect()} == {"Head Same text"}


def test_blocks_on_a_small_share_of_a_host_go(spark):
    page = "<div class=body><p>Story {k} begins</p></div>{box}"
    rows = [(k, f"http://h.example/{k}", page.format(k=k, box="<section class=stripe><div>Read all of it</div></section>" if k < 9 else "")) for k in range(30)]
    rows += [(100 + k, f"http://large.example/{k}", page.format(k=k, box="<section class=stripe>Read on</section>" if k < 9 else "")) for k in range(1000)]
    found = {r.page_id: r.text for r in extract_main_text(pages_of(spark, rows)).collect()}
    assert found == {k: f"Story {k if k < 100 else k - 100} begins" for k in found} and len(found) == 1030


def test_importances_are_those_of_the_recursion(spark):
    draw = random.Random(7)
    value = lambda: draw.choice([None, draw.random()])
    nodes = {k: (draw.randrange(max(1, k - 3), k) if k > 1 else 0, value(), value()) for k in range(1, 60)}
    nodes[90] = (77, value(), value())  # the parent is no node

    def importance(path):
        _, shape, text = nodes[path]
        below = [importance(k) for k, (parent, *_) in nodes.items() if parent == path]
        if not below:
            return next(x for x in (text, shape, 1.0) if x is not None)
        inner = max(x for x in (*below, text) if x is not None)
        return inner if shape is None else 0.9 * inner + 0.1 * shape

    rows = [(host, 0, 0, 0.5, None) for host in "ab"] + [(host, path, *node) for host in "ab" for path, node in nodes.items()]
    found = importances(spark.createDataFrame(rows, "host string, path long, parent long, shape double, text double"), SiteStyle()).collect()
    assert len(found) == 2 * len(nodes) and all(abs(r.importance - importance(r.path)) < 1e-9 for r in found)


def test_copies_do_not_remove_articles(spark):
    rows = [(k, "http://h.example/", f"<article><h1>Head {k // 30}</h1><p>Same text {k if k > 59 else k // 30}</p></article>") for k in range(120)]
    found = {r.page_id: r.text for r in extract_main_text(pages_of(spark, rows)).collect()}
    assert found[3] == "Head 0 Same text 0" and found[100] == "Head 3 Same text 100"


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "no host", "<p>x</p>"), (3, "http://a/", "<p>" + "long " * 50_000), (3, "http://a/", "<p>again")]
    found = sorted((str(r.page_id), r.url, len(r.text)) for r in extract_main_text(pages_of(spark, rows)).collect())
    assert [(page, n) for page, _, n in found] == [("1", 0), ("2", 0), ("3", 5), ("3", 249_999), ("None", 1)]
    assert extract_main_text(pages_of(spark, [])).collect() == []


def test_whole_pages_table(spark):
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    expected = {}
    for row in pages.collect():
        article = row.html[row.html.index("<article>") + 9 : row.html.index("</article>")]
        article = re.sub("</?b>", "", re.sub("</?(?:p|h1|br)>", " ", article))
        expected[row.page_id] = " ".join(html.unescape(article).split())
    assert {r.page_id: r.text for r in extract_main_text(pages).collect()} == expected
