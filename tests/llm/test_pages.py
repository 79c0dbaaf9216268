"""Main text of pages: the given pages by a plain rule, other layouts by hand."""

import html
import re

import pytest

from millrace.llm import catalog, pages

SF = "/root/testdata/sf0.01"


def by_rule(page):
    """The given pages mark their article; its headings and paragraphs are the text."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    out = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", part)).split()) for part in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(part for part in out if part)


def test_query_against_rule(spark):
    given = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = catalog.QUERIES["op5_extract_text"](spark, SF).collect()
    assert len(rows) == len(given)
    for row in rows:
        assert row.text == by_rule(given[row.page_id].html)
        assert row.url == given[row.page_id].url and row.n_chars == len(row.text)


LAYOUTS = {
    "named containers": (
        """<body class="has-sidebar"><header><h1>Site</h1><p>A slogan of the whole site, long enough to read.</p></header>
        <div id="cookie-notice"><p>We use cookies to make this page work for all of you.</p></div>
        <main><article><header><h1>Title &amp; more</h1></header><p>First&nbsp;para<b>graph</b>.<br>Next   line.</p>
        <aside><p>See also these other things that we wrote.</p></aside><p>End.</p>
        <div class="adBox"><p>Buy now.</p></div></article></main>
        <section class="comments"><article class="comment"><p>I do not agree with this at all, and I say so.</p></article></section>
        <form action="/s"><label>Mail</label><button>Send</button></form><footer><p>&copy; Us</p></footer>""",
        "Title & more\nFirst paragraph. Next line.\nEnd.",
    ),
    "no article": (
        """<div class=menu><a href=/>Home</a> <a href=/b>News</a></div><div><h2>A heading of the text</h2>
        <div>""" + "word " * 40 + """</div><div>""" + "text " * 30 + """</div></div>
        <ul><li><a href=x>One</a><li><a href=y>Two</a><li><a href=z>Three</a></ul>""",
        "A heading of the text\n" + ("word " * 40).strip() + "\n" + ("text " * 30).strip(),
    ),
    "broken": (
        """<ARTICLE><P>One <i>two<P title="a > b">three &lt;b&gt; &am &amp x<script>var t="</p>";</script> four
        <!-- <p>no</p> --><p>five</div></p></section>six<style>p{}</style></article><p>after<a hre""",
        "One two\nthree <b> &am & x four\nfive\nsix",
    ),
    "nothing": ("<nav><a href=a>a</a></nav>", ""),
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts(layout):
    page, expected = LAYOUTS[layout]
    assert pages.main_text(page) == expected


def test_tree_knows_its_table():
    assert all(pages.is_main(tuple(row[:-1])) == bool(row[-1]) for row in pages.LABELLED)


def test_unusual_rows(spark):
    long = "<article>" + "<p>word</p>" * 100_000
    rows = [(1, None, "x"), (2, "", "x"), (3, long, "x"), (3, long, "x"), (None, "<p", None), (4, '<p a="' + "x" * 10**6, None)]
    given = spark.createDataFrame(rows, "page_id long, html string, text string")
    found = pages.extract(given).collect()
    assert [r.text for r in found[:2]] == ["", ""] and found[2].text == found[3].text
    assert found[2].text.count("\n") == 99_999 and found[4].text == ""
    assert pages.extract(given.limit(0)).count() == 0


def test_quotes_outside_of_values():
    page = "<article><p title=Bob's>first</p><p>Ann's > second</p><p title=\"a > b\" x='>'>third</p></article>"
    assert pages.main_text(page) == "first\nAnn's > second\nthird"
    assert pages.main_text("<article><p title=\"never closed>first</p><p>second</p></article>") == "first\nsecond"
    assert pages.main_text("<article><p>kept</p><p class=cut") == "kept"


def test_hostile_pages_take_linear_time():
    import time

    begun = time.perf_counter()
    for page in ("<noscript>" * 500_000, "<div>" * 500_000 + "</section>" * 500_000, "<a title='" * 400_000, "<!-" * 1_000_000, "<p =" * 800_000):
        pages.blocks(page)
    assert time.perf_counter() - begun < 60
