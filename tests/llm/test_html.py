import os

import pytest

from tenura.llm import html_text

TREE = html_text.grow_tree(html_text.LABELLED)
SF = "/root/testdata/sf0.001"
PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></ul></nav><div id="cookie-notice">We use cookies</div>
<main><article><header><h1>Title &eacute;</h1></header><p>One&nbsp;two <b>three</b><br>four<p>Five &lt;six&gt;
<ul><li>a<li><a href="/b>c">b</a></ul><div class="ad">Buy</div><form><label>Mail</label><input></form>
<!-- <p>no</p> --><section id="comments"><article class="comment"><p>Nice post</p></article></section>
</article></main><aside>Side</aside><footer>c</footer>"""


def text(page):
    return html_text.main_text(page, TREE)


def test_the_tree_fits_its_table():
    assert all(html_text.is_text(TREE, row[:-1]) == bool(row[-1]) for row in html_text.LABELLED)


def test_article_without_furniture():
    assert text(PAGE) == "Title é\n\nOne two three four\n\nFive <six>\n\na\n\nb"


def test_page_without_an_article():
    long = "many plain words " * 10
    page = f"<ul><li><a href=1>Home</a><li><a href=2>News</a></ul><p>{long}</p><p>{long}</p><div><a href=3>x</a></div>"
    assert text(page) == "\n\n".join([long.strip()] * 2)


@pytest.mark.parametrize("page, expected", [("", ""), ("a < b", "a < b"), ("<article><p>x", "x"), ("<article><p>x<!-- y", "x"), ("<article><script>x", ""), ("<article><p title='a>b'>hi", "hi"), ("<article><h2></h2> &#x41;&amp;amp;", "A&amp;")])
def test_odd_pages(page, expected):
    assert text(page) == expected


LONG = " ".join(["many plain words of a page"] * 8)


@pytest.mark.parametrize("open_, close", [
    ('<html class="no-sidebar"><body class="right-sidebar single-post" id="search">', "</body></html>"),
    ('<div class="content has-header">', "</div>"), ('<div class="right-sidebar"><div><article>', "</article></div></div>"),
    ('<div id="menu"><main>', "</main></div>"), ('<form action="x">', "</form>"), ('<form><div class="content-sidebar">', "</div></form>"),
    ('<main><form id="form1">', "</form></main>"), ('<div class="right-sidebar">', "</div>"),
])
def test_wrappers_around_a_page_are_no_furniture(open_, close):
    page = f'{open_}<nav>a b c</nav><h1>Title words</h1><p>{LONG}</p><div class="cookie-notice">We use cookies</div><p>{LONG}</p><div id="footer">Legal</div>{close}'
    assert text(page) == f"Title words\n\n{LONG}\n\n{LONG}"


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main>%s</main>"])
def test_names_of_headings_and_paragraphs_in_an_article(around):
    page = (
        f'<h2 id="search-methods">Search methods</h2><p id="notice-3">{LONG}</p><h2 id="social-history">Social history</h2>'
        f'<section id="form-and-function"><h3 id="comments" class="notice">Comments on it</h3><p class="share">{LONG}</p></section>'
        '<p class="ad">Buy</p><div class="ad-slot">Buy</div><section id="comments"><p>Nice</p></section><div class="entry-footer">by me</div>'
    )
    assert text(around % page) == f"Search methods\n\n{LONG}\n\nSocial history\n\nComments on it\n\n{LONG}"


def test_furniture_beside_an_article_stays_furniture():
    page = (
        f'<article><h1>Title</h1><p>Short</p><form><p>{LONG}</p><article class="comment">{LONG}</article></form></article>'
        .replace("<form>", '<div id="comments">').replace("</form>", "</div>")
        + f'<div class="left-sidebar"><h2>More</h2><p>{LONG} {LONG}</p></div><aside><article>{LONG}</article></aside><form><label>Mail</label></form>'
    )
    assert text(page) == "Title\n\nShort"


def test_only_an_article_or_what_holds_most_words_makes_the_rest_lost():
    page = '<h1 class="entry-title">T</h1><div class="%s"><p>x y</p><p>' + LONG + "</p></div>"
    assert text(page % "content") == text(page % "post-content") == f"T\n\nx y\n\n{LONG}"
    assert text(f'<div class="post"><p>{LONG}</p><div>z</div></div><div>a b</div>') == f"{LONG}\n\nz"
    assert text(f'<div class="story">Teaser</div><h2>Head</h2><p>{LONG}</p>') == f"Teaser\n\nHead\n\n{LONG}"


def test_long_blocks_beside_an_article_are_text():
    page = f"<article><h1>T</h1><p>x</p></article><div><p>{LONG}</p></div><div>a b</div><div><a href=1>{LONG}</a></div>"
    assert text(page) == f"T\n\nx\n\n{LONG}"


@pytest.mark.parametrize("end", ["<footer><a href=1>Imprint</a></footer>", "<div><a href=1>Imprint</a></div>", ""])
def test_short_lines_and_linked_headings_without_an_article(end):
    page = f"<nav><a href=1>Home</a></nav><h1><a href=2>Linked title</a></h1><p>{LONG}</p><h2><a href=3>Part</a></h2><p>{LONG}</p><p>The end.</p>{end}"
    assert text(page) == f"Linked title\n\n{LONG}\n\nPart\n\n{LONG}\n\nThe end."
    assert text(f"<nav><a href=1>Home</a></nav><p>Hello there</p>{end}") == "Hello there"
    links = "<ul><li><a href=1>One</a><li><a href=2>Two</a></ul>"
    assert text(f"{links}<p>or</p>{links}<p>{LONG}</p>{links}{end}") == LONG


def test_neighbours_are_real_splits():
    used, nodes = set(), [TREE]
    while nodes:
        node = nodes.pop()
        if not isinstance(node, int):
            used.add(node[0])
            nodes += node[2:]
    assert {0, 1, 3, 5} <= used  # words, density, densities before and after


@pytest.mark.parametrize("name", [
    "reader-comments", "user-comments", "discussion-thread", "comment-stream", "cc-cookie-banner", "promo-large",
    "leaderboard-ad", "userComments", "mid_article_ad", "yui-newsletter-signup",
])
def test_names_with_words_not_listed(name):
    inside = f'<article><h1>Title</h1><p>{LONG}</p><div class="{name}"><p>{LONG}</p></div></article>'
    beside = f'<h1>Title</h1><p>{LONG}</p><p>{LONG}</p><section id="{name}"><p>{LONG}</p></section>'
    assert text(inside) == f"Title\n\n{LONG}"
    assert text(beside) == f"Title\n\n{LONG}\n\n{LONG}"


@pytest.mark.parametrize("name", [
    "no-ads", "content-with-newsletter", "ad-free", "discussion", "discussion-section", "thread", "search-methods",
    "comments-on-method", "has-cookie-banner", "large", "reader",
])
def test_names_that_are_no_furniture(name):
    assert text(f'<article><h1>Title</h1><section class="{name}"><p>{LONG}</p></section></article>') == f"Title\n\n{LONG}"


def test_deep_headings():
    deep = "<div>" * 9 + "<a href=1>Linked title</a>" + "</div>" * 9
    page = f"<nav><a href=1>Home</a></nav><h1>{deep}</h1><p>{LONG}</p><h2>Open<p>{LONG}</p><h3>Next</h3><p>{LONG}</p>"
    assert text(page) == "\n\n".join(["Linked title", LONG, "Open", LONG, "Next", LONG])


def test_table(spark, rows):
    data = [(1, "u", PAGE, "clash"), (2, None, None, "clash"), (None, "v", "", "clash"), (1, "u", PAGE, "clash"), (3, "w", "<article>" + "<p>x y</p>" * 50_000, "clash")]
    pages = rows("page_id long, url string, html string, text string", data)
    got = html_text.extract_text(pages).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert {(r["page_id"], r["url"], r["text"]) for r in got if r["page_id"] != 3} == {(1, "u", text(PAGE)), (2, None, ""), (None, "v", "")}
    assert next(r["text"] for r in got if r["page_id"] == 3) == "\n\n".join(["x y"] * 50_000)
    assert html_text.extract_text(rows("page_id long, url string, html string", [])).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_test_pages(spark):
    import re
    from html import unescape

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for row in html_text.extract_text(pages).collect():
        body = re.search(r"<article>(.*?)</article>", source[row["page_id"]], re.S)[1]
        parts = [" ".join(unescape(re.sub("<[^>]+>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", body)]
        assert row["text"] == "\n\n".join(p for p in parts if p)
