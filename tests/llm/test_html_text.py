from __future__ import annotations

import html
import os
import re
import time

import pytest

from ledgerloom.llm import html_text

SCHEMA = "page_id long, url string, html string, text string, words int"
TESTDATA = os.environ.get("LEDGERLOOM_TESTDATA", "/root/testdata")


def main(page):
    return html_text.main_text(page, html_text.default_tree())


def test_the_tree_fits_its_table():
    for *features, label in html_text.LABELLED:
        assert html_text.is_text(html_text.default_tree(), tuple(features)) == bool(label)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>if (a<b) "</p>"</script></head><body>
<header><a href="/">Home</a> <p>The daily something and its long slogan that goes on for many words indeed</p></header>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav><!-- <p>hidden</p> -->
<div class="cookie-notice">We use cookies and this text about them is fairly long, so that length alone won't do.</div>
<article class="post"><h1>A &amp; B</h1><p>First   paragraph<br>goes&nbsp;on &#8211; with <a href="x">a link</a>.
<p><b>Second</b>, unclosed<div class="ad">Buy this now, a very good offer for everyone who reads this far</div><p>Yes.</p>
<ul><li>point one<li>point two</ul><form><label>Mail</label><input name="q"><button>Send</button></form></article>
<aside>Other things to read in this place, many of them</aside>
<section id="comments"><h2>Comments</h2><p>I like this article very much and want to say so at some length here.</p></section>
<footer>&copy; somebody, all rights reserved and so on and so forth</footer></body></html>"""


def test_article():
    assert main(PAGE) == "A & B\nFirst paragraph goes on – with a link.\nSecond, unclosed\nYes.\npoint one\npoint two"


def test_without_semantic_tags():
    long = " ".join(["word"] * 40)
    page = f"<div><a href=1>Home</a></div><div><a href=2>News</a></div><div>{long}</div><div>Short one.</div><div>{long} end</div><div><a href=3>More</a></div>"
    assert main(page) == f"{long}\nShort one.\n{long} end"


@pytest.mark.parametrize("page", ["", "<", "<p", "a < b", "<!-- open", "<script>x", "<p class='a\"b'>", "</div></div>", "<p>" * 3000, "&#0;&bogus;&amp"])
def test_broken_markup_ends(page):
    assert isinstance(main(page), str)


def test_test_pages(spark):
    """The pages' articles, cut out by their own markers."""
    rows = spark.read.parquet(f"{TESTDATA}/sf0.001/pages.parquet")
    found = {r["page_id"]: r["text"] for r in html_text.extract_text(rows).collect()}
    for row in rows.collect():
        article = re.search(r"<article>(.*?)</article>", row["html"], re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h1|h2|ul|li|div)\b[^>]*>", article)
        texts = [" ".join(html.unescape(re.sub(r"<br>", " ", p)).replace("<b>", "").replace("</b>", "").split()) for p in parts]
        assert found[row["page_id"]] == "\n".join(t for t in texts if t)


def test_edge_cases(spark):
    long = "<p>" + "many words here " * 50_000 + "</p>"
    rows = [(1, "u", None, "old", 1), (2, None, "", None, None), (None, "u", "<article><p>x</p></article>", "old", 2), (3, "u", long, "", 3), (3, "u", long, "", 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = html_text.extract_text(df)
    assert found.columns == ["page_id", "url", "words", "text"]
    assert sorted((r["page_id"] or 0, len(r["text"])) for r in found.collect()) == [(0, 1), (1, 0), (2, 0), (3, 799_999), (3, 799_999)]
    assert html_text.extract_text(df.limit(0)).collect() == []


TEXT = " ".join(["word"] * 40)


@pytest.mark.parametrize("long", ["style='" + "color: red; " * 300 + "'", 'data-x="' + "<p class=ad> " * 300 + '"'])
def test_long_attributes(long):
    assert main(f"<p>{TEXT}</p><div {long} class=sidebar>{TEXT} aside</div><p>{TEXT} end</p>") == f"{TEXT}\n{TEXT} end"
    assert main(f"<p>{TEXT}</p><div {long} hidden>{TEXT} aside</div><p>{TEXT} end</p>") == f"{TEXT}\n{TEXT} end"
    assert main(f"<div {long} itemprop=articlebody><p>one</p><p>two</p></div>") == "one\ntwo"
    assert main(f"<div {long}>{TEXT}</div>") == TEXT


@pytest.mark.parametrize("tag", ["video-player", "map-view", "button-group", "object:x"])
def test_custom_elements_are_read(tag):
    assert main(f"<article><{tag} src=x></{tag}><p>body one two</p><{tag}>inside</{tag}></article>") == "body one two\ninside"


@pytest.mark.parametrize("tag", ["button", "object", "map", "video", "svg"])
def test_unread_elements_without_an_end(tag):
    assert main(f"<article><p>one two</p><{tag} a=b><p>three</p><{tag}><p>four</p></article>") == "one two\nthree\nfour"
    assert main(f"<article><{tag}>not read</{tag.upper()} ><p>three</p></article>") == "three"


@pytest.mark.parametrize("tag", ["script", "style", "title", "textarea"])
def test_elements_that_take_the_rest_of_the_page(tag):
    assert main(f"<article><p>one two</p><{tag}><p>three</p></article>") == "one two"


@pytest.mark.parametrize("name", ["has-sidebar", "with-nav page", "layout no-comments", "hasSidebar"])
def test_wrappers_that_only_mention_a_word(name):
    assert main(f"<div class='{name}'><p>{TEXT}</p><div class='sidebar'>{TEXT} aside</div><p>{TEXT} end</p></div>") == f"{TEXT}\n{TEXT} end"


@pytest.mark.parametrize(
    "page",
    ["<svg " * 200_000, '<a b="' * 160_000, '<a b="' * 160_000 + ">", "<div>" * 200_000 + "x" + "</p>" * 200_000, "<b>" * 100_000 + "</i>" * 100_000, "<!-- " * 200_000, "<script>" * 100_000,
     '<a x=">"' * 100_000 + "='", "<" * 1_000_000, "<p>" * 300_000, "<svg>" * 200_000, "&amp" * 250_000, "</" * 500_000],
)
def test_a_megabyte_of_broken_markup_takes_seconds(page):
    begin = time.perf_counter()
    main(page)
    assert time.perf_counter() - begin < 8  # about one second; the time of a quadratic reader is hours


def words(n, k=0):
    return " ".join(f"w{k}x{i}" for i in range(n))


ARTICLES = [
    '<article class="post comments-open">{}</article>',
    '<article id="notice-of-race">{}</article>',
    '<article class="type-post category-notices tag-social-media">{}</article>',
    '<main class="layout-sidebar-right">{}</main>',
    '<main id="main" class="site-main with-banner">{}</main>',
    '<form id="aspnetForm" action="x"><article>{}</article></form>',
    '<form><div class="page"><main>{}</main></div></form>',
    '<div class="content-with-sidebar"><article>{}</article></div>',
    '<body class="has-sidebar comments-open"><article>{}</article></body>',
    '<div class="page-header-layout"><article>{}</article></div>',
]


@pytest.mark.parametrize("layout", ARTICLES)
def test_articles_whose_names_mention_other_things(layout):
    inner = f"<h1>{words(5)}</h1><p>{words(30, 1)}</p><p>{words(3, 2)}</p><ul><li>{words(2, 3)}</li></ul>"
    expected = "\n".join([words(5), words(30, 1), words(3, 2), words(2, 3)])
    menu = '<nav><a href="/">Home</a></nav>'
    assert main(f"{menu}{layout.format(inner)}<footer>{words(20, 4)}</footer>") == expected


NAMED_APART = ["sidebar", "sidebar-left", "site-footer", "main-nav", "cookie-notice", "ad-slot", "comment-list", "related-posts-widget", "social-share", "newsletterSignup", "nav_bar login", "promo-box"]


@pytest.mark.parametrize("name", NAMED_APART)
def test_what_names_itself_something_else(name):
    page = f"<article><p>{words(30)}</p></article><div class='{name}'><p>{words(40, 1)}</p></div>"
    assert main(page) == words(30)
    assert main(f"<div><p>{words(30)}</p><p>{words(35, 2)}</p><div class='{name}'><p>{words(40, 1)}</p></div></div>") == f"{words(30)}\n{words(35, 2)}"


LENGTHS = [[12] * 12, [9] * 12, [20] * 6, [30, 5, 12, 40, 8, 25, 6, 33, 15], [60], [25, 25], [14, 9, 11, 16, 8, 10], [45, 3, 50], [80, 1, 70, 2, 90], [18, 22, 19]]
FRAMES = [
    "<div class='menu'><a href='/a'>One</a></div>{}<div class='footer'>some rights reserved by somebody</div>",
    "<ul><li><a href='/a'>One</a></li><li><a href='/b'>Two things</a></li></ul>{}<p><a href='/c'>More</a></p><p><a href='/d'>Still more</a></p>",
    "<table><tr><td><a href='/'>Home</a></td><td><a href='/n'>News</a></td></tr></table>{}<hr><a href='/up'>Up</a>",
]


@pytest.mark.parametrize("frame", FRAMES)
@pytest.mark.parametrize("lengths", LENGTHS)
@pytest.mark.parametrize("tag", ["p", "div"])
def test_pages_without_markers_are_decided_by_neighbours(tag, lengths, frame):
    texts = [words(n, k) for k, n in enumerate(lengths)]
    page = f"<html><body>{frame.format(''.join(f'<{tag}>{t}</{tag}>' for t in texts))}</body></html>"
    assert main(page) == "\n".join(texts)


def test_a_page_wide_form_without_an_article():
    texts = [words(40), words(28, 1), words(55, 2)]
    page = f"<form id='aspnetForm'><a href='/'>Home</a><div>{''.join(f'<p>{t}</p>' for t in texts)}</div></form>"
    assert main(page) == "\n".join(texts)
    assert main(f"<article><p>{words(30)}</p></article><form><label>Your name</label><p>Send us a message</p></form>") == words(30)


def test_links_and_formulas_in_an_article():
    links = "".join(f"<li><a href='{k}'>{words(2, k)}</a></li>" for k in range(6))
    assert main(f"<article><p>{words(20)}</p><ul>{links}</ul></article>") == "\n".join([words(20), *(words(2, k) for k in range(6))])
    assert main("<article><p>where <math><mi>a</mi><mo>=</mo><mn>2</mn><annotation>a=2</annotation></math> holds</p></article>") == "where a=2 holds"


def test_quotes_in_odd_places():
    assert main("<article><p don't>it's <b title='x>y'>bold</b></p><a href=\"open>link</a><p>two</p></article>").startswith("it's bold")
