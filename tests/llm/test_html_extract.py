"""Main text of pages: an independent reading of the test pages, and hand-written cases."""

from __future__ import annotations

import re
import time
from html import unescape

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm.html_extract import extract_text
from tests.conftest import SF_ORACLE


def article_of(page):
    """The pages of the test table: blocks between the tags of their one article."""
    inner = re.search(r"<article>(.*?)(?:</article>|<footer>)", page, re.S)[1]
    blocks = [" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1|article)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_whole_table_against_an_independent_reading(spark):
    from tallyframe.llm.queries import op3_html_extraction

    got = {r["page_id"]: r for r in op3_html_extraction(spark, SF_ORACLE).collect()}
    pages = duckdb.sql(f"SELECT page_id, html, url FROM '{SF_ORACLE}/pages.parquet'").fetchall()
    assert len(got) == len(pages)
    for page_id, html, url in pages:
        want = article_of(html)
        assert (got[page_id]["text"], got[page_id]["n_chars"], got[page_id]["url"]) == (want, len(want), url)


LONG = "A paragraph with some length, a few commas, and enough words to count."
CASES = {
    "plain text": "plain text",
    "<p>a < b &lt; c &amp;amp; d<p>next&nbsp;block": "a < b < c &amp; d\nnext block",
    f"<div id=nav-bar><p>{LONG}</p></div><div><h2>T</h2><p>{LONG}</p></div>": f"T\n{LONG}",
    f"<article><header><h1>T</h1></header><div class=body><p>{LONG}</p></div><section class='user-comments'><p>{LONG}</p></section></article>": f"T\n{LONG}",
    f"<body><header><h1>Site</h1></header><main><p>{LONG}</p><aside>{LONG}</aside><form>{LONG}</form></main><footer>{LONG}</footer>": LONG,
    f"<div class='page-header'>x</div><article><div class='entry-header'><h2>T</h2></div><p>{LONG}</p></article>": f"T\n{LONG}",
    f"<div class='cookieNotice'>{LONG}</div><p>{LONG}</p>": LONG,
    f"<div class='adipose shadow'><p>{LONG}</p></div>": LONG,
    f"<div><p>{LONG}<div style='display:none'>x</div></div>": LONG,
    f"<script>var a = '</p><p>no</p>';</script><p>{LONG}</p><style>p {{}}</style><noscript>no</noscript><textarea>no": LONG,
    "<ul><li>a<li>b</ul><table><tr><td>x<td>y<tr><td>z</table>": "a\nb\nx y\nz",
    "<p>one<br>two <b>bo</b>ld\n\t text</p>": "one two bold text",
    f"<div><a href=1>links, links, links, links, links, links</a></div><div><p>{LONG}</p></div>": LONG,
    "<!-- x --><p>a</p><!-- <p>b</p> --><p>c": "a\nc",
    "<p>a</p><!-- never closed <p>b</p>": "a",
    "<P CLASS=x>upper</P>": "upper",
    "<p title='a > b'>q</p>": "q",
    "": "", None: "", "<script>": "", "<p></p> \n": "", "&lt;b&gt;": "<b>",
}


@pytest.mark.parametrize("page", list(CASES), ids=range(len(CASES)))
def test_cases(page):
    assert extract_text(page) == CASES[page]


LEAD = "A lead of one sentence that stands in a part of its own, apart from the text that follows it."
TEXT = "\n".join([LONG] * 6)
SIX = f"<p>{LONG}</p>" * 6
WRAPPED = {
    f"<body><div class=lead><p>{LEAD}</p></div><div class=text>{SIX}</div></body>": f"{LEAD}\n{TEXT}",
    f"<body><div class=text>{SIX}</div><div><p>{LEAD}</p></div></body>": f"{TEXT}\n{LEAD}",
    f"<div><p>{LONG} {LONG}</p></div><div><p>{LEAD}</p></div>": f"{LONG} {LONG}\n{LEAD}",
    f"<div class=title><h1>T</h1></div><div class=text>{SIX}</div>": f"T\n{TEXT}",
    f"<div class=title><h1>T</h1></div><div><div class=text>{SIX}</div></div><div><p>{LEAD}</p></div>": f"T\n{TEXT}\n{LEAD}",
    f"<div>{SIX}</div><div><table><tr><td>one<td>1.00 a kilo<tr><td>two<td>2.00 a kilo</table></div>": f"{TEXT}\none 1.00 a kilo\ntwo 2.00 a kilo",
    # Not article text: links before and after, a title of something else.
    f"<div><h3>Topics</h3><a href=1>{LEAD}</a></div><div>{SIX}</div><div><a href=2>{LEAD}</a></div><div><h3>More</h3></div>": TEXT,
}


@pytest.mark.parametrize("page", list(WRAPPED), ids=range(len(WRAPPED)))
def test_parts_beside_the_best_container_without_an_article_tag(page):
    assert extract_text(page) == WRAPPED[page]


CONTROLS = "<label>Name <input name=q></label><select><option>one</select><button>Send</button>"
FORMS = {
    f"<body><form id=aspnetForm>{CONTROLS}<article><h1>T</h1>{SIX}</article></form></body>": f"T\n{TEXT}",
    f"<body><form id=form1 role=form>{CONTROLS}<main>{SIX}</main></form></body>": TEXT,
    f"<form><div class=nav><a href=1>x</a></div>{CONTROLS}<div><h1>T</h1>{SIX}</div><div class=footer>x</div></form>": f"T\n{TEXT}",
    f"<form><div><p>{LONG}</p></div><div><p>{LEAD}</p></div></form>": f"{LONG}\n{LEAD}",
    f"<main><h1>T</h1><form>{CONTROLS}{SIX}</form></main>": f"T\n{TEXT}",
    f"<article>{SIX}<form>{CONTROLS}<p>{LONG}</p></form></article><form>{SIX * 5}</form>": TEXT,
    f"<div>{SIX}</div><form>{CONTROLS}<p>{LONG}</p></form>": TEXT,
}


@pytest.mark.parametrize("page", list(FORMS), ids=range(len(FORMS)))
def test_forms_around_and_beside_the_text(page):
    assert extract_text(page) == FORMS[page]


LINKS = f"<ul><li><a href=1>{LONG}</a><li><a href=2>{LONG}</a></ul>"
NAMES = {
    f"<article><h2 id='Legal_status'>T</h2><p>{LONG}</p><h2><span id=Discussion>D</span></h2><p>{LONG}</p></article>": f"T\n{LONG}\nD\n{LONG}",
    f"<main><section id='related-work'><p>{LONG}</p></section><section id='discussion'><h2>D</h2><p>We agree.</p></section></main>": f"{LONG}\nD\nWe agree.",
    f"<article><p>{LONG}</p><section id='social-impact'><p>{LONG}</p></section></article>": f"{LONG}\n{LONG}",
    f"<article><p>{LONG}</p><div id='advertising-history'><p>{LONG}</p></div></article>": f"{LONG}\n{LONG}",
    f"<article><p>{LONG}</p><div class='legal-status'><p>{LONG}</p></div></article>": f"{LONG}\n{LONG}",
    f"<article><p>{LONG}</p><div class=notice><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div></article>": "\n".join([LONG] * 4),
    f"<div><h2 id=legal>T</h2>{SIX}<section id='discussion'><p>{LONG}</p></section></div>": f"T\n{TEXT}\n{LONG}",
    f"<div>{SIX}<div id='advertising-history'>{SIX}</div></div>": f"{TEXT}\n{TEXT}",
    # Still left out.
    f"<article><p>{LONG}</p><div id=comments><p>{LONG}</p></div><div class=ad><p>{LONG}</p></div><div class='comment reply'>{SIX}</div></article>": LONG,
    f"<article><p>{LONG}</p><section id=related>{LINKS}</section><div class='related-work'>{LINKS}</div><div class=social>Follow us</div></article>": LONG,
    f"<article><p>{LONG}</p><div class='cookie-bar'><p>{LONG}</p></div><div class='share-buttons'>Share</div><div id=cookieNotice>{LONG[:20]}</div></article>": LONG,
    f"<div>{SIX}<div id='share-bar'><p>{LONG}</p></div><div class='legal-links'>{LONG}</div><h2 class=ad-title>x</h2></div>": TEXT,
}


@pytest.mark.parametrize("page", list(NAMES), ids=range(len(NAMES)))
def test_names_that_may_be_subjects(page):
    assert extract_text(page) == NAMES[page]


@pytest.mark.parametrize("page", ["<div>" * 30_000 + "x", "<" * 50_000, "<a " * 30_000, '<p a="' * 10_000, "<p>" * 50_000 + "x",
                                  "<b>" * 30_000 + "x", "<li>" * 20_000 + "x", "<!-" * 30_000, "</div>" * 50_000, "&" * 100_000])
def test_hostile_pages_take_linear_time(page):
    start = time.process_time()
    extract_text(page)
    assert time.process_time() - start < 5


TAGS = st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<li>", "<ul>", "</ul>", "<a>", "</a>", "<b>", "<td>", "<table>", "</table>", "<br>",
                        "text, more", " ", "&amp;", "<", ">", "<!--", "-->", "<script>", "</script>", "<article>", "</article>", "<h1>"])


@settings(max_examples=300, deadline=None)
@given(st.lists(TAGS, max_size=40).map("".join))
def test_any_markup_gives_clean_blocks(page):
    text = extract_text(page)
    assert all(block and block == " ".join(block.split()) for block in text.split("\n")) or text == ""


def test_rows_and_columns(spark):
    from tallyframe.llm.html_extract import with_main_text

    pages = spark.createDataFrame([(1, None, "t"), (1, None, "t"), (None, "<p>x</p>", "t")], "page_id bigint, html string, text string")
    out, name = with_main_text(pages)
    assert out.columns == [*pages.columns, name]
    assert sorted((r[name], r["text"]) for r in out.collect()) == [("", "t"), ("", "t"), ("x", "t")]
    assert with_main_text(pages.limit(0))[0].count() == 0


SIX = [f"Paragraph {i} tells of rain, wind and tides, of boats that stay in, and of people who mend nets, number {i}." for i in range(6)]


@pytest.mark.parametrize("opening", [
    '<p class="a"">', "<p title=it's>", '<p class="x" data-y="z"">', "<p data-a='b''>", '<p title="a > b">', "<p title=a=b>", '<p ">',
    '<p class = "a" \' >', '<p data-json=\'{"a": ">"}\'>', "<p class=x/>", '<p a="1"b="2">',
])
def test_stray_quotes_end_with_their_tag(opening):
    html = "<body><article>" + "".join(f"{opening}{t}</p>" for t in SIX) + "</article></body>"
    assert extract_text(html) == "\n".join(SIX)


@pytest.mark.parametrize("name", [
    "post with-sidebar", "content-sidebar-wrap", "page nav-closed", "has-sidebar", "no-sidebar layout", "sidebar-left-layout",
    "col-with-ads", "main-nav-open", "menu-collapsed content", "newsletter-page", "page-with-comments", "site-footer-sticky",
])
@pytest.mark.parametrize("inner", ["{}", "<article>{}</article>", "<div><div>{}</div></div>"])
def test_layout_names_do_not_remove_the_text(name, inner):
    body = inner.format("".join(f"<p>{t}</p>" for t in SIX))
    page = (f'<body><div class="menu"><a href="/a">Home</a> <a href="/b">News</a></div><div class="{name}">{body}'
            '<div class="sidebar"><p>Most read this week, by all our readers, and more of it.</p></div></div></body>')
    assert extract_text(page) == "\n".join(SIX)


def test_named_parts_go_where_the_article_stands_elsewhere():
    article = "".join(f"<p>{t}</p>" for t in SIX)
    page = (f'<body><div class="story">{article}</div><div class="sidebar-left-box"><p>{" ".join(SIX)}</p></div>'
            f'<div class="reader-comments"><p>{" ".join(SIX * 3)}</p></div></body>')
    assert extract_text(page) == "\n".join(SIX)


def test_articles_in_wrappers_of_their_own_are_all_kept():
    page = "<body><div>" + "".join(f'<div class="item"><article><p>{t}</p></article></div>' for t in SIX) + "</div></body>"
    assert extract_text(page) == "\n".join(SIX)


def test_formulas_in_an_article_are_text():
    page = f"<article><p>{SIX[0]} Energy is <math><mi>E</mi><mo>=</mo><mn>1</mn></math> here.</p></article>"
    assert extract_text(page) == f"{SIX[0]} Energy is E=1 here."
