from html.parser import HTMLParser

import pytest

from daymark.llm import html_text
from daymark.llm.common import table
from daymark.llm.html_text import extract

LONG = "A sentence that is long enough to be the text of a page, with commas, and more words."

PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style>
<script>var t="</p><article>x</article>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies. {LONG}</div><!-- <p>old</p> -->
<div id="content-with-sidebar"><article class="post"><header><h1>Title &amp; more</h1></header>
<p>First&nbsp;&#8212; <b>bo</b>ld<br>line.</p><p>Short.</p><div class="ad">Buy this. {LONG}</div>
<p><b>Unclosed<br><p>Next &lt;tag&gt; a &lt b</p><form><input>Mail: <button>Go</button></form>
<ul><li>one<li>two</ul><section id="comments"><p>Nice! {LONG}</p></section>
<footer>By me</footer></article></div><aside><p>Aside. {LONG}</p><article>Teaser</article></aside>
<footer>&copy; 2020</footer></body></html>"""


def test_article():
    assert extract(PAGE) == (
        "Title & more\nFirst — bold line.\nShort.\nUnclosed\nNext <tag> a < b\none\ntwo"
    )


def test_line_blocks_without_an_article():
    page = (
        "<div><a href=x>Home</a></div><div><a href=y>Other page here</a></div>"
        f"<div>Menu text</div><h2>Title</h2><p>{LONG}</p><div>{LONG}</div><p>End.</p>"
        "<div><a href=z>Next</a></div><div><a href=z>More</a></div><div>(c) x</div>"
    )
    got = extract(page).split("\n")
    assert got[-3:] == [LONG, LONG, "End."]
    assert "Title" in got and "Home" not in got and "(c) x" not in got


def test_line_blocks_decide_beside_an_article():
    article = f"<article><p>One {LONG}</p><p>Two {LONG}</p><p>Three {LONG}</p></article>"
    inner = f"One {LONG}\nTwo {LONG}\nThree {LONG}"
    far = "<div><a href=x>Link</a></div>" * 4
    # Text that goes on beside the element, a run far from it, and short lines next to it.
    assert extract(f"{article}<div><p>Four {LONG}</p></div>") == f"{inner}\nFour {LONG}"
    assert extract(f"{article}{far}<div>Four {LONG}</div>") == inner
    assert extract(f"<div>Menu</div>{article}<div>(c) x</div>") == inner
    # An element with little of the text says nothing.
    text = "".join(f"<p>{i} {LONG}</p>" for i in range(20))
    got = extract(f"<div>{text}</div>{far}<article><p>Card {LONG}</p></article>")
    assert got.startswith(f"0 {LONG}\n1 {LONG}\n") and f"19 {LONG}" in got


LINKS = "<div><a href=x>Link</a></div>" * 4


def test_text_goes_on_after_links():
    page = LINKS + f"<p>A {LONG}</p><p>B {LONG}</p>{LINKS}<p>C {LONG}</p>" + LINKS
    assert extract(page) == "\n".join([f"A {LONG}", f"B {LONG}", *["Link"] * 4, f"C {LONG}"])
    linked = f"<p>See <a href=x>{LONG}</a></p>"
    assert extract(f"<p>A {LONG}</p>{linked}<p>B {LONG}</p>") == f"A {LONG}\nSee {LONG}\nB {LONG}"


def test_main_with_a_card():
    text = [f"{i} {LONG}" for i in range(20)]
    body = "".join(f"<p>{x}</p>" for x in text)
    assert extract(f"<main>{body}<article class='card'>A card.</article></main>") == "\n".join([*text, "A card."])


@pytest.mark.parametrize("outer", ["main", "div"])
@pytest.mark.parametrize("between", ["", LINKS])
def test_sibling_articles(outer, between):
    texts = [f"{i} {LONG * n}" for i, n in enumerate((2, 5, 1))]
    page = between.join(f"<article><p>{x}</p></article>" for x in texts)
    links = "Link\n" * between.count("Link")
    assert extract(f"<{outer}>{page}</{outer}>") == f"\n{links}".join(texts)


def test_the_window_decides_beside_an_article(monkeypatch):
    page = f"<article><p>A {LONG}</p></article>" + "<div><a href=x>Link</a></div>" * 4 + f"<div>B {LONG}</div>"
    assert f"B {LONG}" not in extract(page)
    monkeypatch.setattr(html_text.dense_runs, "__defaults__", (8, 80))
    assert f"B {LONG}" in extract(page)


def test_surge_and_dive():
    assert html_text.surge_and_dive([0, 5, 0, 0, 90, 0, 70, 10, 0, 0, 0, 5]) == (4, 8)
    assert html_text.surge_and_dive([5, 0, 3, 4, 0]) == (2, 4)
    assert html_text.surge_and_dive([]) == (0, 0)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<", "<"),
        ("plain", "plain"),
        ("<nav>only a menu</nav>", ""),
        ("<article></article>", ""),
        ("<article>a", "a"),
        ("<nav><ul><li>never closed<article>text</article>", "text"),
        ("<script>never closed <article>text</article>", ""),
        ("<article>a<script/>b</article>", "a b"),
        ('<article><p title="a>b">x</p><p class=\'share\'>y</p></article>', "x"),
        ('<article><a href="x>never closed</a></article>', '<a href="x>never closed'),
    ],
)
def test_odd_pages(page, text):
    assert extract(page) == text


@pytest.mark.parametrize(
    "block",
    [
        "<h2 id='related-work'>{}</h2>",
        "<h2 id='search'>{}</h2>",
        "<section id='search-algorithms'><p>{}</p></section>",
        "<section id='cookie-recipes'><p>{}</p></section>",
        "<p class='share-price'>{}</p>",
        "<p class='notice'>" + LONG + "{}</p>",
        "<div class='search-results-explained'><p>{}</p></div>",
    ],
)
@pytest.mark.parametrize("outer", ["article", "main"])
def test_text_named_like_furniture(block, outer):
    page = f"<{outer}><p>{LONG}</p>{block.format('Own text.')}<p>{LONG}</p></{outer}>"
    assert "Own text." in extract(page)


@pytest.mark.parametrize(
    "block",
    [
        "<section id='comments'><p>{}</p></section>",
        "<div class='ad-container'>{}</div>",
        "<div class='share'>Share</div>",
        "<div class='related-posts'><a href=x>{}</a></div>",
        "<p class='social'><a href=x>{}</a></p>",
    ],
)
def test_furniture_inside_the_article(block):
    page = f"<article><p>Text {LONG}</p>{block.format(LONG)}<p>End. {LONG}</p></article>"
    assert extract(page) == f"Text {LONG}\nEnd. {LONG}"


def test_deep_and_long_pages():
    assert extract("<div>" * 2000 + "x" + "</div>" * 2000) == "x"
    long = "<article>" + f"<p>{LONG}</p>" * 5000 + "</article>"
    assert extract(long).count("\n") == 4999


def test_pages(spark):
    rows = [(1, "u", PAGE, 5), (2, None, None, 5), (1, "u", PAGE, 5), (None, "v", "<p>x</p>", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted((tuple(r) for r in html_text.extract_pages(df).collect()), key=str)
    assert got == sorted(((i, u, extract(h)) for i, u, h, _ in rows), key=str)
    assert html_text.extract_pages(df.limit(0)).count() == 0


PARAGRAPH = "This is a paragraph of the article, long enough to be taken for text by its length alone. " * 2
OTHER = "Another paragraph that goes on about the same thing, at the same length as the one before it. " * 2


def article(inner):
    return f"<body><nav><a href=x>menu</a></nav><article><h1>Title</h1><p>{PARAGRAPH}</p>{inner}</article></body>"


@pytest.mark.parametrize(
    "name", ["comment-theory", "ad-history", "cookie-recipes", "newsletter-era", "sidebar-notes-essay", "adTheory"]
)
def test_one_word_of_a_longer_name_excludes_no_text_of_the_article(name):
    for tag in ("section", "div"):
        page = article(f"<{tag} class='{name}'><p>{OTHER}</p></{tag}>")
        assert html_text.extract(page) == f"Title\n{PARAGRAPH.strip()}\n{OTHER.strip()}"


@pytest.mark.parametrize("name", ["comments", "comments-area", "comment-list", "ad", "ad-slot", "adBox", "cookie-bar"])
def test_names_of_nothing_but_furniture_exclude(name):
    page = article(f"<section class='{name}'><p>{OTHER}</p></section>")
    assert html_text.extract(page) == f"Title\n{PARAGRAPH.strip()}"


def test_formulas_and_sources_of_quotations_stay():
    page = article(
        "<p>Euler wrote <math><mi>e</mi><mo>=</mo><mn>2.718</mn><annotation>e=2.7</annotation></math> here.</p>"
        f"<blockquote><p>{OTHER}</p><footer>Euler, Letters</footer></blockquote><footer>Filed under maths</footer>"
    )
    text = html_text.extract(page).split("\n")
    assert text[2:] == ["Euler wrote e=2.718 here.", OTHER.strip(), "Euler, Letters"]


@pytest.mark.parametrize("heading", ["Comments", "3 comments", "Reader comments (12)", "Leave a reply", "Responses:"])
def test_unnamed_comment_sections_go(heading):
    behind = f"<section><h2>{heading}</h2><p>{OTHER}</p><div>{OTHER}</div></section>"
    expected = f"Title\n{PARAGRAPH.strip()}"
    assert html_text.extract(article("").replace("</article>", f"</article>{behind}")) == expected
    plain = f"<body><h1>Title</h1><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p>{behind}</body>"
    assert html_text.extract(plain) == "\n".join(["Title", *[PARAGRAPH.strip()] * 3])
    # Inside the article it is a heading like others.
    page = article(f"<h2>{heading}</h2><p>{OTHER}</p>")
    assert html_text.extract(page) == f"Title\n{PARAGRAPH.strip()}\n{heading}\n{OTHER.strip()}"


def test_lines_of_copyright_go():
    line = "© 2024 Example Press and its licensors, of some town and another one, in most countries of the world. All rights reserved."
    body = f"<body><h1>Title</h1><p>{PARAGRAPH}</p><p>{OTHER}</p>"
    expected = f"Title\n{PARAGRAPH.strip()}\n{OTHER.strip()}"
    assert html_text.extract(f"{body}<div>{line}</div></body>") == expected
    assert html_text.extract(f"{body}<div>x</div><div>{line}</div><div>(c) Example</div></body>") != ""
    # A paragraph about copyright is text.
    about = "Copyright law protects works of the mind, and has done so for some three hundred years, in most places."
    assert html_text.extract(f"{body}<p>{about}</p></body>") == f"{expected}\n{about}"


class Tree(HTMLParser):
    """The blocks of article elements, by a parsed tree, without the furniture inside."""

    FURNITURE = {"nav", "aside", "footer", "form", "script", "style", "header", "noscript", "template"}
    VOID = {"br", "img", "hr", "input", "meta", "link"}

    def __init__(self, page):
        super().__init__()
        self.open, self.blocks, self.text = [], [], ""
        self.feed(page)
        self.close()
        self.end()

    def end(self):
        joined = " ".join(self.text.split())
        if joined:
            self.blocks.append(joined)
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag in html_text.BLOCKS:
            self.end()
            if "p" in [t for t, _ in self.open]:
                while self.open.pop()[0] != "p":
                    pass
        if tag == "br":
            self.text += " "
        if tag not in self.VOID:
            classes = set((dict(attrs).get("class") or "").split())
            self.open.append((tag, tag in self.FURNITURE or bool(classes & {"ad", "comments", "notice"})))

    def handle_endtag(self, tag):
        if tag in html_text.BLOCKS:
            self.end()
        if tag in [t for t, _ in self.open]:
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        names = [t for t, _ in self.open]
        if "article" in names and not any(gone for _, gone in self.open):
            self.text += data


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_all_pages_against_a_parsed_tree(spark, sf):
    """Every given page has one article; its blocks by the standard library's parser are the text."""
    pages = table(spark, f"/root/testdata/{sf}", "pages")
    found = {r.page_id: r.text for r in html_text.extract_pages(pages).collect()}
    html = {r.page_id: r.html for r in pages.collect()}
    assert found.keys() == html.keys()
    wrong = [k for k, page in html.items() if found[k] != "\n".join(Tree(page or "").blocks)]
    assert not wrong, (wrong[:5], found[wrong[0]][-300:], Tree(html[wrong[0]]).blocks[-2:])
