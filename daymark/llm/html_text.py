"""Main text of HTML pages by the distribution of text over line blocks.

Markup is stripped into lines, one for each block element with text. Scripts, styles and the
like go with their content, and so do elements that are no article text by their kind (menus,
page headers, footers, sidebars, forms) or by their role. Words of a class or id only exclude with
care (adverts, comments, notices), as text has them too: see ``_named``. Two kinds of furniture have
no name at all: a section of reader comments begins with a heading that says so, beside the text,
and a line of copyright stands at the end of the page. The lengths of the lines that are left, not counting link texts, are summed
over sliding windows. Where a window's sum first rises above a bound is the surge point, where it
last falls below is the dive point, and all lines between are the text, links too. An ``article`` or ``main``
element with most of the text, or several side by side, is a hint: runs that don't meet it are left out, short lines beside it
are no text, and what is met of it is taken whole. Long lines that go on beside it are text. Without
such an element, paragraphs and headings next to the points belong to the text too.

Edge cases: null and empty pages have empty text; unclosed elements end where an outer one does;
the article in an excluded element that holds most of the article's text is not excluded; text without any
block is one line; a page without long lines gives its longest run of lines with text; repeated
rows are rows each; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from daymark.llm.common import own_columns

WINDOW = 3  # lines in a block
SURGE = 80  # characters of a block from which on it is text
BATCH_CHARS = 4_000_000

SCHEMA = "page_id long, url string, text string"

# Elements and attribute words with a meaning on the web.
RAW = frozenset(
    "script style noscript template textarea iframe svg canvas title object annotation annotation-xml".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
EXCLUDED = frozenset("nav aside footer form select button menu dialog audio video head".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption caption".split())
MAINS = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 legend summary".split())
QUOTES = frozenset(["blockquote", "figure"])  # their footer says who is quoted
# Of these an id says where a link leads, not what kind of text it is.
TEXTS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dt figcaption caption".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
    "toolbar".split()
)
SURE_HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense breadcrumb breadcrumbs comment "
    "commentlist comments cookie cookies disqus footer gdpr masthead nav navbar navi newsletter pager "
    "pagination paywall popup sidebar sidebars signin signup sponsored topbar".split()
)
# Words that say what a block is made like, not what it is about.
FORM_WORDS = frozenset(
    "area bar block body bottom box col column container content footer form frame group head header inner "
    "item items left list main module outer panel right row section slot thread top unit wrap wrapper zone".split()
)
HINTS = SURE_HINTS | frozenset(
    "advertising banner consent copyright dialog disclaimer login menu menus modal navigation "
    "notice notices notification overlay promo promoted promotion related recommended "
    "recommendations replies reply respond search share sharing social sponsor sponsors subscribe "
    "subscription teaser toolbar toc widget widgets".split()
)

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>|<|[^<]+",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?", re.DOTALL
)
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")
_COMMENTS = re.compile(
    r"(?:\d+\s+)?(?:(?:reader|user|latest|recent|all)\s+)?(?:comments?|replies|responses|discussion)"
    r"(?:\s*\(?\d+\)?)?\s*:?|(?:leave|post|add|write) a (?:comment|reply)|join the (?:discussion|conversation)",
    re.IGNORECASE,
)
_COPYRIGHT = re.compile(r"\s*(?:©|\(c\)\s|copyright\b)|.*\ball rights reserved\b", re.IGNORECASE)
LONGEST_COPYRIGHT = 300  # of a line that can be no more than that
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Line(NamedTuple):
    text: str
    linked: int  # characters of its links
    prose: bool  # whether its block is a paragraph, a heading or the like
    outside: tuple[int, ...]  # the excluded elements that it lies in
    mains: tuple[int, ...]  # the article and main elements that it lies in
    heading: bool = False


ALWAYS, LINKS_OR_SHORT, LINKS = range(3)  # when an element is excluded


def _named(name: str, classes: str, own_id: str, in_main: bool) -> int | None:
    """When an element is excluded by the words of its class and id; None is never.

    Paragraphs and headings go by a class of nothing but hints, if they are short or links;
    their ids are not looked at. Other blocks go by a class with a sure hint. Inside the article a
    class or id must be nothing but hints and words of form (``comments-area``, not ``comment-theory``
    or ``cookie-recipes``). Hints that are not sure need short text or links besides, or links alone
    if other words stand with them.
    """
    tokens = [
        set(_WORDS.findall(_CAMEL.sub(" ", x).lower()))
        for x in (classes.split() if name in TEXTS else [*classes.split(), own_id])
    ]
    tokens = [x for x in tokens if x & HINTS]
    if not in_main and name not in TEXTS and name != "article" and "header" in _WORDS.findall(
        _CAMEL.sub(" ", f"{classes} {own_id}").lower()
    ):
        return ALWAYS
    if not tokens:
        return None
    whole = [x for x in tokens if x <= HINTS]
    if name in TEXTS:
        return LINKS_OR_SHORT if whole else None
    of_id = set(_WORDS.findall(_CAMEL.sub(" ", own_id).lower()))
    if in_main:
        tokens = [x for x in tokens if x != of_id or x <= HINTS]
        whole = [x for x in whole if x != of_id or x & SURE_HINTS]
    sure = [x for x in tokens if x & SURE_HINTS and (not in_main or x <= HINTS | FORM_WORDS)]
    if name in BLOCKS and sure:
        return ALWAYS
    if whole or tokens and not in_main:
        return LINKS_OR_SHORT if name in BLOCKS else LINKS
    return LINKS if tokens else None


def _excluded(name: str, attributes: str, in_main: bool, quoted: bool = False) -> int | None:
    """When an element is no article text by its kind or its attributes; None is never."""
    if name in EXCLUDED and not (name == "footer" and quoted) or name == "header" and not in_main:
        return ALWAYS
    if not attributes.strip() or name in ("html", "body", "main"):
        return None
    found = {
        m[1].lower(): next((v for v in m.groups()[1:] if v is not None), "")
        for m in _ATTRIBUTE.finditer(attributes)
    }
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return ALWAYS
    if _HIDDEN_STYLE.search(found.get("style", "")):
        return ALWAYS
    if found.get("role", "").lower() in ROLES:
        return ALWAYS
    return _named(name, found.get("class", ""), found.get("id", ""), in_main)


def lines(page: str) -> tuple[list[Line], set[int], dict[int, set[int]], dict[int, int]]:
    """The lines of a page, the numbers of its article elements, and for each excluded element
    the article and main elements inside and when it is excluded."""
    out: list[Line] = []
    stack: list[tuple[str, int | None, int | None]] = []  # name, excluded element, main element
    text: list[str] = []
    linked, links, number = 0, 0, 0
    articles: set[int] = set()
    inside: dict[int, set[int]] = {}
    when: dict[int, int] = {}
    prose = heading = False

    def end_line() -> None:
        nonlocal text, linked
        joined = " ".join("".join(text).split())
        if joined:
            outside = tuple(x for _, x, _ in stack if x is not None)
            mains = tuple(x for _, _, x in stack if x is not None)
            out.append(Line(joined, linked, prose, outside, mains, heading))
        text, linked = [], 0

    def close(depth: int) -> None:
        nonlocal links
        links -= sum(name == "a" for name, _, _ in stack[depth:])
        del stack[depth:]

    at, end = 0, len(page)
    while at < end:
        m = _PIECE.match(page, at)
        at = m.end()
        name = m[2]
        if name is None:
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                decoded = entities.unescape(piece)
                text.append(decoded)
                if links:
                    linked += len(decoded.strip())
            continue
        name = name.lower()
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if name in BLOCKS:
                end_line()
                prose = heading = False
            if depth is not None and (name in BLOCKS or not any(x[0] in BLOCKS for x in stack[depth:])):
                close(depth)
            continue
        if name in RAW:
            # Everything up to the end tag is no markup.
            found = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(page, at)
            if not m[3].endswith("/"):
                at = found.end() if found else end
            if name != "title":
                text.append(" ")
            continue
        if name in BLOCKS:
            end_line()
            # A block inside a paragraph, and an item after an item, end that.
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or name in ("li", "option", "td", "th", "tr", "dd", "dt") and stack[i][0] == name:
                    close(i)
                    break
                if stack[i][0] in BLOCKS:
                    break
            prose, heading = name in PROSE, name in HEADINGS
        elif name == "br":
            text.append(" ")
        if name in VOID:
            continue
        number += 1
        in_main = any(x is not None for _, _, x in stack)
        kind = _excluded(name, m[3], in_main, name == "footer" and any(x[0] in QUOTES for x in stack))
        excluded = number if kind is not None else None
        main = number if name in MAINS and kind != ALWAYS else None
        if main is not None:
            if name == "article":
                articles.add(number)
            for _, outer, _ in stack:
                if outer is not None:
                    inside[outer].add(number)
        if excluded is not None:
            inside[number] = set()
            when[number] = kind
        if m[3].endswith("/") and name not in BLOCKS:
            continue  # <x/>
        links += name == "a"
        stack.append((name, excluded, main))
    end_line()
    return out, articles, inside, when


def dense_runs(lengths: list[int], window: int = WINDOW, least: int = SURGE) -> list[tuple[int, int]]:
    """From each surge to its dive: the first line and the one after the last, by the lines' lengths."""
    n = len(lengths)
    sums, total = [], 0
    for i in range(n):
        total += lengths[i] - (lengths[i - window] if i >= window else 0)
        sums.append(total)  # of the block that ends with line i
    found, run = [], None
    for i in range(n + 1):
        dense = i < n and sums[i] >= least
        if dense and run is None:
            run = i
        elif not dense and run is not None:
            first = max(0, run - window + 1)
            last = i  # the block of line i is the first one that is too short
            while first < last and not lengths[first]:
                first += 1
            while last > first and not lengths[last - 1]:
                last -= 1
            found.append((first, last))
            run = None
    return found


def surge_and_dive(lengths: list[int], window: int = WINDOW, least: int = SURGE) -> tuple[int, int]:
    """The first line and the one after the last of the text, by the lines' lengths."""
    runs = dense_runs(lengths, window, least)
    if runs:
        return runs[0][0], runs[-1][1]
    best, first, n = (0, 0, 0), 0, len(lengths)
    for i in range(n + 1):
        if i == n or not lengths[i]:
            best = max(best, (sum(lengths[first:i]), first, i))
            first = i + 1
    return best[1], best[2]


def _hinted(kept: list[Line], lengths: list[int], articles: set[int]) -> list[int | None]:
    """The article or main element that each line lies in, if they hold most of the page's text.

    All outermost ones count, side by side; of a ``main`` most of whose text lies in articles, these.
    """
    own: dict[int, int] = {}
    within: dict[int, int] = {}  # of a main element, in its articles
    for line in kept:
        for x in line.mains[:1]:
            own[x] = own.get(x, 0) + len(line.text)
            if len(line.mains) > 1 and line.mains[1] in articles:
                within[x] = within.get(x, 0) + len(line.text)

    def hint(mains: tuple[int, ...]) -> int | None:
        if not mains or mains[0] in articles or 2 * within.get(mains[0], 0) <= own[mains[0]]:
            return mains[0] if mains else None
        return mains[1] if len(mains) > 1 and mains[1] in articles else None

    hints = [hint(line.mains) for line in kept]
    if 2 * sum(n for n, x in zip(lengths, hints) if x is not None) >= sum(lengths):
        return hints
    return [None] * len(kept)


def _hinted_points(kept: list[Line], lengths: list[int], hints: list[int | None]) -> tuple[int, int]:
    """Surge and dive on a page whose text is mostly in ``hints``.

    Of several runs those that meet the elements count; lines beside an element that are in a run
    only because its window reaches past the element don't; an element that is met is taken whole.
    """
    runs = [x for x in dense_runs(lengths) if any(y is not None for y in hints[x[0] : x[1]])]
    if not runs:  # all short, or links
        inside = [i for i, x in enumerate(hints) if x is not None]
        return inside[0], inside[-1] + 1
    first, last = runs[0][0], runs[-1][1]

    def beside(i: int) -> bool:
        return hints[i] is None and lengths[i] < SURGE and not (kept[i].prose and kept[i].mains)

    while beside(first):
        first += 1
    while beside(last - 1):
        last -= 1
    met = {x for x in hints[first:last] if x is not None}
    inside = [i for i, x in enumerate(hints) if x in met]
    return min(first, inside[0]), max(last, inside[-1] + 1)


def _without_unnamed(kept: list[Line]) -> list[Line]:
    """The lines without reader comments and copyright that no element names.

    Comments go from their heading to the next article or main element, where they lie beside such
    elements, or else behind most of the text. Lines of copyright are the last ones of the page, and no
    paragraphs.
    """
    some = any(line.mains for line in kept)
    total, passed = sum(len(line.text) for line in kept), 0
    out: list[Line] = []
    inside = False
    for line in kept:
        if line.mains:
            inside = False
        elif line.heading and _COMMENTS.fullmatch(line.text) and (some and passed or 2 * passed > total):
            inside = True
        passed += len(line.text)
        if not inside:
            out.append(line)
    while out and not out[-1].mains and not out[-1].prose and len(out) > 1:
        if len(out[-1].text) > LONGEST_COPYRIGHT or not _COPYRIGHT.match(out[-1].text):
            break
        out.pop()
    return out


def extract(page: str | None) -> str:
    """The main text of a page, its blocks joined by newlines."""
    if not page:
        return ""
    found, articles, inside, when = lines(page)
    sizes: dict[int, int] = {}
    for line in found:
        for x in line.mains:
            sizes[x] = sizes.get(x, 0) + len(line.text)
    outermost = sum(len(line.text) for line in found if line.mains)
    # An element with most of the article's text in it is no menu, whatever its name says.
    pardoned = {
        x
        for x, mains in inside.items()
        if mains and 2 * max((sizes.get(y, 0) for y in mains), default=0) > outermost
    }
    size, linked = dict.fromkeys(inside, 0), dict.fromkeys(inside, 0)
    for line in found:
        for x in line.outside:
            size[x] += len(line.text)
            linked[x] += line.linked
    harmless = {
        x
        for x, kind in when.items()
        if kind != ALWAYS and 2 * linked[x] <= size[x] and (kind == LINKS or size[x] >= SURGE)
    }
    kept = [
        line
        for line in found
        if all(x in harmless or x in pardoned and inside[x] & set(line.mains) for x in line.outside)
    ]
    kept = _without_unnamed(kept)
    lengths = [max(len(line.text) - line.linked, 0) if 2 * line.linked <= len(line.text) else 0 for line in kept]
    hints = _hinted(kept, lengths, articles)
    if any(x is not None for x in hints):
        first, last = _hinted_points(kept, lengths, hints)
        return "\n".join(line.text for line in kept[first:last])
    first, last = surge_and_dive(lengths)
    while first and kept[first - 1].prose and lengths[first - 1]:
        first -= 1
    while last < len(kept) and kept[last].prose and lengths[last]:
        last += 1
    return "\n".join(line.text for line in kept[first:last])


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of (page_id, url, html)."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, first, chars = [], 0, 0
            for at, page in enumerate(batch.column("html")):
                texts.append(extract(page.as_py()))
                chars += len(texts[-1])
                if chars > BATCH_CHARS or at == len(batch) - 1:
                    ids = batch.select(["page_id", "url"]).slice(first, len(texts))
                    yield pa.RecordBatch.from_arrays(
                        [*ids.columns, pa.array(texts, pa.string())], ["page_id", "url", "text"]
                    )
                    texts, first, chars = [], at + 1, 0

    return own_columns(pages, "page_id", "url", "html").mapInArrow(work, SCHEMA)
