"""Main text of HTML pages by tree scoring.

A page is read into a tree with the implied end tags of HTML.  Parts that are
never article text (scripts, styles, menus, headers, footers, sidebars,
and elements whose class, id or role names them as adverts, notices, comments
and the like) are left out.  Where such a name may be a subject (legal,
discussion), length and share of links decide, and inside an article or main
part an id counts only whole, that of a heading never.  A form is left out whole unless it holds an
article or main part or the container with the most points; then only its
controls and labels are.  Every text block then passes points for its
length and commas to its ancestors, halved at each level and discounted by the
share of its text that lies in links; the container with the most points is
kept with those siblings that hold article text too: with a paragraph or a
title before it, and few links.

Blocks are the runs of text between block-level tags; white space inside a
block becomes one space, blocks are joined by line feeds, nothing is cut.

Defined cases: a null or empty page, or one without visible text, gives an
empty text; markup that never closes ends with the page; repeated rows give
equal texts; of containers with equal points the first in the page is kept; an
empty table gives an empty result.  A page is one task's row; memory is a few
times the longest page.  The new column is renamed if its name is taken; no
column of the input changes.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import free_name

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody tfoot thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "html", "caption", "tbody", "tfoot", "thead", "tr", "legend", "option", "optgroup"}
DROPPED = frozenset(
    "aside button canvas datalist dialog embed footer head iframe input menu nav noembed noframes noscript "
    "object script search select style svg template textarea title".split()
)
# Controls and labels of a form; the form itself is judged by what it holds.
IN_FORM = frozenset("label legend meter output progress".split())
CONTROLS = IN_FORM | {"button", "datalist", "select"}
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
# A start tag on the left ends an open element on the right, looked for up to a border.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}), "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "a": ({"a"}, {"td", "th", "li", "div", "p", "article", "section"}),
}
P_BORDER = frozenset("table td th caption button object template body".split())
# Words of a class or id that mark a part as not article text.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar "
    "sidebar aside rail widget widgets related recommended recommendations "
    "footer copyright legal "
    "comment comments commentlist discussion disqus respond replies reply "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social".split()
)
# Those of them that also name subjects: a part with such a name is judged by its text.
DOUBTFUL = frozenset(
    "advertising promotion navigation menu rail banner related recommended recommendations copyright legal discussion "
    "cookie cookies consent notice notices alert overlay share sharing social subscription".split()
)
# Words that only say where or how a part stands.
LAYOUT = frozenset(
    "area articles bar block bottom box button buttons container content icons inner items left links list outer posts "
    "right section site stories top wrap wrapper".split()
)
# These mark a page's head, but inside an article the article's own.
PAGE_HEAD = frozenset("header masthead".split())
KEPT_WHOLE = frozenset(("html", "body", "article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    # A quote opens a value only directly after "="; any other ends with its tag.
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTR = re.compile(r"(?:^|[\s/\"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)|(?=[\s/]|$))", re.I)
_NAME_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


GONE = float("inf")
# Goes by its name, unless it turns out to hold the page's text.
NAMED = 1e18
LONG_TEXT = 200.0


def _name_asks(name: str, key: str, value: str, in_article: bool) -> float:
    """What a class or id asks of the text of a block to stay, see ``_asks``."""
    asked = 0.0
    for token in value.split():
        parts = {part.lower() for part in _NAME_PART.findall(token)}
        if parts & PAGE_HEAD and not in_article:
            return GONE
        found = parts & BOILERPLATE
        if not found:
            continue
        # "with-sidebar" or "content-sidebar-wrap" may be the layout around the article; "sidebar" is not.
        gone = GONE if parts <= BOILERPLATE else NAMED
        # "with-sidebar" or "content-sidebar-wrap" may be the layout around the article; "sidebar" is not.
        gone = GONE if parts <= BOILERPLATE else NAMED
        sure, whole = not found <= DOUBTFUL, parts <= BOILERPLATE | LAYOUT
        slug = key == "id" and name == "section"
        if not in_article:
            need = (LONG_TEXT if sure else MIN_PARAGRAPH) if slug and not (whole and sure) else gone if whole or sure else LONG_TEXT
        elif key == "id":
            # Only a whole name counts: the id of a section or part is often the slug of its title.
            need = 0.0 if not whole else gone if sure else 1.0 if slug else MIN_PARAGRAPH
        elif sure or (whole and len(found) > 1):
            need = gone
        else:
            need = LONG_TEXT if whole else MIN_PARAGRAPH
        asked = max(asked, need)
    return asked


def _asks(name: str, attrs: str, in_article: bool, in_form: bool, in_heading: bool) -> float:
    """The text outside links that an element must hold, with few links, to stay: 0 stays, GONE goes."""
    if name in DROPPED or (in_form and name in IN_FORM):
        return GONE
    if name == "header":
        return 0.0 if in_article else GONE
    if name in KEPT_WHOLE or not attrs:
        return 0.0
    asked = 0.0
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id"):
            # The id of a heading, or of an anchor in one, is the slug of its text.
            if key == "class" or not (name in HEADINGS or (in_heading and name not in BLOCK)):
                asked = max(asked, _name_asks(name, key, value, in_article))
        elif key == "role":
            if value.lower() in DROPPED_ROLES and (name, value.lower()) != ("form", "form"):
                return GONE
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _HIDING.search(value)):
            return GONE
    if name in HEADINGS or name not in BLOCK:
        # Too short to be judged by their text: in an article a whole class counts, else only what is sure.
        return GONE if asked >= (LONG_TEXT if in_article else NAMED) else 0.0
    return asked


class _Page:
    """The kept elements of a page in order, and its text blocks."""

    def __init__(self) -> None:
        self.tag: list[str] = ["#root"]
        self.parent: list[int] = [-1]
        self.asks: dict[int, float] = {}                # text outside links that an element must hold to stay
        self.blocks: list[tuple[int, str, float]] = []  # (element, text, share of it in links)
        self._pieces: list[str] = []
        self._linked = 0
        self._owner = 0

    def open(self, tag: str, parent: int) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        return len(self.tag) - 1

    def text(self, piece: str, owner: int, linked: bool) -> None:
        if not self._pieces or not piece.isspace():
            if not any(not p.isspace() for p in self._pieces[-1:]):
                self._owner = owner
        self._pieces.append(piece)
        if linked:
            self._linked += len("".join(piece.split()))

    def flush(self) -> None:
        if self._pieces:
            text = " ".join("".join(self._pieces).split())
            if text:
                self.blocks.append((self._owner, text, min(1.0, self._linked / max(1, len(text.replace(" ", ""))))))
            self._pieces, self._linked = [], 0


def _read(html: str) -> _Page:
    page = _Page()
    # Open elements: (tag, element of the kept tree, inside a dropped part).
    stack: list[tuple[str, int, bool]] = [("#root", 0, False)]
    block_of = [0]           # nearest block-level element of each open one
    open_tags: Counter[str] = Counter()
    links = articles = 0
    at, n = 0, len(html)

    def pop_to(depth: int) -> None:
        nonlocal links, articles
        while len(stack) > depth:
            tag, _, dropped = stack.pop()
            block_of.pop()
            open_tags[tag] -= 1
            links -= tag == "a"
            articles -= tag in ("article", "main")
            if tag in BLOCK and not dropped:
                page.flush()

    def find(names, border, any_depth: bool) -> int:
        if not any(open_tags[name] for name in names):
            return 0
        for depth in range(len(stack) - 1, 0, -1):
            tag = stack[depth][0]
            if tag in names:
                return depth
            if tag in border or (not any_depth and tag in BLOCK):
                return 0
        return 0

    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            lt = n
        m = _TOKEN.match(html, lt) if lt < n else None
        if m is None and lt < n:          # a lone "<" is text
            lt = html.find("<", lt + 1)
            lt = n if lt < 0 else lt
            m = _TOKEN.match(html, lt) if lt < n else None
            if m is None and lt < n:
                stop = lt
                if not stack[-1][2]:
                    page.text(unescape(html[at:stop]), block_of[-1], links > 0)
                at = stop
                continue
        if lt > at and not stack[-1][2]:
            page.text(unescape(html[at:lt]), block_of[-1], links > 0)
        if m is None:
            break
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            if name in BLOCK or name in CONTROLS or name in SIBLINGS and name != "a":
                depth = find((name,), ("#root",), True)
            else:
                depth = find((name,), ("#root",), False)
            if depth:
                pop_to(depth)
            elif name in BLOCK and not stack[-1][2]:
                page.flush()
            continue
        if name in ("html", "body"):
            page.flush()
            if name == "body":
                depth = find(("head",), ("#root",), True)
                if depth:
                    pop_to(depth)
        elif name == "br" or name == "wbr":
            if not stack[-1][2]:
                page.text(" " if name == "br" else "", block_of[-1], False)
            continue
        if name in CLOSES_P:
            depth = find(("p",), P_BORDER, True)
            if depth:
                pop_to(depth)
        if name in SIBLINGS:
            depth = find(*SIBLINGS[name], True)
            if depth:
                pop_to(depth)
        if name in HEADINGS and stack[-1][0] in HEADINGS:
            pop_to(len(stack) - 1)
        dropped = stack[-1][2]
        if name in BLOCK and not dropped:
            page.flush()
        if name in VOID:
            continue
        asked = 0.0
        if not dropped:
            in_heading = any(open_tags[h] for h in HEADINGS)
            asked = _asks(name, m["attrs"], articles > 0, open_tags["form"] > 0, in_heading)
            dropped = asked == GONE
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(html, at)
            if close is None:
                if not dropped:
                    page.text(html[at:], block_of[-1], False)
                break
            if not dropped:
                page.text(html[at:close.start()], block_of[-1], False)
            gt = html.find(">", close.end())
            at = n if gt < 0 else gt + 1
            continue
        if name in ("td", "th") and not dropped:
            page.text(" ", block_of[-1], False)
        blocklike = name in BLOCK
        element = stack[-1][1] if dropped else (page.open(name, block_of[-1]) if blocklike else stack[-1][1])
        if asked and not dropped:
            page.asks[element] = asked
        stack.append((name, element, dropped))
        open_tags[name] += 1
        block_of.append(element if blocklike and not dropped else block_of[-1])
        links += name == "a"
        articles += name in ("article", "main")
    page.flush()
    return page


MIN_PARAGRAPH = 25
LOW_DENSITY = 0.25           # of link text, in article text
# Elements that can be the best container; others hand their points on whole.
CONTAINERS = frozenset(("#root", "html", "body", "article", "main", "div", "section", "center", "td", "details", "form"))
CONTAINER_BONUS = {"article": 25.0, "main": 15.0}


class _Scores:
    """Points and lengths of every element, with those below it."""

    def __init__(self, page: _Page, blocks: list[tuple[int, str, float]]) -> None:
        n = len(page.tag)
        self.score = [0.0] * n
        self.held = [False] * n           # holds text of its own or below
        self.text_len, self.link_len = [0.0] * n, [0.0] * n
        for element, text, linked in blocks:
            length = len(text)
            if page.tag[element] in HEADINGS:
                points = 0.0
            elif length < MIN_PARAGRAPH:
                points = length / 100.0
            else:
                points = 1.0 + text.count(",") + min(length / 100.0, 3.0)
            points *= 1.0 - linked
            at, share = element, 1.0
            while at >= 0 and share >= 1.0 / 64:
                if page.tag[at] in CONTAINERS:
                    self.score[at] += points * share
                    share /= 2
                at = page.parent[at]
            self.text_len[element] += length
            self.link_len[element] += length * linked
            self.held[element] = True
        for i in range(n - 1, 0, -1):
            p = page.parent[i]
            self.text_len[p] += self.text_len[i]
            self.link_len[p] += self.link_len[i]
            self.held[p] |= self.held[i]

    def unlinked(self, i: int) -> float:
        return 1.0 - self.link_len[i] / self.text_len[i]


def _without_doubtful(page: _Page) -> list[tuple[int, str, float]]:
    """The blocks outside of elements that hold less text than they must, or mostly links.

    Elements that go by a name that may also be a layout's stay if they hold an
    article or main part, or if next to no text is left without them: then
    those around the best container stay.
    """
    if NAMED in page.asks.values():
        s = _Scores(page, page.blocks)
        article = [page.tag[i] in CONTAINER_BONUS and s.held[i] for i in range(len(page.tag))]
        for i in range(len(page.tag) - 1, 0, -1):
            article[page.parent[i]] |= article[i]
        page.asks = {i: 0.0 if asked == NAMED and article[i] else asked for i, asked in page.asks.items()}
        left = _judged(page)
        if sum(len(text) * (1.0 - linked) for _, text, linked in left if len(text) >= MIN_PARAGRAPH) >= LONG_TEXT:
            return left
        points = [s.score[i] * s.unlinked(i) if s.text_len[i] and page.tag[i] in CONTAINERS else -1.0 for i in range(len(page.tag))]
        at = max(range(len(points)), key=lambda i: (points[i], -i))
        while at > 0:
            if page.asks.get(at) == NAMED:
                page.asks[at] = 0.0
            at = page.parent[at]
    return _judged(page)


def _judged(page: _Page) -> list[tuple[int, str, float]]:
    """The blocks outside of elements that hold less text than they must, or mostly links."""
    n = len(page.tag)
    text_len, link_len = [0.0] * n, [0.0] * n
    for element, text, linked in page.blocks:
        text_len[element] += len(text)
        link_len[element] += len(text) * linked
    gone = [False] * n
    for i in range(n - 1, 0, -1):
        if page.asks.get(i):
            gone[i] = text_len[i] - link_len[i] < page.asks[i] or link_len[i] >= LOW_DENSITY * text_len[i]
        if not gone[i]:
            text_len[page.parent[i]] += text_len[i]
            link_len[page.parent[i]] += link_len[i]
    for i in range(1, n):
        gone[i] |= gone[page.parent[i]]
    return [b for b in page.blocks if not gone[b[0]]]


def _without_forms(page: _Page) -> list[tuple[int, str, float]]:
    """The blocks outside of forms that hold no article, main or best container."""
    n = len(page.tag)
    held = _Scores(page, page.blocks).held
    main_part = [page.tag[i] in CONTAINER_BONUS and held[i] for i in range(n)]   # is or holds one
    for i in range(n - 1, 0, -1):
        main_part[page.parent[i]] |= main_part[i]
    form, in_main = [0] * n, [False] * n     # outermost form around it that may go; inside an article or main part
    for i in range(1, n):
        p = page.parent[i]
        form[i] = form[p] or (i if page.tag[i] == "form" and not main_part[i] else 0)
        in_main[i] = in_main[p] or page.tag[i] in CONTAINER_BONUS
    blocks = page.blocks
    if any(in_main[element] and not form[element] for element, _, _ in blocks):
        # The article is known: forms beside it are not part of it.
        blocks = [b for b in blocks if not form[b[0]] or in_main[form[b[0]]]]
    s = _Scores(page, blocks)
    points = [s.score[i] * s.unlinked(i) if s.text_len[i] and page.tag[i] in CONTAINERS else -1.0 for i in range(n)]
    best = form[max(range(n), key=lambda i: (points[i], -i))]
    return [b for b in blocks if form[b[0]] in (0, best)]


def extract_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    page = _read(html)
    if page.asks:
        page.blocks = _without_doubtful(page)
    if "form" in page.tag:
        page.blocks = _without_forms(page)
    if not page.blocks:
        return ""
    n = len(page.tag)
    s = _Scores(page, page.blocks)
    score, held, text_len, link_len = s.score, s.held, s.text_len, s.link_len
    final = [
        (score[i] + (CONTAINER_BONUS.get(page.tag[i], 0.0) if held[i] else 0.0)) * s.unlinked(i)
        if text_len[i] and page.tag[i] in CONTAINERS else -1.0 for i in range(n)
    ]
    best = max(range(n), key=lambda i: (final[i], -i))
    if final[best] <= 0.0:
        best = 0
    # The article or main part around the best container is the container.
    at = best
    while at > 0:
        if page.tag[at] in CONTAINER_BONUS:
            best = at
        at = page.parent[at]
    # A wrapper that holds no other text stands for it, so that its siblings are looked at.
    while page.tag[best] not in CONTAINER_BONUS and best > 0 and text_len[page.parent[best]] == text_len[best]:
        best = page.parent[best]
    def alone(i: int) -> int:
        """The outermost element around ``i`` that holds no other text."""
        while page.parent[i] > 0 and text_len[page.parent[i]] == text_len[i]:
            i = page.parent[i]
        return i

    def alone(i: int) -> int:
        """The outermost element around ``i`` that holds no other text."""
        while page.parent[i] > 0 and text_len[page.parent[i]] == text_len[i]:
            i = page.parent[i]
        return i

    titled = [False] * n         # holds a heading with text
    for element, _, _ in page.blocks:
        titled[element] |= page.tag[element] in HEADINGS
    for i in range(n - 1, 0, -1):
        titled[page.parent[i]] |= titled[i]
    kept = {best}
    if page.tag[best] in CONTAINER_BONUS:
        # Articles of one list, each in a wrapper of its own.
        level = page.parent[alone(best)]
        kept |= {i for i in range(1, n) if page.tag[i] == page.tag[best] and text_len[i]
                 and final[i] >= 0.2 * final[best] and page.parent[alone(i)] == level}
    for i in range(1, n):
        if page.parent[i] != page.parent[best] or i == best or not text_len[i]:
            continue
        density = link_len[i] / text_len[i]
        if page.tag[best] in CONTAINER_BONUS:
            keep = page.tag[i] == page.tag[best] and final[i] >= 0.2 * final[best]
        elif page.tag[i] in HEADINGS:
            keep = i < best
        elif page.tag[i] not in CONTAINERS:
            keep = density < LOW_DENSITY
        else:
            # A wrapped lead, closing paragraph or title, however small beside the best container.
            keep = score[i] >= max(10.0, 0.2 * score[best]) or (
                density < LOW_DENSITY and (text_len[i] - link_len[i] >= MIN_PARAGRAPH or (titled[i] and i < best)))
        if keep:
            kept.add(i)
    inside = [False] * n
    for i in range(n):
        inside[i] = i in kept or (i > 0 and inside[page.parent[i]])
    return "\n".join(text for element, text, _ in page.blocks if inside[element])


def _extract(pages: pa.Array) -> pa.Array:
    return pa.array([extract_text(h) for h in pages.to_pylist()], pa.string())


def with_main_text(pages: DataFrame, html: str = "html", name: str = "text") -> tuple[DataFrame, str]:
    """``pages`` with the main text of every whole page, and the new column's name; no shuffle."""
    name = free_name(pages, name)
    return pages.withColumn(name, F.arrow_udf(_extract, "string")(F.col(html))), name
