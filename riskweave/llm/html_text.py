"""Main text of web pages by tag-path ratios.

A page is a sequence of text blocks, each with the path of block elements from the root to it
(elements are told apart by id and class). For every path the text length and the punctuation of
its blocks are added up and divided by their number; both ratios are smoothed over the paths in
page order by a Gaussian and multiplied, less the share of text in links. Paths whose fused
ratio reaches the threshold are content. Their common container - the nearest article or main
element around the best path, or else its parent - brings along what it holds (headings, short
paragraphs, lists), and content paths outside of it count only where a page has no such
element. Elements that are never part of an article (menus, headers and footers of the page,
sidebars, notices, adverts, forms, comments, scripts, hidden parts) have ratio zero, by their
tag, role, class or id. A header inside an article belongs to it. A class or id name sets an element apart if all its words do or
are neutral ("share-bar", but not "social-contract"); an id of a paragraph or heading is an anchor.
Class, id and form say nothing of an element that holds the first main
element of the page, or without one its first article element (unless more text stands beside
it), or without either over half of the page's text and punctuation: the ratios decide there.

Blocks: character references are decoded, white space becomes one blank, ends are trimmed,
empty blocks fall away; blocks are joined by a line feed in page order.

Defined cases: null and empty pages, and pages without content, give an empty text; unclosed
elements end with their parent, unclosed comments and scripts with the page; a ``<`` that opens
no tag is text; quotes in a tag that are never closed hide nothing; repeated rows give equal texts; an
empty table gives an empty one. Pages are read whole, in time that follows their length also
where quotes stay open or elements nest without end.
Further columns are carried along; one named like a new column gives way to it.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskweave.llm.common import append_columns

#: Share of the standard deviation of fused ratios that a content path must reach.
THRESHOLD = 0.5
#: Paths on either side that the Gaussian takes in, and its width.
REACH, WIDTH = 1, 0.5

#: What opens at a ``<``: a comment, a declaration, or a tag whose attributes follow.
OPEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)", re.DOTALL
)
QUOTE_OR_END = re.compile("[\"'>]")
#: Tags whose quotes lead nowhere, after which quotes no longer hide a ``>`` in a page.
UNCLOSED = 100
ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[a-z]+")
PUNCTUATION = re.compile(r"[.,;:!?、。，！？]")

# Elements whose content is no text of the page.
RAW = frozenset("script style textarea title noscript template iframe object svg math canvas select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
# Parts of a page that belong to no article.
ASIDE = frozenset("nav footer aside form button dialog menu fieldset input header".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert menu nav navbar navigation navi breadcrumb breadcrumbs header footer sidebar aside widget "
    "comment comments disqus reply replies respond share sharing social related recommended newsletter subscribe "
    "subscription signup login popup modal overlay pagination pager toolbar masthead copyright legal skip form".split()
)
# Words that may stand beside those in the name of such a part.
NEUTRAL = frozenset(
    "a area article bar block body bottom box button buttons card cards center class col column container content desktop div "
    "entry fixed floating full global group grid holder home inline inner item items js layout left level link links list "
    "main mobile my outer page panel post posts primary right row secondary section sections site slot small sticky text "
    "title toggle top ui unit view wide wrap wrapper www zone".split()
)
# Elements whose ids are anchors.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th figure figcaption".split())
MAIN = frozenset("article main".split())
# What ends when one of these opens: an open element of the same kind inside its container.
CLOSES = {
    "p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",),
}
SCOPES = frozenset("ul ol dl table article main section div body html blockquote aside nav form".split())


@dataclass(eq=False)
class Element:
    tag: str
    name: str
    #: Set apart for sure, or by its name or as a form.
    aside: bool
    named: bool
    parent: Element | None = None
    path: int = -1
    #: It or an element around it is set apart.
    hidden: bool = False


@dataclass
class Block:
    element: Element | None
    path: int
    text: str
    linked: int

    @property
    def aside(self) -> bool:
        return self.element is not None and self.element.hidden


class Paths:
    """Paths from the root, each a number: its parent's and a name. -1 is the empty path."""

    def __init__(self):
        self.numbers: dict[tuple[int, str], int] = {}
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.depth: list[int] = []
        #: The first path on the way that ends in article or main, or -1.
        self.main: list[int] = []

    def of(self, parent: int, name: str, tag: str) -> int:
        key = (parent, name)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.parent)
            self.parent.append(parent)
            self.tag.append(tag)
            self.depth.append(self.depth[parent] + 1 if parent >= 0 else 1)
            above = self.main[parent] if parent >= 0 else -1
            self.main.append(above if above >= 0 else number if tag in MAIN else -1)
        return number

    def below(self, root: int) -> list[bool]:
        """Which paths begin with ``root``; parents have smaller numbers."""
        out: list[bool] = []
        for number, parent in enumerate(self.parent):
            out.append(number == root or (parent >= 0 and out[parent]) or root < 0)
        return out


@dataclass
class Page:
    paths: Paths
    elements: list[Element]
    blocks: list[Block]


def is_aside_name(mark: str) -> bool:
    words = WORDS.findall(mark)
    return not ASIDE_WORDS.isdisjoint(words) and all(w in ASIDE_WORDS or w in NEUTRAL for w in words)


def element(tag: str, rest: str, in_article: bool = False) -> Element:
    """An element with its name in paths; whether it is set apart from articles."""
    name, aside, named = tag, tag in ASIDE and tag != "form" and not (tag == "header" and in_article), tag == "form"
    if rest.strip(" /\t\r\n"):
        found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(rest)}
        marks = (found.get("id", "") + " " + found.get("class", "")).strip()
        if marks:
            name += "." + ".".join(marks.split())
        aside = (
            aside
            or "hidden" in found
            or found.get("aria-hidden") == "true"
            or found.get("role", "").lower() in ROLES
            or "display:none" in found.get("style", "").replace(" ", "").lower()
        )
        said = found.get("class", "") if tag in TEXTUAL else marks
        named = named or (tag not in ("html", "body") and any(map(is_aside_name, said.lower().split())))
    return Element(tag, name, aside, named)


def clear_wrappers(page: Page, first: dict[str, Element]) -> None:
    """Names and forms no longer set apart what holds the article; then says what is hidden."""
    holder = first.get("main") or first.get("article")
    above = []
    e = holder
    while e is not None:
        above.append(e)
        e = e.parent
    if holder is not None and "main" not in first:
        # An article with less text than what stands beside it, in parts of no other name, is a comment or teaser.
        ids = {id(e) for e in above}
        within, apart = {id(None): False}, {id(None): False}
        for e in page.elements:
            within[id(e)] = e is holder or within[id(e.parent)]
            apart[id(e)] = apart[id(e.parent)] or e.aside or (e.named and id(e) not in ids)
        inside = sum(len(b.text) for b in page.blocks if within[id(b.element)])
        beside = sum(len(b.text) for b in page.blocks if not within[id(b.element)] and not apart[id(b.element)])
        if inside < beside:
            holder = None
    if holder is not None:
        for e in above:
            e.named = False
    else:
        sure = {id(None): False}
        for e in page.elements:
            sure[id(e)] = sure[id(e.parent)] or e.aside
        sums = {id(e): [0, 0] for e in page.elements} | {id(None): [0, 0]}
        for b in page.blocks:
            if not sure[id(b.element)]:
                sums[id(b.element)][0] += len(b.text)
                sums[id(b.element)][1] += len(PUNCTUATION.findall(b.text))
        for e in reversed(page.elements):  # children come after their parents
            for i in (0, 1):
                sums[id(e.parent)][i] += sums[id(e)][i]
        text, marks = sums[id(None)]
        for e in page.elements:
            own, own_marks = sums[id(e)]
            if e.named and not sure[id(e)] and 2 * own > text and 2 * own_marks > marks:
                e.named = False
    for e in page.elements:
        e.hidden = e.aside or e.named or (e.parent is not None and e.parent.hidden)


class Tags:
    """Finds the ends of tags; a ``>`` in quotes is none."""

    def __init__(self, page: str):
        self.page, self.last, self.left = page, page.rfind(">"), UNCLOSED

    def end(self, at: int) -> int:
        """The place of the ``>`` that ends the tag whose attributes begin at ``at``, or -1."""
        if at > self.last:
            return -1
        place = at
        while self.left:
            m = QUOTE_OR_END.search(self.page, place)
            if m and m[0] == ">":
                return m.start()
            close = self.page.find(m[0], m.end()) if m else -1
            if close < 0:
                self.left -= 1
                break
            place = close + 1
        return self.page.find(">", at)


def read(page: str) -> Page:
    """Text blocks of a page in order, with their elements and paths."""
    out = Page(Paths(), [], [])
    first: dict[str, Element] = {}
    stack: list[Element] = []
    open_tags: Counter = Counter()
    asides = articles = 0
    parts: list[str] = []
    linked = links = 0
    at = 0
    tags = Tags(page)

    def close_block():
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            top = stack[-1] if stack else None
            out.blocks.append(Block(top, top.path if top else -1, text, min(linked, len(text))))
        parts.clear()
        linked = 0

    def add(raw: str):
        nonlocal linked
        text = html.unescape(raw)
        parts.append(text)
        if links:
            linked += len(text)

    def pop() -> Element:
        nonlocal asides, articles
        e = stack.pop()
        open_tags[e.tag] -= 1
        asides -= e.aside
        articles -= e.tag == "article"
        return e

    while at < len(page):
        m = OPEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        stop = tags.end(m.end()) if m["tag"] is not None else m.end()
        if stop < 0:
            # No tag ends from here on: what looks like one is text, up to a comment.
            comment = page.find("<!", m.end())
            comment = comment if comment >= 0 else len(page)
            add(page[at:comment])
            at = comment
            continue
        if m.start() > at:
            add(page[at : m.start()])
        at = stop
        if m["tag"] is None:
            continue
        rest = page[m.end() : stop]
        at += 1
        tag, end = m["tag"].lower(), bool(m["end"])
        if tag in RAW:
            if not end and not rest.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(page, at)
                at = close.end() if close else len(page)
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if end else 1
            if tag in ("br", "wbr", "img"):
                parts.append(" " if tag == "br" else "")
            continue
        close_block()
        if end:
            if open_tags[tag] > 0:
                while pop().tag != tag:
                    pass
            links = 0
        else:
            ends = CLOSES.get(tag, ("p",))
            if any(open_tags[t] > 0 for t in ends):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i].tag in ends:
                        while len(stack) > i:
                            pop()
                        break
                    if stack[i].tag in SCOPES:
                        break
            if tag not in VOID and not rest.endswith("/"):
                e = element(tag, rest, articles > 0)
                e.parent = stack[-1] if stack else None
                e.path = out.paths.of(e.parent.path if e.parent else -1, e.name, tag)
                stack.append(e)
                out.elements.append(e)
                open_tags[tag] += 1
                asides += e.aside
                articles += tag == "article"
                if tag in MAIN and tag not in first and not asides:
                    first[tag] = e
            links = 0
    close_block()
    clear_wrappers(out, first)
    return out


def fused_ratios(found: list[Block]) -> dict[int, float]:
    """Smoothed and fused ratios of text and punctuation by path, in page order."""
    sums: dict[int, list[float]] = {}
    for b in found:
        s = sums.setdefault(b.path, [0, 0, 0, 0])
        s[0] += 1
        if not b.aside:
            s[1] += len(b.text)
            s[2] += len(PUNCTUATION.findall(b.text))
            s[3] += b.linked
    paths = list(sums)
    text = [s[1] / s[0] for s in sums.values()]
    marks = [(s[2] + 0.1) / s[0] if s[1] else 0.0 for s in sums.values()]
    kernel = [math.exp(-(d**2) / (2 * WIDTH**2)) for d in range(-REACH, REACH + 1)]

    def smooth(values):
        out = []
        for i in range(len(values)):
            near = [(k, values[j]) for k, j in zip(kernel, range(i - REACH, i + REACH + 1), strict=True) if 0 <= j < len(values)]
            out.append(sum(k * v for k, v in near) / sum(k for k, _ in near))
        return out

    # Parts that are set apart neither get nor give weight.
    real = [i for i, s in enumerate(sums.values()) if s[1]]
    smooth_text, smooth_marks = smooth([text[i] for i in real]), smooth([marks[i] for i in real])
    out = dict.fromkeys(paths, 0.0)
    for i, t, m in zip(real, smooth_text, smooth_marks, strict=True):
        n, chars, _, link = sums[paths[i]]
        # Longer parts weigh by all they hold, not by their mean block alone.
        out[paths[i]] = t * m * n * (1 - link / chars)
    return out


def main_blocks(page: Page) -> list[Block]:
    """The blocks of the article."""
    found, paths = page.blocks, page.paths
    ratios = fused_ratios(found)
    main = lambda p: paths.main[p] if p >= 0 else -1
    articles = {p: v for p, v in ratios.items() if v and main(p) >= 0}
    best = max(articles or ratios, key=ratios.get, default=None)
    if best is None or not ratios[best]:
        return []
    if main(best) >= 0:
        return [b for b in found if not b.aside and main(b.path) == main(best)]
    values = list(ratios.values())
    mean = sum(values) / len(values)
    deviation = math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))
    content = {p for p, v in ratios.items() if v >= THRESHOLD * deviation and v > 0}
    root = paths.parent[best] if best >= 0 else -1
    depth = paths.depth[root] if root >= 0 else 0
    wide = depth > 2 or (depth == 2 and paths.tag[root] not in ("html", "body"))
    below = paths.below(root)
    chosen = []
    for b in found:
        inside = wide and b.path >= 0 and below[b.path]
        heading = b.path >= 0 and re.fullmatch(r"h[1-6]", paths.tag[b.path]) and paths.parent[b.path] == root
        if not b.aside and (b.path in content or inside or heading) and b.linked < 0.8 * len(b.text):
            chosen.append(b)
    return chosen


def extract(page: str | None) -> str:
    return "\n".join(b.text for b in main_blocks(read(page or "")))


def main_texts(pages: DataFrame, name: str = "text") -> DataFrame:
    """``pages`` with the main text of the column html."""

    def make():
        return lambda column: (pa.array([extract(x.as_py()) for x in column], pa.string()),)

    return append_columns(pages, make, [T.StructField(name, T.StringType())], ["html"])
