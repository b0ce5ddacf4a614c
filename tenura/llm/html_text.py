"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at its block-level tags. Each block is described by its words and
its link density (the share of its words inside links), by those of the blocks before and
after it, and by what encloses it: an article, or page furniture such as a menu, a footer,
a notice, a form or reader comments, known by its tag, role, class or id. A decision tree,
grown on the small labelled table below, tells which blocks are text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import chunks, to_batch

# Fixed values of HTML: elements that break a line of text, and those without text content.
BLOCK_TAGS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol option p pre search section select summary table tbody td tfoot th thead "
    "title tr ul".split()
)
RAW_TAGS = "script style noscript template iframe object svg math audio video canvas textarea xmp noembed noframes"
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE_TAGS = set("aside button datalist dialog footer form head input menu nav search select title".split())
FURNITURE_ROLES = set(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
# Words of classes and ids.
FURNITURE_WORDS = set(
    "ad ads advert advertisement adverts adsense alert banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright dialog disclaimer disqus feedback footer form gdpr header login "
    "masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo "
    "promotion recommended related replies reply respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
ARTICLE_WORDS = set("article articlebody entry main post story".split())
# Words that a name of page furniture may have besides: a name counts as a whole, so neither
# "has-header" nor "search-methods" is furniture, but "site-header" and "cookie-notice" are.
NEUTRAL_WORDS = ARTICLE_WORDS | set(
    "area author bar block body bottom box button buttons col column container content desktop fixed global "
    "guest icon icons info inner item items label large law left link links list medium message meta mobile outer "
    "overlay page panel policy posts primary reader readers right row secondary section site slot small space "
    "sticky stream text thread title tools top unit user users visitor visitors wrap wrapper zone".split()
)
# Words that make a name one of page furniture if it ends with them, neutral words apart,
# whatever stands before: "cc-cookie-banner", "leaderboard-ad". Not with a word of a state.
LAST_WORDS = set(
    "ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs comments cookie cookies disqus "
    "modal newsletter pagination popup promo signup sponsored subscribe widget".split()
)
STATE_WORDS = set("after before free has have hide hides is js no not show shows with without".split())
# Two words that make it one together, each of which also names an article's parts.
WORD_PAIRS = [{"discussion", "thread"}, {"discussion", "board"}]
# Words that also name the layout of a wrapper around a whole page.
LAYOUT_WORDS = set("form header masthead nav navbar search sidebar toolbar topbar".split())
# Of a heading's or paragraph's classes in an article, only these count.
ADVERT_WORDS = set("ad ads adsense advert advertisement adverts".split())
HEADING_TAGS = set("h1 h2 h3 h4 h5 h6".split())
PROSE_TAGS = HEADING_TAGS | {"p"}
# A block of this link density is mostly links.
LINKED = 0.5
# How an element is furniture: it may be a wrapper around the page's text, it is, it is hidden.
LAYOUT, FURNITURE, HIDDEN = 1, 2, 3

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + RAW_TAGS.replace(" ", "|") + r")(?=[\s/>])(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>"
    r".*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>"
    r"|<[!?][^>]*>|</[^a-zA-Z][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>=`]+))?""")
_LETTERS = re.compile(r"[a-z]+")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Block:
    text: str
    words: int
    density: float
    in_article: bool
    in_furniture: bool
    heading: bool = False
    element: int = -1
    plain: int = 0


@dataclass
class Element:
    parent: int  # -1: none
    article: bool  # an article or main element, or one with such a role
    main: bool
    named: bool  # called an article by its class or id
    furniture: int = 0
    form: bool = False
    wide: bool = False  # by its name, a wrapper around the page's text is possible
    prose: bool = False  # holds paragraphs or headings
    plain: int = 0  # words outside links and certain furniture


@dataclass
class _Reader:
    """Blocks and elements of one page."""

    blocks: list[Block] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    open: list[tuple[str, int, bool, bool]] = field(default_factory=list)  # tag, element, inside article, furniture
    links: int = 0
    headings: int = 0  # open ones

    def flush(self) -> None:
        if self.parts:
            words = html.unescape("".join(self.parts)).split()
            if words:
                inside = len(html.unescape(" ".join(self.linked)).split()) if self.linked else 0
                self.blocks.append(
                    Block(
                        " ".join(words), len(words), min(1.0, inside / len(words)), False, False,
                        self.headings > 0, self.open[-1][1] if self.open else -1, max(0, len(words) - inside),
                    )
                )
        self.parts, self.linked = [], []

    def text(self, text: str) -> None:
        self.parts.append(text)
        if self.links and not text.isspace():
            self.linked.append(text)

    def start(self, name: str, rest: str) -> None:
        if name == "br":
            self.parts.append(" ")
        if name == "a":
            self.links += 1
            if self.links > 1:  # a link ends where the next one starts
                self.links = 1
        if name not in BLOCK_TAGS and "=" not in rest and name not in FURNITURE_TAGS:
            return
        if name in BLOCK_TAGS:
            self.flush()
            if self.open and self.open[-1][0] == "p" or self.open and self.open[-1][0] == name == "li":
                self.close(len(self.open) - 1)
        if name in HEADING_TAGS and self.headings:  # a heading ends where the next one starts
            self.close(max(i for i, o in enumerate(self.open) if o[0] in HEADING_TAGS))
        if name in VOID_TAGS or rest.endswith("/"):
            return
        if name in BLOCK_TAGS or name in ("span", "button", "label", "ins", "small"):
            _, parent, inside, _ = self.open[-1] if self.open else ("", -1, False, False)
            element = _element(name, rest, inside, parent)
            if element.furniture and name not in BLOCK_TAGS:
                self.flush()
            self.elements.append(element)
            inside |= (element.article or element.named) and not element.furniture
            self.open.append((name, len(self.elements) - 1, inside, element.furniture > 0))
            self.headings += name in HEADING_TAGS

    def close(self, at: int) -> None:
        """Close the open elements from this one on."""
        self.headings -= sum(o[0] in HEADING_TAGS for o in self.open[at:])
        del self.open[at:]

    def end(self, name: str) -> None:
        if name == "a":
            self.links = 0
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == name:
                if name in BLOCK_TAGS or any(o[3] for o in self.open[i:]):
                    self.flush()
                self.close(i)
                return
        if name in BLOCK_TAGS:
            self.flush()


def _furniture_words(parts: list[str]) -> set[str]:
    """The words of a name that make it one of page furniture; none if it isn't one."""
    named = FURNITURE_WORDS.intersection(parts)
    if named and named.union(NEUTRAL_WORDS).issuperset(parts):
        return named
    last = next((p for p in reversed(parts) if p not in NEUTRAL_WORDS), None)
    if last in LAST_WORDS and not STATE_WORDS.intersection(parts):
        return {last}
    pairs = [pair for pair in WORD_PAIRS if pair.issubset(parts) and pair.union(NEUTRAL_WORDS).issuperset(parts)]
    return pairs[0] if pairs else set()


def _element(name: str, rest: str, in_article: bool, parent: int) -> Element:
    """What an element is by its tag, role, class and id."""
    found = Element(parent, name in ("article", "main"), name == "main", False, prose=name in PROSE_TAGS)
    if name == "form":
        found.furniture, found.form = LAYOUT, True
    elif name == "header":
        found.furniture = 0 if in_article else LAYOUT
    elif name in FURNITURE_TAGS:
        found.furniture = FURNITURE
    if name in ("html", "body") or not ("=" in rest or "hidden" in rest):
        return found
    values = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(rest)}
    role = values.get("role", "").lower()
    if role in FURNITURE_ROLES:
        found.furniture, found.form = max(found.furniture, LAYOUT if role == "form" else FURNITURE), role == "form"
    found.article |= role in ("main", "article")
    found.main |= role == "main"
    names = values.get("class", "").split()
    if not found.prose:  # ids of headings and paragraphs are made of their words
        names.append(values.get("id", ""))
        found.named = any(ARTICLE_WORDS.intersection(_LETTERS.findall(n.lower())) for n in names)
    for parts in ([w.lower() for w in _NAME_PARTS.findall(n)] for n in names):
        named = _furniture_words(parts)
        if not named:
            continue
        if named == {"header"} and (in_article or ARTICLE_WORDS.intersection(parts)):
            continue
        if found.prose and in_article and not ADVERT_WORDS.issuperset(parts):
            continue
        wide = named <= LAYOUT_WORDS and (len(parts) > 1 or named == {"form"})
        found.wide |= wide and not found.furniture
        found.wide &= wide
        found.furniture = max(found.furniture, LAYOUT if named <= LAYOUT_WORDS else FURNITURE)
    if "hidden" in values or values.get("aria-hidden", "").lower() == "true" or "display:none" in (
        values.get("style", "").lower().replace(" ", "")
    ):
        found.furniture = HIDDEN
    return found


def _enclose(elements: list[Element], reset: bool) -> list[tuple[int, bool, bool]]:
    """Of each element: how it lies in furniture, whether in an article, in one by its name.

    A main element ends furniture around it. With ``reset`` an article ends what may be a
    wrapper around the page.
    """
    found: list[tuple[int, bool, bool]] = []
    for e in elements:
        outer, article, named = found[e.parent] if e.parent >= 0 else (0, False, False)
        if not e.furniture and (e.main and outer < HIDDEN or reset and e.article and outer <= LAYOUT):
            outer = 0
        own = not e.furniture
        found.append((max(outer, e.furniture), article or own and e.article, named or own and e.named))
    return found


def _resolve(blocks: list[Block], elements: list[Element]) -> None:
    """Tell which blocks lie in the page's article, and which in furniture.

    A form, or without an article a wrapper by its name, that holds most of the page's words
    outside links is no furniture. Classes and ids make an article only of what holds most
    of these words.
    """
    around = _enclose(elements, False)
    at = lambda b: around[b.element] if b.element >= 0 else (0, False, False)
    has_article = lambda: any(a and not f for f, a, _ in map(at, blocks))
    if any(f == LAYOUT for f, _, _ in around):
        total = 0
        for b in blocks:
            if at(b)[0] < FURNITURE:
                total += b.plain
                if b.element >= 0:
                    elements[b.element].plain += b.plain
        for e in reversed(elements):
            if e.parent >= 0:
                elements[e.parent].plain += e.plain
                elements[e.parent].prose |= e.prose
        reset = not has_article()
        if reset:
            around = _enclose(elements, True)
        wide = not any((a or n) and not f for f, a, n in (around[b.element] for b in blocks if b.element >= 0))
        for e in elements:
            if e.furniture == LAYOUT and (e.form or wide and e.wide) and e.prose and 2 * e.plain > total:
                e.furniture = 0
        around = _enclose(elements, reset)
    named = total = 0
    for b in blocks:
        furniture, article, called = at(b)
        b.in_furniture, b.in_article = furniture > 0, article
        if not b.in_furniture:
            total += b.plain
            named += b.plain * called
    if 2 * named > total:
        for b in blocks:
            b.in_article |= at(b)[2]


def text_blocks(page: str) -> list[Block]:
    reader, at = _Reader(), 0
    for match in _TAG.finditer(page):
        if match.start() > at:
            reader.text(page[at : match.start()])
        at = match.end()
        name = match["name"]
        if name is None:
            continue
        if match["end"]:
            reader.end(name.lower())
        else:
            reader.start(name.lower(), match["rest"])
    if at < len(page):
        reader.text(page[at:])
    reader.flush()
    _resolve(reader.blocks, reader.elements)
    return reader.blocks


def block_features(blocks: list[Block]) -> list[tuple]:
    """words, density, those of the block before, of the block after, and what encloses the block.

    That is: article, furniture, lost, heading. ``lost``: the page has an article, but the block
    is outside and no plain heading right before it. Furniture beside a block counts as the
    page's end, and a heading beside it as free of links.
    """
    has_article = any(b.in_article for b in blocks)
    leads = [b.in_article for b in blocks] + [False]  # in the article, or heads it
    for i in range(len(blocks) - 1, -1, -1):
        leads[i] |= leads[i + 1] and blocks[i].heading and blocks[i].density < LINKED
    around = [
        (0, 0.0), *((0, 0.0) if b.in_furniture else (b.words, 0.0 if b.heading else b.density) for b in blocks), (0, 0.0)
    ]
    return [
        (b.words, b.density, *around[i], *around[i + 2], b.in_article, b.in_furniture,
         has_article and not leads[i], b.heading)
        for i, b in enumerate(blocks)
    ]


# The labelled table: words, density, words and density before, and after; 1 if inside an
# article, inside furniture, outside the page's article, in a heading; 1 if the block is text.
LABELLED = [
    # menus and footers
    (6, 1.0, 0, 0.0, 5, 1.0, 0, 1, 0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 1, 0, 0),
    (2, 1.0, 3, 1.0, 40, 0.0, 0, 1, 1, 0, 0), (25, 0.1, 90, 0.0, 0, 0.0, 0, 1, 1, 0, 0),
    (60, 0.0, 2, 1.0, 8, 0.0, 0, 1, 1, 0, 0), (12, 0.0, 120, 0.0, 0, 0.0, 0, 1, 0, 0, 0),
    (1, 0.0, 1, 1.0, 90, 0.0, 0, 1, 1, 0, 0), (9, 0.9, 70, 0.0, 4, 1.0, 0, 1, 0, 0, 0),
    # notices, adverts, forms and comments in an article or beside it
    (30, 0.0, 80, 0.0, 75, 0.0, 1, 1, 0, 0, 0), (8, 0.0, 45, 0.0, 60, 0.0, 1, 1, 0, 0, 0),
    (55, 0.0, 120, 0.0, 40, 0.0, 1, 1, 0, 0, 0), (4, 0.5, 66, 0.0, 21, 0.0, 1, 1, 0, 0, 0),
    (140, 0.0, 20, 0.0, 15, 0.0, 0, 1, 1, 0, 0), (1, 1.0, 80, 0.0, 2, 0.0, 1, 1, 0, 0, 0),
    (70, 0.05, 50, 0.0, 0, 0.0, 0, 1, 1, 0, 0), (18, 0.0, 0, 0.0, 30, 0.0, 0, 1, 1, 0, 0),
    # paragraphs, headings, short lines and linked words of an article
    (9, 0.0, 6, 0.0, 80, 0.0, 1, 0, 0, 0, 1), (80, 0.0, 9, 0.0, 120, 0.02, 1, 0, 0, 0, 1),
    (120, 0.02, 80, 0.0, 3, 0.0, 1, 0, 0, 0, 1), (2, 0.0, 110, 0.0, 70, 0.0, 1, 0, 0, 0, 1),
    (1, 0.0, 2, 0.0, 1, 0.0, 1, 0, 0, 0, 1), (1, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 0, 1),
    (5, 1.0, 60, 0.0, 44, 0.0, 1, 0, 0, 0, 1), (3, 1.0, 4, 1.0, 3, 1.0, 1, 0, 0, 0, 1),
    (30, 0.4, 12, 0.1, 0, 0.0, 1, 0, 0, 0, 1), (1, 0.0, 6, 1.0, 3, 1.0, 1, 0, 0, 0, 1),
    (400, 0.0, 5, 0.0, 15, 0.0, 1, 0, 0, 0, 1), (7, 0.0, 12, 0.0, 9, 0.0, 1, 0, 0, 0, 1),
    # beside a page's article: short or linked blocks
    (20, 0.0, 5, 1.0, 9, 0.0, 0, 0, 1, 0, 0), (90, 0.0, 30, 0.0, 5, 1.0, 0, 0, 1, 0, 1),
    (3, 0.0, 0, 0.0, 100, 0.0, 0, 0, 1, 0, 0), (4, 1.0, 90, 0.0, 4, 1.0, 0, 0, 1, 0, 0),
    (45, 0.0, 200, 0.0, 0, 0.0, 0, 0, 1, 0, 1), (1, 0.0, 2, 0.0, 1, 0.0, 0, 0, 1, 0, 0),
    # pages without a marked article: text
    (60, 0.0, 4, 0.0, 70, 0.0, 0, 0, 0, 0, 1), (70, 0.03, 60, 0.0, 2, 1.0, 0, 0, 0, 0, 1),
    (25, 0.0, 70, 0.0, 30, 0.0, 0, 0, 0, 0, 1), (18, 0.1, 40, 0.0, 33, 0.0, 0, 0, 0, 0, 1),
    (4, 0.0, 60, 0.0, 50, 0.0, 0, 0, 0, 0, 1), (2, 0.0, 45, 0.0, 80, 0.0, 0, 0, 0, 0, 1),
    (6, 0.0, 3, 1.0, 55, 0.0, 0, 0, 0, 0, 1), (8, 0.0, 0, 0.0, 90, 0.0, 0, 0, 0, 0, 1),
    (12, 0.0, 38, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (150, 0.2, 3, 1.0, 2, 1.0, 0, 0, 0, 0, 1),
    (16, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (14, 0.0, 9, 0.0, 12, 0.0, 0, 0, 0, 0, 1),
    # pages without a marked article: lists of links and loose words
    (3, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0, 0), (2, 1.0, 3, 1.0, 60, 0.0, 0, 0, 0, 0, 0),
    (5, 0.8, 70, 0.0, 4, 1.0, 0, 0, 0, 0, 0), (24, 0.9, 60, 0.0, 0, 0.0, 0, 0, 0, 0, 0),
    (1, 0.0, 2, 1.0, 1, 1.0, 0, 0, 0, 0, 0), (3, 0.0, 4, 1.0, 2, 1.0, 0, 0, 0, 0, 0),
    (2, 0.0, 3, 0.0, 4, 1.0, 0, 0, 0, 0, 1), (40, 0.7, 5, 1.0, 6, 1.0, 0, 0, 0, 0, 0),
    (9, 0.6, 50, 0.0, 44, 0.0, 0, 0, 0, 0, 0), (2, 1.0, 2, 1.0, 0, 0.0, 0, 0, 0, 0, 0),
    # long blocks beside a page's article: text if free of links
    (30, 0.0, 5, 1.0, 9, 0.0, 0, 0, 1, 0, 1), (60, 0.0, 0, 0.0, 40, 0.0, 0, 0, 1, 0, 1),
    (120, 0.02, 3, 0.0, 80, 0.0, 0, 0, 1, 0, 1), (35, 0.5, 60, 0.0, 9, 1.0, 0, 0, 1, 0, 0),
    (60, 0.9, 90, 0.0, 5, 1.0, 0, 0, 1, 0, 0), (24, 1.0, 0, 0.0, 0, 0.0, 0, 0, 1, 0, 0),
    # headings, linked ones too
    (4, 1.0, 60, 0.0, 70, 0.0, 0, 0, 0, 1, 1), (6, 1.0, 0, 0.0, 90, 0.0, 0, 0, 0, 1, 1),
    (3, 0.6, 2, 1.0, 40, 0.0, 0, 0, 0, 1, 1), (1, 0.0, 2, 1.0, 1, 1.0, 0, 0, 0, 1, 1),
    (2, 1.0, 4, 1.0, 3, 1.0, 0, 0, 0, 1, 1), (30, 1.0, 0, 0.0, 60, 0.0, 0, 0, 0, 1, 1),
    (5, 1.0, 60, 0.0, 60, 0.0, 0, 1, 0, 1, 0), (3, 0.0, 0, 0.0, 60, 0.0, 0, 1, 1, 1, 0),
    (4, 0.0, 90, 0.0, 20, 0.0, 0, 0, 1, 1, 0), (4, 1.0, 90, 0.0, 20, 0.0, 0, 0, 1, 1, 0),
    # short last lines and first ones
    (3, 0.0, 60, 0.0, 5, 1.0, 0, 0, 0, 0, 1), (1, 0.0, 80, 0.0, 30, 0.9, 0, 0, 0, 0, 1),
    (2, 0.0, 2, 0.0, 5, 1.0, 0, 0, 0, 0, 1), (1, 0.0, 1, 0.0, 1, 1.0, 0, 0, 0, 0, 1),
    (2, 0.0, 0, 0.0, 4, 1.0, 0, 0, 0, 0, 1), (2, 0.0, 4, 1.0, 0, 0.0, 0, 0, 0, 0, 1),
    # more than loose words between lists of links
    (5, 0.0, 4, 1.0, 3, 1.0, 0, 0, 0, 0, 1), (20, 0.0, 3, 1.0, 6, 1.0, 0, 0, 0, 0, 1),
    (90, 0.0, 2, 1.0, 5, 1.0, 0, 0, 0, 0, 1), (40, 0.05, 8, 0.9, 2, 1.0, 0, 0, 0, 0, 1),
    (60, 0.0, 2, 1.0, 1, 1.0, 0, 0, 0, 0, 1), (8, 0.0, 5, 1.0, 1, 1.0, 0, 0, 0, 0, 1),
    (1, 0.0, 3, 1.0, 6, 1.0, 0, 0, 0, 0, 0),
    (2, 0.0, 8, 0.9, 12, 0.9, 0, 0, 0, 0, 0), (3, 0.0, 20, 1.0, 3, 1.0, 0, 0, 0, 0, 0),
]


def grow_tree(table: list[tuple], depth: int = 10):
    """Nodes (feature, limit, below, above) and leaves 0 or 1, by least Gini impurity.

    Ties go to the feature that comes last and the smallest limit, so what encloses a block
    goes before its sizes.
    """
    data = np.array(table, np.float64)
    x, y = data[:, :-1], data[:, -1]
    if depth == 0 or len(np.unique(y)) < 2:
        return int(y.mean() > 0.5)
    best = None
    for f in range(x.shape[1] - 1, -1, -1):
        levels = np.unique(x[:, f])
        for limit in (levels[1:] + levels[:-1]) / 2:
            low = x[:, f] < limit
            cost = sum(len(s) * s.mean() * (1 - s.mean()) for s in (y[low], y[~low]))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, limit)
    if best is None:
        return int(y.mean() > 0.5)
    _, f, limit = best
    rows = [t for t in table if t[f] < limit], [t for t in table if t[f] >= limit]
    below, above = (grow_tree(r, depth - 1) for r in rows)
    return below if below == above else (f, float(limit), below, above)


def is_text(tree, features: tuple) -> bool:
    while not isinstance(tree, int):
        f, limit, below, above = tree
        tree = below if features[f] < limit else above
    return bool(tree)


def main_text(page: str, tree) -> str:
    """The text blocks of a page, joined by empty lines."""
    blocks = text_blocks(page)
    chosen = [b.text for b, f in zip(blocks, block_features(blocks)) if is_text(tree, f)]
    return "\n\n".join(chosen)


def extract_text(
    pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", labelled: list[tuple] = LABELLED
) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page, from its whole HTML.

    Character references are decoded, white space in a block becomes one space, and blocks
    are joined by two newlines in page order. A null or empty page, and one without text
    blocks, has an empty text. All rows are kept.
    """
    tree = grow_tree(labelled)
    kind = pages.schema[key].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        schema = pa.schema(
            [(key, to_arrow_type(kind)), (url, pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]
        )
        for rows in chunks(batches, 2):
            texts = [main_text(r[2], tree) for r in rows]
            yield to_batch(
                schema, [[r[0] for r in rows], [r[1] for r in rows], texts, list(map(len, texts))]
            )

    schema = f"`{key}` {kind.simpleString()}, `{url}` string, text string, n_chars long"
    return pages.select(F.col(key), F.col(url).cast("string").alias(url), F.col(page).alias("_page")).mapInArrow(run, schema)
