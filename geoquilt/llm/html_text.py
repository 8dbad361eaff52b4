"""The main text of web pages from flat text blocks.

A page is read once into a flat list of text blocks. Each block has its number of words, its share of words inside links,
whether it stands in the article or in a heading, how much it stands in a part named as something else, and words and link
share of the blocks before and after it. A name counts in full where it stands alone or with names of parts, by half among
other words, where words, links and neighbours decide, and not beside words for a state (``no-sidebar``). A decision tree, trained on the labelled table below, tells which blocks belong to the
article; these are joined in page order. Pages don't meet, so the job is one pass without a shuffle.

Null or empty pages give an empty text. Broken markup is read as far as it can be told: an unclosed element ends with the
element around it, paragraphs and items end where the next begins, text after an unclosed script or style is part of it.
What isn't shown (``hidden``, ``display: none``) and what drawings, media and other objects hold isn't read. Repeated rows are answered each; an empty table
gives an empty table; clashing column names don't matter, as only ``keep`` is returned. Very long pages are read whole, in a time that
goes with their length. A block on which the tree is undecided is kept.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from geoquilt.llm.common import slices

# Fixed values
BLOCK_TAGS = frozenset("address article aside blockquote body br button center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
UNREAD_TAGS = frozenset("audio canvas object select svg template video".split())
OTHER_TAGS = frozenset("aside button dialog fieldset footer form menu nav search".split())
ARTICLE_TAGS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OTHER_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies "
    "copyright disqus feedback footer gdpr hidden legal login menu menubar modal nav navbar navigation newsletter notice notices outbrain overlay pager pagination "
    "paywall popup promo promoted promotion recommended related replies respond search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription tags taboola teaser toolbar topbar widget complementary contentinfo alert".split()
)
PAGE_HEADER_NAMES = frozenset("header masthead".split())
#: Elements that end where another one begins beside them.
_CELL, _ROW = ("td", "th"), ("td", "th", "tr")
ENDED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "td": _CELL, "th": _CELL, "tr": _ROW, "tbody": _ROW, "thead": _ROW, "tfoot": _ROW} | dict.fromkeys(HEADINGS, tuple(HEADINGS))
#: Words beside a name that tell a state of the page, and parts that such an element has.
STATE_NAMES = frozenset("has have no not with without is open closed on off enabled disabled show shown hide layout format type status category tag full".split())
PART_NAMES = frozenset(
    "list box bar wrap wrapper container area section block left right top bottom main primary secondary inner outer item items link links post posts page site "
    "global article articles form header title body content text author meta count button buttons icon icons group row column col panel region zone slot unit "
    "message policy story stories news reader user thread small large mobile desktop sticky fixed the a an and for of by in us".split()
)

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "article", "other", "heading")
#: Labelled blocks: the FEATURES, then 1 for article text.
LABELLED = (
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0), (2, 1.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0), (3, 1.0, 3, 1.0, 30, 0.0, 0, 1, 0, 0),
    (9, 0.0, 1, 1.0, 8, 0.0, 0, 1, 0, 0), (12, 0.0, 1, 1.0, 40, 0.0, 0, 1, 0, 0), (60, 0.0, 40, 0.0, 0, 0.0, 0, 1, 0, 0), (25, 0.1, 80, 0.0, 3, 1.0, 0, 1, 0, 0),
    (45, 0.0, 50, 0.0, 45, 0.0, 1, 1, 0, 0), (30, 0.0, 60, 0.0, 20, 0.0, 1, 1, 0, 0), (7, 0.0, 90, 0.0, 0, 0.0, 1, 1, 0, 0), (4, 0.5, 20, 0.0, 4, 0.5, 1, 1, 0, 0),
    (6, 0.0, 30, 0.0, 30, 0.0, 1, 1, 1, 0), (3, 0.0, 2, 1.0, 25, 0.0, 0, 1, 1, 0), (120, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 0), (14, 0.9, 10, 0.9, 11, 0.9, 1, 1, 0, 0),
    (8, 0.0, 9, 0.0, 50, 0.0, 1, 0, 1, 1), (5, 0.0, 1, 1.0, 1, 0.0, 1, 0, 1, 1), (1, 0.0, 40, 0.0, 60, 0.0, 1, 0, 0, 1), (1, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 1),
    (2, 0.0, 3, 0.0, 2, 0.0, 1, 0, 0, 1), (30, 0.0, 8, 0.0, 45, 0.0, 1, 0, 0, 1), (80, 0.05, 60, 0.0, 90, 0.0, 1, 0, 0, 1), (200, 0.1, 4, 0.0, 10, 0.0, 1, 0, 0, 1),
    (15, 0.4, 50, 0.0, 40, 0.0, 1, 0, 0, 1), (6, 0.5, 70, 0.1, 30, 0.0, 1, 0, 0, 1), (3, 0.0, 50, 0.0, 10, 0.0, 1, 0, 0, 1), (12, 1.0, 60, 0.0, 60, 0.0, 1, 0, 0, 1),
    (5, 1.0, 30, 0.0, 40, 0.0, 1, 0, 0, 1), (4, 1.0, 4, 1.0, 4, 1.0, 1, 0, 0, 0), (6, 1.0, 40, 0.0, 6, 1.0, 1, 0, 0, 0), (5, 1.0, 6, 1.0, 12, 0.0, 1, 0, 0, 0),
    (50, 0.0, 40, 0.0, 60, 0.0, 0, 0, 0, 1), (35, 0.1, 6, 0.0, 2, 1.0, 0, 0, 0, 1), (90, 0.2, 0, 0.0, 30, 0.0, 0, 0, 0, 1), (22, 0.0, 70, 0.0, 80, 0.0, 0, 0, 0, 1),
    (6, 0.0, 2, 1.0, 60, 0.0, 0, 0, 1, 1), (9, 0.0, 60, 0.0, 55, 0.0, 0, 0, 1, 1), (4, 0.0, 60, 0.0, 45, 0.0, 0, 0, 0, 1), (8, 0.0, 30, 0.0, 30, 0.1, 0, 0, 0, 1),
    (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0), (6, 0.0, 2, 0.5, 8, 0.0, 0, 0, 0, 0), (30, 0.9, 20, 0.9, 30, 0.8, 0, 0, 0, 0), (18, 0.7, 3, 1.0, 50, 0.0, 0, 0, 0, 0),
    (3, 0.0, 3, 1.0, 2, 1.0, 0, 0, 1, 0), (5, 0.0, 3, 0.0, 4, 0.9, 0, 0, 1, 0), (8, 0.0, 5, 0.0, 0, 0.0, 0, 0, 0, 0), (7, 0.3, 40, 0.0, 3, 1.0, 0, 0, 0, 0),
    (24, 0.0, 3, 0.0, 1, 0.0, 1, 0, 0, 1), (40, 0.0, 1, 1.0, 2, 1.0, 1, 0, 0, 1), (7, 0.0, 1, 1.0, 3, 1.0, 1, 0, 0, 1), (2, 0.0, 1, 1.0, 1, 1.0, 1, 0, 0, 1),
    (10, 0.0, 2, 1.0, 1, 0.0, 1, 0, 0, 1), (16, 0.1, 20, 0.8, 1, 1.0, 1, 0, 0, 1), (60, 0.0, 9, 1.0, 0, 0.0, 1, 0, 0, 1), (9, 0.0, 4, 1.0, 0, 0.0, 1, 0, 0, 1),
    (1, 0.0, 1, 1.0, 5, 0.6, 1, 0, 0, 1), (3, 0.0, 8, 0.9, 2, 0.5, 1, 0, 0, 1), (12, 0.2, 1, 0.0, 1, 0.0, 1, 0, 0, 1), (28, 0.0, 1, 0.0, 4, 0.7, 1, 0, 0, 1),
    (5, 0.0, 1, 1.0, 1, 1.0, 1, 0, 1, 1), (11, 0.0, 6, 1.0, 0, 0.0, 1, 0, 1, 1), (32, 0.3, 5, 0.5, 12, 0.9, 1, 0, 0, 1), (150, 0.0, 1, 1.0, 1, 1.0, 1, 0, 0, 1),
    (6, 0.0, 1, 0.0, 0, 0.0, 1, 0, 0, 1), (17, 0.0, 0, 0.0, 1, 1.0, 1, 0, 0, 1), (2, 0.0, 60, 0.0, 5, 0.8, 1, 0, 0, 1), (8, 0.1, 100, 0.1, 7, 1.0, 1, 0, 0, 1),
    (20, 0.0, 6, 0.0, 1, 1.0, 0, 0, 0, 1), (45, 0.0, 1, 1.0, 2, 0.5, 0, 0, 0, 1), (70, 0.1, 3, 1.0, 5, 1.0, 0, 0, 0, 1), (30, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (5, 0.0, 1, 1.0, 2, 0.0, 0, 0, 0, 0), (3, 0.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0), (1, 0.0, 9, 0.0, 3, 1.0, 0, 0, 0, 0), (9, 0.0, 2, 1.0, 1, 1.0, 0, 0, 0, 0),
    (2, 0.0, 2, 0.0, 2, 0.0, 0, 0, 0, 0), (10, 0.0, 4, 0.0, 3, 0.0, 0, 0, 0, 0), (6, 0.0, 12, 0.9, 4, 0.0, 0, 0, 0, 0), (12, 1.0, 8, 1.0, 9, 1.0, 0, 0, 0, 0),
    (45, 0.0, 50, 0.0, 45, 0.0, 1, 0.5, 0, 1), (30, 0.0, 6, 0.0, 20, 0.0, 1, 0.5, 0, 1), (22, 0.1, 60, 0.0, 1, 1.0, 1, 0.5, 0, 1), (60, 0.0, 0, 0.0, 3, 1.0, 0, 0.5, 0, 1),
    (6, 0.0, 30, 0.0, 40, 0.0, 1, 0.5, 1, 1), (90, 0.2, 2, 0.0, 0, 0.0, 0, 0.5, 0, 1), (20, 0.0, 8, 0.0, 70, 0.0, 1, 0.5, 0, 1), (35, 0.0, 40, 0.0, 0, 0.0, 1, 0.5, 0, 1),
    (4, 0.5, 20, 0.0, 4, 0.5, 1, 0.5, 0, 0), (3, 1.0, 3, 1.0, 3, 1.0, 0, 0.5, 0, 0), (8, 0.9, 40, 0.0, 8, 0.9, 1, 0.5, 0, 0), (5, 0.0, 60, 0.0, 4, 1.0, 1, 0.5, 0, 0),
    (5, 0.0, 60, 0.0, 30, 0.0, 1, 0, 0, 1), (4, 0.0, 90, 0.0, 0, 0.0, 1, 0, 0, 1), (6, 0.0, 120, 0.0, 5, 0.0, 1, 0, 0, 1), (5, 0.0, 70, 0.0, 4, 1.0, 1, 0, 0, 1),
    (25, 0.8, 20, 0.7, 18, 0.9, 1, 0.5, 0, 0), (2, 0.0, 1, 1.0, 6, 1.0, 0, 0.5, 1, 0), (7, 0.0, 3, 0.0, 2, 1.0, 0, 0.5, 0, 0), (12, 1.0, 9, 1.0, 60, 0.0, 0, 0.5, 0, 0),
    (25, 0.0, 1, 1.0, 3, 0.0, 0, 1, 0, 0), (2, 0.0, 1, 0.0, 9, 0.0, 0, 1, 0, 0), (50, 0.0, 1, 0.0, 60, 0.0, 1, 1, 0, 0), (5, 0.0, 30, 0.0, 1, 1.0, 1, 1, 0, 0),
)

TAG = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
#: A value in quotes, or the end of a tag.
VALUE_OR_END = re.compile(r">|=\s*+(?:\"[^\"]*+\"|'[^']*+')")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]*+))?")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: How much an element is something else if it isn't shown at all.
HIDDEN = 2.0
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def named_other(tag: str, attributes: str, in_article: bool) -> float:
    """How much an element says that it isn't article text: HIDDEN, 1 outright, 0.5 by a name among others, or 0."""
    most = 1.0 if tag in OTHER_TAGS or tag == "header" and not in_article else 0.0
    if not attributes or tag in ("html", "body", *ARTICLE_TAGS):
        return most
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and HIDING.search(value):
            return HIDDEN
        if key in ("class", "id", "role"):
            for word in value.split():
                names = {x.lower() for x in NAME.findall(word)}
                said = names & OTHER_NAMES or (set() if in_article else names & PAGE_HEADER_NAMES)
                if said and not names & STATE_NAMES:
                    most = max(most, 1.0 if names <= said | OTHER_NAMES | PART_NAMES else 0.5)
    return most


def tags(page: str) -> Iterator[tuple[str, str, str, bool]]:
    """(text before it, name, attributes, closing) of each tag in page order, then the text behind the last one with no name.

    One pass: every character is looked at a bounded number of times. Raw elements come with nothing between their tags. A
    value whose quotes hide every later end of a tag has no quotes: from there on tags end at the next ``>``. An unfinished
    tag at the end of a page is left out."""
    at, text, quotes = 0, [], True
    while (lt := page.find("<", at)) >= 0:
        text.append(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 2)  # <!--> is a comment, too
            at = len(page) if end < 0 else end + 3
            continue
        m = TAG.match(page, lt)
        if m is None and page[lt + 1 : lt + 2] not in ("!", "?", "/"):
            text.append("<")
            at = lt + 1
            continue
        gt = -1
        if quotes and m is not None:
            gt = next((v.start() for v in VALUE_OR_END.finditer(page, m.end()) if v[0] == ">"), -1)
            quotes = gt >= 0
        if gt < 0 and (gt := page.find(">", lt)) < 0:
            at = len(page)
            break
        at = gt + 1
        if m is None:
            continue
        name, closing = m[1].lower(), page[lt + 1] == "/"
        yield "".join(text), name, page[m.end() : gt], closing
        text = []
        if name in RAW_TAGS and not closing:
            found = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            at = found.start() if found else len(page)
    yield "".join([*text, page[at:]]), "", "", False


class Element(NamedTuple):
    tag: str
    article: bool
    other: float
    heading: bool
    unread: bool


class Elements:
    """Open elements. An article is a scope that end tags of other elements don't reach out of. Places of blocks, and those
    of paragraphs, are kept on stacks of their own, so nothing is searched for."""

    def __init__(self) -> None:
        self.open: list[Element] = []
        self.scopes: list[Counter] = [Counter()]
        self.articles: Counter = Counter()
        self.blocks: list[int] = []
        self.paragraphs: list[int] = []

    def now(self) -> Element:
        return self.open[-1] if self.open else Element("", False, 0.0, False, False)

    def push(self, e: Element, block: bool) -> None:
        if e.tag in ARTICLE_TAGS:
            self.scopes.append(Counter())
            self.articles[e.tag] += 1
        self.scopes[-1][e.tag] += 1
        if e.tag == "p":
            self.paragraphs.append(len(self.open))
        elif block:
            self.blocks.append(len(self.open))
        self.open.append(e)

    def pop(self) -> str:
        tag = self.open.pop().tag
        self.scopes[-1][tag] -= 1
        if tag in ARTICLE_TAGS:
            self.scopes.pop()
            self.articles[tag] -= 1
        for places in (self.blocks, self.paragraphs):
            if places and places[-1] == len(self.open):
                places.pop()
        return tag

    def has(self, tag: str) -> bool:
        return (self.articles if tag in ARTICLE_TAGS else self.scopes[-1])[tag] > 0

    def end(self, tag: str) -> None:
        while self.has(tag) and self.pop() != tag:
            pass

    def make_room(self, tag: str) -> None:
        """End what a block that begins now ends: a paragraph, an item before it, a heading, a drawing."""
        if self.paragraphs and (not self.blocks or self.paragraphs[-1] > self.blocks[-1]):
            self.end("p")
        while self.blocks and (before := self.open[self.blocks[-1]].tag) in (*ENDED_BY.get(tag, ()), "svg"):
            self.end(before)


def blocks(page: str) -> list[tuple[str, int, int, int, float, int]]:
    """(text, words, words in links, article, other, heading) in page order."""
    out: list[tuple[str, int, int, int, float, int]] = []
    elements = Elements()
    parts: list[str] = []
    linked: list[str] = []
    in_link = False

    def end_block() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            now = elements.now()
            out.append((text, text.count(" ") + 1, len(html.unescape("".join(linked)).split()), int(now.article), now.other, int(now.heading)))
        parts.clear()
        linked.clear()

    for text, tag, attributes, closing in tags(page):
        now = elements.now()
        if text and not now.unread:
            parts.append(text)
            if in_link:
                linked += [text, " "]
        if tag == "a":
            in_link = not closing
        block = tag in BLOCK_TAGS
        if block:
            end_block()
            in_link = in_link and not closing and tag == "br"
        if closing:
            if elements.has(tag):
                if not block and (now.tag != tag or not now.unread):
                    end_block()
                elements.end(tag)
            continue
        if tag in VOID_TAGS or tag in ("", "html", "body", "head") or tag in RAW_TAGS:
            if tag == "hr":
                elements.make_room(tag)
            continue
        if block:
            elements.make_room(tag)
            now = elements.now()
        if attributes.endswith("/"):
            continue
        own = named_other(tag, attributes, now.article)
        other = max(now.other, own)
        # inside a line what is named outright is left out, so that the words around it stay one block
        unread = now.unread or tag in UNREAD_TAGS or own == HIDDEN or not block and other > now.other and other >= 1
        heading = tag in HEADINGS or now.heading and not block
        if block or unread != now.unread or other > now.other or elements.has(tag):
            if not block and not unread:
                end_block()
            elements.push(Element(tag, now.article or tag in ARTICLE_TAGS, other, heading, unread), block or tag in UNREAD_TAGS)
    end_block()
    return out


def features(found: list[tuple[str, int, int, int, float, int]]) -> np.ndarray:
    x = np.zeros((len(found), len(FEATURES)))
    for i, (_, words, links, article, other, heading) in enumerate(found):
        x[i, [0, 1, 6, 7, 8]] = words, links / words, article, other, heading
    x[1:, 2:4], x[:-1, 4:6] = x[:-1, 0:2], x[1:, 0:2]
    return x


def train(x: np.ndarray, y: np.ndarray, depth: int = 6) -> tuple:
    """A decision tree: (feature, threshold, tree at or below, tree above), or a leaf's share of ones; splits by Gini's index."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0):
        return (share,)
    best = (2 * share * (1 - share) - 1e-9,)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            gini = sum(2 * p * (1 - p) * part.mean() for part, p in ((low, y[low].mean()), (~low, y[~low].mean())))
            if gini < best[0]:
                best = (float(gini), f, float(cut))
    if len(best) == 1:
        return (share,)
    low = x[:, best[1]] <= best[2]
    return (best[1], best[2], train(x[low], y[low], depth - 1), train(x[~low], y[~low], depth - 1))


def predict(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    low = x[:, tree[0]] <= tree[1]
    out = np.empty(len(x))
    out[low], out[~low] = predict(tree[2], x[low]), predict(tree[3], x[~low])
    return out


def main_text(page: str | None, tree: tuple) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    return " ".join(b[0] for b, p in zip(found, predict(tree, features(found)), strict=True) if p >= 0.5)


def extract(pages: DataFrame, page: str = "html", keep: list[str] | None = None, labelled: tuple = LABELLED, out: str = "text") -> DataFrame:
    """The ``keep`` columns (default: all) and the main text of each page."""
    keep = [c for c in (pages.columns if keep is None else keep) if c != out]
    table = np.array(labelled, float)
    tree = train(table[:, :-1], table[:, -1])
    rows = pages.select(*[pages[c] for c in keep], pages[page].cast("string").alias("_page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in slices(batch.column(len(keep)), 1 << 20):
                part = batch.slice(at, n)
                texts = [main_text(t, tree) for t in part.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, out])

    return rows.mapInArrow(run, rows.select(*keep).schema.add(out, "string"))
