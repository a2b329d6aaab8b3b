"""Main text of web pages by minimum-cut labelling of their text blocks.

A page becomes a list of text blocks in page order.  A linear classifier over what a
block says about itself (its place in the page, class names, links, length, punctuation)
gives a score; a positive score is the capacity of the edge from the source (content), a
negative one that of the edge to the sink (boilerplate).  Neighbouring blocks, and blocks
with the same parent element, are joined by smoothness edges that are stronger the closer
the blocks are in the element tree.  The minimum cut, found by maximum flow, is the
labelling with the least total cost, so a short line between paragraphs of an article
follows them, and a sentence in a menu does not stand out.

A class name, id or role speaks against all text below its element, but only so far: a
name that describes the layout (``has-sidebar``, ``overflow-hidden``, ``tag-search``)
hardly counts, and neither does anything that speaks against a *wrapper*, an element
around the page's article or around most of its text.

Scripts, styles, comments of the markup, drawings, forms' controls and the page head never
become text; a formula's text does, its annotations, which are not shown, do not.  Character references are decoded, white space inside a block becomes one space,
blocks are joined by an empty line.  Nothing is cut off: an unfinished tag at the end is
markup, an unfinished reference stays as it is.

Defined cases: a null or empty page, or one without content, has the empty text;
repeated rows give repeated rows.
"""

from __future__ import annotations

import math
import re
from collections import deque
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.text import per_text

# --- the classifier's fixed weights -------------------------------------------

BIAS = -1.2
#: Per natural logarithm of one plus the number of words.
LENGTH = 0.7
SENTENCE = 0.8
TEXT_ELEMENT = 1.2
IN_ARTICLE = 3.0
#: Times the share of characters inside links.
LINKS = -5.0
#: The same inside an article or main element, where lists of links are content unless the
#: page has the same link in its navigation.
LINKS_IN_ARTICLE = -1.5
#: Inside an element that is not the article or not shown, under such a class name or
#: role, and under one that describes the layout, or a wrapper.
APART, NAMED, LAYOUT = -14.0, -8.0, -0.5
#: Smoothness between neighbours, divided by one plus their distance in the tree, and
#: between one block and the next with the same parent.
BESIDE, SIBLING = 1.5, 0.6

# Element names.
TEXT_ELEMENTS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figcaption", "dd", "dt"}
BLOCK_ELEMENTS = TEXT_ELEMENTS | set(
    "address article aside body button center details dialog div dl fieldset figure footer form "
    "head header hr html legend li main menu nav ol option section select summary table tbody td "
    "tfoot th thead title tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = {"head", "title", "button", "select", "option", "datalist", "object", "audio", "video", "canvas"}
APART_ELEMENTS = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
ARTICLE_ELEMENTS = {"article", "main"}
#: Words from which on a wrapper of one paragraph, in an article or not, can be the text.
LONG_PARAGRAPH = (40, 100)
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "body": {"head"},
}
# Words of class names, ids and roles.
APART_WORDS = set(
    "nav navbar navigation menu footer sidebar aside rail ad ads advert adverts advertisement adsense "
    "advertising banner promo promotion sponsor sponsored sponsors cookie cookies consent gdpr notice "
    "notices notification popup modal overlay alert comment comments commentlist respond reply replies "
    "disqus discussion share sharing social related recommended recommendations newsletter subscribe "
    "subscription signup login breadcrumb breadcrumbs pagination pager widget widgets toolbar topbar "
    "masthead copyright legal disclaimer skip search searchbox complementary contentinfo tags "
    "hidden outbrain taboola toc".split()
)
APART_NAMES = {"header", "site-header", "page-header", "main-header", "global-header", "top-header"}
#: First words of names that describe the layout or the topic.
LAYOUT_WORDS = set("has with without no not non overflow tag category cat term taxonomy".split())
ARTICLE_WORDS = set("article content post entry story articlebody main body text".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|iframe)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    # a drawing ends, as in browsers, at the latest where an element of the page begins
    r"|<(svg|annotation(?:-xml)?)(?=[\s/>])(?:(?:\"[^\"]*\"|'[^']*'|[^>\"'])*|[^>]*)"
    rf"(?:(?<=/)>|(?<!/)>.*?(?:</\2\s*>|(?=</?(?:{'|'.join(sorted(BLOCK_ELEMENTS - {'title'}))}|math)[\s/>])|\Z))"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>?"
    r"|<[!?/][^>]*>?",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(
    r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))|\b(hidden)\b"""
)
_SENTENCE = re.compile(r"[.!?…。！？][\"'»”’)]?(?:\s|$)|,\s")


class Element:
    __slots__ = ("tag", "parent", "depth", "own", "against", "article", "inside", "silent", "chars", "clean", "texts", "words")

    def __init__(self, tag: str, attributes: str, parent: Element | None):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.article = tag in ARTICLE_ELEMENTS or bool(parent and parent.article)
        #: In an element of that meaning, whatever class names say.
        self.inside = tag in ARTICLE_ELEMENTS or bool(parent and parent.inside)
        self.silent = tag in NO_TEXT or bool(parent and parent.silent)
        #: What speaks against the text in this element, because of itself.
        self.own = APART if tag in APART_ELEMENTS or (tag == "header" and not self.article) else 0.0
        if attributes and tag not in ("html", "body"):
            names = _names(attributes)
            if names is None:
                self.own = APART
            elif names:
                words = {w for n in names for w in re.split(r"[-_]+", n)}
                bad = min(map(_against, names))
                if names & APART_NAMES and not self.article:
                    bad = NAMED
                self.own = min(self.own, bad)
                self.article |= bool(words & ARTICLE_WORDS) and bad > NAMED
        #: The same with all elements around it.
        self.against = min(self.own, parent.against if parent else 0.0)
        self.chars = self.clean = 0.0
        self.texts = self.words = 0


def _against(name: str) -> float:
    """What a class name, id or role says against the text below it."""
    variant, _, plain = name.rpartition(":")
    words = re.split(r"[-_]+", plain)
    if APART_WORDS.isdisjoint(words):
        return 0.0
    return LAYOUT if variant or words[0] in LAYOUT_WORDS else NAMED


def _names(attributes: str) -> set[str] | None:
    """Lower-case class names, id and role; None for an element that is not shown."""
    out = set()
    for m in _ATTRIBUTE.finditer(attributes):
        if m[5]:
            return None
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id", "role"):
            out.update(re.sub(r"([a-z])([A-Z])", r"\1-\2", value).split())
        elif name == "aria-hidden" and value == "true":
            return None
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return None
    return out


class Block:
    __slots__ = ("text", "element", "linked", "repeated")

    def __init__(self, text: str, element: Element, linked: float):
        self.text, self.element, self.linked = text, element, linked
        #: A link that the page's navigation has as well.
        self.repeated = False


def blocks(html: str | None) -> list[Block]:
    """Text blocks in page order."""
    out: list[Block] = []
    if not html:
        return out
    root = here = Element("", "", None)
    made = [root]
    parts: list[str] = []
    linked, in_link = 0, 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text and not here.silent:
                out.append(Block(text, here, min(1.0, linked / max(1, sum(map(len, parts))))))
            parts.clear()
        linked = 0

    def add(text: str):
        nonlocal linked
        parts.append(text)
        if in_link:
            linked += len(text)

    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        if m is None:
            rest = html[at:]
            add(rest[:-1] if rest.endswith("<") else rest)
            break
        if m.start() > at:
            add(html[at : m.start()])
        at = m.end()
        tag = m[4].lower() if m[4] else ""
        if tag and not m[0].endswith(">"):
            close = html.find(">", at)
            at = end if close < 0 else close + 1
        if not tag:
            continue
        if m[3]:  # end tag
            if tag == "a":
                in_link = max(0, in_link - 1)
            if tag in BLOCK_ELEMENTS:
                flush()
                e = here
                while e is not root and e.tag != tag:
                    e = e.parent
                if e is not root:
                    here = e.parent
            continue
        if tag == "br":
            add(" ")
            continue
        if tag == "a":
            in_link += 1
        if tag not in BLOCK_ELEMENTS:
            continue
        flush()
        closes = CLOSES.get(tag, ())
        e = here
        if e.tag == "p":
            here = e.parent
        while closes and e is not root and e.tag in closes | {"p"}:
            here = e.parent
            e = here
        if tag not in VOID and not m[5].rstrip().endswith("/"):
            here = Element(tag, m[5], here)
            made.append(here)
        in_link = 0 if tag in ("li", "p", "div", "td") else in_link
    flush()
    _spare_wrappers(made, out)
    around = {b.text for b in out if b.linked > 0.5 and (b.element.against <= NAMED or not b.element.article)}
    for b in out:
        b.repeated = b.linked > 0.5 and b.text in around
    return out


def _spare_wrappers(made: list[Element], found: list[Block]) -> None:
    """Weigh ``against`` of all elements (parents first) anew: of wrappers little is left.

    A wrapper is around the largest article or main element, if that holds a third of the
    page's text outside links, or around more than half of that text.  Neither counts if
    enough text that nothing speaks against lies elsewhere.
    """
    if all(e.own > NAMED for e in made):
        return
    total = 0.0
    for b in found:
        e, n = b.element, len(b.text) * (1 - b.linked)
        total += n
        e.chars += n
        e.texts += e.tag in TEXT_ELEMENTS
        e.words += b.text.count(" ") + 1
        if e.article:
            e.clean += 5 * n
        elif evidence(b) > 0:
            e.clean += n
    for e in reversed(made[1:]):
        up = e.parent
        up.chars += e.chars
        up.texts += e.texts
        up.words += e.words
        if e.own > NAMED:
            up.clean += e.clean
    articles = [e for e in made if e.tag in ARTICLE_ELEMENTS]
    named = [e for e in articles if e.own > NAMED]
    best = max(named or articles, key=lambda e: e.chars, default=None)
    clean = made[0].clean
    around = set()
    if best is not None and 3 * best.chars >= total > 0 and clean < best.chars:
        while best is not None:
            around.add(id(best))
            best = best.parent
    for e in made[1:]:
        if e.own <= NAMED:
            most = (
                2 * e.chars > total > 4 * clean
                and (e.texts > 1 or e.words >= LONG_PARAGRAPH[not e.inside])
                and e.tag not in ("nav", "footer", "aside", "menu")
            )
            if id(e) in around or most:
                e.own = LAYOUT
                clean += e.clean
        e.against = min(e.own, e.parent.against)


def score(block: Block) -> float:
    """Positive: content."""
    return evidence(block) + block.element.against


def evidence(block: Block) -> float:
    """The score without what names and elements say against the block."""
    e, words = block.element, block.text.count(" ") + 1
    links = LINKS_IN_ARTICLE if e.inside and not block.repeated else LINKS
    z = BIAS + LENGTH * math.log1p(words) + links * block.linked
    if e.article:
        z += IN_ARTICLE
    if e.tag in TEXT_ELEMENTS:
        z += TEXT_ELEMENT
    if _SENTENCE.search(block.text):
        z += SENTENCE
    return z


def tree_distance(a: Element, b: Element) -> int:
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return n


def edges(found: list[Block]) -> dict[tuple[int, int], float]:
    """Smoothness edges ``(i, j)``, ``i < j``."""
    out: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for j, b in enumerate(found):
        if j:
            out[j - 1, j] = BESIDE / (1 + tree_distance(found[j - 1].element, b.element))
        parent = id(b.element.parent)
        if parent in last:
            i = last[parent]
            out[i, j] = out.get((i, j), 0.0) + SIBLING
        last[parent] = j
    return out


def minimum_cut(scores: list[float], smooth: dict[tuple[int, int], float]) -> list[bool]:
    """The side of each node: True with the source.

    A node whose own score outweighs all its edges takes its own side in any minimum
    cut; its edges then add to its neighbours' scores.  What is left is cut by maximum
    flow (Dinic's algorithm).
    """
    n = len(scores)
    z = list(scores)
    around: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), w in smooth.items():
        around[i][j] = around[i].get(j, 0.0) + w
        around[j][i] = around[j].get(i, 0.0) + w
    weight = [sum(a.values()) for a in around]
    side: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if side[i] is not None or abs(z[i]) < weight[i] or z[i] == 0:
            continue
        side[i] = z[i] > 0
        for j, w in around[i].items():
            if side[j] is None:
                z[j] += w if side[i] else -w
                weight[j] -= w
                queue.append(j)
    open_ = [i for i in range(n) if side[i] is None]
    if open_:
        number = {i: k for k, i in enumerate(open_)}
        flow = _Flow(len(open_) + 2)
        s, t = len(open_), len(open_) + 1
        for i in open_:
            k = number[i]
            if z[i] > 0:
                flow.edge(s, k, z[i], 0.0)
            elif z[i] < 0:
                flow.edge(k, t, -z[i], 0.0)
            for j, w in around[i].items():
                if j in number and i < j:
                    flow.edge(k, number[j], w, w)
        reached = flow.run(s, t)
        for i in open_:
            side[i] = reached[number[i]] >= 0
    return [bool(x) for x in side]


class _Flow:
    """Maximum flow on a small graph of floats."""

    TINY = 1e-9

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[float] = []

    def edge(self, a: int, b: int, there: float, back: float) -> None:
        for x, y, c in ((a, b, there), (b, a, back)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(c)

    def levels(self, s: int) -> list[int]:
        level = [-1] * len(self.out)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                if self.room[e] > self.TINY and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def run(self, s: int, t: int) -> list[int]:
        """Levels from ``s`` once no flow is left; -1 on the sink's side."""
        while True:
            level = self.levels(s)
            if level[t] < 0:
                return level
            turn = [0] * len(self.out)
            path: list[int] = []
            a = s
            while True:
                if a == t:
                    most = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= most
                        self.room[e ^ 1] += most
                    path, a = [], s
                    continue
                while turn[a] < len(self.out[a]):
                    e = self.out[a][turn[a]]
                    if self.room[e] > self.TINY and level[self.to[e]] == level[a] + 1:
                        break
                    turn[a] += 1
                if turn[a] < len(self.out[a]):
                    path.append(self.out[a][turn[a]])
                    a = self.to[path[-1]]
                elif path:
                    a = self.to[path.pop() ^ 1]
                    turn[a] += 1
                else:
                    break


def main_text(html: str | None) -> str:
    found = blocks(html)
    if not found:
        return ""
    content = minimum_cut([score(b) for b in found], edges(found))
    return "\n\n".join(b.text for b, c in zip(found, content, strict=True) if c)


def extract(pages: DataFrame, out: str, *, html: str = "html") -> DataFrame:
    """``pages`` with a string column ``out``, the main text."""
    return pages.withColumn(out, per_text(lambda: main_text, T.StringType())(F.col(html)))


def query(spark, sf_dir: str) -> DataFrame:
    """op9: the main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages, "main").select(
        "page_id", "url", F.col("main").alias("text"), F.length("main").cast("long").alias("n_chars")
    )
