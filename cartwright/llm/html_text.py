"""Main text of web pages from flat text blocks.

A page is read as a flat sequence of text blocks: block-level tags end a block,
inline tags do not; elements end where HTML ends them, also without an end tag. A
block knows its number of words, the share of its words
inside links, the zone it stands in (an element or class that says article, or
one that says menu, footer, advert, comment ...), whether the page has an article
zone, and the words and link density of the blocks before and after it. A
decision tree, trained with Spark ML on a small labelled table of blocks, says
which blocks are article.

Defined cases: null, empty and tag-less html are pages of one or no block; broken
markup is read as browsers do (unclosed elements end with their container, an
unfinished tag, comment or script swallows the rest); very long pages are read
whole; repeated rows are separate pages; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import html_samples

#: Content that is no text of the page.
_SKIPPED = frozenset("script style template svg math iframe noscript object audio video canvas select textarea button title".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Block elements whose class or id cannot make them the article: parts of text.
_PARTS = frozenset("p li dd dt tr th caption figcaption blockquote pre address summary h1 h2 h3 h4 h5 h6".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Where end tags may be left out: a start tag ends these elements, up to an element that holds them.
_ENDS = {
    **dict.fromkeys(("li",), (frozenset(("li",)), frozenset(("ul", "ol", "menu")))),
    **dict.fromkeys(("dd", "dt"), (frozenset(("dd", "dt")), frozenset(("dl",)))),
    **dict.fromkeys(("td", "th"), (frozenset(("td", "th")), frozenset(("tr", "table")))),
    "tr": (frozenset(("td", "th", "tr")), frozenset(("table",))),
    **dict.fromkeys(("tbody", "thead", "tfoot"), (frozenset(("td", "th", "tr", "tbody", "thead", "tfoot", "caption")),
                                                  frozenset(("table",)))),
}
#: What may stand in a head; anything else ends it.
_IN_HEAD = frozenset("meta link base title script style noscript template object".split())
#: A paragraph cannot be closed from inside these.
_NOT_IN_P = frozenset("td th caption button table html body".split())
_BOILER_TAGS = frozenset("nav footer aside form dialog fieldset head".split())
_MAIN_TAGS = frozenset("article main".split())
_MAIN_NAMES = frozenset("article main content post entry story articlebody body text".split())
_BOILER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert sidebar side aside menu nav navbar navigation navi breadcrumb breadcrumbs crumbs footer foot "
    "header masthead topbar toolbar comment comments commentlist disqus reply replies respond discussion related "
    "recommended recommendations more share sharing social follow newsletter subscribe subscription signup login popup "
    "modal overlay widget tags pagination pager copyright legal disclaimer search rating widgets teaser teasers".split())
_SOFT_NAMES = frozenset("header sidebar side more".split())
#: Boxes that hold articles of others; the other boilerplate names may only describe a wrapper's layout.
_OTHERS_NAMES = frozenset(
    "ad advert adverts advertisement advertising sponsor sponsored promo promotion comment comments commentlist disqus reply "
    "replies respond discussion related recommended recommendations more teaser teasers popup modal overlay".split())

_TAG = re.compile(r"""<([a-zA-Z][^\s/>]*+)((?:[^'">]|"[^"]*"|'[^']*')*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

FEATURES = ("words", "link_density", "zone", "page_has_main", "heading", "sentence",
            "prev_words", "prev_link_density", "next_words", "next_link_density", "prev_zone", "next_zone")


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)}


def _zone(tag: str, attributes: dict[str, str], outer: int) -> int:
    """1 article, -1 around it, 0 unknown; -2 around it by an outer wrapper's class or
    a form only, 2 an article element in there (see ``_settle``)."""
    if outer == -1:
        return -1
    wraps = outer in (0, -2)
    if tag in _BOILER_TAGS or tag == "header" and wraps:
        return -2 if tag == "form" and wraps else -1
    main = 1 if outer in (0, 1) else 2
    if tag in _HEADINGS:
        return outer
    if attributes.get("role") in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert"):
        return -1
    names = {n.lower() for k in ("class", "id") if k in attributes for n in _NAMES.findall(attributes[k])}
    if tag not in ("html", "body"):
        around = names & _BOILER_NAMES
        if around:
            return outer if around <= _SOFT_NAMES and (names & _MAIN_NAMES or outer > 0) else (
                -2 if wraps and tag not in _MAIN_TAGS and not around & _OTHERS_NAMES else -1)
        if tag in _PARTS:
            return outer
        if attributes.get("role") in ("main", "article") or outer != -2 and (
                names & _MAIN_NAMES or "articlebody" in attributes.get("itemprop", "").lower()):
            return main
    return main if tag in _MAIN_TAGS else outer


def _is_hidden(attributes: dict[str, str]) -> bool:
    return "hidden" in attributes or _HIDDEN.search(attributes.get("style", "")) is not None


class Block:
    __slots__ = ("text", "words", "linked", "zone", "heading", "label")

    def __init__(self, text: str, words: int, linked: int, zone: int, heading: bool, label: int) -> None:
        self.text, self.words, self.linked, self.zone, self.heading, self.label = text, words, linked, zone, heading, label


def _settle(blocks: list[Block]) -> None:
    """A wrapper goes round the page: article elements in it count where no other
    article is, and not less text than stands in unknown zones; else it is a box."""
    words = dict.fromkeys((-2, -1, 0, 1, 2), 0)
    for b in blocks:
        words[b.zone] += b.words
    inner = 1 if not words[1] and words[2] >= words[0] else -1
    for b in blocks:
        b.zone = {-2: -1, 2: inner}.get(b.zone, b.zone)


def blocks_of(html: str | None) -> list[Block]:
    """Text blocks of a page in page order."""
    html = html or ""
    blocks: list[Block] = []
    pieces: list[str] = []
    stack: list[tuple[str, int]] = []
    state = {"zone": 0, "link": 0, "heading": False, "label": 0}
    linked: list[str] = []
    hidden: list[tuple[str, int]] = []  # open inline elements from a hidden one on, and how deep the blocks were

    def end_block() -> None:
        if pieces:
            words = "".join(pieces).split()
            if words:
                blocks.append(Block(" ".join(words), len(words), min(len(words), len("".join(linked).split())),
                                    state["zone"], state["heading"], state["label"]))
            pieces.clear()
            linked.clear()

    def leave(names: frozenset[str], within: frozenset[str] = frozenset()) -> None:
        """End the outermost of the open elements ``names`` that is not outside ``within``."""
        at = len(stack)
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in within:
                break
            if stack[i][0] in names:
                at = i
        if at < len(stack):
            drop(at)

    def drop(at: int) -> None:
        state["zone"], state["link"] = stack[at][1], 0
        del stack[at:]
        while hidden and hidden[-1][1] > at:
            hidden.pop()

    def say(raw: str) -> None:
        if hidden:
            return
        if stack and stack[-1][0] == "head" and raw.strip():
            leave(frozenset(("head",)))
        text = unescape(raw) if "&" in raw else raw
        pieces.append(text)
        if state["link"]:
            linked.append(text)

    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            say(html[at:])
            break
        if lt > at:
            say(html[at:lt])
        follow = html[lt + 1:lt + 2]
        if follow.isascii() and follow.isalpha():
            m = _TAG.match(html, lt)
            if m is None:  # a quote that never ends: the tag goes up to the next bracket
                stop = html.find(">", lt)
                if stop < 0:
                    break
                tag, raw, at = re.match(r"[^\s/>]+", html[lt + 1:stop + 1])[0].lower(), "", stop + 1
            else:
                tag, raw, at = m[1].lower(), m[2], m.end()
            if stack and stack[-1][0] == "head" and tag not in _IN_HEAD:
                end_block()
                leave(frozenset(("head",)))
            if tag in _SKIPPED:
                if not raw.endswith("/"):
                    close = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
                    if close is None:
                        break
                    at = close.start()
                if tag not in ("button", "select", "textarea"):
                    continue
                say(" ")
                continue
            if tag in _INLINE:
                if tag not in _VOID and (hidden or raw.strip() and _is_hidden(_attributes(raw))):
                    hidden.append((tag, len(stack)))
                if tag == "a":
                    state["link"] = 1
                    say(" ") if not pieces else None
                continue
            if tag == "br":
                say(" ")
                continue
            end_block()
            if tag in _VOID:
                continue
            attributes = _attributes(raw) if raw.strip() else {}
            leave(frozenset(("p",)), _NOT_IN_P)
            if tag in _ENDS:
                leave(*_ENDS[tag])
            stack.append((tag, state["zone"]))
            state["link"] = 0
            state["zone"] = -1 if _is_hidden(attributes) else _zone(tag, attributes, state["zone"])
            state["heading"] = tag in _HEADINGS
            state["label"] = int("data-article" in attributes)
        elif follow == "/" and html[lt + 2:lt + 3].isalpha():
            stop = html.find(">", lt)
            if stop < 0:
                break
            tag, at = re.match(r"[^\s/>]+", html[lt + 2:stop + 1])[0].lower(), stop + 1
            if tag == "a":
                state["link"] = 0
            if tag in _INLINE and hidden:
                for i in range(len(hidden) - 1, -1, -1):
                    if hidden[i][0] == tag:
                        del hidden[i:]
                        break
            if tag in _INLINE or tag in _SKIPPED:
                continue
            end_block()
            state["heading"], state["label"] = False, 0
            last = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if last >= 0:
                drop(last)
        elif html.startswith("<!--", lt):
            if html.startswith(("<!-->", "<!--->"), lt):
                at = html.index(">", lt) + 1
                continue
            stop = html.find("-->", lt + 4)
            if stop < 0:
                break
            at = stop + 3
        elif follow in ("!", "?", "/") and follow:
            stop = html.find(">", lt)
            if stop < 0:
                break
            at = stop + 1
        else:
            say("<")
            at = lt + 1
    end_block()
    _settle(blocks)
    return blocks


def features_of(blocks: list[Block]) -> list[tuple[float, ...]]:
    """One tuple in the order of FEATURES per block."""
    has_main = float(any(b.zone > 0 for b in blocks))
    edge = (0.0, 0.0, -1.0)
    own = [(float(b.words), b.linked / b.words, float(b.zone)) for b in blocks]
    out = []
    for i, b in enumerate(blocks):
        words, density, zone = own[i]
        before, after = own[i - 1] if i else edge, own[i + 1] if i + 1 < len(own) else edge
        sentence = float(b.text[-1] in ".!?…:;\"”»)")
        out.append((words, density, zone, has_main, float(b.heading), sentence, *before[:2], *after[:2], before[2], after[2]))
    return out


def labelled_blocks(spark: SparkSession) -> DataFrame:
    """The built-in training table: features and label (1: article) per block."""
    rows = [(*f, float(b.label)) for page in html_samples.pages() for blocks in [blocks_of(page)]
            for f, b in zip(features_of(blocks), blocks)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in (*FEATURES, "label")))


def train(labelled: DataFrame, depth: int = 6) -> tuple:
    """A decision tree as nested (feature, threshold, left, right) or a label."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(labelled)
    model = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=2, seed=0).fit(data)

    def node(n) -> tuple:
        if n.subtreeDepth() == 0:
            return (float(n.prediction()),)
        return (n.split().featureIndex(), n.split().threshold(), node(n.leftChild()), node(n.rightChild()))

    return node(model._call_java("rootNode"))  # noqa: SLF001


def classify(tree: tuple, features: tuple[float, ...]) -> bool:
    while len(tree) > 1:
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree[0] > 0.5


def main_text(html: str | None, tree: tuple) -> str:
    blocks = blocks_of(html)
    return " ".join(b.text for b, f in zip(blocks, features_of(blocks)) if classify(tree, f))


def extract_text(html: Column, tree: tuple) -> Column:
    """Main text of an html column; never null."""

    @F.pandas_udf(T.StringType())
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p, tree) for p in pages], dtype=object)

    return of(html)
