"""Main text of web pages by tag-path ratios.

A page is read into text nodes, each with its tag path (elements from the root, with their classes and ids).
Per path, text length and punctuation are summed and divided by the nodes that have it; the two ratios are
smoothed over neighbouring nodes in page order and fused into one score, and nodes whose score passes a
threshold (a share of the mean, lowered by the spread) are content. An ``article`` or ``main`` (or those of the page
together) that holds most of their weight is taken for the main text as a whole. Elsewhere the nodes are chosen one
by one: of the deepest element that holds nearly all of the weight, the nodes from the first to the last whose own
path passes the threshold, with the headings that stand right before them; what lies between is filled in.

Boilerplate never takes part: elements that by tag, role, class or id are menus, page headers, footers,
sidebars, notices, adverts, forms, reader comments, scripts or styles, and hidden elements. A form, or an element
known only by its class or id, takes part after all if it holds nearly all of the scored weight, or most of it on
a page without text in an article or main outside of it. Outside an article, blocks that are mostly links are
dropped as well. A head that is not closed ends where text or an element of the body begins.

Every page is one row and worked on whole; there is no shuffle. Defined cases: null and empty html give the
empty text; text without any markup is its own main text; unclosed, misnested and cut-off markup is read as far
as it goes, in time and memory in proportion to the page's length, however long or deep it is; repeated rows give repeated results; columns other than id, url and html are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.llm.common import ship

# Kinds of elements, and the names by which boilerplate is known.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rb rp rt ruby s
    samp small span strike strong sub sup time tt u var wbr""".split())
CLOSES_P = frozenset("""address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table ul""".split())
SCOPES = frozenset("""article aside blockquote body button caption dialog div footer form header html li main nav object
    section table td th""".split())
SAME_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
               "td": ("td", "th"), "th": ("td", "th")}
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
DROPPED = frozenset("""head script style noscript template iframe svg canvas object embed audio video map input
    button select option textarea fieldset nav footer aside menu dialog title noembed noframes""".split())
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
DROPPED_ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar
    toolbar tablist""".split())
DROPPED_WORDS = frozenset("""ad ads adv advert advertisement advertising adsense adslot banner sponsor sponsored promo
    promotion promoted cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe
    subscription nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar aside rail widget widgets related
    recommended share sharing social comment comments commentlist reply replies respond disqus discussion footer foot
    masthead login signin signup register search searchform toolbar pagination pager skip skiplink hidden
    disclaimer copyright outbrain taboola tags tagcloud""".split())
DROPPED_HEADERS = frozenset("header site topbar".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？।؟،]")

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+)(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_RAW_END = {tag: re.compile(rf"</{tag}[\s/>]", re.I) for tag in RAW}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

SMOOTHING = 1.0        # standard deviation of the smoothing, in nodes
MOST = 0.5
COVERED = 0.9          # share of the content's weight that the content element holds
LINKS = 0.5            # share of linked text from which a block outside an article is a list of links


@dataclass
class Node:
    text: str                          # decoded, white space as it came
    element: int                       # innermost open element
    path: int                          # number of its tag path
    linked: bool
    block: int


@dataclass
class Element:
    """An element of the page; 0 stands for the page itself. Parents come before their children."""

    tag: str
    parent: int
    path: int
    dropped: bool = False
    linked: bool = False               # in a link
    article: bool = False              # in an article or main, itself included
    named: bool = False                # boilerplate by name only


def _boilerplate(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in DROPPED or tag == "header" and not in_article:
        return True
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    return attributes.get("role", "").lower() in DROPPED_ROLES or bool(_HIDDEN_STYLE.search(attributes.get("style", "")))


def _named(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether a form, or boilerplate by class or id alone."""
    if tag == "form":
        return True
    if tag in ("body", "html", "article", "main"):
        names = {w.lower() for x in (attributes.get("class", ""), attributes.get("id", "")) for w in re.split(r"\s+", x)}
        return tag == "article" and bool(names & {"comment", "comments", "reply", "ad", "advert", "sponsored", "related"})
    for value in (attributes.get("class", ""), attributes.get("id", "")):
        for name in value.split():
            words = [w.lower() for w in _WORDS.findall(name)]
            if DROPPED_WORDS.intersection(words) or not in_article and DROPPED_HEADERS.intersection(words[:1]):
                return True
    return False


def parse(page: str) -> tuple[list[Node], list[Element]]:
    """(text nodes without boilerplate, all elements)."""
    nodes: list[Node] = []
    elements = [Element("", 0, 0)]
    stack = [0]                                    # open elements
    opened: Counter[str] = Counter()               # and how many of each tag
    paths: dict[tuple[int, str], int] = {}         # a path is its parent's number and a label
    last: dict[int, int] = {}                      # last node of the block by innermost named element
    chain = [0]                                    # of each element the innermost boilerplate by name
    at = block = 0

    def pop(to: int) -> None:
        for e in stack[to:]:
            opened[elements[e].tag] -= 1
        del stack[to:]

    def text(raw: str) -> None:
        nonlocal last
        if raw and not raw.isspace() and elements[stack[-1]].tag == "head":
            pop(-1)
        here = elements[stack[-1]]
        if not raw or here.dropped:
            return
        if not raw.isspace():
            last[chain[stack[-1]]] = len(nodes)
            nodes.append(Node(html.unescape(raw), stack[-1], here.path, here.linked, block))
        elif chain[stack[-1]] in last:
            nodes[last[chain[stack[-1]]]].text += " "

    while at < len(page):
        m = _MARKUP.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:-3])
            continue
        tag, closing, rest = name.lower(), (m[1] or m[4]) == "/", m[3] or m[6] or ""
        if tag not in INLINE:
            block += 1
            last = {}
        if closing:
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                open_tag = elements[stack[i]].tag
                if open_tag == tag:
                    if tag in INLINE:
                        opened[tag] -= 1
                        del stack[i]
                    else:
                        pop(i)
                    break
                if tag in INLINE and open_tag not in INLINE or tag == "p" and open_tag in SCOPES:
                    break
            continue
        if tag not in HEAD and elements[stack[-1]].tag == "head":
            pop(-1)
        if tag in CLOSES_P or tag in SAME_CLOSES:
            over = ("p", *SAME_CLOSES.get(tag, ()))
            i = len(stack) - 1
            while i > 0 and any(opened[x] for x in over):
                open_tag = elements[stack[i]].tag
                if open_tag in over:
                    pop(i)
                elif open_tag in SCOPES or open_tag in ("ul", "ol", "dl", "select"):
                    break
                i -= 1
        if tag in VOID:
            continue
        attributes = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(rest)} if rest.strip("/ \n\t") else {}
        up = elements[stack[-1]]
        dropped = up.dropped or _boilerplate(tag, attributes, up.article)
        if tag in RAW:
            close = _RAW_END[tag].search(page, at)
            at = close.start() if close else len(page)
        label = tag + "".join("." + x for x in attributes.get("class", "").split()[:3])
        named = not dropped and _named(tag, attributes, up.article)
        elements.append(Element(tag, stack[-1], paths.setdefault((up.path, label), len(paths) + 1), dropped,
                                up.linked or tag == "a", up.article or tag in ("article", "main"), named))
        chain.append(len(elements) - 1 if named else chain[stack[-1]])
        stack.append(len(elements) - 1)
        opened[tag] += 1
    return without_named(nodes, elements), elements


def without_named(nodes: list[Node], elements: list[Element]) -> list[Node]:
    """The nodes outside of boilerplate by name, except for elements that hold what the page is about."""
    if not any(e.named for e in elements):
        return nodes
    held, total = weights(nodes, elements)
    out = [False] * len(elements)                      # in boilerplate by name
    for i, e in enumerate(elements[1:], 1):
        out[i] = out[e.parent] or e.named
    region = any(elements[n.element].article for n in nodes if not out[n.element])
    for i, e in enumerate(elements[1:], 1):
        out[i] = out[e.parent] or e.named and not (
            held[i] >= COVERED * total or not region and held[i] > MOST * total)
    return [n for n in nodes if not out[n.element]]


def scores(nodes: list[Node]) -> tuple[list[float], list[float]]:
    """Fused tag-path ratio of each node, smoothed and of its own path alone: the text ratio times one plus the log
    of the punctuation ratio."""
    chars: dict[int, int] = {}
    marks: dict[int, int] = {}
    count: dict[int, int] = {}
    for n in nodes:
        size = len(n.text.strip())
        chars[n.path] = chars.get(n.path, 0) + (0 if n.linked else size)
        marks[n.path] = marks.get(n.path, 0) + (0 if n.linked else len(PUNCTUATION.findall(n.text)))
        count[n.path] = count.get(n.path, 0) + 1
    length = [chars[n.path] / count[n.path] for n in nodes]
    signs = [marks[n.path] / count[n.path] for n in nodes]
    reach = [math.exp(-0.5 * (d / SMOOTHING) ** 2) for d in range(3)]

    def smooth(x: list[float]) -> list[float]:
        out = []
        for i in range(len(x)):
            total = weight = 0.0
            for j in range(max(0, i - 2), min(len(x), i + 3)):
                total += reach[abs(i - j)] * x[j]
                weight += reach[abs(i - j)]
            out.append(total / weight)
        return out

    fuse = lambda x, y: [a * (1.0 + math.log1p(b)) for a, b in zip(x, y)]
    return fuse(smooth(length), smooth(signs)), fuse(length, signs)


def threshold(score: list[float]) -> float:
    mean = sum(score) / len(score)
    spread = math.sqrt(sum((s - mean) ** 2 for s in score) / len(score))
    return max(0.0, mean - 0.5 * spread) * 0.5


def weights(nodes: list[Node], elements: list[Element]) -> tuple[list[float], float]:
    """(weight of the nodes that pass the threshold in each element, and in all)."""
    held = [0.0] * len(elements)
    if nodes:
        score, _ = scores(nodes)
        limit = threshold(score)
        for n, s in zip(nodes, score):
            if s >= limit:
                held[n.element] += len(n.text.strip()) * (0.2 if n.linked else 1.0)
    for i in range(len(elements) - 1, 0, -1):
        held[elements[i].parent] += held[i]
    return held, held[0]


def inside(elements: list[Element], roots: set[int]) -> list[int]:
    """Of each element the outermost of ``roots`` that holds it (or that it is); -1 if none does."""
    out = [-1] * len(elements)
    for i, e in enumerate(elements):
        out[i] = out[e.parent] if i and out[e.parent] >= 0 else i if i in roots else -1
    return out


def chosen_nodes(nodes: list[Node], elements: list[Element]) -> list[Node]:
    """The nodes from the first to the last whose own path passes the threshold, and the headings right before them.

    Smoothing fills what lies between; at the edges, where it would lift a menu beside a paragraph, a node must pass
    by its path alone.
    """
    score, own = scores(nodes)
    limit = threshold(score)
    passing = [i for i, s in enumerate(own) if s >= limit and not nodes[i].linked]
    if not passing:
        return nodes
    first = passing[0]
    heading = [False] * len(elements)
    for i, e in enumerate(elements[1:], 1):
        heading[i] = heading[e.parent] or e.tag in HEADINGS
    while first and heading[nodes[first - 1].element]:
        first -= 1
    last, block = passing[-1] + 1, nodes[passing[-1]].block
    while last < len(nodes) and nodes[last].block == block:      # the rest of the last block
        last += 1
    while first and nodes[first - 1].block == nodes[first].block:
        first -= 1
    return nodes[first:last]


def content_nodes(nodes: list[Node], elements: list[Element]) -> list[Node]:
    """The nodes of the main text."""
    if not nodes:
        return []
    held, total = weights(nodes, elements)
    regions = {i for i, e in enumerate(elements) if e.tag in ("article", "main") and held[i] > 0}
    if regions:       # the article or main of the greatest weight; an article inside a main of equal weight first
        best = max(regions, key=lambda i: (held[i], elements[i].tag == "article", i))
        if held[best] > MOST * total:
            of = inside(elements, {best})
            return [n for n in nodes if of[n.element] >= 0]
        # the articles of a page are one text if none of them, but all of them together hold the weight
        of = inside(elements, regions)
        if sum(held[i] for i in {x for x in of if x >= 0}) > MOST * total:
            return [n for n in nodes if of[n.element] >= 0]
    deepest = max(i for i, w in enumerate(held) if w >= COVERED * total)
    of = inside(elements, {deepest})
    chosen = chosen_nodes([n for n in nodes if of[n.element] >= 0] or nodes, elements)
    linked: dict[int, list[int]] = {}
    for n in chosen:
        sizes = linked.setdefault(n.block, [0, 0])
        sizes[n.linked] += len(n.text.strip())
    return [n for n in chosen if linked[n.block][1] <= LINKS * sum(linked[n.block])]


def main_text(page: str | None) -> str:
    """The main text: white space made single, blocks in page order joined by one space."""
    if not page:
        return ""
    parts, last = [], None
    for n in content_nodes(*parse(page)):
        if last is not None and n.block != last:
            parts.append(" ")
        parts.append(n.text)
        last = n.block
    return " ".join("".join(parts).split())


def extract_main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            texts = [main_text(p) for p in x["html"].tolist()]
            yield pd.DataFrame({"page_id": x["page_id"].astype("Int64"), "url": x["url"], "text": texts,
                                "n_chars": [len(t) for t in texts]})

    return (pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"),
                         F.col(html_col).alias("html"))
            .mapInPandas(run, "page_id bigint, url string, text string, n_chars bigint"))
