"""Main text of web pages by tag-path ratios.

A page is read once as a sequence of text nodes, each with its root-to-leaf tag path. Text length and punctuation
are summed per path and divided by the path's number of nodes; both sequences over the nodes are smoothed by a
Gaussian, fused by multiplication and compared with their spread. The nodes above it are content. Nodes under
structural boilerplate (menus, page headers and footers, asides, forms, adverts, comments; by tag, role, class or
id) have ratio zero. Content nodes point to the article's element, of which every remaining block is returned,
so short paragraphs and headings stay.

Pages are independent: no shuffle, one batch in memory.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import free, text_or_empty

#: Elements nested deeper belong to their parent, as in browsers; no text is lost by it.
DEEPEST = 512
#: Nodes within this distance share in a node's smoothed ratio.
SMOOTH = 2
#: A content node's fused ratio exceeds this many standard deviations of all.
SPREAD = 0.5

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PUNCTUATION = ".,;:!?…。、，；：！？"
# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template head title textarea select option datalist svg math iframe object canvas audio video".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
SCOPE = frozenset("ul ol dl table body html div section article main".split())
# What is never part of an article.
BOILERPLATE_TAGS = frozenset("nav footer aside form button menu dialog".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement adsbygoogle sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer comment comments commentlist reply replies respond disqus notice notices "
    "cookie cookies consent alert popup modal newsletter subscribe signup share sharing social related recommended login "
    "search pagination pager widget toolbar skip masthead topbar".split()
)
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar toolbar alert dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


@dataclass(slots=True)
class Element:
    """An open element; ``boilerplate`` and ``hidden`` hold for all inside, paths leave out inline elements."""

    tag: str
    boilerplate: bool
    hidden: bool
    path: str
    above: tuple[int, ...]
    tags: tuple[str, ...]


@dataclass(slots=True)
class Node:
    """A run of text without a block boundary, and the element it begins in."""

    inside: Element
    parts: list[str] = field(default_factory=list)

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def unescaped(raw: str) -> str:
    ands = raw.count("&")
    if not ands:
        return raw
    return raw.replace("&amp;", "&") if ands == raw.count("&amp;") else html.unescape(raw)


def _is_boilerplate(tag: str, attributes: str, open_tags: list[Element]) -> bool:
    if tag in BOILERPLATE_TAGS:
        return True
    if tag == "header":
        return not any(e.tag in ("article", "main") for e in open_tags)
    if tag in ("html", "body", "article", "main") and "comment" not in attributes:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        words = set(re.split(r"[^a-z0-9]+", "".join(values).lower()))
        if words & (BOILERPLATE_ROLES if name.lower() == "role" else BOILERPLATE_NAMES):
            return True
    return False


def text_nodes(page: str) -> list[Node]:
    """Text nodes of a page in order; hidden elements give none. Unclosed and stray tags are tolerated."""
    stack: list[Element] = [Element("", False, False, "", (), ())]
    nodes: list[Node] = []
    count, at, current = 0, 0, None

    def add(raw: str) -> None:
        nonlocal current
        if not raw or stack[-1].hidden:
            return
        if current is None:
            if raw.isspace():
                return
            current = Node(stack[-1])
            nodes.append(current)
        current.parts.append(unescaped(raw))

    def pop_to(tags: set[str] | frozenset[str], scope: frozenset[str] = frozenset()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in scope:
                return

    while True:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag not in INLINE:
                current = None
            if any(e.tag == tag for e in stack):
                pop_to({tag})
            continue
        if tag not in INLINE:
            current = None
        elif tag == "br":
            add(" ")
        if tag in VOID:
            continue
        if tag in CLOSES_P:
            pop_to({"p"}, SCOPE | {"td", "th", "li"})
        if tag in SIBLINGS:
            pop_to(SIBLINGS[tag], SCOPE)
        if m[3].endswith("/") and tag not in ("p", "div", "article", "section", "body", "main"):
            continue
        if len(stack) > DEEPEST:
            continue
        up = stack[-1]
        boilerplate = up.boilerplate or _is_boilerplate(tag, m[3], stack)
        if tag in INLINE:
            stack.append(Element(tag, boilerplate, up.hidden, up.path, up.above, up.tags))
        else:
            count += 1
            hidden = up.hidden or tag in HIDDEN
            stack.append(Element(tag, boilerplate, hidden, f"{up.path}/{tag}", (*up.above, count), (*up.tags, tag)))
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            if tag not in HIDDEN:
                add(page[at : end.start() if end else len(page)])
            at = end.start() if end else len(page)
    return nodes


def fused_ratios(nodes: list[Node], texts: list[str]) -> np.ndarray:
    """Smoothed text ratio times smoothed punctuation ratio of each node's path; 0 for boilerplate."""
    sums: dict[tuple[str, bool], list[int]] = {}
    own = []
    for node, text in zip(nodes, texts, strict=True):
        total = sums.setdefault((node.inside.path, node.inside.boilerplate), [0, 0, 0])
        if not node.inside.boilerplate:
            total[0] += len(text)
            total[1] += sum(map(text.count, PUNCTUATION))
        total[2] += 1
        own.append(total)
    length, marks, number = np.array(own, float).T
    fused = _smooth(length / number) * _smooth(1 + marks / number)
    return np.where([n.inside.boilerplate for n in nodes], 0.0, fused)


def _smooth(values: np.ndarray) -> np.ndarray:
    weights = np.exp(-(np.arange(-SMOOTH, SMOOTH + 1) ** 2) / 2)
    near = slice(SMOOTH, SMOOTH + len(values))
    return np.convolve(values, weights)[near] / np.convolve(np.ones_like(values), weights)[near]


def main_text(page: str) -> str:
    """The article's blocks, one per line; empty if the page has none."""
    nodes = text_nodes(page)
    texts = [n.text for n in nodes]
    kept = [i for i, t in enumerate(texts) if t]
    nodes, texts = [nodes[i] for i in kept], [texts[i] for i in kept]
    if not nodes:
        return ""
    ratios = fused_ratios(nodes, texts)
    if not ratios.any():
        return ""
    bar = min(SPREAD * float(ratios.std()), float(ratios.max()))
    chosen = [i for i, r in enumerate(ratios) if r > 0 and r >= bar]
    # The article is what the content nodes lie in: their <article> and <main> elements, else the innermost element
    # that holds all of them (of a single node, what its block lies in).
    roots = {
        e for i in chosen for e, t in zip(nodes[i].inside.above, nodes[i].inside.tags, strict=True) if t in ("article", "main")
    }
    if not roots:
        common = set(nodes[chosen[0]].inside.above[:-1] or nodes[chosen[0]].inside.above)
        for i in chosen:
            common &= set(nodes[i].inside.above)
        roots = {max(common)} if common else set()
    return "\n".join(
        t for n, t in zip(nodes, texts, strict=True) if not n.inside.boilerplate and (not roots or roots & set(n.inside.above))
    )


def extract_articles(pages: DataFrame, key: str = "page_id", page: str = "html") -> DataFrame:
    """All other columns of ``pages`` (named text replaced) and ``text``, the main text; null html counts as empty."""
    rest = [c for c in pages.columns if c not in (page, "text")]
    rows = pages.select(*[F.col(f"`{c}`") for c in rest], text_or_empty(page).alias(*free(rest, "_page")))
    schema = pages.select(*[F.col(f"`{c}`") for c in rest]).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, source = batch.columns
            texts = pa.array([main_text(source[i].as_py()) for i in range(len(source))], pa.string())
            yield pa.RecordBatch.from_arrays([*others, texts], [*rest, "text"])

    return rows.mapInArrow(run, schema)
