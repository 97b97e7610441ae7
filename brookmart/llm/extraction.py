"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks at block-level tags. The nodes of its graph are the blocks and the elements around several of them. A small
linear classifier tells from a block's words, links and last character what calling it content or boilerplate costs; an element has costs
if its tag or class says what it is. These costs are the capacities to the two terminals. Smoothness edges tie blocks
that follow each other, and every node to the element around it: that is how a short paragraph learns that it stands in an article, and
how a container without a name learns from its paragraphs. The maximum flow saturates the cheapest labelling of the page, and the source side is the content.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import importable, whole

TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
SPACES = re.compile(r"[\x20\x09-\x0D]+")

#: Elements whose text is not shown or not HTML.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "math", "object", "canvas", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
          "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: What the start of an element closes, up to the elements that hold it.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}

BOILERPLATE_TAGS = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "fieldset"}
BOILERPLATE_WORDS = {
    "ad", "ads", "advert", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie",
    "cookies", "disqus", "footer", "form", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter",
    "notice", "pagination", "pager", "popup", "promo", "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing",
    "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "tags", "toolbar", "topbar", "widget",
    "complementary", "contentinfo", "alert",
}
#: Of these, the words that make an <article> or <main> boilerplate; its other names tell topics and layout.
FOREIGN_WORDS = {"ad", "ads", "advert", "advertisement", "advertising", "comment", "comments", "replies", "reply", "promo", "sponsor", "sponsored"}
CONTENT_TAGS = {"article", "main"}
CONTENT_WORDS = {"article", "content", "entry", "main", "post", "story", "text"}
#: Names that tell what stands beside an element, not what it is.
BESIDE = re.compile(r"(?<![a-z])(?:has|with|without|no)[-_][a-z]+", re.IGNORECASE)
#: Weights of the classifier, in log odds of being content.
NAMED_BOILERPLATE, NAMED_CONTENT, LINKED, LONG, PROSE, BASE = -9.0, 6.0, -5.0, 4.0, 1.0, -1.0
LONG_WORDS, PROSE_WORDS = 40, 12
#: Smoothness: of neighbours; of a block to its element; of an element to the one around it for each block in it, halved per level of height.
#: In named content a node is tied by IN_CONTENT, and by MORE_CONTENT for each further block in it.
ADJACENT, BLOCK_TIE, ELEMENT_TIE, IN_CONTENT, MORE_CONTENT = 0.5, 1.8, 0.4, 8.0, 3.0
UNIT = 1000
#: Evidence of a tag that leaves no doubt.
CERTAIN = 10**12

NEUTRAL, CONTENT, BOILERPLATE, PAGE_FORM = "neutral", "content", "boilerplate", "page form"


@dataclass
class Element:
    """A block-level element: its parent's number, the zone it stands in, and its own evidence in log odds."""

    parent: int
    zone: str
    odds: float = 0.0
    ties: bool = True


@dataclass
class Block:
    text: str
    element: int
    zone: str
    linked: int = 0


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    elements: list[Element] = field(default_factory=lambda: [Element(-1, NEUTRAL, ties=False)])


@dataclass
class _Open:
    tag: str
    number: int
    zone: str


def _evidence(tag: str, attributes: str, above: str, outermost: bool) -> tuple[str, float]:
    """(zone, own log odds) of an element that opens in zone ``above``.

    What stands in named boilerplate stays so. A form directly in the body may be the whole page; named content inside it is content.
    """
    if above == BOILERPLATE:
        return above, 0.0
    words: set[str] = set()
    if attributes and tag not in ("html", "body"):
        for name, *values in ATTRIBUTE.findall(attributes):
            value = next(filter(None, values), "")
            if name.lower() == "hidden" or (name.lower() == "aria-hidden" and value.lower() == "true"):
                return BOILERPLATE, 0.0
            words.update(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", BESIDE.sub("", value)).lower()))
    bad = words & (FOREIGN_WORDS if tag in CONTENT_TAGS else BOILERPLATE_WORDS)
    if tag == "form" and outermost and not bad - {"form"}:
        return PAGE_FORM, 0.0
    if tag in BOILERPLATE_TAGS or bad:
        # The head of the article itself belongs to it.
        own_head = (tag == "header" or bad) and not (bad - {"header"}) and (tag == "header" or tag not in BOILERPLATE_TAGS)
        if not (own_head and (above == CONTENT or words & CONTENT_WORDS)):
            return BOILERPLATE, 0.0
    if tag in CONTENT_TAGS:
        return CONTENT, CERTAIN / UNIT
    if words & CONTENT_WORDS:
        return CONTENT, NAMED_CONTENT
    return above, 0.0


def blocks_of(page: str) -> Page:
    """The page's blocks in order, with white space runs as one space and references decoded, and its elements. Unfinished tags at the end are dropped."""
    found = Page()
    stack = [_Open("", 0, NEUTRAL)]
    texts: list[str] = []
    linked = links = 0

    def end_block() -> None:
        nonlocal linked
        if texts:
            text = SPACES.sub(" ", html.unescape("".join(texts))).strip(" ")
            if text.strip():
                found.blocks.append(Block(text, stack[-1].number, stack[-1].zone, linked))
            texts.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal links
        links -= sum(o.tag == "a" for o in stack[depth:])
        del stack[depth:]

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        stop = m.start() if m else n
        if stop > at:
            texts.append(page[at:stop])
            if links:
                linked += stop - at
        if not m:
            break
        at = m.end()
        close, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if not close and tag in RAW:
            if not attributes.endswith("/") or tag in ("script", "style", "title", "textarea"):
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = end.end() if end else n
            texts.append(" " if tag in INLINE else "")
            continue
        if tag not in INLINE:
            end_block()
        elif tag == "br":
            texts.append(" ")
        if close:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if depth:
                pop_to(depth)
            continue
        if tag in VOID:
            continue
        if tag not in INLINE:
            # An open paragraph, and inline elements left open in it, end where another block starts.
            p = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == "p"), 0)
            if p and all(o.tag in INLINE for o in stack[p + 1:]):
                pop_to(p)
            if tag in CLOSES:
                ends, holders = CLOSES[tag]
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in holders:
                        break
                    if stack[k].tag in ends:
                        pop_to(k)
                        break
        top = stack[-1]
        zone, odds = _evidence(tag, attributes, top.zone, top.tag == "body")
        number = top.number
        if tag not in INLINE:
            number = len(found.elements)
            # The body holds all kinds of parts, and named boilerplate ends where its element ends.
            apart = zone in (BOILERPLATE, PAGE_FORM) and zone != top.zone
            found.elements.append(Element(top.number, zone, odds, ties=not apart and tag not in ("html", "body") and top.tag not in ("", "html", "body")))
        stack.append(_Open(tag, number, zone))
        links += tag == "a"
    end_block()
    return found


def costs(block: Block) -> tuple[int, int]:
    """(capacity to the content terminal, capacity to the boilerplate terminal): evidence for either label, from the block alone."""
    words = block.text.count(" ") + 1
    odds = BASE + LONG * min(words, LONG_WORDS) / LONG_WORDS + LINKED * min(1.0, block.linked / max(1, len(block.text)))
    odds += PROSE * (words >= PROSE_WORDS and block.text[-1] in ".!?…:;\"'»”)")
    odds += NAMED_BOILERPLATE * (block.zone in (BOILERPLATE, PAGE_FORM))
    return (round(odds * UNIT), 0) if odds > 0 else (0, round(-odds * UNIT))


def graph(page: Page) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
    """Terminal capacities of blocks, then of elements, and the smoothness edges (i, j, capacity).

    Elements around one block only, without evidence of their own, are passed over: the block is tied to what is around them.
    """
    blocks, elements = page.blocks, page.elements
    mass, height = [0] * len(elements), [0] * len(elements)
    for b in blocks:
        mass[b.element] += 1
        height[b.element] = max(height[b.element], 1)
    kept = [False] * len(elements)
    for e in range(len(elements) - 1, 0, -1):  # children have higher numbers
        above = elements[e].parent
        kept[e] = mass[e] > 1 or (mass[e] == 1 and elements[e].odds != 0)
        mass[above] += mass[e]
        if mass[e]:
            height[above] = max(height[above], height[e] + kept[e])
    # The kept element around each one, or the root where a border lies between.
    holder = [0] * len(elements)
    for e in range(1, len(elements)):
        above = elements[e].parent
        holder[e] = 0 if not elements[e].ties else above if kept[above] else holder[above]
    number = {e: len(blocks) + k for k, e in enumerate(e for e in range(len(elements)) if kept[e])}
    terminals = [costs(b) for b in blocks] + [(round(elements[e].odds * UNIT), 0) for e in number]
    edges = [(i, i + 1, round(ADJACENT * UNIT)) for i in range(len(blocks) - 1)]
    for i, b in enumerate(blocks):
        around = b.element if kept[b.element] else holder[b.element]
        if around:
            edges.append((i, number[around], round((IN_CONTENT if b.zone == CONTENT else BLOCK_TIE) * UNIT)))
    for e in number:
        if holder[e]:
            tie = (IN_CONTENT + MORE_CONTENT * (mass[e] - 1)) if elements[e].zone == CONTENT else ELEMENT_TIE * mass[e] * 0.5 ** height[e]
            edges.append((number[e], number[holder[e]], round(tie * UNIT)))
    return terminals, edges


def minimum_cut(terminals: list[tuple[int, int]], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Labels of a minimum cut: True on the source side. Nodes have capacities from the source and to the sink.

    Maximum flow by blocking flows: every round orders the nodes by their distance from those with flow left, and sends along ever larger
    distances what goes, leaving nodes that lead nowhere. What a node can send straight through is sent first, so each node keeps capacity
    to one terminal at most; of several minimum cuts it is the one with the fewest nodes on the source side.
    """
    n = len(terminals)
    excess = [a - b for a, b in terminals]
    out: list[list[int]] = [[] for _ in range(n)]
    head, room = [], []  # an edge and its reverse have numbers that differ in the last bit
    for i, j, c in edges:
        if c > 0 and i != j:
            out[i].append(len(head))
            out[j].append(len(head) + 1)
            head += (j, i)
            room += (c, c)
    while True:
        sources = [i for i in range(n) if excess[i] > 0]
        level = [-1] * n
        for i in sources:
            level[i] = 0
        queue, met = list(sources), False
        for i in queue:
            for e in out[i]:
                j = head[e]
                if room[e] > 0 and level[j] < 0:
                    level[j] = level[i] + 1
                    met = met or excess[j] < 0
                    queue.append(j)
        if not met:
            return [x >= 0 for x in level]
        following = [0] * n
        for source in sources:
            path: list[int] = []
            i = source
            while excess[source] > 0:
                if excess[i] < 0:
                    push = min(excess[source], -excess[i], min(room[e] for e in path))
                    excess[source] -= push
                    excess[i] += push
                    full = 0
                    for k in range(len(path) - 1, -1, -1):
                        e = path[k]
                        room[e] -= push
                        room[e ^ 1] += push
                        if room[e] == 0:
                            full = k + 1
                    if full:
                        i = head[path[full - 1] ^ 1]
                        del path[full - 1:]
                    continue
                while following[i] < len(out[i]):
                    e = out[i][following[i]]
                    if room[e] > 0 and level[head[e]] == level[i] + 1:
                        break
                    following[i] += 1
                else:
                    if not path:
                        break
                    i = head[path.pop() ^ 1]
                    following[i] += 1
                    continue
                path.append(e)
                i = head[e]


def main_text(page: str) -> str:
    parts = blocks_of(page)
    labels = minimum_cut(*graph(parts))
    return "\n".join(b.text for b, keep in zip(parts.blocks, labels) if keep)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text (empty if there is none) and n_chars (its code points), for every row.

    Null and empty html have no text. Repeated pages are treated one by one; other columns are not read. A long page is cut whole, in time about in
    proportion to its length; of labellings that cost the same the one with the least content is taken.
    """
    importable(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                  names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), whole(F.col(html_col)).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
