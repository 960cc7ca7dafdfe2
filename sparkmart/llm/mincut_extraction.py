"""Operator 1: the main text of web pages by a minimum cut between content and boilerplate.

A page is read into blocks of text (paragraphs, headings, list items, cells), each with
its place in the document tree.  A fixed linear classifier - amount of text, share of
links, names and roles of the elements around it - gives each block a score; its positive
part is the capacity from the source, its negative part the capacity to the sink.  Edges
between neighbours on the page, and between blocks of the same or of sibling parents, make
it costly to part them.  The blocks on the source side of the minimum cut, in page order,
are the text.

A block knows the element that holds it, and elements know their parents, so time and memory
grow with the page, however long or deeply nested it is.  Columns of the input beside
``page_id, url, html`` are left out.

Scripts, styles, controls and what is hidden never become blocks.  NULL and empty pages,
and pages without content, give the empty text; markup that isn't closed is closed where
its parent ends.  Repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections import defaultdict, deque
from collections.abc import Iterable
from functools import lru_cache
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import map_texts

_MARKUP = re.compile(
    r"""<!--(?:.*?-->|.*)|<([/]?)([a-zA-Z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>|<[/!?][^>]*(?:>|\Z)|<([/]?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

# Elements of HTML by how they lay out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
DROPPED = frozenset("head noscript template svg math select button object audio video canvas datalist map".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
          "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}

#: The classifier: what an element around a block adds to its score.
TAG_WEIGHT = {"article": 3.0, "main": 2.5, "nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "menu": -9.0, "dialog": -9.0, "header": -9.0}
ROLE_WEIGHT = {"main": 2.5, "article": 3.0} | dict.fromkeys(
    "navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split(), -9.0)
GOOD_NAMES = frozenset("article content post entry story body main text prose".split())
BAD_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer "
    "disqus footer gdpr header legal login masthead menu modal nav navbar navigation newsletter notice notification pager pagination popup promo "
    "promoted recommend recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "tags teaser toc toolbar topbar widget widgets".split()
)
GOOD_WEIGHT, BAD_WEIGHT, MOST_GOOD = 1.5, -9.0, 4.5
#: Names that turn the next one around, as in ``no-sidebar``.
NEGATIONS = frozenset("no has with without".split())
#: Score of a block's own text: words count up to a bound; links, and few words, count against it.
WORD_WEIGHT, MOST_WORDS, BIAS, LINK_WEIGHT = 0.08, 40, -0.5, 3.0
#: Smoothness: neighbours on the page, by distance in the tree; blocks under one parent.
NEAR_WEIGHT, PARENT_WEIGHT = 0.3, 0.25
#: Capacities are whole numbers.
SCALE = 100
#: Steps in the tree beyond which the edge of two neighbours rounds to nothing.
FARTHEST = int(NEAR_WEIGHT * 2 * SCALE / 0.5)


class Node:
    """A block element of the document tree: its parent and its depth."""

    __slots__ = ("depth", "parent")

    def __init__(self, parent: Node | None):
        self.parent, self.depth = parent, parent.depth + 1 if parent else 1


class Block:
    """A run of text: its pieces, characters in links, score of what is around it, and the block element that holds it."""

    __slots__ = ("around", "links", "node", "parts")

    def __init__(self, node: Node | None, around: float):
        self.node, self.around, self.parts, self.links = node, around, [], 0


@lru_cache(4096)
def element_weight(tag: str, attributes: str) -> tuple[float, bool]:
    """(what the element adds to the score, whether it is hidden)."""
    weight = TAG_WEIGHT.get(tag, 0.0)
    if not attributes.strip():
        return weight, False
    found = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), unescape(a or b or c))
    if "hidden" in found or found.get("aria-hidden") == "true" or _HIDDEN.search(found.get("style", "").lower()):
        return weight, True
    weight += ROLE_WEIGHT.get(found.get("role", "").lower(), 0.0) if tag not in TAG_WEIGHT else 0.0
    if found.get("itemprop") == "articleBody":
        weight += TAG_WEIGHT["article"]
    if tag in ("html", "body", "article", "main", "a"):
        return weight, False
    names = [n.lower() for n in _NAME_PARTS.findall(f"{found.get('id', '')} {found.get('class', '')}")]
    plain = [n for before, n in zip(["", *names], names, strict=False) if before not in NEGATIONS]
    if any(n in BAD_NAMES for n in plain):
        weight += BAD_WEIGHT
    elif any(n in GOOD_NAMES for n in plain):
        weight += GOOD_WEIGHT
    return weight, False


def blocks(html: str) -> list[Block]:
    """The text blocks of a page, in order."""
    found: list[Block] = []
    # open elements: tag, block element, good and bad score so far, whether dropped
    stack: list[tuple[str, Node | None, float, float, bool]] = [("", None, 0.0, 0.0, False)]
    # where in the stack the elements of each tag are, and all block elements
    open_: dict[str, list[int]] = defaultdict(list)
    open_blocks: list[int] = []
    at = 0
    block: Block | None = None
    size = len(html)

    def close(depth: int) -> None:
        while len(stack) > depth:
            tag = stack.pop()[0]
            open_[tag].pop()
            if tag in BLOCK:
                open_blocks.pop()

    def innermost(tags: Iterable[str]) -> int:
        return max((open_[tag][-1] for tag in tags if open_[tag]), default=0)

    def text(start: int, end: int) -> None:
        nonlocal block
        if start >= end or stack[-1][4]:
            return
        part = html[start:end]
        if block is None:
            if part.isspace():
                return
            block = Block(stack[-1][1], min(MOST_GOOD, stack[-1][2]) + stack[-1][3])
            found.append(block)
        block.parts.append(part)
        if open_["a"]:
            block.links += len(part.strip())

    while at < size:
        m = _MARKUP.search(html, at)
        if m is None:
            text(at, size)
            break
        text(at, m.start())
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if open_[tag]:
                close(open_[tag][-1])
            if tag in BLOCK:
                block = None
            continue
        if tag in BLOCK:
            block = None
            # a paragraph ends where another block begins
            if open_blocks and stack[open_blocks[-1]][0] == "p":
                close(open_blocks[-1])
        if tag in CLOSES:
            same, within = CLOSES[tag]
            depth = innermost(same.split())
            if depth > innermost(within):
                close(depth)
        if tag in VOID:
            if tag in ("br", "hr", "img", "input") and block is not None:
                block.parts.append(" ")
            continue
        attributes = m[3] if m[3] is not None else m[6] or ""
        if tag in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(html, at)
            at = end.end() if end else size
            continue
        if attributes.endswith("/") and tag not in BLOCK:
            continue
        weight, hidden = element_weight(tag, attributes)
        _, _, good, bad, dropped = stack[-1]
        if tag == "header" and good >= TAG_WEIGHT["main"]:
            weight = 0.0  # the head of the article itself
        if tag == "body":
            dropped = False
        node = Node(stack[-1][1]) if tag in BLOCK else stack[-1][1]
        open_[tag].append(len(stack))
        if tag in BLOCK:
            open_blocks.append(len(stack))
        stack.append((tag, node, good + max(weight, 0.0), bad + min(weight, 0.0), dropped or hidden or tag in DROPPED))
    return found


def block_text(block: Block) -> str:
    return " ".join(unescape("".join(block.parts)).split())


def score(block: Block, text: str) -> float:
    """Positive: looks like content."""
    n = min(text.count(" ") + 1, MOST_WORDS)
    return BIAS + WORD_WEIGHT * n - LINK_WEIGHT * min(1.0, block.links / max(1, len(text))) + block.around


def distance(a: Node | None, b: Node | None, most: int) -> int:
    """Steps in the tree from one block element to another; some number above ``most`` if there are more."""
    steps = 0
    while a is not b and steps <= most:
        x, y = (n.depth if n else 0 for n in (a, b))
        a, b = a.parent if x >= y else a, b.parent if y >= x else b
        steps += 1 + (x == y)
    return steps


def smoothness(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours on the page, and to the last block before under the same parent or its parent.

    Neighbours whose edge would be no whole number of capacity have none, so the way
    between two of them in the tree is followed for ``FARTHEST`` steps only.
    """
    edges, last = [], {}
    for i, block in enumerate(found):
        if i:
            steps = distance(block.node, found[i - 1].node, FARTHEST)
            if steps <= FARTHEST:
                edges.append((i - 1, i, NEAR_WEIGHT * 2 / max(2, steps)))
        node = block.node
        for k in (1, 2):
            node = node.parent if node else None
            if node is None:
                break
            if node in last and last[node] != i - 1:
                edges.append((last[node], i, PARENT_WEIGHT / k))
            last[node] = i
    return edges


def source_side(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Blocks on the source's side of the minimum cut (the smallest such set)."""
    n = len(scores)
    if all(s > 0 for s in scores):
        return [True] * n
    if all(s <= 0 for s in scores):
        return [False] * n
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, s in enumerate(scores):
        if s > 0:
            link(source, i, round(s * SCALE), 0)
        elif s < 0:
            link(i, sink, round(-s * SCALE), 0)
    for a, b, w in edges:
        link(a, b, round(w * SCALE), round(w * SCALE))
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        position = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if not room[e])
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while position[a] < len(out[a]):
                e = out[a][position[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                position[a] += 1
            else:
                if a == source:
                    break
                e = path.pop()
                a = to[e ^ 1]
                position[a] += 1
                continue
            path.append(e)
            a = to[e]


def main_text(html: str | None) -> str:
    """The main text of a page."""
    pairs = [(b, t) for b, t in ((b, block_text(b)) for b in blocks(html or "")) if t]
    found = [b for b, _ in pairs]
    keep = source_side([score(b, t) for b, t in pairs], smoothness(found))
    return " ".join(t for (_, t), kept in zip(pairs, keep, strict=True) if kept)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row.  No shuffle."""

    def rows(keys, texts):
        for key, html in zip(keys, texts, strict=True):
            text = main_text(html)
            yield key["page_id"], key["url"], text, len(text)

    keyed = pages.select(F.struct("page_id", "url").alias("key"), F.col("html").alias("text"))
    return map_texts(keyed, rows, "page_id long, url string, text string, n_chars long", key="key")
