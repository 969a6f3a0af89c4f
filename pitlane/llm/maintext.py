"""Main-text extraction by minimum-cut labelling of a page's blocks.

A page is read into blocks of text with their place in the element tree.  A linear
classifier turns each block's place, links and wording into a probability of being
content; its two log losses are the capacities from the source and to the sink.
Neighbours in page order and neighbours under one parent are joined by smoothness
edges, stronger the nearer they are in the tree.  The minimum cut separates content
from boilerplate: a block that says little by itself goes with its surroundings.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.llm.common import append_column, check_new, extended

# -- blocks ----------------------------------------------------------------------------------------

#: Elements whose content is never text of the page.
RAW = "script|style|noscript|template|textarea|title"
#: The same, but these end with their parent at the latest, and at a block that cannot be inside.
DROPPED = frozenset(("svg", "select", "iframe"))
#: Elements that start a block of their own.
BLOCK = frozenset((
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul").split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Opening one of these ends an open one of the same list.
SIBLINGS = ({"li"}, {"dt", "dd"}, {"td", "th"}, {"tr"}, {"option"})
#: Elements that hold boilerplate wherever they are; so do hidden elements.
SIDE_TAGS = frozenset("nav aside footer menu dialog".split())
#: Elements and class, id or role words that hold boilerplate the surer the less of the page's text is inside.
LOOSE_TAGS = frozenset(("form", "fieldset"))
SIDE_WORDS = frozenset((
    "ad ads adbox advert advertisement advertising banner breadcrumb breadcrumbs comment comments complementary contentinfo "
    "cookie cookies consent dialog alertdialog discussion disqus feedback footer gdpr login menu modal nav navbar navigation newsletter notice "
    "notification pager pagination popup privacy promo promotion recommended related replies search share sharing sidebar "
    "signup skip social sponsor sponsored subscribe tags toolbar widget").split())
#: Of these, words of reader comments, and words of other containers that are boilerplate however much of the page
#: they hold, as long as there is a main text outside of them; an article inside the latter is no boilerplate.
COMMENT_WORDS = frozenset("comment comments discussion disqus replies".split())
STRONG_WORDS = frozenset("sidebar nav navbar navigation footer dialog alertdialog modal popup cookie cookies consent gdpr".split())
#: Inline elements with these words are left out of their paragraph, as controls and hidden ones are.
AD_WORDS = frozenset("ad ads adbox advert advertisement advertising promo sponsor sponsored".split())
CONTROLS = frozenset(("button", "label"))
#: Elements that hold running text.
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre td dd".split())
#: Class and id words of a page's header, where it isn't the article's own.
HEAD_WORDS = frozenset("header masthead topbar".split())
MAIN_TAGS = frozenset(("article", "main"))
MAIN_WORDS = frozenset("article articlebody body content entry main post story text".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    rf"|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)>?"
    r"|<[!?][^>]*>", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Class names that begin so tell of a state, not of what the element holds.
STATES = frozenset("has no not with without is hide hides show shows".split())
#: Side words that also are subjects: as a section's id inside an article they name what it is about.
SUBJECTS = frozenset((
    "advertisement advertising consent cookies discussion feedback navigation notice privacy promotion recommended related "
    "replies search share sharing social sponsored tags").split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Block:
    """Text of a block, the number of its innermost block element, and what the classifier looks at."""

    text: str
    node: int
    side: float  #: 0 to 1: how surely its container holds boilerplate
    main: bool
    head: bool
    tag: str
    linked: int
    strong: bool = False  #: in a container that no share of the page excuses

    def is_text(self) -> bool:
        """Main text by its place, or a sentence in a text element that is neither a header nor mostly links."""
        return self.side < 1 and (self.main or self.tag in TEXT_TAGS and not self.head and 2 * self.linked < len(self.text)
                                  and self.text.count(" ") >= 4 and self.text[-1] in ".!?…\"”")


@dataclass
class Tree:
    """Parent and depth of every block element, by number; 0 is the page."""

    parent: list[int]
    depth: list[int]

    def nearness(self, a: int, b: int) -> float:
        """The share of the deeper one's path that both have in common; climbs only as far as they are apart."""
        most = max(self.depth[a], self.depth[b])
        while a != b:
            if self.depth[a] >= self.depth[b]:
                a = self.parent[a]
            else:
                b = self.parent[b]
        return (self.depth[a] + 1) / (most + 1)


@dataclass
class _Open:
    """An open element with what it passes on to its children."""

    name: str
    node: int
    side: bool = False
    main: bool = False
    head: bool = False
    link: bool = False
    dropped: str = ""  #: the element of ``DROPPED``, or the inline element left out, it is in
    strong: int = 0  #: 1 in a container of ``STRONG_WORDS``, 2 in one of ``COMMENT_WORDS``
    within: int = 0  #: the innermost loose container around, 0 for the page
    loose: int = 0  #: the one whose share counts; 0 if there is none or an article inside resets it


def _naming(token: str) -> set[str]:
    """What a class, id or role token says of its element: the whole, its first and its last part; nothing if it is a state."""
    parts = _WORDS.findall(token)
    return {parts[0], parts[-1]} if parts and (len(parts) == 1 or parts[0] not in STATES) else set()


def read_blocks(page: str) -> tuple[list[Block], Tree]:
    """The page's non-empty blocks in order, and the tree they hang in; unclosed and stray tags are put up with."""
    blocks: list[Block] = []
    tree = Tree([0], [0])
    stack = [_Open("", 0)]
    open_names: Counter[str] = Counter()
    parts: list[str] = []
    link_parts = 0
    around, held, loose = [0], [0], []  # of each loose container: the one around it, its text; of each block: its container

    def flush() -> None:
        nonlocal parts, link_parts
        text = " ".join(unescape("".join(parts)).split())
        if text:
            inner = next((s for s in reversed(stack) if s.name in BLOCK), stack[0])
            held[inner.within] += len(text)
            loose.append(inner.loose)
            blocks.append(Block(text, inner.node, float(inner.side), inner.main, inner.head and not inner.main, inner.name,
                                min(link_parts, len(text)), inner.strong > 0))
        parts, link_parts = [], 0

    def take(text: str) -> None:
        nonlocal link_parts
        if stack[-1].dropped:
            return
        parts.append(text)
        if stack[-1].link:
            link_parts += len(text.strip())

    def close_to(at: int) -> None:
        if any(s.name in BLOCK for s in stack[at:]):
            flush()
        open_names.subtract(s.name for s in stack[at:])
        del stack[at:]

    last_frame = max((m.start() for m in re.finditer(r"</iframe", page, re.I)), default=-1)
    last = 0
    for m in _TOKEN.finditer(page):
        if m.start() > last:
            take(page[last:m.start()])
        last = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["close"]:
            if open_names[name] > 0:
                close_to(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name))
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCK:
            kind = stack[-1].dropped
            if kind == "select" and name not in ("option", "hr") or kind == "svg" and not open_names["foreignobject"]:
                close_to(next(i for i, s in enumerate(stack) if s.dropped))
            flush()
            # a block ends an open paragraph, and an item the item before it
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == "p" or any(stack[i].name in s and name in s for s in SIBLINGS):
                    close_to(i)
                    break
                if stack[i].name in BLOCK or stack[i].name in DROPPED:
                    break
        if name in VOID or m["attrs"].rstrip().endswith("/") and name not in BLOCK:
            continue
        if name == "iframe" and m.start() > last_frame:  # never closed: nothing is inside
            continue
        up = stack[-1]
        words, names, hidden = set(), set(), False
        for found in _ATTRIBUTE.finditer(m["attrs"]):
            key, value = found[1].lower(), (found[2] or found[3] or found[4] or "").lower()
            if key in ("class", "id", "role"):
                words.update(_WORDS.findall(value))
                if key != "id" or name not in HEADINGS:
                    own = set().union(*map(_naming, value.split()))
                    names |= own - SUBJECTS if key == "id" and name == "section" and up.main else own
            hidden |= key == "hidden" or key == "aria-hidden" and value == "true" or (
                key == "style" and "display:none" in value.replace(" ", ""))
        node = up.node
        if name in BLOCK:
            node = len(tree.parent)
            tree.parent.append(up.node)
            tree.depth.append(tree.depth[up.node] + 1)
        open_names[name] += 1
        named = bool(names & SIDE_WORDS) or bool(names & HEAD_WORDS and not up.main)
        within, inside = up.within, up.loose
        if name in MAIN_TAGS:
            if not named and not up.main:
                inside = 0
        elif name in LOOSE_TAGS or named and name not in ("html", "body"):
            within = inside = len(around)
            around.append(up.within)
            held.append(0)
        strong = up.strong
        if name in MAIN_TAGS and not named and not up.main:
            strong = strong if strong == 2 else 0
        elif name not in ("html", "body"):
            strong = max(strong, 2 if names & COMMENT_WORDS else 1 if names & STRONG_WORDS else 0)
        out = name if name in DROPPED or name not in BLOCK and (hidden or name in CONTROLS or names & AD_WORDS) else ""
        stack.append(_Open(
            name, node, up.side or hidden or name in SIDE_TAGS,
            up.main or name in MAIN_TAGS or bool(words & MAIN_WORDS and name in ("div", "section")),
            up.head or name in ("head", "header"), up.link or name == "a",
            up.dropped or out, strong, within, inside))
    take(page[last:])
    flush()
    for i in range(len(around) - 1, 0, -1):
        held[around[i]] += held[i]
    for b, i in zip(blocks, loose, strict=True):
        if i:
            b.side = max(b.side, 1 - (held[i] / held[0]) ** 2)
    if any(b.is_text() and not b.strong for b in blocks):
        for b in blocks:
            b.side = 1.0 if b.strong else b.side
    return blocks, tree


# -- classifier ------------------------------------------------------------------------------------

#: Log-odds of content: fixed weights, in the order of ``features``.
WEIGHTS = (-0.3, -9.0, 5.0, -4.0, 0.5, -3.5, 0.8, 0.35)


def features(b: Block) -> tuple[float, ...]:
    """Bias, boilerplate container, content container, page header, text element, share of links, sentence end, log words."""
    return (1.0, float(b.side), b.main * (1.0 - b.side), float(b.head and not b.main),
            float(b.tag in TEXT_TAGS),
            b.linked / max(1, len(b.text)), float(b.text[-1] in ".!?…\"”:;"), math.log1p(b.text.count(" ")))


def log_odds(b: Block) -> float:
    return sum(w * x for w, x in zip(WEIGHTS, features(b), strict=True))


# -- minimum cut -----------------------------------------------------------------------------------


def min_cut(source: list[int], sink: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay on the source's side of the minimum cut, ties with the sink.

    ``source`` and ``sink`` are each node's terminal capacities, ``edges`` undirected
    (a, b, capacity).  Dinic's algorithm: shortest augmenting paths by levels.
    """
    n = len(source)
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    cap: list[int] = []

    def join(a: int, b: int, there: int, back: int) -> None:
        head[a].append(len(to))
        to.append(b)
        cap.append(there)
        head[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i in range(n):
        low = min(source[i], sink[i])  # flows straight through the node
        if source[i] > low:
            join(s, i, source[i] - low, 0)
        elif sink[i] > low:
            join(i, t, sink[i] - low, 0)
    for a, b, c in edges:
        if c > 0:
            join(a, b, c, c)

    def levels() -> list[int]:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in head[a]:
                if cap[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        return level

    while (level := levels())[t] >= 0:
        turn = [0] * (n + 2)
        path: list[int] = []
        at = s
        while True:
            if at == t:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                keep = next(i for i, e in enumerate(path) if not cap[e])
                at = to[path[keep] ^ 1]
                del path[keep:]
                continue
            while turn[at] < len(head[at]):
                e = head[at][turn[at]]
                if cap[e] and level[to[e]] == level[at] + 1:
                    break
                turn[at] += 1
            if turn[at] < len(head[at]):
                path.append(e)
                at = to[e]
            elif path:  # a dead end: back one step
                at = to[path.pop() ^ 1]
                turn[at] += 1
            else:
                break
    return [level[i] >= 0 for i in range(n)]


SCALE = 1000


def page_graph(blocks: list[Block], tree: Tree, smooth: float = 1.0) -> tuple[list[int], list[int], list[tuple[int, int, int]]]:
    """Terminal capacities and smoothness edges of a page, as integers.

    Consecutive blocks are joined; so is each block with the last one before it under
    the same parent.  The capacity is ``smooth`` times their nearness in the tree.
    """
    odds = [log_odds(b) for b in blocks]
    loss = lambda x: int(SCALE * (math.log1p(math.exp(-abs(x))) + max(0.0, x)))
    edges: list[tuple[int, int, int]] = []
    before: dict[int, int] = {}
    join = lambda a, b: edges.append((a, b, int(SCALE * smooth * tree.nearness(blocks[a].node, blocks[b].node))))
    for i, b in enumerate(blocks):
        if i:
            join(i - 1, i)
        parent = tree.parent[b.node]
        if before.get(parent, i - 1) != i - 1:
            join(before[parent], i)
        before[parent] = i
    return [loss(x) for x in odds], [loss(-x) for x in odds], edges


def extract(page: str, smooth: float = 1.0) -> str:
    """The blocks on the content side, one per line; empty if there are none."""
    blocks, tree = read_blocks(page)
    if not blocks:
        return ""
    return "\n".join(b.text for b, keep in zip(blocks, min_cut(*page_graph(blocks, tree, smooth)), strict=True) if keep)


def with_main_text(pages: DataFrame, html_col: str = "html", name: str = "text", smooth: float = 1.0) -> DataFrame:
    """``pages`` with the main text of each page in the column ``name``, which ``pages`` must not have.

    A null or empty page has an empty text; repeated rows stay.
    """
    check_new(pages, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(p or "", smooth) for p in batch.column(at).to_pylist()]
            yield append_column(batch, name, pa.array(texts, pa.string()))

    at = pages.columns.index(html_col)
    return pages.mapInArrow(run, extended(pages.schema, name, T.StringType()))
