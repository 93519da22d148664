"""Main text of web pages: blocks labelled by a minimum cut between content and boilerplate."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not text of the page.
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
HIDDEN = frozenset(
    "head script style template noscript svg math canvas object iframe select option button textarea title audio video map "
    "datalist".split()
)
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
)
#: Opening one of these ends an open paragraph.
ENDS_P = BLOCK - {"br", "body", "head", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "legend"}
#: Opening the tag ends the nearest open one of the set, up to the tags that hold it.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

#: The classifier: log odds for content (above 0) or boilerplate that an element's tag, and words
#: of its class, id and role, add to all blocks in it; the strongest of each sign counts.
TAG_ODDS = {
    "article": 6.0, "main": 4.0, "p": 1.0, "blockquote": 1.0, "pre": 1.0, "figcaption": 0.5, "h1": 1.0, "h2": 1.0,
    "h3": 0.5, "nav": -14.0, "footer": -14.0, "aside": -14.0, "header": -12.0, "form": -14.0, "menu": -12.0,
    "dialog": -12.0, "fieldset": -12.0, "label": -10.0, "search": -14.0, "address": -3.0,
}
WORD_ODDS = {
    **dict.fromkeys("article articlebody content entry main post story text body".split(), 3.0),
    **dict.fromkeys(
        "ad ads adbox adslot advert adverts advertisement advertorial banner breadcrumb breadcrumbs comment comments "
        "commentlist contentinfo cookie cookies consent disqus disclaimer footer form gdpr header masthead menu menubar modal "
        "nav navbar navigation newsletter notice notices notification overlay pagination pager popup promo promotion related "
        "replies reply respond search share sharing sidebar sidenav signup social sponsor sponsored subscribe subscription "
        "teaser toolbar topbar widget widgets alert complementary".split(),
        -12.0,
    ),
}
#: What it says to lie outside all articles of a page that has one.
OUTSIDE = -5.0
#: Steps up the tree beyond which elements count as far apart.
FAR = 64
_COPYRIGHT = re.compile(r"(©|\(c\)|copyright\b)", re.I)
#: An article's own header may hold its headline: inside an article these tags say less.
MILD_IN_ARTICLE = {"header": -2.0}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)",
    re.S,
)
_NAMES = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PART = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Element:
    tag: str
    up: float  # strongest log odds for content so far, from the root
    down: float  # strongest against
    hidden: bool
    article: bool
    link: bool
    depth: int
    parent: Element | None = None


@dataclass
class Block:
    """A run of text between block boundaries, in the innermost open element `inside`."""

    inside: Element
    odds: float
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _odds_of(tag: str, attributes: str, article: bool) -> tuple[float, float, bool]:
    """(for, against, hidden) that an element's own tag and attributes say."""
    own = MILD_IN_ARTICLE.get(tag, TAG_ODDS.get(tag, 0.0)) if article else TAG_ODDS.get(tag, 0.0)
    up, down, hidden = max(own, 0.0), min(own, 0.0), tag in HIDDEN
    if attributes:
        for name, value in _NAMES.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                hidden = True
            elif name == "style":
                hidden |= "display:none" in value.replace(" ", "")
            elif tag not in ("body", "html", "article", "main"):
                for part in _PART.findall(value):
                    odds = WORD_ODDS.get(part, 0.0)
                    up, down = max(up, odds), min(down, odds)
    return up, down, hidden


def blocks_of(page: str) -> list[Block]:
    """The page's text blocks in order, with the classifier's log odds. Broken markup is read as
    browsers do in the main: unclosed paragraphs, items and cells end where the next begins."""
    stack = [Element("", 0.0, 0.0, False, False, False, 0)]
    found: list[Block] = []
    current: Block | None = None
    marked = False  # whether the page says where its article is

    def close() -> None:
        nonlocal current
        if current is not None:
            current.text = _SPACE.sub(" ", "".join(current.pieces)).strip()
            if current.text:
                found.append(current)
            current = None

    def add(raw: str) -> None:
        nonlocal current
        top = stack[-1]
        if top.hidden or not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if current is None:
            if text.isspace():
                return
            current = Block(top, top.up + top.down)
        current.pieces.append(text)
        if top.link:
            current.linked += len(text)

    def pop_to(size: int) -> None:
        if any(e.tag in BLOCK for e in stack[size:]):
            close()
        del stack[size:]

    at, end = 0, len(page)
    while at < end:
        less = page.find("<", at)
        if less < 0:
            add(page[at:])
            break
        match = _TOKEN.match(page, less)
        if match is None:  # a bare "<"
            add(page[at : less + 1])
            at = less + 1
            continue
        add(page[at:less])
        at = match.end()
        tag = match[2] or match[6]
        if not tag or match[4] == "" or match[8] == "":  # a comment, or a tag that the page's end cuts off
            continue
        tag, closing, attributes = tag.lower(), match[1] or match[5], match[3] or match[7] or ""
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    pop_to(i)
                    break
                if stack[i].tag in ("article", "table") and tag in ("p", "b", "i", "a", "span", "em", "strong", "li"):
                    break
            if tag in BLOCK:
                close()
            continue
        if tag in BLOCK:
            close()
        if tag in ENDS_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    pop_to(i)
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in SIBLINGS:
            ended, holders = SIBLINGS[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ended:
                    pop_to(i)
                    break
                if stack[i].tag in holders:
                    break
        if tag in VOID:
            continue
        parent = stack[-1]
        up, down, hidden = _odds_of(tag, attributes, parent.article)
        if not attributes.rstrip().endswith("/") or tag in BLOCK | HIDDEN:
            marked |= tag in ("article", "main")
            stack.append(
                Element(
                    tag, max(parent.up, up), min(parent.down, down), parent.hidden or hidden,
                    parent.article or tag in ("article", "main"), parent.link or tag == "a", parent.depth + 1, parent,
                )
            )
        if tag in RAW:  # ends at its own closing tag only
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else end
            pop_to(len(stack) - 1)
    close()
    if marked:
        for block in found:
            block.odds += 0.0 if block.inside.article else OUTSIDE
    return found


def unary(block: Block) -> float:
    """Log odds that a block is content: what its elements say, and its own length, links and stops."""
    text, words = block.text, block.text.count(" ") + 1
    own = -1.0 if words < 5 else 0.5 if words < 15 else 1.5
    own -= 3.0 if words < 15 and _COPYRIGHT.match(text) else 0.0
    own += 0.5 if text[-1] in ".!?\"'”»…" else -0.5
    links = min(1.0, block.linked / max(1, len(text)))
    return block.odds + own - 6.0 * links * links


def proximity(a: Block, b: Block) -> float:
    """Weight of the edge between two blocks: the fewer steps lead from one to the other over
    their nearest common element, the closer they are."""
    x, y, apart = a.inside, b.inside, 0
    while x is not y and apart < FAR:
        if x.depth >= y.depth:
            x = x.parent
        else:
            y = y.parent
        apart += 1
    return 2.0 / (1.0 + apart)


def smoothness(blocks: list[Block], reach: int = 3) -> list[tuple[int, int, float]]:
    """Edges (i, j, weight): each block with the next (adjacency), and with the nearest blocks
    before it that share its parent (DOM proximity), at most `reach` places away."""
    edges = []
    for j in range(1, len(blocks)):
        edges.append((j - 1, j, 0.5 + proximity(blocks[j - 1], blocks[j])))
        for i in range(max(0, j - reach), j - 1):
            if blocks[i].inside.parent is blocks[j].inside.parent:
                edges.append((i, j, 0.5))
    return edges


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (content or not) that minimise the cost: |odds| for each label against the odds, and an
    edge's weight where its ends differ. Ties go to boilerplate.

    The odds are capacities of the edges from the content terminal (positive) and to the
    boilerplate terminal (negative). A node whose odds exceed all its edges has its label in
    every minimum, so it is settled first and only moves its neighbours' odds; the rest goes
    through a maximum flow by shortest augmenting paths (Dinic). Content is what the first
    terminal still reaches.
    """
    n = len(odds)
    odds, near = list(odds), [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    label: list[bool | None] = [None] * n
    slack = [sum(x.values()) for x in near]
    todo = list(range(n))
    while todo:
        i = todo.pop()
        if label[i] is None and abs(odds[i]) > slack[i] + 1e-9:
            label[i] = odds[i] > 0
            for j, w in near[i].items():
                if label[j] is None:
                    odds[j] += w if label[i] else -w
                    slack[j] -= w
                    todo.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        number = {v: k for k, v in enumerate(rest)}
        links = [
            (number[i], number[j], w) for i in rest for j, w in near[i].items() if i < j and label[j] is None
        ]
        for v, side in zip(rest, _flow([odds[v] for v in rest], links), strict=True):
            label[v] = side
    return [bool(x) for x in label]


def _flow(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    n = len(odds)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def connect(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((there, back))

    for i, x in enumerate(odds):
        if x > 0:
            connect(source, i, x, 0.0)
        elif x < 0:
            connect(i, sink, -x, 0.0)
    for i, j, w in edges:
        connect(i, j, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source], queue = 0, [source]
        for v in queue:
            for e in out[v]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        v = source
        while True:
            if v == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                first = next(k for k, e in enumerate(path) if room[e] <= 1e-9)
                v = to[path[first] ^ 1]
                del path[first:]
                continue
            while turn[v] < len(out[v]):
                e = out[v][turn[v]]
                if room[e] > 1e-9 and level[to[e]] == level[v] + 1:
                    break
                turn[v] += 1
            if turn[v] < len(out[v]):
                path.append(out[v][turn[v]])
                v = to[path[-1]]
            elif v == source:
                break
            else:
                v = to[path.pop() ^ 1]
                turn[v] += 1


def main_text(page: str | None) -> tuple[str, int, int]:
    """(text, blocks kept, blocks found) of one page."""
    blocks = blocks_of(page) if page else []
    labels = minimum_cut([unary(b) for b in blocks], smoothness(blocks))
    kept = [b.text for b, content in zip(blocks, labels, strict=True) if content]
    return "\n".join(kept), len(kept), len(blocks)


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """Adds text, n_chars, n_blocks and n_content to every row of `pages`.

    `text` joins the blocks labelled content by line feeds; character references are decoded and
    runs of white space in a block are one space. Null and empty pages, and pages without
    content, have an empty text; broken and cut-off markup is read as far as it goes; a page of
    any length is one row and one graph, linear in its blocks. Rows are independent: repeated
    rows repeat their text, an empty table gives an empty one; input columns of the new names
    are replaced. Map-only.
    """

    @F.pandas_udf("struct<text:string,kept:long,found:long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([main_text(p) for p in batch], columns=["text", "kept", "found"])

    new = {"text", "n_chars", "n_blocks", "n_content", "_got"}
    kept = [c for c in pages.columns if c.lower() not in new]
    got = F.col("_got")
    return pages.select(*kept, run(F.col(html_column).cast("string")).alias("_got")).select(
        *kept,
        got["text"].alias("text"),
        F.length(got["text"]).cast("long").alias("n_chars"),
        got["found"].alias("n_blocks"),
        got["kept"].alias("n_content"),
    )
