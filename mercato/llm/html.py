"""Main text of web pages by minimum-cut labelling of their blocks.

A page becomes a list of blocks (runs of text between block-level tags). A
linear classifier over the tags, names and text of a block gives the log odds
that it is content; its two costs are the capacities from the source and to the
sink. Smoothness edges join neighbouring blocks and neighbouring children of one
parent, the stronger the closer they are in the document tree. A maximum flow
finds the cheapest labelling; blocks on the source side are the main text.

Pages are independent: one pass, no shuffle, memory bounded by one page.

Defined cases: a null or empty page, or one without content, has the text ``""``;
unclosed, truncated or misnested markup is read leniently; repeated rows give
the same row; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements whose content is never text, elements that begin and end
# blocks, and elements without content.
_SILENT = "script|style|noscript|template|title|svg|math|iframe|object|canvas|audio|video|textarea|select"
#: Of these, those without markup inside: unclosed, they run to the end of the page.
_PLAIN = frozenset("script style title textarea".split())
_FOREIGN = frozenset(("svg", "math"))
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A new one of these ends an open one of the same group.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_HOLDS = frozenset("article aside body blockquote div footer form header main nav ol section table td th ul".split())

# Log odds of content by element, by role and by word of a class or id.
_TAG_ODDS = {
    "article": 3.0, "main": 2.0, "nav": -8.0, "footer": -8.0, "aside": -8.0, "form": -8.0, "button": -8.0, "menu": -8.0,
    "dialog": -8.0, "head": -20.0, "header": -5.0, "label": -4.0, "legend": -4.0, "p": 0.5, "pre": 0.5, "blockquote": 0.5,
}
_ROLE_ODDS = {
    "main": 2.0, "article": 3.0, "navigation": -8.0, "banner": -8.0, "contentinfo": -8.0, "complementary": -8.0,
    "search": -8.0, "alert": -8.0, "dialog": -8.0, "menu": -8.0, "menubar": -8.0, "note": -4.0,
}
_GOOD_NAMES = frozenset("article body content entry main post story text".split())
_BAD_NAMES = frozenset(
    "ad ads adv advert advertisement adverts alert author-bio banner breadcrumb breadcrumbs byline-share comment commentlist "
    "comments consent cookie cookies copyright disclaimer discussion disqus footer footnav form gdpr header legal links login "
    "masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay pagination pager popup "
    "promo promoted promotion reader related recommended replies reply respond responses search share sharing sidebar "
    "sidebars signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets".split()
)
#: Words that leave a bad name bad when they stand in one class or id with it
#: ("site-nav", "comment-list"); any other makes another name ("has-sidebar").
_BESIDE = frozenset(
    "area bar block bottom box button buttons container footer global group header icon icons inner item items left link list "
    "main nav of page post posts primary right secondary section site the top wrap wrapper".split()
)
_NAME_ODDS = (1.0, -8.0)

_RAW = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(/?)({_SILENT})(?=[\s/>])((?:"[^"<]*"|'[^'<]*'|[^'">]|["'])*+)>|<[!?][^>]*(?:>|\Z)""", re.IGNORECASE | re.DOTALL
)
_ENDS = {t: re.compile(rf"</{t}(?:[\s/][^>]*)?>", re.IGNORECASE) for t in _PLAIN}
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:"[^"<]*"|'[^'<]*'|[^'"<>]|["'])*)(?:>|\Z)""")
_NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_WORD = re.compile(r"[a-zA-Z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

ADJACENT, SIBLING = 0.6, 0.4


def _is_bad(name: str) -> bool:
    """Whether a whole class or id (without its modifier) is a bad name."""
    name = name.split("--")[0]
    words = {w.lower() for w in _WORD.findall(_CAMEL.sub(" ", name))}
    return name.lower() in _BAD_NAMES or bool(words & _BAD_NAMES) and words <= _BAD_NAMES | _BESIDE


def _name_odds(tag: str, attributes: str) -> tuple[float, float]:
    """(odds of the element, odds of its bad names)."""
    odds, bad = _TAG_ODDS.get(tag, 0.0), 0.0
    for m in _NAMES.finditer(attributes):
        kind, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if kind == "role":
            odds += _ROLE_ODDS.get(value.strip().lower(), 0.0)
        elif kind == "hidden" or (kind == "aria-hidden" and value.lower() == "true"):
            odds += _NAME_ODDS[1]
        elif tag not in ("html", "body") and any(map(_is_bad, value.split())):
            bad += _NAME_ODDS[1]
        elif {w.lower() for w in _WORD.findall(_CAMEL.sub(" ", value))} & _GOOD_NAMES:
            odds += _NAME_ODDS[0]
    return odds, bad


def _spoken(html: str) -> str:
    """The page without comments, declarations and silent elements. One without
    its end tag loses only its tag, unless it holds no markup."""
    kept: list[str] = []
    opened: list[tuple[str, int]] = []  # (tag, parts kept before it)
    unclosed: set[str] = set()
    at = 0
    while m := _RAW.search(html, at):
        kept.append(html[at : m.start()])
        at = m.end()
        if not m.group(2):
            continue
        tag, foreign = m.group(2).lower(), any(t in _FOREIGN for t, _ in opened)
        if m.group(1):
            for k in range(len(opened) - 1, -1, -1):
                if opened[k][0] == tag:
                    del kept[opened[k][1] :], opened[k:]
                    break
        elif m.group(3).endswith("/") and (foreign or tag in _FOREIGN):
            continue
        elif tag in _PLAIN:
            end = None if tag in unclosed else _ENDS[tag].search(html, at)
            if end:
                at = end.end()
            elif foreign:
                unclosed.add(tag)
            else:
                return "".join(kept)
        else:
            opened.append((tag, len(kept)))
    return "".join(kept) + html[at:]


@dataclass
class Block:
    text: str
    path: tuple[int, ...]  # open elements, by number
    odds: float


def _spared(blocks: list[Block], named: set[int], mains: set[int], articles: set[int]) -> set[int]:
    """Elements of bad names that hold the page's main element, its longest
    article or, with none of these outside of them, most of its text."""
    size: dict[int, int] = {}
    above: dict[int, tuple[int, ...]] = {}
    for b in blocks:
        for k, n in enumerate(b.path):
            if n in mains or n in articles or n in named:
                size[n] = size.get(n, 0) + len(b.text)
                above[n] = b.path[:k]
    total = sum(len(b.text) for b in blocks)
    holders = [n for n in size if n in mains or n in articles]
    longest = max((n for n in holders if n in articles), key=lambda n: size[n], default=0)
    held = {n for h in holders if h in mains or h == longest for n in above[h]}
    return {n for n in named & size.keys() if n in held or 2 * size[n] > total and all(h == n or n in above[h] for h in holders)}


def blocks_of(html: str) -> list[Block]:
    """The page's blocks in order, with the log odds of being content."""
    page = _spoken(html)
    blocks: list[Block] = []
    stack: list[tuple[str, int, float]] = [("", 0, 0.0)]  # (tag, number, odds so far)
    named: dict[int, float] = {}  # odds of bad names by element
    mains, articles = set(), set()
    parts: list[str] = []
    linked = opened = 0

    def close_block() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            share = min(1.0, linked / len(text))
            words = text.count(" ") + 1
            heading = any(t in _HEADINGS for t, _, _ in stack)
            odds = stack[-1][2] - 3.0 * share + (0.0 if heading else max(-0.4, min(1.5, 0.5 * math.log(words / 6.0))))
            odds += 0.5 if text[-1] in ".!?:;\"')" else 0.0
            blocks.append(Block(text, tuple(n for _, n, _ in stack), odds))
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text = unescape(raw)
        parts.append(text)
        if any(t == "a" for t, _, _ in stack):
            linked += len(text.strip())

    at = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        closing, tag, attributes = m.group(1), m.group(2).lower(), m.group(3)
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _BLOCK:
            close_block()
        if closing:
            if tag in _BLOCK or any(t == tag for t, _, _ in stack[-4:]):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
                    if stack[k][0] in _HOLDS and tag not in _HOLDS:
                        break
            continue
        if tag in _VOID or attributes.rstrip().endswith("/"):
            continue
        if tag in _CLOSES or tag in _BLOCK:
            ends = _CLOSES.get(tag, {"p"})
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ends:
                    del stack[k:]
                    break
                if stack[k][0] in _HOLDS:
                    break
        opened += 1
        own, bad = _name_odds(tag, attributes)
        odds = stack[-1][2] + own
        role = next((m.group(2) or m.group(3) or m.group(4) for m in _NAMES.finditer(attributes) if m.group(1).lower() == "role"), None) or ""
        if bad:
            named[opened] = bad
        elif "main" in (tag, role.strip().lower()):
            mains.add(opened)
        elif "article" in (tag, role.strip().lower()):
            articles.add(opened)
        if tag == "header" and any(t in ("article", "main") for t, _, _ in stack):
            odds += 4.0  # an article's own heading area
        stack.append((tag, opened, odds))
    if at < len(page):
        add(page[at:])
    close_block()
    if named:
        for n in _spared(blocks, set(named), mains, articles):
            del named[n]
        for b in blocks:
            b.odds += sum(named.get(n, 0.0) for n in b.path)
    return blocks


def _shared(a: tuple[int, ...], b: tuple[int, ...]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges (i, j, capacity): neighbours in the page, and the last block before
    under the same parent; both weaken with the distance in the tree."""
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            a = blocks[i - 1].path
            far = len(a) + len(b.path) - 2 * _shared(a, b.path)
            edges.append((i - 1, i, ADJACENT / (1 + far)))
        parent = b.path[-2] if len(b.path) > 1 else 0
        if parent in last and last[parent] < i - 1:
            edges.append((last[parent], i, SIBLING))
        last[parent] = i
    return edges


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source (content) side of a minimum cut.

    The source has an edge to every node with the cost of calling it boilerplate,
    every node one to the sink with the cost of calling it content. What both
    have in common flows at once; augmenting paths by layers (Dinic) do the rest.
    """
    n = len(odds)
    source, sink = n, n + 1
    graph: list[list[list]] = [[] for _ in range(n + 2)]

    def join(u: int, v: int, there: float, back: float) -> None:
        graph[u].append([v, there, len(graph[v])])
        graph[v].append([u, back, len(graph[u]) - 1])

    for i, o in enumerate(odds):
        # log(1 + e^o) - log(1 + e^-o) = o: what is left after the common flow
        if o > 0:
            join(source, i, o, 0.0)
        elif o < 0:
            join(i, sink, -o, 0.0)
    for i, j, w in edges:
        join(i, j, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for v, cap, _ in graph[u]:
                if cap > 1e-9 and level[v] < 0:
                    level[v] = level[u] + 1
                    queue.append(v)
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        nxt = [0] * (n + 2)
        path: list[tuple[int, int]] = []
        u = source
        while True:
            if u == sink:
                flow = min(graph[a][k][1] for a, k in path)
                for a, k in path:
                    e = graph[a][k]
                    e[1] -= flow
                    graph[e[0]][e[2]][1] += flow
                path, u = [], source
                continue
            while nxt[u] < len(graph[u]):
                v, cap, _ = graph[u][nxt[u]]
                if cap > 1e-9 and level[v] == level[u] + 1:
                    break
                nxt[u] += 1
            if nxt[u] < len(graph[u]):
                path.append((u, nxt[u]))
                u = graph[u][nxt[u]][0]
            elif u == source:
                break
            else:
                u, k = path.pop()
                nxt[u] += 1


def main_text(html: str | None) -> tuple[str, int, int]:
    """(text, blocks, blocks kept) of a page."""
    blocks = blocks_of(html or "")
    kept = minimum_cut([b.odds for b in blocks], smoothness(blocks))
    texts = [b.text for b, k in zip(blocks, kept) if k]
    return "\n".join(texts), len(blocks), len(texts)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_blocks, n_kept of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                got = [main_text(h.as_py()) for h in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([g[0] for g in got], pa.string()),
                        pa.array([g[1] for g in got], pa.int64()),
                        pa.array([g[2] for g in got], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_blocks", "n_kept"],
                )

    wanted = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    return wanted.mapInArrow(run, "page_id long, url string, text string, n_blocks long, n_kept long")
