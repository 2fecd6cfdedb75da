"""Main text of web pages by minimum-cut labelling.

A page becomes its blocks of text. A small classifier, trained on a bounded sample, turns each block into two costs
(of calling it content, of calling it boilerplate); these are the terminal capacities of
a graph whose smoothness edges join neighbouring blocks and blocks of one container. The
minimum cut, found by maximum flow, is the cheapest labelling of all blocks at once.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolytics.llm.common import byte_slices, ship

# fixed values: element names with a meaning of their own
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt "
             "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
             "li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead "
             "title tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style template noscript textarea iframe xmp noembed noframes".split())
HIDDEN = RAW | set("head title svg math object canvas audio video select button datalist".split())
HEAD = set("base link meta title style script noscript template".split())
NEVER = set("nav aside footer form menu dialog".split())
CONTENT = set("article main".split())
#: class, id and role words of what surrounds an article
SIGNS = re.compile(
    r"(?:\A|[\s_-])(?:ads?|advert(?:s|isement|ising)?|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|"
    r"notices?|gdpr|popup|modal|overlay|newsletter|subscribe|signup|login|nav(?:igation|bar)?|menu|"
    r"breadcrumbs?|pagination|pager|toolbar|sidebar|aside|widget|related|recommended|trending|share|sharing|"
    r"social|footer|masthead|site-?header|page-?header|copyright|comments?|disqus|replies|reply|respond|"
    r"skip(?:-link)?|search(?:form|box|bar)?|complementary|contentinfo)(?:\Z|[\s_-])", re.IGNORECASE)
SPACE = re.compile(r"\s+")
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                   r"</([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)|"
                   r"<([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.DOTALL)
#: one attribute after the other: its whole name and its value
ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: names that say which signs a part has or lacks, not what it is
ABOUT = re.compile(r"(?:\A|(?<=[\s_-]))(?:has|have|no|not|with|without|hide|show)[_-]\S+", re.IGNORECASE)

# elements whose start closes an open paragraph, and the scopes that end the search
CLOSES_P = BLOCKS - set("body caption dd dt head html legend optgroup option tbody td tfoot th thead title tr".split()) \
    | {"dd", "dt", "li"}
SELF_CLOSING = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",),
                "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
PAIRS = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}


class Block:
    __slots__ = ("text", "tag", "parent", "inside", "banned", "link", "depth", "signed", "marks", "outer")

    def __init__(self, text, tag, parent, inside, banned, link, depth, signed=False, marks=(), outer=0):
        self.text, self.tag, self.parent, self.inside = text, tag, parent, inside
        self.banned, self.link, self.depth, self.signed = banned, link, depth, signed
        self.marks, self.outer = marks, outer


#: share of a page's words from which an element is no part beside the article
WHOLE_PAGE = 0.75


def weigh_marks(page: list[Block]) -> list[Block]:
    """Set ``banned`` (menus, footers, forms and the like) and ``signed`` (named like what
    surrounds an article) from the marked elements that hold a block. A mark does not count
    on the way to the article of a page that has none without, nor where it holds nearly all
    words of the page."""
    if not any(b.marks for b in page):
        return page
    held: dict[int, int] = {}
    total = 0
    for b in page:
        n = b.text.count(" ") + 1
        total += n
        for m in b.marks:
            held[m] = held.get(m, 0) + n
    none = {m for m, n in held.items() if n >= WHOLE_PAGE * total}
    inside = [b for b in page if b.inside]
    if inside:
        outer = [sum(m not in none for m in b.marks[:b.outer]) for b in inside]
        least = min(outer)
        if least:
            none = none.union(*(b.marks[:b.outer] for b, k in zip(inside, outer) if k == least))
    for b in page:
        b.banned = any(m < 0 and m not in none for m in b.marks)
        b.signed = any(m > 0 and m not in none for m in b.marks)
    return page


def blocks(html: str) -> list[Block]:
    """The blocks of text of a page, in order, with their place in the tree."""
    # an open element: name, number, marked elements it is in (its number, negative for a
    # menu or the like), inside content, hidden, link, marks down to that content
    stack = [("", 0, (), False, False, False, 0)]
    out: list[Block] = []
    parts: list[str] = []
    linked = 0
    numbers = 0

    def flush():
        nonlocal linked
        if parts:
            text = SPACE.sub(" ", "".join(parts)).strip()
            if text:
                own = next((x for x in reversed(stack) if x[0] in BLOCKS or not x[0]), stack[0])
                k = stack.index(own)
                parent = stack[max(0, k - 1)][1]
                out.append(Block(text, own[0], parent, stack[-1][3], False, min(1.0, linked / len(text)), k,
                                 marks=stack[-1][2], outer=stack[-1][6]))
            parts.clear()
            linked = 0

    def add(raw: str):
        nonlocal linked
        top = stack[-1]
        if raw and not top[4]:
            text = unescape(raw)
            parts.append(text)
            if top[5]:
                linked += len(text.strip())

    def pop_to(k: int):
        if any(x[0] in BLOCKS for x in stack[k:]):
            flush()
        del stack[k:]

    at, size = 0, len(html)
    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            add(html[at:])
            break
        m = TOKEN.match(html, lt)
        if not m:                                       # a "<" that opens nothing is text
            nxt = html.find("<", lt + 1)
            add(html[at:nxt if nxt >= 0 else size])
            at = nxt if nxt >= 0 else size
            continue
        add(html[at:lt])
        at = m.end()
        close, name = m.group(1), m.group(2)
        if close:
            close = close.lower()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == close:
                    pop_to(k)
                    break
                if stack[k][0] in ("article", "main", "body", "table", "nav", "aside", "footer", "form") \
                        and close not in BLOCKS:
                    break                               # a stray inline end tag closes no container
            else:
                if close in ("p", "br"):
                    flush() if close == "p" else add(" ")
            continue
        if not name:
            continue
        name = name.lower()
        if len(stack) > 1 and stack[-1][0] == "head" and name not in HEAD:
            pop_to(len(stack) - 1)                      # the end tag of head may be left out
        if name in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    pop_to(k)
                    break
                if stack[k][0] in BLOCKS:
                    break
        if name in SELF_CLOSING:
            same = PAIRS.get(name, (name,))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in same:
                    pop_to(k)
                    break
                if stack[k][0] in SELF_CLOSING[name]:
                    break
        if name in BLOCKS:
            flush()
        if name in VOID:
            if name in ("br", "img", "hr"):
                add(" ")
            continue
        attrs = m.group(3) or ""
        if attrs.rstrip().endswith("/") and name not in BLOCKS and name not in RAW and name != "a":
            continue
        if name in RAW:                                 # its content is no markup
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
            at = end.end() if end else size
            continue
        top = stack[-1]
        marks, inside, hidden, link, outer = top[2:]
        banned = signed = content = False
        if name in HIDDEN:
            hidden = True
        if name in NEVER or (name == "header" and not inside):
            banned = True
        if name in CONTENT:
            content = True
        if attrs:
            for a in ATTR.finditer(attrs):
                key = a.group(1).lower()
                value = a.group(2) or a.group(3) or a.group(4) or ""
                if key == "hidden" or key == "aria-hidden" and value.lower() == "true" \
                        or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    hidden = True
                elif key in ("class", "id", "role") and name not in ("html", "body", "main") \
                        and SIGNS.search(ABOUT.sub(" ", value)):
                    signed = True
                elif key == "role" and value.lower() in ("main", "article"):
                    content = True
                elif key == "role" and value.lower() in ("navigation", "banner", "dialog", "alert", "form", "search"):
                    banned = True
        numbers += 1
        if banned or signed:
            marks += (-numbers if banned else numbers,)
        if content:
            inside, outer = True, len(marks)
        stack.append((name, numbers, marks, inside, hidden, link or name == "a", outer))
    flush()
    return weigh_marks(out)


#: prior log odds of content by structure: inside <article> or <main> where a page has one
#: (else against), headings, paragraphs, list items
INSIDE, HEADING, PARAGRAPH, ITEM = 6.0, 0.8, 0.8, -0.6
TEXT_LIMIT = 4.0                 # most the text says either way: structure that is there wins
HARD = 1e6
SIGNED = 12.0                    # against content under a class or id sign
#: text weights (bias, words, link share, sentence end) where there is nothing to learn from
DEFAULT_WEIGHTS = (-0.6, 0.9, -4.0, 0.8)
MAX_TRAIN_PAGES = 400
MAX_TRAIN_BLOCKS = 64            # of a training page
LEAST_TRAIN_BLOCKS = 20          # of each label


def text_features(b: Block) -> tuple[float, float, float, float]:
    n = b.text.count(" ") + 1
    return 1.0, math.log2(1 + n) / 2, b.link, float(b.text[-1] in ".!?:;\"'»”…")


def costs(b: Block, any_inside: bool, weights) -> tuple[float, float]:
    """Cost of the label boilerplate and of the label content: negative log probabilities."""
    if b.banned:
        return 0.0, HARD
    z = sum(w * x for w, x in zip(weights, text_features(b)))
    z = max(-TEXT_LIMIT, min(TEXT_LIMIT, z))
    z += (HEADING * (len(b.tag) == 2 and b.tag[0] == "h") + PARAGRAPH * (b.tag in ("p", "pre", "blockquote", "td"))
          + ITEM * (b.tag in ("li", "dt", "option")))
    if any_inside:
        z += INSIDE if b.inside else -INSIDE
    if b.signed:
        z -= SIGNED
    return math.log1p(math.exp(z)), math.log1p(math.exp(-z))


def fit_weights(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                max_pages: int = MAX_TRAIN_PAGES) -> tuple[float, ...]:
    """Train the text weights on blocks whose structure names their label: inside <article> or
    <main> (content), or in menus, footers, adverts and the like (boilerplate).

    The sample is bounded: about ``max_pages`` pages drawn by a hash of the id, and at most
    ``MAX_TRAIN_BLOCKS`` evenly spaced blocks of each. Without enough blocks of both labels
    the default weights are returned.
    """
    from aerolytics.llm.toxicity import fit_layer
    ship(pages.sparkSession)
    n = pages.count()
    part = F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.lit(11)), F.lit(1_000_003)) / 1_000_003.0
    some = pages.where(part < min(1.0, max_pages / max(1, n))).select(F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for html in batch.column(0).to_pylist():
                page = [b for b in blocks(html or "") if b.banned or b.signed or b.inside]
                step = -(-len(page) // MAX_TRAIN_BLOCKS) or 1
                rows += [(float(b.inside and not (b.banned or b.signed)), *text_features(b)) for b in page[::step]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.float64()) for c in (zip(*rows) if rows else [[]] * 5)], names=list("yabcd"))

    rows = np.array(sorted(map(tuple, some.mapInArrow(run, "y double, a double, b double, c double, d double").collect())))
    if not len(rows) or min((rows[:, 0] == k).sum() for k in (0.0, 1.0)) < LEAST_TRAIN_BLOCKS:
        return DEFAULT_WEIGHTS
    y = rows[:, 0]
    share = {k: len(y) / (2.0 * (y == k).sum()) for k in (0.0, 1.0)}
    return tuple(float(w) for w in fit_layer(rows[:, 1:], y, np.where(y == 1, share[1.0], share[0.0])))


class MaxFlow:
    """Dinic's algorithm on adjacency arrays; the source side of the minimum cut."""

    def __init__(self, n: int):
        self.head = [[] for _ in range(n)]
        self.to: list[int] = []
        self.cap: list[float] = []

    def edge(self, a: int, b: int, there: float, back: float = 0.0) -> None:
        self.head[a].append(len(self.to))
        self.to.append(b)
        self.cap.append(there)
        self.head[b].append(len(self.to))
        self.to.append(a)
        self.cap.append(back)

    def levels(self, s: int) -> list[int]:
        level = [-1] * len(self.head)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in self.head[u]:
                if self.cap[e] > 1e-9 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[u] + 1
                    queue.append(self.to[e])
        return level

    def run(self, s: int, t: int) -> list[bool]:
        while (level := self.levels(s))[t] >= 0:
            nxt = [0] * len(self.head)
            path: list[int] = []                        # edges from s to the current node
            u = s
            while True:
                if u == t:
                    f = min(self.cap[e] for e in path)
                    cut = None
                    for i, e in enumerate(path):
                        self.cap[e] -= f
                        self.cap[e ^ 1] += f
                        if cut is None and self.cap[e] <= 1e-9:
                            cut = i
                    u = self.to[path[cut] ^ 1]
                    del path[cut:]
                    continue
                while nxt[u] < len(self.head[u]):
                    e = self.head[u][nxt[u]]
                    if self.cap[e] > 1e-9 and level[self.to[e]] == level[u] + 1:
                        break
                    nxt[u] += 1
                if nxt[u] < len(self.head[u]):
                    e = self.head[u][nxt[u]]
                    path.append(e)
                    u = self.to[e]
                elif path:
                    u = self.to[path.pop() ^ 1]
                    nxt[u] += 1
                else:
                    break
        return [x >= 0 for x in self.levels(s)]


def label(page: list[Block], weights=DEFAULT_WEIGHTS, near: float = 0.7, same: float = 0.4) -> list[bool]:
    """True for the blocks on the content side of the minimum cut."""
    if not page:
        return []
    inside = any(b.inside and not (b.banned or b.signed) for b in page)
    n = len(page)
    g = MaxFlow(n + 2)
    s, t = n, n + 1
    last: dict[int, int] = {}
    for i, b in enumerate(page):
        boiler, content = costs(b, inside, weights)
        g.edge(s, i, boiler)                            # cut when i is labelled boilerplate
        g.edge(i, t, content)                           # cut when i is labelled content
        if i and not b.banned and not page[i - 1].banned and (b.inside, b.signed) == (page[i - 1].inside, page[i - 1].signed):
            w = near / (1 + abs(b.depth - page[i - 1].depth))
            g.edge(i - 1, i, w, w)
        if not b.banned and not b.signed:
            if b.parent in last and last[b.parent] != i - 1:
                g.edge(last[b.parent], i, same, same)
            last[b.parent] = i
    return g.run(s, t)[:n]


def main_text(html: str | None, weights=DEFAULT_WEIGHTS) -> str:
    page = blocks(html or "")
    return "\n\n".join(b.text for b, keep in zip(page, label(page, weights)) if keep)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html", weights=DEFAULT_WEIGHTS) -> DataFrame:
    """One row per page: id, url, text (blocks joined by two line feeds; empty if none).

    Null or empty html gives an empty text; null ids, null urls and repeated rows are
    kept; an empty table gives no rows; other columns are not read. Whole pages are read.
    """
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in byte_slices(b.column(2)):
                text = [main_text(h, weights) for h in b.column(2).slice(lo, hi - lo).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo),
                     pa.array(text, pa.string())], names=["page_id", "url", "text"])

    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                         F.col(html_col).alias("html"))
            .mapInArrow(run, "page_id long, url string, text string"))
