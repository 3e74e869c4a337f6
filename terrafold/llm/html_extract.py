"""Main text of web pages: wrapper induction over pages of a host, on a tolerant parse.

One page stands for each layout of a host. All its other pages are aligned with it by simple tree
matching, and a grouped count says, for each of its nodes, on how many of them the node has the same
text. Constant nodes are template; of what varies, the region with most text is the content where
no element says so.
"""

from __future__ import annotations

import html as entities
import re
import sys
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.language import host_of
from terrafold.llm.shared import Scratch

#: The fewest pages that make a wrapper, and the share of them on which a template node is the same.
_LEAST_PAGES, _SHARE = 3, 0.5
#: Share of the varying text that a region holds, and bytes of wrappers that may be broadcast (more
#: are joined by host and layout).
_REGION, _BROADCAST = 0.6, 16 << 20
#: Elements that tell layouts of a host apart.
_LAYOUT = ("article", "main", "section", "table")
#: Cells of an alignment that are kept at once; longer child lists are halved until they fit.
_CELLS = 1 << 20

# Elements of the HTML standard by role.
_RAW = "script style noscript template svg math iframe object canvas audio video textarea select title".split()
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary"
    " table tbody td tfoot th thead tr ul".split()
)
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
_HOLDS = {"ul", "ol", "menu", "dir", "dl", "table", "select", "article", "aside", "section", "div", "nav", "main", "td", "th", "blockquote", "form", "figure"}
_APART = set("nav footer aside form menu dialog head button search fieldset".split())
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "form", "menu", "menubar", "toolbar"}
# Words in class and id that name what is beside the text.
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adv|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|menus|breadcrumbs?|sidebar|aside|footer|"
    r"masthead|cookies?|notice|notices|consent|gdpr|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|"
    r"comments?|commentlist|disqus|respond|replies|related|recommend\w*|widgets?|toolbar|pagination|pager|alert|copyright)(?=$|[\s_-])",
    re.I,
)
_HEAD_NAMES = re.compile(r"(?:^|[\s_-])(?:header|topbar|site-title|logo)(?=$|[\s_-])", re.I)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(_RAW) + r")\b[^>]*>(?:.*?</(?P=raw)\s*>|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b|display\s*:\s*(none)""", re.I)


@dataclass
class Node:
    """A block element: its texts and block children in page order (inline markup is dissolved)."""

    tag: str
    names: str = ""
    role: str = ""
    hidden: bool = False
    items: list = field(default_factory=list)
    links: int = 0
    has_main: bool = False
    shape: int = 0

    def nodes(self) -> list[Node]:
        return [x for x in self.items if isinstance(x, Node)]

    def texts(self) -> list[str]:
        return [x for x in self.items if isinstance(x, str)]


def parse(page: str | None) -> Node:
    """The tree of block elements of a page, whatever is left open or closed twice."""
    root = Node("#")
    stack, parts, linked, in_link = [root], [], 0, False
    opened: Counter[str] = Counter()
    page = page or ""

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                stack[-1].items.append(text)
                stack[-1].links += min(linked, len(text))
            parts.clear()
        linked = 0

    def close(depth: int) -> None:
        flush()
        opened.subtract(x.tag for x in stack[depth:])
        del stack[depth:]

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
            linked += (m.start() - at) * in_link
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["raw"] or m[0].startswith("<!["):
                parts.append(" " if m["raw"] else entities.escape(m[0][9:-3]))
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = not m["end"]
        elif tag not in _BLOCK:
            continue
        elif m["end"]:
            if opened[tag] > 0:
                close(next(depth for depth in range(len(stack) - 1, 0, -1) if stack[depth].tag == tag))
            else:
                flush()
        else:
            flush()
            in_link = False
            ends = _CLOSES.get(tag, frozenset())
            if opened["p"] > 0 or any(opened[x] > 0 for x in ends):
                for depth in range(len(stack) - 1, 0, -1):
                    open_ = stack[depth].tag
                    if open_ == "p" or open_ in ends:
                        close(depth)
                        break
                    if open_ in _HOLDS and tag != "body":
                        break
            if tag in _VOID or (tag in ("html", "body") and opened[tag] > 0):
                continue
            node = Node(tag)
            if m["rest"]:
                for a in _ATTRIBUTE.finditer(m["rest"]):
                    value = (a[2] or a[3] or a[4] or "").strip()
                    if a[5] or a[6]:
                        node.hidden = True
                    elif a[1].lower() == "role":
                        node.role = value.lower()
                    else:
                        node.names = f"{node.names} {value}".strip()
            stack[-1].items.append(node)
            stack.append(node)
            opened[tag] += 1
    parts.append(page[at:])
    flush()
    for node in reversed(in_order(root)):
        node.has_main = any(x.tag in ("article", "main") and not _NAMES.search(x.names) or x.has_main for x in node.nodes())
    return root


def in_order(root: Node) -> list[Node]:
    """All nodes of a tree in page order, parents first; however deep it is."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += reversed(node.nodes())
    return out


class Matching:
    """Simple tree matching: the most nodes of two trees that can be aligned, keeping parents and
    order, where roots have the same tag and names.

    Subtrees of the same shape (tags and names all through) are compared once, whatever their number;
    child lists first lose what they have in common at both ends, which some best alignment
    matches; a row of the table is one vector operation. So the result is exact for wide and for
    deep trees.
    """

    def __init__(self, a: Node, b: Node):
        self.shapes: dict[tuple, int] = {}
        self.children: list[list[int]] = []
        self.heads: list[tuple[str, str]] = []
        self.sizes: list[int] = []
        self.known: dict[tuple[int, int], int] = {}
        for root in (a, b):
            for node in reversed(in_order(root)):
                below = tuple(x.shape for x in node.nodes())
                key = (node.tag, node.names, below)
                if key not in self.shapes:
                    self.shapes[key] = len(self.children)
                    self.children.append(list(below))
                    self.heads.append((node.tag, node.names))
                    self.sizes.append(1 + sum(self.sizes[x] for x in below))
                node.shape = self.shapes[key]

    def count(self, x: int, y: int) -> int:
        """How many nodes of two shapes can be aligned."""
        if x == y:
            return self.sizes[x]
        if self.heads[x] != self.heads[y]:
            return 0
        if (x, y) not in self.known:
            xs, ys, ends = self._middle(self.children[x], self.children[y])
            inner = sum(self.sizes[z] for z in ends)
            self.known[x, y] = 1 + inner + (int(self._last(xs, ys)[-1]) if xs and ys else 0)
        return self.known[x, y]

    def _middle(self, xs: list[int], ys: list[int]) -> tuple[list[int], list[int], list[int]]:
        """Two lists without what they begin and end with alike, and that."""
        least, head = min(len(xs), len(ys)), 0
        while head < least and xs[head] == ys[head]:
            head += 1
        tail = 0
        while tail < least - head and xs[-1 - tail] == ys[-1 - tail]:
            tail += 1
        return xs[head : len(xs) - tail], ys[head : len(ys) - tail], xs[:head] + xs[len(xs) - tail :]

    def _weights(self, xs: list[int], ys: list[int]) -> Iterator[np.ndarray]:
        """For each of ``xs``, how many nodes it shares with each of ``ys``."""
        kinds, of = np.unique(np.array(ys), return_inverse=True)
        rows: dict[int, np.ndarray] = {}
        for x in xs:
            if x not in rows:
                rows[x] = np.array([self.count(x, int(y)) for y in kinds])
            yield rows[x][of]

    def _last(self, xs: list[int], ys: list[int], table: list | None = None) -> np.ndarray:
        """The last row of the table of best alignments of leading parts; all rows go to ``table``."""
        row = np.zeros(len(ys) + 1, np.int64)
        for weights in self._weights(xs, ys):
            if table is not None:
                table.append(row)
            met = np.maximum(row[1:], np.where(weights > 0, row[:-1] + weights, 0))
            row = np.append(0, np.maximum.accumulate(met))
        return row

    def aligned(self, xs: list[int], ys: list[int]) -> list[tuple[int, int]]:
        """Places of children that a best alignment matches."""
        least, head = min(len(xs), len(ys)), 0
        while head < least and xs[head] == ys[head]:
            head += 1
        inner_x, inner_y, ends = self._middle(xs, ys)
        tail = len(ends) - head
        out = [(i, i) for i in range(head)] + [(len(xs) - 1 - i, len(ys) - 1 - i) for i in range(tail)]
        todo = [(inner_x, inner_y, head, head)]
        while todo:
            xs_, ys_, at_x, at_y = todo.pop()
            if not xs_ or not ys_:
                continue
            if len(xs_) * len(ys_) > _CELLS and len(xs_) > 1:
                half = len(xs_) // 2
                front, back = self._last(xs_[:half], ys_), self._last(xs_[:half - 1 : -1], ys_[::-1])
                cut = int(np.argmax(front + back[::-1]))
                todo += [(xs_[:half], ys_[:cut], at_x, at_y), (xs_[half:], ys_[cut:], at_x + half, at_y + cut)]
                continue
            table: list[np.ndarray] = []
            table.append(self._last(xs_, ys_, table))
            i, j = len(xs_), len(ys_)
            while i and j:
                if table[i][j] == table[i - 1][j]:
                    i -= 1
                elif table[i][j] == table[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    out.append((at_x + i, at_y + j))
        return out


def match(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """The aligned nodes of two trees by simple tree matching; none if their roots differ."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 1_000_000))
    m = Matching(a, b)
    if m.heads[a.shape] != m.heads[b.shape]:
        return []
    pairs, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        pairs.append((x, y))
        xs, ys = x.nodes(), y.nodes()
        todo += [(xs[i], ys[j]) for i, j in m.aligned([n.shape for n in xs], [n.shape for n in ys])]
    return pairs


@dataclass
class Numbered:
    """A layout's page, its nodes by number, and how many of them have text."""

    root: Node
    order: list[Node]
    number: dict[int, int]
    held: int

    @classmethod
    def of(cls, page: str) -> Numbered:
        root = parse(page)
        order = in_order(root)
        return cls(root, order, {id(x): i for i, x in enumerate(order)}, sum(bool(x.texts()) for x in order))


def compare(first: Numbered, page: Node) -> dict[int, tuple[int, int]] | None:
    """For the nodes of ``first``, by number: whether the page's aligned node has the same text, and how
    long its text is if not (links don't count). None for a copy of ``first``, which says nothing."""
    out, same = {}, 0
    for x, y in match(first.root, page):
        theirs = y.texts()
        if not theirs:
            continue
        if x.texts() == theirs:
            out[first.number[id(x)]] = (1, 0)
            same += 1
        else:
            out[first.number[id(x)]] = (0, max(0, sum(map(len, theirs)) - y.links))
    return None if same == first.held else out


@dataclass
class Wrapper:
    """A layout's page, its constant nodes with their texts, and the node of the region that holds the
    varying text."""

    first: Numbered
    constant: set[int]
    texts: set[tuple[str, ...]]
    region: int | None

    @classmethod
    def of(cls, page: str, pages: int, nodes: list[int], same: list[int], varying: list[int]) -> Wrapper:
        """From how often each node of the layout's ``page`` is the same on ``pages`` others, and how much
        its text varies on them."""
        numbered = Numbered.of(page)
        first, order = numbered.root, numbered.order
        constant = {n for n, k in zip(nodes, same, strict=True) if k >= _LEAST_PAGES and k >= _SHARE * pages}
        below: dict[int, int] = defaultdict(int)
        by_node = dict(zip(nodes, varying, strict=True))
        for i in range(len(order) - 1, -1, -1):
            below[id(order[i])] += by_node.get(i, 0) * (i not in constant) + sum(below[id(x)] for x in order[i].nodes())
        node, total = first, below[id(first)]
        while total and (inner := [x for x in node.nodes() if x.nodes() and below[id(x)] >= _REGION * total]):
            node = inner[0]
        texts = {tuple(order[i].texts()) for i in constant}
        return cls(numbered, constant, texts, numbered.number[id(node)] if total and node is not first else None)

    def applied(self, root: Node) -> tuple[set[int], Node | None]:
        """The template nodes of a page (by id), and its node of the region."""
        template, region = set(), None
        for x, y in match(self.first.root, root):
            i = self.first.number[id(x)]
            if i in self.constant and x.texts() == y.texts():
                template.add(id(y))
            if i == self.region:
                region = y
        return template, region


def induce(pages: list[str]) -> Wrapper | None:
    """The wrapper of some pages of one layout; None for too few, or where they are copies of one."""
    if len(pages) < _LEAST_PAGES:
        return None
    first = Numbered.of(pages[0])
    found = [x for x in (compare(first, parse(p)) for p in pages[1:]) if x is not None]
    if not found:
        return None
    nodes = sorted({n for x in found for n in x})
    same, varying = ([sum(x.get(n, (0, 0))[k] for x in found) for n in nodes] for k in (0, 1))
    return Wrapper.of(pages[0], len(found), nodes, same, varying)


def _mains(root: Node) -> list[tuple[int, Node]]:
    """Article and main elements with the length of their own text."""
    apart: set[int] = set()
    order = in_order(root)
    for node in order:
        if id(node) in apart or _apart(node, False):
            apart.add(id(node))
            apart.update(id(x) for x in node.nodes())
    length: dict[int, int] = {}
    for node in reversed(order):
        length[id(node)] = 0 if id(node) in apart else sum(len(x) if isinstance(x, str) else length[id(x)] for x in node.items)
    return [(length[id(x)], x) for x in reversed(order) if id(x) not in apart and (x.tag in ("article", "main") or x.role in ("main", "article") or "articlebody" in x.names.lower().split())]


def _apart(node: Node, inside: bool) -> bool:
    """Whether an element is beside the text; ``inside`` the article, its header belongs to it."""
    if node.hidden or node.tag in _APART or node.role in _ROLES:
        return not (node.tag in ("form", "body") and node.has_main)
    if node.tag == "header" or _HEAD_NAMES.search(node.names):
        return not inside and not node.has_main
    return bool(node.names and node.tag not in ("html", "body", "main") and _NAMES.search(node.names) and not node.has_main)


def extract(page: str | None, wrapper: Wrapper | None = None) -> str:
    """The main text: blocks in page order, one a line.

    Blocks that align with a constant node of the layout's wrapper, and have its text, are
    template. Of the rest, those count that are inside the page's longest article (or main) element, or
    else inside the region that varies in the wrapper, without what elements and names mark as
    beside the text; a page with neither is taken whole, less lists of links.
    """
    root = parse(page)
    found = _mains(root)
    articles = [x for x in found if x[1].tag == "article" or x[1].role == "article" or "articlebody" in x[1].names.lower().split()]
    top = max(articles or found, key=lambda x: x[0], default=(0, None))[1]
    template: set[int] = set()
    # Trees are aligned unless nothing in the element has the text of a constant node: then none of it is template.
    if wrapper and (top is None or any(tuple(x.texts()) in wrapper.texts for x in in_order(top) if x.items)):
        template, region = wrapper.applied(root)
        top = top or region
    inside = top is not None
    blocks: list[str] = []
    todo: list = [top or root]
    while todo:
        node, text = x if isinstance(x := todo.pop(), tuple) else (x, None)
        if text is not None:
            if id(node) not in template and (inside or not (node.tag == "li" and node.links >= sum(map(len, node.texts())))):
                blocks.append(text)
            continue
        todo += [x if isinstance(x, Node) else (node, x) for x in reversed(node.items) if isinstance(x, str) or not _apart(x, inside)]
    return "\n".join(blocks)


def _hosted(pages: DataFrame, url: str, html: str) -> DataFrame:
    """With _host, _layout (which of some elements the page has, a bit each) and _html."""
    page = F.coalesce(F.col(html), F.lit(""))
    layout = [F.when(F.rlike(page, F.lit(f"(?i)<{tag}[\\s>]")), 1 << i).otherwise(0) for i, tag in enumerate(_LAYOUT)]
    total = layout[0]
    for bit in layout[1:]:
        total = total + bit
    return pages.withColumn("_host", F.coalesce(host_of(F.col(url)), F.lit(""))).withColumn("_html", page).withColumn("_layout", total)


def _beside(rows: DataFrame, side: DataFrame) -> DataFrame:
    """``rows`` with the written table ``side`` by host and layout, broadcast if it is measured to be small."""
    size = side.agg(F.coalesce(F.sum(F.octet_length("first")), F.lit(0))).first()[0]
    return rows.join(F.broadcast(side) if size <= _BROADCAST else side, ["_host", "_layout"], "left")


def wrappers(pages: DataFrame, scratch: Scratch, url: str = "url", html: str = "html") -> DataFrame:
    """(_host, _layout, first, pages, nodes, same, varying): what ``Wrapper.of`` takes, for each layout of
    each host, from all its pages.

    The page of least hash stands for a layout. All others are aligned with it where they lie, and
    each task adds up what it found before the counts are shuffled, so a host with a third of
    all pages costs no task more. Copies of the page don't count.
    """
    rows = _hosted(pages, url, html).where("_host <> ''").select("_host", "_layout", "_html")
    firsts = scratch.write(rows.groupBy("_host", "_layout").agg(F.min_by("_html", F.xxhash64("_html")).alias("first"), F.count("*").alias("n")).where(F.col("n") > _LEAST_PAGES).drop("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list[int]] = {}
        trees: dict[str, Numbered] = {}

        def told() -> pa.RecordBatch:
            keys = list(found)
            columns = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32()))]
            columns += [pa.array([found[k][i] for k in keys], pa.int64()) for i in (0, 1)]
            return pa.record_batch(columns, names=["_host", "_layout", "node", "same", "varying"])

        for batch in batches:
            for host, layout, page, first in zip(*[batch.column(i) for i in range(4)], strict=True):
                text = first.as_py()
                if text not in trees:
                    if len(trees) > 1000:
                        trees.clear()
                    trees[text] = Numbered.of(text)
                counts = compare(trees[text], parse(page.as_py()))
                if counts is not None:
                    host, layout = host.as_py(), layout.as_py()
                    for node, (same, varying) in [(-1, (1, 0)), *counts.items()]:
                        own = found.setdefault((host, layout, node), [0, 0])
                        own[0] += same
                        own[1] += varying
            if len(found) > 100_000:
                yield told()
                found.clear()
        yield told()

    met = _beside(rows, firsts).where("first is not null").select("_host", "_layout", "_html", "first")
    counts = met.mapInArrow(run, "_host string, _layout int, node int, same long, varying long").groupBy("_host", "_layout", "node").agg(F.sum("same").alias("same"), F.sum("varying").alias("varying"))
    each = F.sort_array(F.collect_list(F.when(F.col("node") >= 0, F.struct("node", "same", "varying"))))
    of_layout = counts.groupBy("_host", "_layout").agg(F.max(F.when(F.col("node") < 0, F.col("same"))).alias("pages"), each.alias("x")).where(F.col("pages") >= _LEAST_PAGES)
    return scratch.write(of_layout.join(firsts, ["_host", "_layout"]).select("_host", "_layout", "first", "pages", F.col("x.node").alias("nodes"), F.col("x.same").alias("same"), F.col("x.varying").alias("varying")))


def main_text(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): a row per row of ``pages``.

    Null html is empty, and gives an empty text; pages of a null or odd url have no host and no
    wrapper. Repeated rows are rows like others; ties between pages that could stand for a layout
    are copies, so either gives the same. Other columns are not read, whatever their names; an
    empty table gives no rows.
    """
    scratch = Scratch(pages.sparkSession, "wrappers")
    made = wrappers(pages, scratch, url, html)
    rows = _hosted(pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")), "url", "html")
    joined = _beside(rows, made).select("page_id", "url", "_html", "first", "pages", "nodes", "same", "varying")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded: dict[str, Wrapper] = {}
        for batch in batches:
            texts = []
            for page, first, *counts in zip(*[batch.column(i) for i in range(2, 7)], batch.column(7), strict=True):
                of = first.as_py()
                if of is not None and of not in loaded:
                    if len(loaded) > 1000:
                        loaded.clear()
                    loaded[of] = Wrapper.of(of, *[x.as_py() for x in counts])
                texts.append(extract(page.as_py(), loaded.get(of)))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = joined.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
