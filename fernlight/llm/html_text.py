"""Main text of web pages by minimum cut.

A page becomes its text blocks in order. A block's terminal capacity is its log-odds of being content
(from the source if positive, to the sink if negative) by itself: the shape of its text, its own
element and its share of links. The shape's weights (length, how it starts and ends) are fitted here
by logistic regression. Its teachers are pages that say themselves what is what: blocks in article
or main elements against blocks in navigation, footers, asides and forms, on at most `sample` pages,
those with the smallest id hashes; a page counts once for each shape, and only these counts, under two
hundred, leave the executors.
Shapes that no page teaches keep the weights stated below.

Edges. Smoothness edges join each block with the next one and with the block before it in the same
container, and weigh more the nearer the two are in the DOM; a border of furniture counts as steps
more. Elements that say what they are, by tag, role or name, are seeds, fixed on their side: a block
below them has an edge to the terminal. An edge to a seed outweighs the shape of one block's text, for
comments and adverts read like articles, and an article has headings, lists and tables that read like
menus; where no seed is, text and neighbours are of one order and decide together. The minimum cut of this graph is the
labelling of least cost; blocks on the source's side are content.

Maximum flow by elimination, exact and in linear time on pages: a block with one edge pushes as much
of its surplus through it as it carries; a block with two is replaced by the equal network between
its neighbours (star to triangle). Same-container edges of a page never cross, so one of the two
is always possible and nothing is left; other graphs go on with shortest augmenting paths. Labels
are read back in reverse order.

Text: character references are decoded, white space inside a block becomes one space, and the
content blocks are joined by one space. Script, style, head, form controls and comments are no text.

Cases: null html is empty. Pages without tags are one block. Unclosed elements end with their
parent, or where HTML closes them (p, li, td and the like). A tag or comment that never ends takes
the rest as markup. A page is one row's work, whatever its size: time and memory follow its length.
Rows that repeat an id are each their own page. Without rows or ids nothing is fitted.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: HTML's element names by what they do to text

SKIPPED = frozenset("script style head title noscript template svg math iframe object embed canvas audio video map select textarea button option datalist noframes".split())
RAW = frozenset("script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table caption tbody td tfoot th thead tr ul".split())
SPACES = frozenset("br hr wbr".split())
CLOSES_P = BLOCKS - frozenset("body html td th tr tbody thead tfoot caption legend summary".split())
ENDS = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "tr": ("tr td th", ("table",))}

# --- the classifier's weights

#: Elements and roles whose text is furniture or the article.
AWAY = frozenset("nav footer aside form menu dialog search".split())
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar status".split())
#: Words in class and id.
AWAY_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adsense adslot banner sponsor sponsored sponsors promo promos promotion promoted "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager paginator toc tabs toolbar skip "
    "header masthead topbar footer foot colophon copyright legal sidebar sidebars aside rail widget widgets "
    "cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay lightbox disclaimer "
    "form forms login signin signup register subscribe subscription newsletter search searchbox "
    "comment comments commentlist commenter reply replies respond discussion disqus feedback reviews "
    "share sharing social follow related recommended recommendations trending popular outbrain taboola teaser teasers more-stories hidden".split()
)
NEAR_WORDS = frozenset("article content main post entry story body text prose page-content articlebody article-body post-body entry-content maincontent".split())
#: Weights of edges to seeds: of an article and names of text where nothing around says furniture, else of furniture alone, once.
IN_ARTICLE, IN_AWAY, AWAY_NAME, NEAR_NAME = 2.5, -5.0, -5.0, 0.6
#: What a block's own element says, and all of its text in links.
BY_TAG = {"": 0.8, "p": 0.8, "h1": 0.8, "h2": 0.6, "h3": 0.4, "li": 0.2, "pre": 0.5, "blockquote": 0.5, "address": -0.6}
LINKS = -2.0
#: The most that the shape of a text says.
MOST = 2.0
#: Weights of shapes before pages have taught: each length (by its logarithm), and the three marks.
LENGTHS = 12
PRIOR = [max(-1.0, min(1.5, 0.5 * (k + 0.5 - 6))) for k in range(LENGTHS)] + [0.5, 0.2, -2.0]
RIDGE = 1.0
#: Pages of a site are made alike and say little more than a few of them: all that teach weigh as so many, at most.
WEIGH_AS = 50
NEXT_EDGE, SAME_EDGE, BORDER = 2.0, 1.0, 2

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_RIGHTS = re.compile(r"^\s*(?:©|\(c\)|copyright\b)", re.I)
_STOP = re.compile(r"[.!?:;…。]\s*$")


@dataclass(slots=True)
class Node:
    tag: str
    parent: "Node | None"
    depth: int
    away: int  # furniture around or at it
    article: bool
    names: float  # evidence of its names and those around
    inner: bool = False  # has blocks in elements below it


@dataclass(slots=True)
class Block:
    text: str
    node: Node
    links: int  # characters in links


def _child(tag: str, attrs: str, parent: Node) -> Node | None:
    """The element below parent; None if nothing of it is seen."""
    cost, away = parent.names, parent.away
    article = parent.article or tag in ("article", "main")
    names: list[str] = []
    if attrs and not attrs.isspace():
        for name, *values in _NAMES.findall(attrs):
            name, value = name.lower(), next((v for v in values if v), "")
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return None
            if name == "role":
                if value.lower() in AWAY_ROLES:
                    away += 1
                article = article or value.lower() in ("main", "article")
            elif name in ("class", "id"):
                for part in value.split():
                    names.append(part.lower())
                    names += [w.lower() for w in _WORD.findall(part)]
    if tag in AWAY or tag == "header" and not parent.article:
        away += 1
    if tag != "body" and tag != "html" and any(w in AWAY_WORDS for w in names):
        cost = AWAY_NAME
    elif any(w in NEAR_WORDS for w in names):
        cost = cost or NEAR_NAME
    return Node(tag, parent, parent.depth + 1, away, article, cost)


def blocks_of(html: str) -> list[Block]:
    """Text blocks in page order."""
    root = Node("", None, 0, 0, False, 0.0)
    stack, out = [root], []
    opened: Counter[str] = Counter()  # elements of the stack by name
    pieces: list[str] = []
    in_link = linked = 0
    skipped = ""  # name of the element whose inside is no text
    depth = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = "".join(pieces)
            if "&" in text:
                text = unescape(text)
            text = " ".join(text.split())
            if text:
                node = stack[-1]
                out.append(Block(text, node, linked))
                while node.parent and not node.parent.inner:
                    node = node.parent
                    node.inner = True
            pieces.clear()
        linked = 0

    def close(k: int) -> None:
        for x in stack[k:]:
            opened[x.tag] -= 1
        del stack[k:]

    def say(text: str) -> None:
        nonlocal linked
        if text and not skipped:
            pieces.append(text)
            if in_link:
                linked += len(text.strip())

    at = 0
    while True:
        found = _TOKEN.search(html, at)
        if found is None:
            say(html[at:])
            break
        say(html[at : found.start()])
        at = found.end()
        name = found.group(2)
        if name is None:
            if found.group().startswith("<![CDATA["):
                say(found.group()[9:].removesuffix("]]>"))
            continue
        name, closing = name.lower(), bool(found.group(1))
        if skipped:
            if name == skipped:
                depth += -1 if closing else 1
                if depth == 0:
                    skipped = ""
            continue
        if name in SPACES:
            pieces.append(" ")
            continue
        if name == "a":
            in_link = 0 if closing else 1
            continue
        if closing:
            if opened[name]:
                flush()
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == name))
                in_link = 0
            elif name == "p":
                flush()
            continue
        if name in VOID:
            continue
        attrs = found.group(3) or ""
        if name in SKIPPED:
            if name in RAW:
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
            elif not attrs.rstrip().endswith("/"):
                skipped, depth = name, 1
            if name == "head":
                skipped, depth = "", 0
                end = re.compile(r"</head\b[^>]*>|<body\b", re.I).search(html, at)
                if end:
                    at = end.start() if html[end.start() + 1] != "/" else end.end()
            pieces.append(" ")
            continue
        if name not in BLOCKS:
            hidden = attrs and "hidden" in attrs.lower()
            if hidden and _child(name, attrs, stack[-1]) is None:
                skipped, depth = name, 1
            continue
        flush()
        if name in CLOSES_P and stack[-1].tag == "p":
            close(len(stack) - 1)
        if name in ENDS and any(opened[x] for x in ENDS[name][0].split()):
            ended, until = ENDS[name]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in until:
                    break
                if stack[k].tag in ended.split():
                    close(k)
                    break
        node = _child(name, attrs, stack[-1])
        if node is None:
            skipped, depth = name, 1
        else:
            stack.append(node)
            opened[name] += 1
    flush()
    return out


def shape_of(text: str) -> int:
    """A small number for the length of a text and its marks: ends as a sentence, starts with a capital, claims rights."""
    marks = (_STOP.search(text) is not None) | text[:1].isupper() << 1 | (_RIGHTS.search(text) is not None) << 2
    return min(len(text).bit_length() - 1, LENGTHS - 1) << 3 | marks


def _parts(shape: int) -> list[int]:
    """Weights that a shape adds up."""
    return [shape >> 3, *(LENGTHS + k for k in range(3) if shape >> k & 1)]


def shape_costs(weights: list[float] | np.ndarray) -> list[float]:
    """Log-odds of each shape, at most MOST either way."""
    return [max(-MOST, min(MOST, sum(float(weights[k]) for k in _parts(shape)))) for shape in range(LENGTHS << 3)]


DEFAULT_COSTS = shape_costs(PRIOR)


def fit(counts: dict[int, tuple[int, int]], steps: int = 30) -> np.ndarray:
    """Weights from the numbers of pages with (furniture, content) of each shape, both classes at the weight of the rarer, WEIGH_AS at most: logistic regression by Newton's method with a ridge towards PRIOR."""
    prior = np.array(PRIOR)
    x = np.zeros((len(counts), len(prior)))
    for row, shape in zip(x, counts, strict=True):
        row[_parts(shape)] = 1
    n = np.array(list(counts.values()), float).reshape(-1, 2)
    if not n.sum(axis=0).all():
        return prior
    n *= min(WEIGH_AS, n.sum(axis=0).min()) / n.sum(axis=0)
    w = prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (n[:, 1] - n.sum(axis=1) * p) - RIDGE * (w - prior)
        bend = (x.T * (n.sum(axis=1) * p * (1 - p))) @ x + RIDGE * np.eye(len(w))
        w += np.clip(np.linalg.solve(bend, slope), -1, 1)
    return w


def cost_of(block: Block, costs: list[float] = DEFAULT_COSTS) -> float:
    """Log-odds of content of a block by itself."""
    return costs[shape_of(block.text)] + BY_TAG.get(block.node.tag, 0.0) + LINKS * min(1.0, block.links / len(block.text))


def tie_of(node: Node) -> float:
    """Weight of the edges from blocks of an element to the seeds around it: to the source if positive, else to the sink."""
    if node.away or node.names < 0:
        return min(IN_AWAY if node.away else 0.0, node.names)
    return (IN_ARTICLE if node.article else 0.0) + node.names


def _apart(a: Node, b: Node) -> int:
    """Steps between two elements in the DOM, borders of furniture among them."""
    steps = 0
    while a is not b:
        if a.depth < b.depth:
            a, b = b, a
        border = a.away > a.parent.away or a.names < 0 <= a.parent.names
        steps += 1 + BORDER * border
        a = a.parent
    return steps


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    out = []
    last: dict[int, int] = {}
    for k, x in enumerate(blocks):
        if k:
            out.append((k - 1, k, NEXT_EDGE / (1 + _apart(blocks[k - 1].node, x.node))))
        container = id(x.node if x.node.inner else x.node.parent or x.node)
        before = last.get(container)
        if before is not None and before != k - 1:
            out.append((before, k, SAME_EDGE / (1 + _apart(blocks[before].node, x.node))))
        last[container] = k
    return out


def _eliminate(z: list[float], near: list[dict[int, float]]) -> list[tuple[int, dict[int, float]]]:
    """Takes out nodes of up to two edges, each replaced by the equal network on its neighbours; nodes and their edges in order."""
    todo = [a for a in range(len(z)) if len(near[a]) <= 2]
    gone, done = [], [False] * len(z)
    while todo:
        a = todo.pop()
        if done[a] or len(near[a]) > 2:
            continue
        done[a] = True
        gone.append((a, near[a]))
        sides = list(near[a].items())
        for b, _ in sides:
            del near[b][a]
        if len(sides) == 1:
            (b, w), = sides
            z[b] += max(-w, min(w, z[a]))
        elif sides:
            (b, w), (c, v) = sides
            both, none = min(0.0, z[a] + w + v), min(w + v, z[a])  # cost of a, its neighbours both content, or neither
            left, right = min(v, z[a] + w), min(w, z[a] + v)  # b alone, c alone
            z[b] += (none - both + right - left) / 2
            z[c] += (none - both + left - right) / 2
            joined = (left + right - both - none) / 2
            if joined > 0:
                near[b][c] = near[c][b] = near[b].get(c, 0.0) + joined
        todo += [b for b, _ in sides if len(near[b]) <= 2]
    return gone


def minimum_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut."""
    n = len(costs)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        if a != b:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
    z, side = list(costs), [False] * n
    gone = _eliminate(z, near)
    rest = set(range(n)).difference(a for a, _ in gone)
    if rest:
        source, sink = n, n + 1
        flow: dict[int, dict[int, float]] = {a: dict(near[a]) for a in rest} | {source: {}, sink: {}}
        for a in rest:
            if z[a] > 0:
                flow[source][a], flow[a][source] = z[a], 0.0
            elif z[a] < 0:
                flow[a][sink], flow[sink][a] = -z[a], 0.0
        while True:  # shortest augmenting paths
            came, queue = {source: source}, deque([source])
            while queue and sink not in came:
                a = queue.popleft()
                for b, w in flow[a].items():
                    if w > 1e-12 and b not in came:
                        came[b] = a
                        queue.append(b)
            if sink not in came:
                break
            path, b = [], sink
            while b != source:
                path.append((came[b], b))
                b = came[b]
            most = min(flow[a][b] for a, b in path)
            for a, b in path:
                flow[a][b] -= most
                flow[b][a] = flow[b].get(a, 0.0) + most
        for a in rest:
            side[a] = a in came
    for a, sides in reversed(gone):
        side[a] = z[a] + sum(w if side[b] else -w for b, w in sides.items()) > 0
    return side


def main_text(html: str, costs: list[float] = DEFAULT_COSTS) -> str:
    blocks = blocks_of(html)
    kept = minimum_cut([cost_of(x, costs) + tie_of(x.node) for x in blocks], edges_of(blocks))
    return " ".join(x.text for x, keep in zip(blocks, kept, strict=True) if keep)


# --- the operator


def _taught(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of pages (shape, content, n) with blocks that their elements tell to be furniture or content."""
    seen: Counter[tuple[int, int]] = Counter()
    for batch in batches:
        for html in batch.column(0):
            seen.update({(shape_of(x.text), int(not x.node.away)) for x in blocks_of(html.as_py()) if (x.node.article or x.node.away) and x.node.names >= 0})
    rows = [(shape, content, n) for (shape, content), n in seen.items()]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["shape", "content", "n"])


def train(pages: DataFrame, *, sample: int = 2000, id_col: str = "page_id", html_col: str = "html") -> list[float]:
    """Costs of shapes, taught by the pages of at most `sample` ids, those with the smallest hashes."""
    drawn = pages.select(F.xxhash64(F.col(id_col).cast("long")).alias("x")).where(F.col(id_col).isNotNull()).orderBy("x").limit(sample).distinct()
    own = pages.where(F.col(id_col).isNotNull()).select(F.xxhash64(F.col(id_col).cast("long")).alias("x"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("h"))
    told = own.join(F.broadcast(drawn), "x", "left_semi").select("h").mapInArrow(_taught, "shape long, content long, n long")
    counts: dict[int, list[int]] = {}
    for shape, content, n in told.groupBy("shape", "content").agg(F.sum("n")).orderBy("shape", "content").collect():
        counts.setdefault(shape, [0, 0])[content] = n
    return shape_costs(fit({shape: tuple(n) for shape, n in counts.items()}))


def extract_main_text(pages: DataFrame, *, costs: list[float] | None = None, sample: int = 2000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, text, n_chars. costs: of shapes, as train makes them; fitted to the pages themselves if not given."""
    costs = costs or train(pages, sample=sample, id_col=id_col, html_col=html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                text = [main_text(x.as_py(), costs) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64())], ["i", "u", "text", "n_chars"])

    own = pages.select(F.col(id_col).cast("long").alias("i"), F.col(url_col).cast("string").alias("u"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("h"))
    return own.mapInArrow(run, "i long, u string, text string, n_chars long").withColumnsRenamed({"i": id_col, "u": url_col})
