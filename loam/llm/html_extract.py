"""Main text of web pages: content marginals of a tree-structured graphical model over the DOM."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loam.llm.common import ready
from loam.llm.html_pages import LABELLED_PAGES

#: Elements without content (fixed values of the markup language).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements inside a line of text; all others end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Elements whose text is never shown as text; of all others (formulas, objects, text for browsers without scripts) the
#: marginals decide.
UNSEEN = frozenset("script style head title template".split())
#: Start tags that end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: Start tags that end an open element of the listed kinds, up to the nearest listed parent.
ENDS_ITEM = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select", "datalist")),
}

#: Elements that hold parts of a page.
CONTAINER = frozenset("div section article main aside header footer nav form center".split())

#: Where text has no element of its own: a run of it becomes a node, which is judged like any part of the page.
BARE = frozenset(("#root", "html", "body"))

PLACES = 1 << 11
KINDS = 5
#: Potentials kept for reuse at once.
MEMO = 1 << 16


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    names: list[str]
    mark: str | None = None
    own: int = 0
    links: int = 0
    total: int = 0
    unseen: bool = False
    runs: str | None = None


@dataclass
class Page:
    """Nodes in page order (parents first) and pieces of text: (node, text or None for a block's end)."""

    nodes: list[Node] = field(default_factory=list)
    pieces: list[tuple[int, str | None]] = field(default_factory=list)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page = Page([Node("#root", -1, [])])
        self.stack = [0]
        #: Depths of the open elements, by tag and of blocks, so that no tag walks the whole stack.
        self.at: dict[str, list[int]] = {}
        self.blocks = [0]

    def _push(self, i: int) -> None:
        tag, depth = self.page.nodes[i].tag, len(self.stack)
        self.stack.append(i)
        self.at.setdefault(tag, []).append(depth)
        if tag not in INLINE:
            self.blocks.append(depth)

    def _pop(self, depth: int) -> None:
        for i in self.stack[depth:]:
            tag = self.page.nodes[i].tag
            self.at[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()
                self.page.pieces.append((i, None))
        del self.stack[depth:]

    def _last(self, tags) -> int:
        """Depth of the innermost open element of the tags; 0 without one."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def _end_open(self, tags, until) -> None:
        while (depth := self._last(tags)) and depth > self._last(until):
            self._pop(depth)

    def _run(self) -> None:
        """Opens a node for text (with the inline elements in it) that stands right under the body."""
        up = self.page.nodes[self.stack[-1]]
        if up.tag in BARE:
            self.page.nodes.append(Node("#run", self.stack[-1], [], up.runs, unseen=up.unseen))
            self.page.pieces.append((len(self.page.nodes) - 1, None))
            self._push(len(self.page.nodes) - 1)

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_P:
            self._end_open(("p",), ENDS_P - {"p"})
        if tag in ENDS_ITEM:
            self._end_open(*ENDS_ITEM[tag])
        nodes = self.page.nodes
        if tag in INLINE:
            self._run()
        elif nodes[self.stack[-1]].tag == "#run" and tag not in VOID and tag not in UNSEEN:
            self._pop(len(self.stack) - 1)
        found = {k: v or "" for k, v in attrs}
        names = re.findall(r"[a-z]+", " ".join(found.get(k, "") for k in ("class", "id", "role")).lower()) if attrs else []
        up = self.stack[-1]
        node = Node(tag, up, names, found.get("data-main"), unseen=nodes[up].unseen or tag in UNSEEN, runs=found.get("data-runs"))
        nodes.append(node)
        if tag not in INLINE:
            self.page.pieces.append((len(nodes) - 1, None))
        if tag not in VOID:
            self._push(len(nodes) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        depth = self._last((tag,))
        # a stray end tag of an inline element doesn't close blocks
        if depth and (tag not in INLINE or depth > self.blocks[-1]):
            self._pop(depth)

    def handle_data(self, data):
        if data.strip():
            self._run()
        self.page.pieces.append((self.stack[-1], data))


def read_page(html: str) -> Page:
    """DOM of a page; markup that ends early, crosses or is never closed gives the tree as far as it goes."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    if builder.rawdata:
        builder.handle_data(builder.rawdata)
    page = builder.page
    for i, text in page.pieces:
        if text is None or page.nodes[i].unseen:
            continue
        page.nodes[i].own += len(text.strip())
    for i in range(len(page.nodes) - 1, -1, -1):
        node = page.nodes[i]
        node.total += node.own
        if node.tag == "a":
            node.links = node.total
        if i:
            up = page.nodes[node.parent]
            up.total += node.total
            up.links += node.links
    return page


@lru_cache(maxsize=1 << 16)
def _place(name: str) -> int:
    return crc32(name.encode()) % PLACES


def node_key(page: Page, i: int) -> tuple:
    """What is known about a node by itself: (edge kind, tag, length, names, share of links)."""
    n = page.nodes[i]
    linked = n.links / n.total if n.total else 0.0
    kind = edge_kind(page, i)
    # a part of the page speaks for itself; text inside a part follows it
    part = (n.tag, min(3, len(str(n.total)))) if kind in (1, 3, 4) else ("", 0)
    return kind, *part, tuple(n.names), round(4 * linked) if linked > 0.4 else 0


def node_features(key: tuple) -> list[int]:
    """Hash places of a node's features (:func:`node_key`)."""
    kind, tag, length, names, linked = key
    found = [f"linked {linked}"] if linked else []
    if kind == 4:
        found.append(f"run {length}")
    elif tag:
        found += [f"tag {tag}", f"length {length}"]
    found += [f"name {x}" for x in names]
    found += [f"part {x[:k]}" for x in names for k in (2, 4, 6) if len(x) > k]
    return sorted({_place(x) for x in found})


def edge_kind(page: Page, i: int) -> int:
    """Kind of the edge to a node from its parent: 0 inline, 1 a part of the page, 2 a block of text, 3 a container, 4 a run of bare text."""
    node = page.nodes[i]
    if node.tag == "#run":
        return 4
    if node.tag in INLINE or node.tag == "br":
        return 0
    if page.nodes[node.parent].tag in ("#root", "html", "body"):
        return 1
    return 3 if node.tag in CONTAINER else 2


@dataclass
class TreeModel:
    """Parent-child potentials from ``weights`` (features), ``start`` and ``follow`` (by edge kind); text evidence ``seen``."""

    weights: np.ndarray
    start: np.ndarray
    follow: np.ndarray
    seen: np.ndarray
    memo: dict = field(default_factory=dict)

    def potential(self, page: Page, i: int) -> np.ndarray:
        """Log probabilities of node ``i``'s label (columns) given its parent's (rows)."""
        key = node_key(page, i)
        if key not in self.memo:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            z = self.weights[node_features(key)].sum() + self.start[key[0]] + self.follow[key[0]] * np.arange(2)
            self.memo[key] = -np.logaddexp(0, np.outer(z, [1, -1]))
        return self.memo[key]

    def evidence(self, page: Page, i: int) -> np.ndarray:
        """Log likelihood of what node ``i``'s own text looks like, by label."""
        return self.seen[:, text_look(page, i)] if page.nodes[i].own else np.zeros(2)


def text_look(page: Page, i: int) -> int:
    """Own text inside a link or not, short, middling or long."""
    node = page.nodes[i]
    return 3 * (node.tag == "a") + min(2, node.own // 25)


def _labels(page: Page) -> np.ndarray:
    out = np.zeros(len(page.nodes), dtype=np.int64)
    for i, n in enumerate(page.nodes):
        out[i] = int(n.mark) if n.mark is not None else (out[n.parent] if i else 0)
    return out


def learn(pages: list[str] = LABELLED_PAGES, steps: int = 25, penalty: float = 0.05, trust: float = 0.25) -> TreeModel:
    """Potentials by logistic regression of a label on features and the parent's label, text evidence by counting.

    Texts of one part look alike, so their evidence counts only ``trust`` each.
    """
    rows, kinds, ups, labels, seen = [], [], [], [], np.ones((2, 6))
    for html in pages:
        page = read_page(html)
        y = _labels(page)
        for i, node in enumerate(page.nodes):
            if not i or node.unseen or not node.total:
                continue
            rows.append(node_features(node_key(page, i)))
            kinds.append(edge_kind(page, i))
            ups.append(y[node.parent])
            labels.append(y[i])
            if node.own:
                seen[y[i], text_look(page, i)] += 1
    places = sorted({p for r in rows for p in r})
    column = {p: c for c, p in enumerate(places)}
    n, k = len(places), np.array(kinds)
    x = np.zeros((len(rows), n + 2 * KINDS))
    for r, found in enumerate(rows):
        x[r, [column[p] for p in found]] = 1
    x[np.arange(len(rows)), n + k] = 1
    x[np.arange(len(rows)), n + KINDS + k] = ups
    y, w = np.array(labels, dtype=float), np.zeros(x.shape[1])
    for _ in range(steps):  # Newton with a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        w -= np.linalg.solve(hessian, x.T @ (p - y) + penalty * w)
    weights = np.zeros(PLACES)
    weights[places] = w[:n]
    return TreeModel(weights, w[n : n + KINDS], w[n + KINDS :], trust * np.log(seen / seen.sum(axis=1, keepdims=True)))


def marginals(page: Page, model: TreeModel) -> np.ndarray:
    """Probability that each node is content, by sum-product messages up and down the tree."""
    n = len(page.nodes)
    belief, pair, to_parent = np.zeros((n, 2)), [np.zeros((2, 2))] * n, np.zeros((n, 2))
    belief[0, 1] = -50.0
    for i in range(1, n):
        node = page.nodes[i]
        if node.unseen:
            belief[i, 1] = -50.0
        elif node.total:
            pair[i] = model.potential(page, i)
            belief[i] = model.evidence(page, i)
    for i in range(n - 1, 0, -1):  # upward
        to_parent[i] = np.logaddexp(*(pair[i] + belief[i]).T)
        belief[page.nodes[i].parent] += to_parent[i]
    for i in range(1, n):  # downward
        other = belief[page.nodes[i].parent] - to_parent[i]
        message = np.logaddexp(*(pair[i] + other[:, None]))
        belief[i] += message - message.max()
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -50, 50)))


def main_text(html: str, model: TreeModel, threshold: float = 0.5) -> str:
    """Text of the content nodes: blocks in page order, white space inside a block as one space."""
    page = read_page(html)
    content = marginals(page, model) >= threshold
    blocks, block = [], []
    for i, text in page.pieces:
        if text is None:
            blocks.append("".join(block))
            block = []
        elif content[i] and not page.nodes[i].unseen:
            block.append(text)
    blocks.append("".join(block))
    return " ".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def _extract(model: TreeModel, threshold: float):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h or "", model, threshold) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page", "url", "text", "n_chars"],
            )

    return extract


def extract_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    labelled: list[str] | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """Main text of every page: ``id_col, url_col, text, n_chars``, one row per input row.

    Each page is parsed into its DOM; a node's label (content or not) depends
    on its own features and, through parent-child potentials, on its parent's
    and children's labels.  Messages up and down the tree give each node's
    marginal; text of nodes of at least ``threshold`` stays.  The model is
    learnt from the labelled pages (``data-main`` marks, see
    :mod:`loam.llm.html_pages`) on the driver: a small fixed table.

    Rows are independent, so there is no shuffle; a page is read whole.

    Edge cases: a null html counts as empty and gives an empty text; markup
    that is cut off gives the text up to there; a run of text right under the
    body, or of a page without any markup, is a node of its own; text outside
    any content node, scripts, styles and comments give nothing; repeated rows repeat; an empty
    table gives an empty result; other columns are ignored.
    """
    ready(pages.sparkSession)
    model = learn(labelled if labelled is not None else LABELLED_PAGES)
    kinds = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}
    return (
        pages.select(pages[id_col].alias("page"), pages[url_col].alias("url"), pages[html_col].alias("html"))
        .mapInArrow(_extract(model, threshold), f"page {kinds[id_col]}, url {kinds[url_col]}, text string, n_chars long")
        .withColumnsRenamed({"page": id_col, "url": url_col})
    )
