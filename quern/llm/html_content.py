"""Main text of web pages, by boosted trees over DOM nodes and a decoding that respects the tree.

A page is parsed into nodes; each has features of its subtree (text, tags, links, their
density), its attribute tokens, its depth, its siblings and its parent. Gradient-boosted trees
give each node the log-odds that its text belongs to the page's main content. The
decoding then finds the best labelling of all nodes in which a node is content only if its
parent is, by dynamic programming from the leaves up: no content under boilerplate.

There are no labelled pages, so the trees learn from pages that mark their parts: what lies
in article or main is content, what lies in nav, footer, aside, header or a script isn't. The
names of those tags aren't features, so that pages without them can be read too. Where no page has such
marks, they learn from rules of text density instead. Fitting
takes a bounded sample of pages, drawn by a hash (parameters sample and longest); all pages are read whole.
"""

from __future__ import annotations

import html as entities
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import kernels as K

#: Pages to learn from, at most, and characters of such a page; trees, their depth, rate of learning, bins of a feature.
SAMPLE, LONGEST, TREES, DEPTH, RATE, BINS = 300, 200_000, 40, 3, 0.2, 32
_TOKEN_SLOTS = 16

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe".split())
_HIDDEN = frozenset("script style noscript template iframe head title svg".split())
_INLINE = frozenset("a abbr b bdi bdo cite code data dfn em i kbd mark q s samp small span strong sub sup time u var font".split())
_LANDMARK_GOOD = frozenset(["article", "main"])
_LANDMARK_BAD = frozenset("nav footer aside header script style noscript template iframe form".split())
#: A start tag closes an open element of its group first, unless a boundary lies in between.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}} | {t: {"p"} for t in "div section article main nav header footer aside ul ol dl table blockquote pre form h1 h2 h3 h4 h5 h6 hr figure".split()}
_BOUNDARY = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}, "p": {"div", "section", "article", "td", "li", "body", "blockquote"}}
_TAGS = ["p", "div", "span", "li", "ul", "a", "td", "table", "h1", "h2", "pre", "img", "b", "script", "body", "html"]
_TAG_PLACE = {t: i for i, t in enumerate(_TAGS)} | {"ol": 4, "dl": 4, "h3": 9, "h4": 9, "style": 13, "tr": 7, "strong": 12, "em": 12, "i": 12, "code": 10, "th": 6} | {t: 1 for t in "section article main nav header footer aside form".split()}


@dataclass
class Dom:
    """Nodes in document order: parent (-1 at the root), tag, attribute tokens; texts: node, line and words."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    tokens: list[tuple[str, ...]] = field(default_factory=list)
    texts: list[tuple[int, int, str]] = field(default_factory=list)


def parse(page: str) -> Dom:
    """Nodes and texts of a page, however broken: unclosed tags are closed by what contains them, stray end tags are skipped."""
    dom = Dom([-1], [""], [()], [])
    stack = [0]
    line = at = 0

    def say(text: str) -> None:
        if text and not text.isspace():
            dom.texts.append((stack[-1], line, entities.unescape(text) if "&" in text else text))
        elif text and dom.texts and dom.texts[-1][1] == line:
            dom.texts.append((stack[-1], line, " "))

    while m := _MARKUP.search(page, at):
        say(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                say(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if tag not in _INLINE:
            line += 1
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if dom.tag[stack[depth]] == tag:
                    del stack[depth:]
                    break
            continue
        closes = _CLOSES.get(tag)
        if closes:
            stop = _BOUNDARY.get(tag, _BOUNDARY["p"])
            for depth in range(len(stack) - 1, 0, -1):
                t = dom.tag[stack[depth]]
                if t in closes:
                    del stack[depth:]
                    break
                if t in stop:
                    break
        node = len(dom.tag)
        dom.parent.append(stack[-1])
        dom.tag.append(tag)
        dom.tokens.append(tuple(w.lower() for a in _ATTRIBUTE.finditer(m[3]) for w in re.split(r"[\W_]+", a[2] or a[3] or a[4] or "") if w) if m[3] else ())
        if tag in _VOID or m[3].endswith("/"):
            continue
        stack.append(node)
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.IGNORECASE).search(page, at)
            stop_at = end.start() if end else len(page)
            say(page[at:stop_at])
            at = end.end() if end else len(page)
            stack.pop()
    say(page[at:])
    return dom


def _sum_up(value: np.ndarray, parent: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Sums of values over subtrees."""
    total = value.astype(float).copy()
    for at in reversed(levels[1:]):
        np.add.at(total, parent[at], total[at])
    return total


def _levels(parent: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Depth of nodes, and the nodes of each depth. Roots have parent -1; parents come first."""
    depth = np.zeros(len(parent), np.int64)
    levels = [np.flatnonzero(parent < 0)]
    rest = np.flatnonzero(parent >= 0)
    d = 0
    is_last = parent < 0
    while len(rest):
        d += 1
        hit = is_last[parent[rest]]
        at, rest = rest[hit], rest[~hit]
        depth[at] = d
        is_last = np.zeros(len(parent), bool)
        is_last[at] = True
        levels.append(at)
    return depth, levels


@dataclass
class Forest:
    """Many pages' nodes in one array; base has where each page's begin."""

    doms: list[Dom]
    base: np.ndarray
    parent: np.ndarray
    depth: np.ndarray
    levels: list[np.ndarray]
    own: np.ndarray
    x: np.ndarray


def features(doms: list[Dom]) -> Forest:
    """Features of every node of pages."""
    sizes = np.array([len(d.tag) for d in doms], np.int64)
    base = np.concatenate([[0], np.cumsum(sizes)])
    n = int(base[-1])
    page = np.repeat(np.arange(len(doms)), sizes)
    parent = np.fromiter((p for d in doms for p in d.parent), np.int64, n)
    parent = np.where(parent >= 0, parent + base[page], -1)
    tags = [t for d in doms for t in d.tag]
    tag = np.array([_TAG_PLACE.get(t, len(_TAGS)) for t in tags], np.int64)
    hidden = np.array([t in _HIDDEN for t in tags], bool)
    depth, levels = _levels(parent)
    own, stops, first = np.zeros(n), np.zeros(n), np.full(n, np.inf)
    seen = np.zeros(len(doms))
    for i, d in enumerate(doms):
        for node, _, text in d.texts:
            j = base[i] + node
            own[j] += len(text)
            stops[j] += text.count(".") + text.count(",")
            seen[i] += len(text)
    shown = np.where(hidden, 0, own)
    inside_link = tag == _TAG_PLACE["a"]
    for at in levels[1:]:
        inside_link[at] |= inside_link[parent[at]]
        hidden[at] |= hidden[parent[at]]
    text = _sum_up(np.where(hidden, 0, own), parent, levels)
    links = _sum_up(np.where(inside_link & ~hidden, own, 0), parent, levels)
    nodes = _sum_up(np.ones(n), parent, levels)
    marks = _sum_up(np.where(hidden, 0, stops), parent, levels)
    up = np.where(parent >= 0, parent, np.arange(n))
    children = np.bincount(parent[parent >= 0], minlength=n).astype(float)
    order = np.lexsort((np.arange(n), up))
    place = np.empty(n)
    place[order] = np.arange(n) - np.searchsorted(up[order], up[order])
    alike = up * 64 + tag
    _, which, count = np.unique(alike, return_inverse=True, return_counts=True)
    whole = np.maximum(text[base[page]], 1)
    # Text before a node, as a share of the page's.
    before = np.cumsum(shown) - shown
    before = (before - before[base[page]]) / whole
    slots = np.zeros((n, _TOKEN_SLOTS))
    for i, d in enumerate(doms):
        for node, words in enumerate(d.tokens):
            for w in words:
                slots[base[i] + node, xxhash.xxh32_intdigest(w) % _TOKEN_SLOTS] = 1
    inherited = slots.copy()
    for at in levels[1:]:
        inherited[at] = np.maximum(inherited[at], inherited[parent[at]])
    one = [text, text / nodes, links / np.maximum(text, 1), nodes, own, marks / np.maximum(text, 1) * 100, text / whole, depth, children, place, place / np.maximum(children[up], 1), count[which], before, text[up] / nodes[up], links[up] / np.maximum(text[up], 1), text / np.maximum(text[up], 1), hidden]
    x = np.column_stack([*one, np.eye(len(_TAGS) + 1)[tag], np.eye(len(_TAGS) + 1)[tag[up]], inherited]).astype(np.float32) if n else np.zeros((0, len(one) + 2 * len(_TAGS) + 2 + _TOKEN_SLOTS), np.float32)
    return Forest(doms, base, parent, depth, levels, np.where(hidden, 0, own), x)


def marked(forest: Forest) -> tuple[np.ndarray, np.ndarray]:
    """What pages' own marks say of nodes: the share of a subtree's text that is content, and which nodes may serve as examples."""
    tags = [t for d in forest.doms for t in d.tag]
    good = np.array([t in _LANDMARK_GOOD for t in tags], bool)
    bad = np.array([t in _LANDMARK_BAD for t in tags], bool)
    for at in forest.levels[1:]:
        good[at] |= good[forest.parent[at]]
        bad[at] |= bad[forest.parent[at]]
    content = _sum_up(np.where(good & ~bad, forest.own, 0), forest.parent, forest.levels)
    text = _sum_up(forest.own, forest.parent, forest.levels)
    roots = forest.base[:-1]
    page = np.repeat(np.arange(len(forest.doms)), np.diff(forest.base))
    usable = (content[roots] > 0)[page]
    return np.where(text > 0, content / np.maximum(text, 1), (good & ~bad).astype(float)), usable


def dense(forest: Forest) -> tuple[np.ndarray, np.ndarray]:
    """What stands in for marks where no page has any: content is text outside links, in blocks of many characters a node that have sentence marks."""
    text = np.maximum(_sum_up(forest.own, forest.parent, forest.levels), 1)
    links, per_node, marks = forest.x[:, 2], forest.x[:, 1], forest.x[:, 5]
    good = (links < 0.3) & (per_node >= 20) & (marks > 0.5)
    content = _sum_up(np.where(good, forest.own, 0), forest.parent, forest.levels)
    return content / text, forest.own > 0


@dataclass
class Boosted:
    """Trees of one depth: for each inner node a feature and a threshold, for each leaf a value."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        row = np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(leaf)))):
                at = 2 * at + 1 + (x[row, f[at]] > t[at])
            out += leaf[at - len(f)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> Boosted:
    """Gradient-boosted trees for the logistic loss; splits are sought on quantile histograms."""
    inner = (1 << depth) - 1
    n, width = x.shape
    if not n:
        return Boosted(1.0, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, inner + 1)))
    edges = np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], axis=0).astype(np.float32)
    binned = np.column_stack([np.searchsorted(edges[:, j], x[:, j], "left") for j in range(width)])
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    score = np.full(n, np.log(mean / (1 - mean)))
    model = Boosted(float(score[0]), np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, inner + 1)))
    flat = binned + np.arange(width) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            for node in range((1 << level) - 1, (2 << level) - 1):
                rows = np.flatnonzero(at == node)
                if len(rows) >= 10:
                    cells = flat[rows].ravel()
                    gs = np.bincount(cells, np.repeat(g[rows], width), width * bins).reshape(width, bins).cumsum(1)
                    hs = np.bincount(cells, np.repeat(h[rows], width), width * bins).reshape(width, bins).cumsum(1)
                    G, H = gs[:, -1:], hs[:, -1:]
                    gain = (gs**2 / (hs + 1) + (G - gs) ** 2 / (H - hs + 1) - G**2 / (H + 1))[:, : bins - 1]
                    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
                    if gain[f, b] > 1e-6:
                        model.feature[t, node], model.threshold[t, node] = f, edges[b, f]
                f, limit = model.feature[t, node], model.threshold[t, node]
                at[rows] = 2 * node + 1 + (x[rows, f] > limit)
        leaf = at - inner
        model.leaf[t] = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        score += model.leaf[t][leaf]
    return model


def decode(score: np.ndarray, parent: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The labelling of best total score (a node's score if it is content, its negative if not) where content has only content above it."""
    drop = -_sum_up(score, parent, levels)
    keep = score.astype(float).copy()
    for at in reversed(levels[1:]):
        np.add.at(keep, parent[at], np.maximum(keep[at], drop[at]))
    chosen = keep > drop
    for at in levels[1:]:
        chosen[at] &= chosen[parent[at]]
    return chosen


def fit(pages: list[str], **settings: int) -> Boosted:
    """Trees learned from pages that mark their content."""
    forest = features([parse(p) for p in pages])
    share, usable = marked(forest)
    if not usable.any():
        share, usable = dense(forest)
    return boost(forest.x[usable], (share[usable] >= 0.5).astype(float), **settings)


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE, longest: int = LONGEST) -> Boosted:
    """Learn from sample pages at most, those of the least hashes among pages of up to longest characters that have an article or main tag.

    Where no page has such a tag, all pages of up to longest characters are candidates, and dense says what is content. Where none
    is so short, or there are no pages, nothing is learned, and extract takes every text outside hidden elements for
    content. A narrow count gives a threshold of the hash that leaves about three times the pages wanted, so few are ranked and sent.
    """
    h = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(11)), F.lit(1 << 40))
    rows = pages.where(F.length(html_col).between(1, longest)).select(F.col(html_col).alias("t"), h.alias("h"), F.col(html_col).rlike("(?i)<(article|main)[ >]").alias("marked"))
    counts = {r["marked"]: r["count"] for r in rows.groupBy("marked").count().collect()}
    of = True in counts
    n = counts.get(of, 0)
    if not n:
        return fit([])
    share = (1 << 40) if n <= 3 * sample else int((1 << 40) * 3 * sample / n)
    return fit([r[0] for r in rows.where((F.col("marked") == of) & (F.col("h") <= share)).orderBy("h", "t").limit(sample).select("t").collect()])


def contents(pages: list[str], model: Boosted) -> list[tuple[str, int, int]]:
    """Main text, nodes and content nodes of pages."""
    forest = features([parse(p) for p in pages])
    # A node's vote counts as its own text does, so that a page's text decides, not its tags.
    score = np.clip(model.log_odds(forest.x), -8, 8) * (0.1 + np.sqrt(forest.own))
    score[forest.base[:-1]] = 1e-3  # the page itself is nobody's boilerplate
    chosen = decode(score, forest.parent, forest.levels)
    out = []
    for i, d in enumerate(forest.doms):
        base = forest.base[i]
        mine = chosen[base : forest.base[i + 1]]
        lines: list[str] = []
        last = None
        for node, line, text in d.texts:
            if mine[node] and d.tag[node] not in _HIDDEN:
                if line != last:
                    lines.append("")
                    last = line
                lines[-1] += text
        tidy = (" ".join(x.split()) for x in lines)
        out.append(("\n".join(x for x in tidy if x), len(d.tag) - 1, int(mine[1:].sum())))
    return out


def extract(pages: DataFrame, model: Boosted, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row for each row of pages: id_col, content (lines of main text), nodes and content_nodes.

    A null page has null content and no nodes; an empty one, or one in which nothing counts as
    content, an empty text. Broken markup, plain text and very long pages are read whole. Rows
    are read each on its own, so ids may be null or repeat; an empty table gives an empty one;
    other columns are ignored. One scan, no shuffle; the trees go out with the tasks.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    sent = pages.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = pickle.loads(sent.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                texts = part.column(1).to_pylist()
                got = contents([t or "" for t in texts], trees)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([None if t is None else g[0] for t, g in zip(texts, got)], pa.string()), pa.array([g[1] for g in got], pa.int32()), pa.array([g[2] for g in got], pa.int32())], ["id", "content", "nodes", "content_nodes"])

    return pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("h")).mapInArrow(K.tidy(run), f"id {kind}, content string, nodes int, content_nodes int").withColumnRenamed("id", id_col)
