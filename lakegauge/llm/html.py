"""Main text of pages by sum-product inference on the DOM tree.

Every block element and every run of text is a node with two states, content
or not. A node's own potential comes from logistic weights on its features
(tag, text length, links, punctuation, place, being inside an article's mark or
below a tag or class word of something else); the potential between parent and
child from how often their states go together. Messages go up from the leaves
and down from the root, which gives the exact marginal of each node; runs of
text with a marginal of at least one half make the result. All weights are
learned, those of marks and class words too: a long text below a word such as
``share`` inside an article may still be content.

Pages that mark their article (``article``, ``main``) are the labelled pages:
inside is content, outside or below a tag or word of something else is not. A
third of them is learned from as it is, a third without the article's marks and
a third without any of these hints, so that pages without them are read as
well; half of them with other parts and comments inside the article, too. The sample is bounded: ``sample_pages`` different pages, those with the
smallest hashes, and ``NODES_PER_PAGE`` nodes of each.

Null and empty pages give an empty text. Rows with equal ``page_id`` are pages
of their own.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.llm.common import arrow_schema, groups, lean, per_row, texts_of

# Elements that never have text of the page.
HIDDEN = {
    "head", "script", "style", "noscript", "template", "iframe", "object", "title",
    "canvas", "select", "textarea", "annotation", "annotation-xml",
}
# Elements whose parts stand in one line.
FORMULAS = {"math", "svg"}
# Elements without an end.
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "param", "source", "track", "wbr",
}
# Elements within a line of text.
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del",
    "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby",
    "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
    "u", "var", "br", "wbr", "img",
}
# Elements that end an open paragraph, and items that end their like.
ENDS_PARAGRAPH = {
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}
ENDS_LIKE = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SCOPES = {"ul", "ol", "dl", "table", "td", "th", "div", "section", "article", "body"}
# Elements and class words that hint at something else than the article.
OTHER_TAGS = {"nav", "footer", "aside", "form", "button", "dialog", "menu"}
OTHER_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "breadcrumb", "breadcrumbs",
    "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "pagination", "popup",
    "promo", "promoted", "replies", "reply", "sidebar", "sponsored",
}
# Words that articles use of their own parts as well.
LOOSE_WORDS = {
    "banner", "copyright", "header", "notice", "related", "share", "sharing", "signup",
    "social", "sponsor", "subscribe", "toolbar", "widget",
}
ARTICLE_TAGS = {"article", "main"}
_TAGS = ("article", "main", "section", "div", "p", "h1", "h2", "li", "td", "body")
_SPLIT = re.compile(r"[^a-z]+")


@dataclass
class Node:
    parent: int
    tag: str  # "#text" for a run of text
    words: frozenset[str]  # of class, id and role
    depth: int
    text: str = ""
    linked: int = 0  # characters inside links


class _Tree(HTMLParser):
    """Block elements and runs of text, parents before children."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes = [Node(-1, "#root", frozenset(), 0)]
        # Tags with their block, and whether they began it.
        self.open: list[tuple[str, int, bool]] = [("#root", 0, True)]
        self.hidden = 0
        self.formulas = 0
        self.links = 0
        self.run: list[str] = []
        self.linked = 0

    def _flush(self) -> None:
        text = " ".join("".join(self.run).split())
        if text:
            block = self.open[-1][1]
            depth = self.nodes[block].depth + 1
            node = Node(block, "#text", frozenset(), depth, text, self.linked)
            self.nodes.append(node)
        self.run, self.linked = [], 0

    def _close(self, at: int) -> None:
        for tag, _, _ in self.open[at:]:
            self.hidden -= tag in HIDDEN
            self.formulas -= tag in FORMULAS
            self.links -= tag == "a"
        if any(began for _, _, began in self.open[at:]):
            self._flush()
        del self.open[at:]

    def _close_open(self, tags: set[str], scopes: set[str]) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.open[at][0]
            if tag in tags:
                self._close(at)
                return
            if tag in scopes:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body" or tag not in HIDDEN and self.open[-1][0] == "head":
            self._close_open({"head"}, set())
        if tag in ENDS_PARAGRAPH:
            self._close_open({"p"}, SCOPES)
        if tag in ENDS_LIKE:
            self._close_open(ENDS_LIKE[tag], SCOPES - ENDS_LIKE[tag])
        if tag in ("br", "hr", "wbr"):
            self.run.append(" ")
        if tag in VOID:
            return
        block = self.open[-1][1]
        self.formulas += tag in FORMULAS
        begins = tag not in INLINE and not self.formulas
        if begins:
            self._flush()
            named = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role"))
            words = frozenset(_SPLIT.split(named.lower())) - {""}
            self.nodes.append(Node(block, tag, words, self.nodes[block].depth + 1))
            block = len(self.nodes) - 1
        self.open.append((tag, block, begins))
        self.hidden += tag in HIDDEN
        self.links += tag == "a"

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == tag:
                self._close(at)
                return

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.run.append(data)
            if self.links:
                self.linked += len(data.strip())


def parse(html: str | None) -> list[Node]:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    tree._flush()
    return tree.nodes


def _is_other(node: Node) -> bool:
    words = node.words
    return node.tag in OTHER_TAGS or bool(words & OTHER_WORDS or words & LOOSE_WORDS)


def _below(nodes: list[Node], start) -> list[bool]:
    """Whether a node or one above it satisfies ``start``."""
    found: list[bool] = []
    for node in nodes:
        above = node.parent >= 0 and found[node.parent]
        found.append(above or start(node))
    return found


def other_flags(nodes: list[Node]) -> list[bool]:
    """Nodes marked as not the article; a page header counts outside of it."""
    inside = _below(nodes, lambda n: n.tag in ARTICLE_TAGS)
    flags: list[bool] = []
    for node, within in zip(nodes, inside):
        above = node.parent >= 0 and flags[node.parent]
        flags.append(above or _is_other(node) or node.tag == "header" and not within)
    return flags


SHOWN, NO_MARKS, NO_HINTS = 0, 1, 2  # what the features of a page may see
_FIGURES = 14


def features(nodes: list[Node], hide: int = SHOWN) -> np.ndarray:
    """A row per node; ``hide`` says which of the page's hints count."""
    n = len(nodes)
    chars, linked, runs, marks, words = (np.zeros(n) for _ in range(5))
    for k, node in enumerate(nodes):
        chars[k], linked[k], runs[k] = len(node.text), node.linked, bool(node.text)
        marks[k] = sum(map(node.text.count, ".,!?;:"))
        words[k] = node.text.count(" ") + bool(node.text)
    before = np.cumsum(chars) - chars
    for k in range(n - 1, 0, -1):
        for column in (chars, linked, runs, marks, words):
            column[nodes[k].parent] += column[k]
    whole = max(1.0, chars[0])
    rows = np.zeros((n, _FIGURES + len(_TAGS)))
    for k, node in enumerate(nodes):
        size = max(1.0, chars[k])
        rows[k, :10] = (
            1.0,
            math.log1p(chars[k]) / 5,
            linked[k] / size,
            10 * marks[k] / size,
            size / max(1.0, words[k]) / 10,
            math.log1p(runs[k]),
            chars[k] / whole,
            before[k] / whole,
            min(node.depth, 10) / 10,
            float(node.tag == "#text"),
        )
        if not (hide and node.tag in ARTICLE_TAGS) and node.tag in _TAGS:
            rows[k, _FIGURES + _TAGS.index(node.tag)] = 1.0
    if hide < NO_MARKS:
        rows[:, 10] = _below(nodes, lambda node: node.tag in ARTICLE_TAGS)
    if hide < NO_HINTS:
        rows[:, 11] = _below(nodes, lambda node: node.tag in OTHER_TAGS)
        rows[:, 12] = _below(nodes, lambda node: bool(node.words & OTHER_WORDS))
        rows[:, 13] = _below(nodes, lambda node: bool(node.words & LOOSE_WORDS))
    return rows


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of the features, for content against not
    together: np.ndarray  # log potential by parent's and child's state


def labels(nodes: list[Node]) -> list[bool] | None:
    """Content flags of a page that marks its article, else None."""
    inside = _below(nodes, lambda n: n.tag in ARTICLE_TAGS)
    if not any(inside):
        return None
    return [i and not o for i, o in zip(inside, other_flags(nodes))]


# Nodes of a page that are learned from.
NODES_PER_PAGE = 300


# Characters of a run of text that is no label or button.
_LONG_TEXT = 80


def _with_more_inside(
    nodes: list[Node], own: list[bool], seed: int
) -> tuple[list[Node], list[bool]]:
    """A labelled page with more at the end of its article, as other pages have
    it: its parts that are something else; readers' comments, for which its own
    paragraphs stand; and long paragraphs below a loose word, which stay
    content."""
    article = next(k for k, node in enumerate(nodes) if node.tag in ARTICLE_TAGS)
    made, flags, place = list(nodes), list(own), {}

    def add(node: Node, parent: int, content: bool) -> int:
        made.append(replace(node, parent=parent, depth=made[parent].depth + 1))
        flags.append(content)
        return len(made) - 1

    for k, other in enumerate(other_flags(nodes)):
        if other and nodes[k].tag != "header":
            place[k] = add(nodes[k], place.get(nodes[k].parent, article), False)
    texts = [n for n, content in zip(nodes, own) if content and len(n.text) > _LONG_TEXT]
    for words, content in ((OTHER_WORDS, False), (LOOSE_WORDS, True)):
        word = sorted(words)[seed % len(words)]
        part = Node(0, "div", frozenset([word]), 0)
        below = add(part, article, content)
        for text in texts[-3:]:
            add(text, add(Node(0, "p", frozenset(), 0), below, content), content)
    return made, flags


def training_rows(html: str | None) -> tuple[list[float], list[float]]:
    """Of a labelled page: features and label of nodes, in a row, and how often
    the states of parents and children go together. Else nothing."""
    nodes = parse(html)
    own = labels(nodes)
    if own is None:
        return [], []
    seed = zlib.crc32((html or "").encode())
    if seed // 3 % 2:
        nodes, own = _with_more_inside(nodes, own, seed)
    pairs = np.zeros((2, 2))
    for node, label in zip(nodes[1:], own[1:]):
        pairs[int(own[node.parent]), int(label)] += 1
    rows = np.column_stack([features(nodes, hide=seed % 3), own])
    if len(rows) > NODES_PER_PAGE:
        chosen = np.random.default_rng(seed).permutation(len(rows))[:NODES_PER_PAGE]
        rows = rows[np.sort(chosen)]
    return rows.ravel().tolist(), pairs.ravel().tolist()


def learn(parts: list[tuple[list[float], list[float]]]) -> Model:
    """The model from the training rows of pages."""
    width = _FIGURES + len(_TAGS)
    parts = [part for part in parts if part[0]]
    if not parts:  # nothing to learn from: all but what hints at something else
        weights = np.zeros(width)
        weights[0], weights[10:14] = 1.0, (2.0, -4.0, -4.0, -2.0)
        return Model(weights, np.zeros((2, 2)))
    pairs = 1 + sum(np.array(pairs).reshape(2, 2) for _, pairs in parts)
    together = np.maximum(np.log(pairs / pairs.sum(axis=1, keepdims=True)), -4.0)
    rows = np.concatenate([np.array(flat).reshape(-1, width + 1) for flat, _ in parts])
    x, y = rows[:, :-1], rows[:, -1]
    weights = np.zeros(width)
    ridge = 1e-4 * len(y) * np.eye(width)
    for _ in range(25):  # Newton steps of logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge
        weights += np.linalg.solve(hessian, x.T @ (y - p) - ridge @ weights)
    return Model(weights, together)


def fit_pages(pages: list[str]) -> Model:
    return learn([training_rows(html) for html in sorted(pages)])


def _add(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def marginals(nodes: list[Node], model: Model) -> list[float]:
    """Probability of content of each node, by messages up and down."""
    odds = features(nodes) @ model.weights
    # Belief of (not, content) from the node itself and what is below it.
    up = [[0.0, float(v)] for v in odds]
    (nn, nc), (cn, cc) = model.together.tolist()
    message = [(0.0, 0.0)] * len(nodes)  # from a node to its parent
    for k in range(len(nodes) - 1, 0, -1):
        no, yes = up[k]
        sent = _add(nn + no, nc + yes), _add(cn + no, cc + yes)
        message[k] = sent
        above = up[nodes[k].parent]
        above[0] += sent[0]
        above[1] += sent[1]
    full = [(up[0][0], up[0][1])]  # belief with what comes from above
    for k in range(1, len(nodes)):
        parent = full[nodes[k].parent]
        no, yes = parent[0] - message[k][0], parent[1] - message[k][1]
        full.append((up[k][0] + _add(no + nn, yes + cn), up[k][1] + _add(no + nc, yes + cc)))
    return [1 / (1 + math.exp(min(700.0, no - yes))) for no, yes in full]


def extract(html: str | None, model: Model) -> str:
    nodes = parse(html)
    content = marginals(nodes, model)
    return "\n".join(n.text for n, p in zip(nodes, content) if n.text and p >= 0.5)


def fit(pages: DataFrame, sample_pages: int = 600) -> Model:
    """Model from the pages that mark an article among ``sample_pages`` different
    ones. Pages stay in Spark: the driver gets their training rows, about 25
    numbers a node."""
    marked = pages.where("lower(html) RLIKE '<(article|main)'").selectExpr(
        "html", "xxhash64(html) AS hash"
    )
    least = marked.select("hash").distinct().orderBy("hash").limit(sample_pages)
    chosen = marked.join(F.broadcast(least), "hash")
    found = per_row(
        chosen.groupBy("hash").agg(F.first("html").alias("text")).selectExpr(
            "hash AS doc_id", "text"
        ),
        "flat array<double>, pairs array<double>",
        lambda: training_rows,
    ).orderBy("doc_id")
    return learn([(row["flat"], row["pairs"]) for row in found.toLocalIterator()])


def main_text(pages: DataFrame, model: Model) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    schema = "page_id bigint, url string, text string, n_chars bigint"

    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for group in groups(texts_of(batch.column("html"))):
                texts = [extract(html, shared.value) for html in group]
                part = batch.slice(done, len(group))
                done += len(group)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array(map(len, texts), pa.int64()),
                    ],
                    schema=arrow_schema(schema),
                )

    columns = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return columns.mapInArrow(work, schema)
