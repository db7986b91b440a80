"""HTML extraction with a tree-structured graphical model.

Block elements of a page are the nodes of its tree; each is content or not. A node has a
potential from its own features (tag, words of class, id and role, amount of text, share of
links) and one with its parent. Messages go from the leaves up and from the root down
(sum-product), for all pages of a batch together, level by level, and give every node its
marginal. The text of nodes that are content by more than one half is the article.

Learning takes a sample of about TRAIN_PAGES pages, chosen by a hash: nodes of pages with
an article (or main) landmark are labelled by it and by what names itself a menu, an advert
and so on inside it. The node weights are fitted around prior weights, which alone decide
where no page is labelled; the parent potentials are smoothed counts. The model is small
and of fixed size.

Defined cases: a NULL or empty page, and one without content, has the empty text; markup
that is not closed or not opened is read as browsers do for blocks; repeated rows and
extra columns are kept as they are.
"""

from __future__ import annotations

import gc
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.common import text_slices

TRAIN_PAGES = 2_000
FEATURES = 4096
_SMOOTHING = 1.0

# Elements of HTML by how they take part in the layout.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "object", "select", "button")
VOID = {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
CLOSES = {  # an opening tag ends an open one of these, up to the nearest of its holders
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
# Names that tell what a part of a page is.
LANDMARKS = {"article", "main"}
ASIDE_TAGS = {"nav", "header", "footer", "aside", "form", "dialog", "menu", "head"}
ASIDE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "cookie",
    "cookies", "disqus", "footer", "header", "masthead", "menu", "nav", "navbar", "navigation", "newsletter", "notice",
    "pagination", "popup", "promo", "promotion", "related", "reply", "replies", "share", "sharing", "sidebar", "social",
    "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
CONTENT_NAMES = {"article", "content", "entry", "main", "post", "story", "body"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?/][^>]*>", re.S | re.I)
_NAMES = re.compile(r"\b(class|id|role|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")


@dataclass
class Page:
    """Nodes in page order, and the runs of text with the node each stands in."""

    tags: list[str] = field(default_factory=list)
    names: list[frozenset[str]] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    depths: list[int] = field(default_factory=list)
    link_chars: list[int] = field(default_factory=list)
    texts: list[tuple[int, str]] = field(default_factory=list)


def parse(source: str) -> Page:
    page = Page()
    stack: list[int] = []
    held: list[str] = []
    links = 0

    def open_node(tag: str, names: frozenset[str]) -> None:
        page.tags.append(tag)
        page.names.append(names)
        page.parents.append(stack[-1] if stack else -1)
        page.depths.append(len(stack))
        page.link_chars.append(0)
        stack.append(len(page.tags) - 1)

    def flush() -> None:
        if held:
            text = _SPACE.sub(" ", entities.unescape("".join(held))).strip()
            if text:
                page.texts.append((stack[-1], text))
            held.clear()

    def close(wanted: set[str], until: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            tag = page.tags[stack[depth]]
            if tag in until:
                return
            if tag in wanted:
                del stack[depth:]
                return

    open_node("#page", frozenset())
    at = 0
    for match in _TOKEN.finditer(source):
        if match.start() > at:
            held.append(source[at:match.start()])
            if links:
                page.link_chars[stack[-1]] += match.start() - at
        at = match.end()
        tag = match["tag"]
        if not tag:
            continue  # a comment, a declaration, or an element whose text is never shown
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                links = 0 if match["close"] else 1
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                held.append(" ")
            continue
        flush()
        links = 0
        if match["close"]:
            close({tag}, set())
            continue
        if tag != "p" and tag in CLOSES:
            close(*CLOSES[tag])
        else:
            close({"p"}, {"td", "th", "li", "div", "article", "section", "blockquote", "button", "form"})
        attrs = match["attrs"]
        names = frozenset(part.lower() for m in _NAMES.finditer(attrs) for part in _SPLIT.split(m[2]) if part) if attrs else frozenset()
        if not attrs.endswith("/"):
            open_node(tag, names)
    if at < len(source):
        held.append(source[at:])
    flush()
    return page


def _slot(name: str) -> int:
    import zlib

    return zlib.crc32(name.encode()) % FEATURES


_slots: dict[str, int] = {}


def node_features(page: Page) -> list[list[int]]:
    own = [0] * len(page.tags)
    for node, text in page.texts:
        own[node] += len(text)
    out = []
    for node, tag in enumerate(page.tags):
        chars = own[node]
        keys = ["bias", f"tag={tag}", f"size={min(8, chars.bit_length() // 2) if chars else 'none'}",
                f"links={min(4, 5 * page.link_chars[node] // chars) if chars else 'none'}"]
        keys += [f"name={name}" for name in page.names[node]]
        slots = []
        for key in keys:
            slot = _slots.get(key)
            if slot is None:
                slot = _slot(key)
                if len(_slots) < 100_000:
                    _slots[key] = slot
            slots.append(slot)
        out.append(slots)
    return out


def labels(page: Page) -> list[int] | None:
    """1 for nodes in a landmark and in nothing aside; None for a page without a landmark."""
    if not LANDMARKS & set(page.tags) and not any("main" in names for names in page.names):
        return None
    inside, aside = [False] * len(page.tags), [False] * len(page.tags)
    for node, (tag, names, parent) in enumerate(zip(page.tags, page.names, page.parents)):
        inside[node] = tag in LANDMARKS or "main" in names or (parent >= 0 and inside[parent])
        aside[node] = tag in ASIDE_TAGS or bool(names & ASIDE_NAMES) or (parent >= 0 and aside[parent])
    return [int(a and not b) for a, b in zip(inside, aside)]


@dataclass(frozen=True)
class TreeModel:
    weights: np.ndarray  # log odds of content by feature
    pairs: np.ndarray  # log potential by label of the parent and of the child
    root: np.ndarray


def prior() -> TreeModel:
    weights = np.zeros(FEATURES)
    for tag in ASIDE_TAGS:
        weights[_slot(f"tag={tag}")] -= 8
    for name in ASIDE_NAMES:
        weights[_slot(f"name={name}")] -= 8
    for tag in LANDMARKS:
        weights[_slot(f"tag={tag}")] += 4
    for name in CONTENT_NAMES:
        weights[_slot(f"name={name}")] += 2
    weights[_slot("tag=p")] += 1
    weights[_slot("links=4")] -= 2
    return TreeModel(weights, np.log(np.array([[0.8, 0.2], [0.1, 0.9]])), np.log(np.array([0.9, 0.1])))


def learn(pages: DataFrame, html: str = "html", rows: int = TRAIN_PAGES) -> TreeModel:
    """Fit the potentials on the labelled pages of the sample."""
    model = prior()
    total = pages.count()
    share = min(1.0, rows / total) if total else 1.0
    # The sample goes by the page itself, so equal pages are in it together or not at all.
    sample = pages.select(F.col(html).alias("html")).where(
        F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple, int] = {}
            for source in batch.column("html").to_pylist():
                page = parse(source or "")
                marked = labels(page)
                if marked is not None:
                    for node, slots in enumerate(node_features(page)):
                        parent = page.parents[node]
                        key = tuple(sorted(set(slots))), marked[parent] if parent >= 0 else -1, marked[node]
                        found[key] = found.get(key, 0) + 1
            yield pa.RecordBatch.from_arrays([
                pa.array([list(k[0]) for k in found], pa.list_(pa.int32())), pa.array([k[1] for k in found], pa.int32()),
                pa.array([k[2] for k in found], pa.int32()), pa.array(list(found.values()), pa.int64())],
                ["slots", "above", "label", "n"])

    # Nodes of at most about `rows` pages, equal ones counted.
    table = sample.mapInArrow(run, "slots array<int>, above int, label int, n bigint").groupBy(
        "slots", "above", "label").agg(F.sum("n").alias("n")).toArrow()
    if not table.num_rows:
        return model
    slots = table["slots"].to_pylist()
    above, label, n = (table[name].to_numpy().astype(np.int64) for name in ("above", "label", "n"))
    pairs = np.full((2, 2), _SMOOTHING)
    inner = above >= 0
    np.add.at(pairs, (above[inner], label[inner]), n[inner])
    pairs = np.log(pairs / pairs.sum(1, keepdims=True))
    root = np.full(2, _SMOOTHING)
    np.add.at(root, label[~inner], n[~inner])
    # Logistic regression of a node given its parent, whose potential is fixed.
    lengths = np.fromiter(map(len, slots), np.int64, len(slots))
    flat, owner = np.fromiter((s for row in slots for s in row), np.int64, int(lengths.sum())), np.repeat(np.arange(len(slots)), lengths)
    offset = np.where(inner, pairs[np.maximum(above, 0), 1] - pairs[np.maximum(above, 0), 0], np.log(root[1] / root[0]))
    weights, squares = model.weights.copy(), np.full(FEATURES, 1e-6)
    for _ in range(300):
        score = offset + np.bincount(owner, weights[flat], len(slots))
        error = n * (label - 1 / (1 + np.exp(-np.clip(score, -30, 30))))
        gradient = np.bincount(flat, error[owner], FEATURES) - 0.1 * (weights - model.weights)
        squares += gradient ** 2
        weights += 0.5 * gradient / np.sqrt(squares)
    return TreeModel(weights, pairs, np.log(root / root.sum()))


def marginals(pages: list[Page], model: TreeModel) -> list[np.ndarray]:
    """P(content) of every node of every page."""
    sizes = [len(page.tags) for page in pages]
    starts = np.concatenate(([0], np.cumsum(sizes)))
    slots = [sorted(set(s)) for page in pages for s in node_features(page)]
    lengths = np.fromiter(map(len, slots), np.int64, len(slots))
    flat = np.fromiter((s for row in slots for s in row), np.int64, int(lengths.sum()))
    total = len(slots)
    score = np.bincount(np.repeat(np.arange(total), lengths), model.weights[flat], total)
    depth = np.fromiter((d for page in pages for d in page.depths), np.int64, total)
    parent = np.fromiter((p + start if p >= 0 else -1 for page, start in zip(pages, starts) for p in page.parents), np.int64, total)
    own = np.stack((np.zeros(total), score), axis=1)
    own[depth == 0] += model.root
    below = own.copy()  # own potential and all messages from below
    up = np.zeros((total, 2))
    levels = [np.flatnonzero(depth == d) for d in range(int(depth.max()) + 1)]
    for nodes in reversed(levels[1:]):
        up[nodes] = np.logaddexp(model.pairs[:, 0] + below[nodes, :1], model.pairs[:, 1] + below[nodes, 1:])
        np.add.at(below, parent[nodes], up[nodes])
    belief = below.copy()
    for nodes in levels[1:]:
        above = belief[parent[nodes]] - up[nodes]  # what the parent knows without this child
        above -= above.max(1, keepdims=True)
        belief[nodes] += np.logaddexp(above[:, :1] + model.pairs[0], above[:, 1:] + model.pairs[1])
    sure = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -50, 50)))
    return [sure[a:b] for a, b in zip(starts, starts[1:])]


def extract(pages: DataFrame, model: TreeModel, html: str = "html", to: str = "text") -> DataFrame:
    """Add the main text of every page; `html` is dropped."""
    kept = pages.drop(to)
    schema = T.StructType([*kept.drop(html).schema.fields, T.StructField(to, T.StringType())])
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        for whole in batches:
            for batch in text_slices(whole, 8_000_000, html):
                parsed = [parse(source or "") for source in batch.column(html).to_pylist()]
                texts = ["\n\n".join(text for node, text in page.texts if sure[node] > 0.5)
                         for page, sure in zip(parsed, marginals(parsed, shared.value))]
                others = [i for i, name in enumerate(batch.schema.names) if name != html]
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in others), pa.array(texts, pa.string())], schema.names)

    return kept.mapInArrow(run, schema)


def op8_html_extraction(pages: DataFrame) -> DataFrame:
    pages = pages.select("page_id", "url", "html")
    return extract(pages, learn(pages)).withColumn("n_chars", F.length("text").cast("bigint"))
