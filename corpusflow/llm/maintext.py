"""HTML main-text extraction by a tree-structured graphical model.

A page becomes a tree: its block elements, and the stretches of text right inside them as leaves. Each node is content or not. What a
node looks like (element, names, words, links, punctuation, its place and share of the page) gives it a potential, and so does each pair of
parent and child, by the child's kind. Sum-product messages go up from the leaves and down from the root, which gives every node's exact chance
of being content, given the whole page; the leaves that are more likely content than not are the text. Messages of all pages of a batch
are passed together, one depth after another.

The potentials are trained from labelled pages, a page and its main text: gradient steps on the likelihood of all labels of a page together, in
one task over a bounded number of pages (TRAIN_PAGES, made up by `layouts` unless others are given).

Defined results: null and empty html give an empty text, as does a page without text; pages are judged one by one, so repeated rows and rows without an id are
extracted like others; markup that is never closed ends with the page; an empty table gives no rows.
"""

from __future__ import annotations

import difflib
import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import layouts
from .common import give_back, lean, table

#: Labelled pages that the model is trained on, and the steps, their rate and the prior's weight.
TRAIN_PAGES, STEPS, RATE, PRIOR = 1000, 200, 0.2, 0.00005
BITS = 13
#: Nodes of pages whose messages are passed together.
FOREST = 100_000

# Elements that HTML treats alike.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes template svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul li dt dd td th tr".split())
#: An element that ends an open one of these, unless one of the second kind lies between.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select", "datalist")), "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("table", "tr")), "th": (("td", "th"), ("table", "tr")), "tbody": (("tr", "td", "th", "thead", "tbody", "tfoot"), ("table",)),
    "thead": (("tr", "td", "th", "tbody", "tfoot"), ("table",)), "tfoot": (("tr", "td", "th", "thead", "tbody"), ("table",)), "body": (("head",), ()),
}
KINDS = {"#": 0, **dict.fromkeys(("h1", "h2", "h3", "h4", "h5", "h6"), 1), **dict.fromkeys(("p", "pre", "blockquote"), 2), **dict.fromkeys(("li", "ul", "ol", "dl", "dt", "dd", "td", "th", "tr", "table", "tbody"), 3), **dict.fromkeys(("article", "main"), 4), **dict.fromkeys(("nav", "aside", "footer", "header", "form", "button", "label", "select", "option", "dialog"), 5)}
N_KINDS = 7  # the last: any other

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)>""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PIECES = re.compile(r"[a-z]+|[A-Z][a-z]*")
_ENDS_RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_STOPS = re.compile(r"[.!?…。](?=[\s\"'”»)]|$)")
_MARKS = re.compile("©")


class Tree:
    """Nodes of pages: their parents (-1: a root), elements, names, texts and characters in links. Parents come first."""

    def __init__(self):
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.names: list[tuple] = []
        self.text: list[str | None] = []
        self.linked: list[int] = []
        self.depth: list[int] = []

    def add(self, parent: int, tag: str, names: tuple = (), text: str | None = None, linked: int = 0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.names.append(names)
        self.text.append(text)
        self.linked.append(linked)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        return len(self.parent) - 1


def _attributes(raw: str) -> tuple:
    """The words of an element's names, as said in its class, id and role."""
    found = [a or b or c for a, b, c in _NAMES.findall(raw)]
    return tuple(p.lower() for x in found for p in _PIECES.findall(x))


def parse(source: str, tree: Tree) -> None:
    """Add a page to the tree."""
    last = source.rfind(">") + 1  # a tag that is never closed goes with all behind it
    tail = re.search(r"<[a-zA-Z/!?]", source[last:])
    source = source[: last + tail.start()] if tail else source
    root = tree.add(-1, "html")
    stack: list[tuple[str, int]] = [("html", root)]  # open elements; inline ones have the node -1
    run: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                tree.add(next(n for _, n in reversed(stack) if n >= 0), "#", (), text, min(linked, len(text)))
            run.clear()
        linked = 0

    def close(tags: tuple, until: tuple = ()) -> None:
        """End the last open element of tags and all inside it."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in tags:
                if any(n >= 0 for _, n in stack[k:]):
                    flush()
                del stack[k:]
                return
            if stack[k][0] in until:
                return

    at = 0
    while m := _TOKEN.search(source, at):
        if m.start() > at:
            run.append(source[at : m.start()])
            if any(t == "a" for t, n in stack[-4:] if n < 0):
                linked += m.start() - at
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag = tag.lower()
        if m[1]:
            close((tag,))
            continue
        if tag in RAW and not m[3].endswith("/"):
            end = _ENDS_RAW[tag].search(source, at)
            at = end.start() if end else len(source)
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag in INLINE:
            if tag not in VOID:
                stack.append((tag, -1))
            continue
        flush()
        if tag in CLOSES_P:
            close(("p",), ("td", "th", "table", "button", "article", "section", "div", "li", "blockquote", "form", "body"))
        if tag in ENDS:
            first, until = ENDS[tag]
            for _ in first:
                close(first, until)
        if tag in ("html", "body") and any(t == tag for t, _ in stack):
            continue
        if tag not in VOID:
            stack.append((tag, tree.add(next(n for _, n in reversed(stack) if n >= 0), tag, _attributes(m[3]) if m[3] else ())))
    run.append(source[at:])
    flush()


# --- features --------------------------------------------------------------------------------

_index: dict[str, int] = {}


def _feature(name: str) -> int:
    got = _index.get(name)
    if got is None:
        if len(_index) > 200_000:
            _index.clear()
        got = _index[name] = xxhash.xxh64_intdigest(name.encode()) & ((1 << BITS) - 1)
    return got


def _bucket(x: np.ndarray, *bars: float) -> np.ndarray:
    return np.searchsorted(np.array(bars), x, side="left")


class Forest:
    """A tree without the nodes that hold no text, ready for messages: parents, depths, kinds and features."""

    def __init__(self, tree: Tree):
        parent, depth = np.array(tree.parent, np.int64), np.array(tree.depth, np.int64)
        chars = np.array([len(t) if t else 0 for t in tree.text], np.int64)
        own = np.stack((chars, np.array(tree.linked, np.int64), *(np.array([f(t) if t else 0 for t in tree.text], np.int64) for f in (lambda t: t.count(" ") + 1, lambda t: len(_STOPS.findall(t)), lambda t: 1))))
        total = own.copy()
        for d in range(int(depth.max(initial=0)), 0, -1):
            at = np.flatnonzero(depth == d)
            for k in range(len(total)):
                np.add.at(total[k], parent[at], total[k][at])
        live = np.flatnonzero(total[0] > 0)
        place = np.full(len(parent), -1)
        place[live] = np.arange(len(live))
        self.nodes = live
        self.parent = np.where(parent[live] >= 0, place[parent[live]], -1)
        self.depth = depth[live]
        self.text = [tree.text[i] for i in live.tolist()]
        self.levels = [np.flatnonzero(self.depth == d) for d in range(int(self.depth.max(initial=-1)) + 1)]
        tags = [tree.tag[i] for i in live.tolist()]
        self.kind = np.array([KINDS.get(t, N_KINDS - 1) for t in tags], np.int64)
        chars, linked, words, stops, leaves = (x[live].astype(float) for x in total)
        root = np.flatnonzero(self.parent < 0)
        page = np.searchsorted(root, np.arange(len(live)), side="right") - 1
        before = np.cumsum(own[0][live]) - own[0][live]  # parents come before what is in them
        before = (before - before[root][page]) / np.maximum(chars[root][page], 1)
        share = chars / np.maximum(chars[root][page], 1)
        w, l = _bucket(words, 1, 2, 4, 8, 16, 32, 64, 128, 512), _bucket(linked / chars, 0.01, 0.2, 0.5, 0.9)
        s = _bucket(stops / words, 0.001, 0.02, 0.05, 0.1, 0.2, 0.4)
        p, h, n = _bucket(before, 0.02, 0.1, 0.5, 0.9), _bucket(share, 0.01, 0.05, 0.2, 0.5, 0.9), _bucket(words / leaves, 2, 5, 10, 20, 40)
        rows, index = [], []
        for i, (node, t, *x) in enumerate(zip(live.tolist(), tags, *(v.tolist() for v in (w, l, s, p, h, n)))):
            names = tree.names[node]
            up = tags[self.parent[i]] if self.parent[i] >= 0 else ""
            f = ["", f"t:{t}", f"t:{t}:{up}", *[f"{k}:{t == '#'}:{v}" for k, v in zip("wlsphn", x)], f"wl:{t == '#'}:{x[0]}:{x[1]}", f"lh:{t == '#'}:{x[1]}:{x[4]}"]
            for name in names:
                f += (f"c:{name}", f"c3:{name[:3]}")
            if t == "#" and _MARKS.search(self.text[i]):
                f.append("mark")
            index += [_feature(v) for v in f]
            rows.append(len(f))
        self.row = np.repeat(np.arange(len(live)), np.array(rows, np.int64))
        self.index = np.array(index, np.int64)


# --- model -----------------------------------------------------------------------------------


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    """log of the sum of exponentials over an axis of two states."""
    a, b = np.moveaxis(x, axis, 0)
    return np.logaddexp(a, b)


class Model:
    """weights: of the features of nodes that are content; pairs[kind, parent, child]: of a parent's and a child's state, by the child's kind."""

    def __init__(self, weights: np.ndarray | None = None, pairs: np.ndarray | None = None):
        self.weights = np.zeros(1 << BITS) if weights is None else weights
        self.pairs = np.zeros((N_KINDS, 2, 2)) if pairs is None else pairs

    def messages(self, f: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What comes from below (the node's own potential in it), from the parent, and what the parent knows without the node; each by state, in logarithms."""
        up = np.zeros((len(f.parent), 2))
        up[:, 1] = np.bincount(f.row, self.weights[f.index], len(f.parent))
        sent = np.zeros_like(up)
        for at in reversed(f.levels[1:]):
            sent[at] = _lse(self.pairs[f.kind[at]] + up[at][:, None, :], 2)
            for y in (0, 1):
                np.add.at(up[:, y], f.parent[at], sent[at, y])
        down, around = np.zeros_like(up), np.zeros_like(up)
        for at in f.levels[1:]:
            over = f.parent[at]
            around[at] = up[over] + down[over] - sent[at]
            down[at] = _lse(self.pairs[f.kind[at]] + around[at][:, :, None], 1)
        return up, down, around

    def marginals(self, f: Forest) -> np.ndarray:
        """The chance of each node of being content."""
        up, down, _ = self.messages(f)
        x = (up + down)[:, 1] - (up + down)[:, 0]
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))

    def likelihood(self, f: Forest, label: np.ndarray) -> float:
        """The logarithm of the chance of all labels together."""
        up, _, _ = self.messages(f)
        score = (np.bincount(f.row, self.weights[f.index], len(f.parent)) * label).sum()
        inner = np.flatnonzero(f.parent >= 0)
        return score + self.pairs[f.kind[inner], label[f.parent[inner]], label[inner]].sum() - _lse(up[f.parent < 0], 1).sum()

    def gradient(self, f: Forest, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of likelihood(): what was seen less what is expected."""
        up, down, around = self.messages(f)
        chance = np.exp((up + down) - _lse(up + down, 1)[:, None])[:, 1]
        weights = np.bincount(f.index, (label - chance)[f.row], len(self.weights))
        inner = np.flatnonzero(f.parent >= 0)
        both = self.pairs[f.kind[inner]] + around[inner][:, :, None] + up[inner][:, None, :]
        both = np.exp(both - _lse(_lse(both, 2), 1)[:, None, None])
        pairs = np.zeros_like(self.pairs)
        np.add.at(pairs, (f.kind[inner], label[f.parent[inner]], label[inner]), 1.0)
        pairs -= np.stack([np.bincount(f.kind[inner], x, N_KINDS) for x in both.reshape(-1, 4).T], axis=1).reshape(pairs.shape)
        return weights, pairs

    def fit(self, f: Forest, label: np.ndarray, steps: int = STEPS) -> Model:
        """Adaptive steps on the likelihood of all labels, with a prior around 0."""
        first = [np.zeros_like(self.weights), np.zeros_like(self.pairs)]
        second = [np.zeros_like(self.weights), np.zeros_like(self.pairs)]
        size = max(1, int((f.parent < 0).sum()))
        used, f.index = np.unique(f.index, return_inverse=True)
        whole, self.weights = self.weights, self.weights[used]
        first[0], second[0] = first[0][used], second[0][used]
        for k in range(1, steps + 1):
            for j, (x, g) in enumerate(zip((self.weights, self.pairs), self.gradient(f, label))):
                g = g / size - PRIOR * x
                first[j] = 0.9 * first[j] + 0.1 * g
                second[j] = 0.99 * second[j] + 0.01 * g * g
                x += RATE * (first[j] / (1 - 0.9**k)) / (np.sqrt(second[j] / (1 - 0.99**k)) + 1e-6)
        whole[used] = self.weights
        self.weights, f.index = whole, used[f.index]
        return self


def labels(f: Forest, texts: list[str]) -> np.ndarray:
    """0 or 1 for each node, from the pages' main texts: leaves found among a text's blocks in order, and elements of whose text most is content."""
    out = np.zeros(len(f.parent), np.int64)
    root = np.flatnonzero(f.parent < 0)
    leaves = np.array([t is not None for t in f.text], bool)
    weight, good = np.zeros(len(f.parent)), np.zeros(len(f.parent))
    for page, (a, b) in enumerate(zip(root.tolist(), [*root.tolist()[1:], len(f.parent)])):
        own = np.flatnonzero(leaves[a:b]) + a
        weight[own] = [len(f.text[i]) for i in own.tolist()]
        found = difflib.SequenceMatcher(None, [f.text[i] for i in own.tolist()], texts[page].split("\n\n"), autojunk=False)
        for i, _, n in found.get_matching_blocks():
            good[own[i : i + n]] = weight[own[i : i + n]]
    for at in reversed(f.levels[1:]):
        np.add.at(weight, f.parent[at], weight[at])
        np.add.at(good, f.parent[at], good[at])
    out[good > weight / 2] = 1
    return out


def forest(pages: list[str]) -> Forest:
    tree = Tree()
    for source in pages:
        parse(source, tree)
    return Forest(tree)


def made_up(spark: SparkSession, n: int = TRAIN_PAGES) -> DataFrame:
    """(html, text): labelled pages of many layouts."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame([layouts.labelled(int(i)) for i in part["id"]], columns=["html", "text"])

    return spark.range(n).mapInPandas(run, "html string, text string")


def train(pages: DataFrame, limit: int = TRAIN_PAGES) -> Model:
    """The model of labelled pages (html, text: its blocks with an empty line between), at most `limit` of them, fitted in one task."""

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part[[len(forest([h]).nodes) > 0 for h in part["html"]]]
        f = forest(part["html"].tolist())
        model = Model().fit(f, labels(f, part["text"].tolist()))
        return pd.DataFrame({"weights": [model.weights.astype(np.float32).tobytes()], "pairs": [model.pairs.tobytes()]})

    some = pages.where("html is not null").select("html", F.coalesce("text", F.lit("")).alias("text")).orderBy(F.xxhash64("html"), "text").limit(limit)
    got = some.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fit, "weights binary, pairs binary").collect()  # one row
    if not got:
        return Model()
    return Model(np.frombuffer(got[0]["weights"], np.float32).astype(np.float64), np.frombuffer(got[0]["pairs"], np.float64).reshape(N_KINDS, 2, 2))


def main_texts(model: Model, pages: list[str | None]) -> list[str]:
    """The main text of each page."""
    out: list[list[str]] = [[] for _ in pages]
    tree, owner = Tree(), []

    def settle() -> None:
        f = Forest(tree)
        if len(f.nodes):
            chance = model.marginals(f)
            page = np.searchsorted(np.array([r for r, _ in owner]), f.nodes, side="right") - 1
            for i in np.flatnonzero(chance > 0.5).tolist():
                if f.text[i] is not None:
                    out[owner[page[i]][1]].append(f.text[i])

    for k, source in enumerate(pages):
        if source:
            owner.append((len(tree.parent), k))
            parse(source, tree)
            if len(tree.parent) >= FOREST:
                settle()
                tree, owner = Tree(), []
    if owner:
        settle()
    return ["\n\n".join(x) for x in out]


def extract(pages: DataFrame, model: Model | None = None, column: str = "html") -> DataFrame:
    """pages with the columns text and n_chars (its code points), after the others without those names; the model is the one of made-up pages unless another is given."""
    spark = pages.sparkSession
    sent = spark.sparkContext.broadcast(model or train(made_up(spark)))
    kept = [c for c in pages.columns if c not in ("text", "n_chars")]
    schema = pages.select(*[F.col(f"`{c}`") for c in kept], F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    at = pages.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, len(whole), 256):
                batch = whole.slice(i, 256)
                texts = main_texts(sent.value, batch.column(at).to_pylist())
                cols = [batch.column(pages_.index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*kept, "text", "n_chars"])
            give_back()

    pages_ = pages.columns
    return pages.mapInArrow(lean(run), schema)


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", "n_chars")
