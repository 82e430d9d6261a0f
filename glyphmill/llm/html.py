"""Main text of HTML pages by a tree-structured graphical model.

A page becomes a tree of its block elements, with a leaf for each run of text between block borders. Every node is
content or not; its own evidence is a sum of learned weights (tag, words of class, id and role, length, share of link
text), and parent-child potentials connect the nodes. Sum-product messages pass upward from the leaves and downward
from the root, for all pages of a slice at once, depth by depth; leaves with a content marginal of one half or more
are the text. Weights and potentials are those of a conditional random field on trees, trained by gradient ascent on
labelled pages (html_samples), whose expectations come from the same messages.

Scripts, styles, titles, form fields, templates and HTML comments never become leaves. Only script, style, title and
textarea are raw text up to their end tag; the other HIDDEN elements are read as elements and their text is left out.
One without an end tag of its own ends with its parent or at the next block border; '/>' ends it at once. Character
references are decoded, white space inside a block is one space, blocks are joined by two line feeds.

Defined cases: null and empty pages and pages without content have empty text; broken pages (unclosed tags, a cut in
the middle of a tag) are read as far as they go; repeated rows get equal texts; extra columns are ignored.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, trimmed
from .html_samples import pages as sample_pages

TRAIN_PAGES, SEED, STEPS = 500, 17, 80
HASH_BITS = 14

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea)(?![^\s/>])(?:(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+(?:>|\Z)|[^>]*+(?:>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attr>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|</?[a-zA-Z!?][^>]*+(?:>|\Z)|<\Z",
    re.S | re.I,
)
_RAW_END = {k: re.compile(rf"</{k}(?![^\s/>])[^>]*+(?:>|\Z)", re.I) for k in ("script", "style", "title", "textarea")}
_ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+")
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset(["hr"])
HIDDEN = frozenset("button canvas iframe noscript object select svg template".split())
#: Elements other than blocks that have no end tag.
EMPTY = frozenset("area base br col embed img input link meta param source track wbr".split())
#: A start tag ends an open element of these, up to the given outer ones.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}


class Tree:
    """Nodes of one page: parent (-1: none), depth, hashed features; leaves with their text."""

    def __init__(self):
        self.parent, self.depth, self.features, self.leaf, self.text = [], [], [], [], []

    def add(self, parent: int, features: list[str], text: str | None = None) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.features.append(features)
        self.leaf.append(text is not None)
        self.text.append(text)
        return len(self.parent) - 1


def _tags(page: str) -> tuple[list[tuple], set[int]]:
    """(start, end, name or None, whether an end tag, attributes) of all markup in order, and which start tags of HIDDEN
    elements have an end tag. Raw text belongs to its start tag."""
    tags, open_, closed, at = [], {}, set(), 0
    while m := _TOKEN.search(page, at):
        at = m.end()
        if m["raw"]:
            raw = m["raw"].lower()
            if not (open_.get("svg") and m[0].endswith("/>")):  # in SVG alone these can be empty
                end = _RAW_END[raw].search(page, at)
                at = end.end() if end else len(page)
            tags.append((m.start(), at, None, False, ""))
            continue
        tag, attr = m["tag"] and m["tag"].lower(), m["attr"] or ""
        if tag in HIDDEN:
            if m["end"]:
                if open_.get(tag):
                    closed.add(open_[tag].pop())
            elif not attr.endswith("/"):
                open_.setdefault(tag, []).append(len(tags))
        tags.append((m.start(), at, tag, bool(m["end"]), attr))
    return tags, closed


def parse(page: str, at_offset: list[int] | None = None) -> Tree:
    """The tree; at_offset gets, for each node, its place in the page (for labelling)."""
    tree = Tree()
    root = tree.add(-1, ["tag:root"])
    stack, run, links, in_link, where = [(root, "root")], [], 0, False, 0
    if at_offset is not None:
        at_offset.append(0)

    def flush():
        nonlocal run, links, in_link
        text = " ".join("".join(run).split())
        if text:
            n, share = len(text), links / max(1, sum(map(len, run)))
            tree.add(stack[-1][0], [f"in:{stack[-1][1]}", f"length:{min(8, n.bit_length())}", f"links:{int(share * 3.99)}", "stop" if text[-1] in ".!?…。" else "open"], text)
            if at_offset is not None:
                at_offset.append(where)
        run, links, in_link = [], 0, False

    # Open elements that are no nodes, and of them the hidden ones: place, whether it has an end tag.
    held, count, hidden = [], {}, []

    def hold(tag: str):
        held.append(tag)
        count[tag] = count.get(tag, 0) + 1

    def leave(k: int):
        for x in held[k:]:
            count[x] -= 1
        del held[k:]
        while hidden and hidden[-1][0] >= k:
            hidden.pop()

    def end_held(tag: str):
        k = len(held) - 1
        while held[k] != tag:
            k -= 1
        leave(k)

    # Where each name stands in the stack, so that no tag walks through it.
    places: dict[str, list[int]] = {}

    def cut(k: int):
        for _, x in stack[k:]:
            places[x].pop()
        del stack[k:]

    def innermost(names) -> int:
        return max((places[x][-1] for x in names if places.get(x)), default=0)

    last = 0
    tags, closed = _tags(page)
    for number, (start, end, tag, ends, attr) in enumerate(tags):
        if start > last and not hidden:
            text = html.unescape(page[last:start])
            if not run:
                where = last
            run.append(text)
            if in_link:
                links += len(text)
        last = end
        if tag is None:
            continue
        if tag in BLOCKS:
            while hidden and not hidden[-1][1]:
                leave(hidden[-1][0])
            if hidden:
                if not ends:
                    if tag not in VOID:
                        hold(tag)
                    continue
                if count.get(tag):
                    end_held(tag)
                    continue
                if not places.get(tag):
                    continue
                leave(hidden[0][0])
        else:
            if ends:
                if count.get(tag):
                    end_held(tag)
            elif tag in HIDDEN:
                if not attr.endswith("/"):
                    hold(tag)
                    hidden.append((len(held) - 1, number in closed))
            elif tag not in EMPTY:
                hold(tag)
            if hidden:
                continue
        if tag == "a":
            in_link = not ends
        elif tag == "br":
            run.append(" ")
        elif tag in BLOCKS:
            flush()
            if ends:
                if places.get(tag):
                    cut(places[tag][-1])
                continue
            if stack[-1][1] == "p":
                cut(len(stack) - 1)
            if tag in ENDS:
                same, outer = ENDS[tag]
                if (k := innermost(same)) > innermost(x for x in outer if x not in same):
                    cut(k)
            if tag in VOID:
                continue
            features = [f"tag:{tag}"]
            if attr:
                for a in _ATTR.finditer(attr):
                    features += [f"name:{w}" for w in _PART.findall((a[1] or a[2] or a[3] or "").lower())]
            if len(features) == 1:
                features.append(f"plain:{tag}")
            node = tree.add(stack[-1][0], features)
            if at_offset is not None:
                at_offset.append(start)
            places.setdefault(tag, []).append(len(stack))
            stack.append((node, tag))
    if last < len(page) and not hidden:
        if not run:
            where = last
        run.append(html.unescape(page[last:]))
    flush()
    return tree


_SLOT: dict[str, int] = {}


def _slot(feature: str) -> int:
    if feature not in _SLOT:
        import zlib

        if len(_SLOT) > 100_000:
            _SLOT.clear()
        _SLOT[feature] = zlib.crc32(feature.encode()) & ((1 << HASH_BITS) - 1)
    return _SLOT[feature]


class Forest:
    """The trees of many pages as arrays; messages pass over all of them at once."""

    def __init__(self, trees: list[Tree]):
        sizes = np.array([len(t.parent) for t in trees])
        base = np.cumsum(sizes) - sizes
        self.page = np.repeat(np.arange(len(trees)), sizes)
        parent = np.concatenate([np.array(t.parent) for t in trees])
        self.parent = np.where(parent < 0, -1, parent + base[self.page])
        depth = np.concatenate([np.array(t.depth) for t in trees])
        self.levels = [np.flatnonzero(depth == d) for d in range(int(depth.max()) + 1)]
        self.leaf = np.concatenate([np.array(t.leaf, bool) for t in trees])
        features = [f for t in trees for f in t.features]
        self.owner = np.repeat(np.arange(len(features)), [len(f) for f in features])
        self.slot = np.array([_slot(x) for f in features for x in f])

    def evidence(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=weights[self.slot], minlength=len(self.parent))

    def messages(self, weights: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log odds of content of each node; of its parent without it; of itself without its parent. pair[kind, y_parent, y_child]."""
        below = self.evidence(weights)  # evidence and all children's messages
        up, down, other = np.zeros(len(below)), np.zeros(len(below)), np.zeros(len(below))
        kind = self.leaf.astype(int)
        t = pair[kind]
        for level in self.levels[:0:-1]:
            b = below[level]
            up[level] = np.logaddexp(t[level, 1, 0], t[level, 1, 1] + b) - np.logaddexp(t[level, 0, 0], t[level, 0, 1] + b)
            np.add.at(below, self.parent[level], up[level])
        for level in self.levels[1:]:
            p = self.parent[level]
            o = other[level] = below[p] + down[p] - up[level]
            down[level] = np.logaddexp(t[level, 0, 1], t[level, 1, 1] + o) - np.logaddexp(t[level, 0, 0], t[level, 1, 0] + o)
        return below + down, other, below


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def labelled(pieces: list[tuple[str, int]]) -> tuple[Tree, np.ndarray]:
    """A page's tree, and a label for each node: of its piece; an element around pieces is content if all its text is."""
    starts, page = [], '<html><head><title>t</title></head><body>'
    for piece, _ in pieces:
        starts.append(len(page))
        page += piece
    page += "</body></html>"
    at: list[int] = []
    tree = parse(page, at)
    own = np.searchsorted(starts, at, "right") - 1
    y = np.array([pieces[k][1] if k >= 0 else 0 for k in own])
    leaves, good = np.zeros(len(y)), np.zeros(len(y))
    for i in range(len(y) - 1, -1, -1):
        if tree.leaf[i]:
            leaves[i], good[i] = 1, y[i]
        if (p := tree.parent[i]) >= 0:
            leaves[p] += leaves[i]
            good[p] += good[i]
    inner = ~np.array(tree.leaf, bool)
    y[inner] = (leaves[inner] > 0) & (2 * good[inner] > leaves[inner]) & (np.array(tree.depth)[inner] > 2)
    return tree, y


def train(pages: list[list[tuple[str, int]]]) -> tuple[np.ndarray, np.ndarray]:
    """(weights, pair) of maximal conditional likelihood, by AdaGrad with a small penalty."""
    made = [labelled(p) for p in pages]
    forest, y = Forest([t for t, _ in made]), np.concatenate([y for _, y in made])
    w, pair = np.zeros(1 << HASH_BITS), np.zeros((2, 2, 2))
    g2, p2 = np.full(w.shape, 1e-2), np.full(pair.shape, 1e-1)
    child = np.flatnonzero(forest.parent >= 0)
    kind, yp, yc = forest.leaf[child].astype(int), y[forest.parent[child]], y[child]
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (kind, yp, yc), 1)
    for _ in range(STEPS):
        odds, other, below = forest.messages(w, pair)
        grad = np.bincount(forest.slot, weights=(y - _sigmoid(odds))[forest.owner], minlength=len(w)) - 0.05 * w
        g2 += grad**2
        w += 0.5 * grad / np.sqrt(g2)
        joint = pair[kind] + other[child][:, None, None] * np.array([[0], [1]]) + below[child][:, None, None] * np.array([[0, 1]])
        joint = np.exp(joint - joint.max((1, 2), keepdims=True))
        joint /= joint.sum((1, 2), keepdims=True)
        expected = np.zeros((2, 2, 2))
        np.add.at(expected, kind, joint)
        grad = seen - expected - 0.05 * pair
        p2 += grad**2
        pair += 0.3 * grad / np.sqrt(p2)
    return w, pair


def texts_of(pages: list[str | None], model: tuple[np.ndarray, np.ndarray]) -> list[str]:
    trees = [parse(p or "") for p in pages]
    forest = Forest(trees)
    content = forest.messages(*model)[0] >= 0
    out, at = [], 0
    for t in trees:
        out.append("\n\n".join(x for x, c in zip(t.text, content[at : at + len(t.text)]) if c and x is not None))
        at += len(t.text)
    return out


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(train(sample_pages(TRAIN_PAGES, SEED)))  # 130 KB

    def run(batches):
        for batch in batches:
            for part in slices(batch, 2, 1 << 20):
                texts = texts_of(part.column(2).to_pylist(), sent.value)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(trimmed(run), "page_id bigint, url string, text string, n_chars bigint")
