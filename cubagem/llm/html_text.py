"""Main text of web pages: a recurrent labeller of their blocks."""

from __future__ import annotations

import html
import pickle
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Training: at most so many pages, none larger than this, and at most so many consecutive blocks of each.
SAMPLE_PAGES, SAMPLE_CHARS, WINDOW = 256, 1 << 18, 96
#: Units per direction; hashed tokens of paths and of words.
HIDDEN, PATH_DIM, WORD_DIM = 16, 256, 128
EPOCHS, BATCH, RATE = 6, 32, 0.01
#: Markup that a task parses and labels at a time, and entries it remembers.
SLICE_CHARS, REMEMBERED = 4 << 20, 500_000

EXTRACTED = "page_id bigint, url string, text string, n_chars bigint, n_blocks bigint, n_kept bigint"

#: Elements that do not end a block (fixed by HTML).
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Elements without content, elements whose content is no text, and elements whose text holds no tags (fixed by HTML).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style template iframe noembed noframes".split())
PLAIN = frozenset("title textarea".split())
#: Open elements that a new one ends, as far as the list or table that both are in (fixed by HTML).
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "option": ("option",)}
SCOPES = frozenset("ul ol dl menu table select body".split())
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+|[0-9]+")


class Block(NamedTuple):
    #: Each element around the block, from the outside: its name, then words of its class, id and role.
    path: tuple[tuple[str, ...], ...]
    text: str
    #: Share of characters in links.
    linked: float


class _Elements(dict):
    """Name and words of a start tag; begins anew when full."""

    def __missing__(self, key: tuple[str, str]) -> tuple[str, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        name, attributes = key
        words = [w for m in _NAMES.finditer(attributes) for w in _WORD.findall((m[2] or m[3] or m[4] or "").lower())]
        if _HIDDEN.search(attributes):
            words.append("hidden")
        found = self[key] = (name, *dict.fromkeys(words))
        return found


_elements = _Elements()


def blocks_of(page: str) -> list[Block]:
    """Blocks of text of a page in order; a tag, comment or script that never ends takes the rest of the page."""
    blocks: list[Block] = []
    stack: list[tuple[str, ...]] = []
    parts: list[str] = []
    links = in_link = 0

    def end_block() -> None:
        nonlocal links, in_link
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(tuple(stack), text, min(links / max(sum(map(len, parts)), 1), 1.0)))
            parts.clear()
        links = in_link = 0

    def add(raw: str) -> None:
        nonlocal links
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        links += len(text) * in_link

    at, n = 0, len(page)
    while at < n:
        tag = _TAG.search(page, at)
        if tag is None:
            add(page[at:])
            break
        if tag.start() > at:
            add(page[at : tag.start()])
        at = tag.end()
        close, name, attributes = tag.group(1, 2, 3) if tag[2] else tag.group(4, 5, 6)
        if not name or page[at - 1] != ">":
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
        elif name in INLINE:
            if name == "a":
                in_link = 0 if close else 1
        elif close:
            end_block()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
        else:
            end_block()
            if stack and stack[-1][0] == "p":
                stack.pop()
            for depth in range(len(stack) - 1, -1, -1) if name in ENDS else ():
                if stack[depth][0] in SCOPES:
                    break
                if stack[depth][0] in ENDS[name]:
                    del stack[depth:]
                    break
            if name in VOID:
                continue
            if name in UNREAD or name in PLAIN:
                rest = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(page, at)
                if name in PLAIN:
                    stack.append(_elements[name, attributes])
                    add(page[at : rest.start() if rest else n])
                    end_block()
                    stack.pop()
                if rest is None:
                    break
                at = page.find(">", rest.end()) + 1 or n
                continue
            stack.append(_elements[name, attributes])
    end_block()
    return blocks


# Labels for training: what markup says of itself.

#: Names of elements, and words of classes, ids and roles, that say what a part of a page is.
MAIN_PARTS = frozenset("article main articlebody story entry post content".split())
OTHER_PARTS = frozenset(
    "nav navbar navigation menu header masthead footer aside sidebar form button select textarea label dialog head title "
    "noscript svg hidden ad ads advert advertisement sponsored sponsor promo banner cookie cookies consent notice notices "
    "popup newsletter subscribe breadcrumb breadcrumbs related recommended share social comment comments reply replies "
    "disqus widget search login copyright pagination".split()
)


def labels_of(blocks: list[Block]) -> list[int]:
    """1 main text, 0 anything else, -1 not known; the innermost part that says what it is decides.

    Where no part says that it is the main text, longer blocks outside links and other parts are taken for it.
    """
    known = [_part(b.path) for b in blocks]
    if 1 in known:
        return [0 if k == -1 and b.linked > 0.5 else k for k, b in zip(known, blocks, strict=True)]
    return [
        1 if k == -1 and b.linked < 0.3 and b.text.count(" ") >= 8 else k for k, b in zip(known, blocks, strict=True)
    ]


def _part(path: tuple[tuple[str, ...], ...]) -> int:
    for k in range(len(path) - 1, -1, -1):
        words = path[k]
        if not OTHER_PARTS.isdisjoint(words):
            # The heading of an article may stand in a header of its own.
            inner = words[0] == "header" and any(not MAIN_PARTS.isdisjoint(outer) for outer in path[:k])
            if not inner:
                return 0
            return -1
        if not MAIN_PARTS.isdisjoint(words):
            return 1
    return -1


# Other markup for the same parts, so that the model does not depend on one way of writing them.
_WRITTEN = {
    "article": ["main", "div post", "div entry content", "section story", "div", "td", "div body text"],
    "nav": ["div menu", "div top nav", "ul navigation", "div"],
    "footer": ["div footer", "div bottom", "div copyright", "div"],
    "ad": ["div ads", "aside promo", "div sponsored box", "section advert", "div banner"],
}
_ADDED = [
    ("header masthead", ["div", "h2", "p"], "before"),
    ("aside sidebar", ["li", "p", "h3"], "around"),
    ("div cookie notice", ["p", "div"], "before"),
    ("div notice", ["p"], "around"),
    ("form search", ["label", "button", "p"], "around"),
    ("div newsletter subscribe", ["h3", "p", "label"], "after"),
    ("section comments", ["p", "div comment", "li comment"], "after"),
    ("div reader comments", ["p", "h3", "blockquote"], "inside"),
    ("div related", ["li", "h3", "p"], "after"),
]


def rewritten(blocks: list[Block], labels: list[int], words: np.ndarray, rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """The page with other markup for its parts, and with parts added that other pages have.

    Added parts say words of any page, so that words alone don't tell them from the main text.
    """
    chosen = {name: tuple(rng.choice(ways).split()) for name, ways in _WRITTEN.items()}
    out = []
    for block in blocks:
        path = tuple(next((chosen[w] for w in element if w in chosen), element) for element in block.path)
        out.append((Block(path, block.text, block.linked), labels[len(out)]))
    outer = blocks[0].path[:2] if blocks else ()
    for k in rng.choice(len(_ADDED), size=int(rng.integers(0, 5)), replace=False):
        part, inner, where = _ADDED[k]
        main = [i for i, (_, label) in enumerate(out) if label == 1]
        around = (*outer, chosen["article"], tuple(part.split())) if where == "inside" else (*outer, tuple(part.split()))
        added = []
        for _ in range(int(rng.integers(1, 7))):
            own = " ".join(words[rng.integers(0, len(words), int(rng.choice([2, 5, 12, 40])))])
            added.append((Block((*around, tuple(rng.choice(inner).split())), own, float(rng.choice([0, 0, 1]))), 0))
        first, last = (main[0], main[-1] + 1) if main else (0, len(out))
        at = {"before": 0, "after": last, "inside": last, "around": int(rng.choice([first, last]))}[where]
        out[at:at] = added
    return [b for b, _ in out], [label for _, label in out]


# Features of blocks.


class _Buckets(dict):
    """Hashed tokens; begins anew when full."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, token: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[token] = zlib.crc32(token.encode("utf-8", "surrogatepass")) % self.size
        return found


class _Paths(dict):
    """Buckets of a path: its tokens, and the innermost elements once more; begins anew when full."""

    def __missing__(self, path: tuple) -> list[int]:
        if len(self) >= REMEMBERED // 10:
            self.clear()
        tokens = {t for element in path for t in (element[0], *(f".{w}" for w in element[1:]))}
        inner = [f"{k}<{e[0]}" for k, e in enumerate(path[:-3:-1])]
        found = self[path] = sorted({_path_bucket(t) for t in (*tokens, *inner)})
        return found


_words, _paths = _Buckets(WORD_DIM), _Paths()
DIM = PATH_DIM + WORD_DIM + 6


def _path_bucket(token: str) -> int:
    return zlib.crc32(f"path {token}".encode("utf-8", "surrogatepass")) % PATH_DIM


def features_of(blocks: list[Block]) -> np.ndarray:
    """A row per block: tokens of its path, its hashed words by their share, and figures of its text."""
    out = np.zeros((len(blocks), DIM), np.float32)
    for row, block in zip(out, blocks, strict=True):
        row[_paths[block.path]] = 1
        words = block.text.split(" ")
        n = len(words)
        row[PATH_DIM : PATH_DIM + WORD_DIM] = np.bincount(list(map(_words.__getitem__, words)), minlength=WORD_DIM) / n
        row[-6:] = np.log1p(n) / 5, block.linked, block.text[-1] in ".!?:;…", n < 4, len(block.path) / 10, 1
    return out


# The model: a long short-term memory in each direction, and one output per block.


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Probability of each block of a page to be main text, given all blocks of the page."""

    def __init__(self, seed: int = 1, dim: int = DIM, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.weights: dict[str, np.ndarray] = {}
        for way in "fb":
            self.weights[f"x{way}"] = rng.normal(0, 0.2, (dim, 4 * hidden)).astype(np.float32)
            self.weights[f"h{way}"] = rng.normal(0, 0.2, (hidden, 4 * hidden)).astype(np.float32)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden : 2 * hidden] = 1  # remember at first
            self.weights[f"c{way}"] = bias
        self.weights["out"] = rng.normal(0, 0.2, 2 * hidden + 1).astype(np.float32)

    def _step(self, way: str, z: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple:
        n = self.hidden
        z = z + h @ self.weights[f"h{way}"]
        i, f, o = _sigmoid(z[:, :n]), _sigmoid(z[:, n : 2 * n]), _sigmoid(z[:, 2 * n : 3 * n])
        g = np.tanh(z[:, 3 * n :])
        c_new = f * c + i * g
        t = np.tanh(c_new)
        return i, f, o, g, c_new, t, o * t

    def states(self, x: np.ndarray, lengths: np.ndarray, kept: list | None = None) -> np.ndarray:
        """States of both directions of all blocks; pages lie one after the other, longest first.

        Shorter pages end earlier, so step t has the pages that are longer than t. ``kept`` takes what gradients need.
        """
        begins = np.cumsum(lengths) - lengths
        out = np.zeros((len(x), 2 * self.hidden), np.float32)
        for k, way in enumerate("fb"):
            z = x @ self.weights[f"x{way}"] + self.weights[f"c{way}"]
            h = c = np.zeros((len(lengths), self.hidden), np.float32)
            for t in range(int(lengths[0]) if len(lengths) else 0):
                n = int(np.searchsorted(-lengths, -t, "left"))
                at = begins[:n] + (t if way == "f" else lengths[:n] - 1 - t)
                step = self._step(way, z[at], h[:n], c[:n])
                if kept is not None:
                    kept.append((way, at, h[:n], c[:n], step))
                c, h = step[4], step[6]
                out[at, k * self.hidden : (k + 1) * self.hidden] = h
        return out

    def probabilities(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of blocks of pages of any order of length."""
        order = np.argsort(-lengths, kind="stable")
        begins = np.cumsum(lengths) - lengths
        sorted_lengths = lengths[order]
        inside = np.arange(len(x)) - np.repeat(np.cumsum(sorted_lengths) - sorted_lengths, sorted_lengths)
        rows = np.repeat(begins[order], sorted_lengths) + inside
        states = self.states(x[rows], sorted_lengths)
        out = np.empty(len(x), np.float32)
        out[rows] = _sigmoid(states @ self.weights["out"][:-1] + self.weights["out"][-1])
        return out

    def gradients(self, x: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log loss over labelled blocks, and its gradients; pages longest first, label -1 is not known."""
        kept: list = []
        states = self.states(x, lengths, kept)
        known = labels >= 0
        p = _sigmoid(states @ self.weights["out"][:-1] + self.weights["out"][-1])
        n = max(int(known.sum()), 1)
        loss = -np.log(np.clip(np.where(labels == 1, p, 1 - p)[known], 1e-7, 1)).sum() / n
        d = np.where(known, p - labels, 0).astype(np.float32) / n
        found = {name: np.zeros_like(w) for name, w in self.weights.items()}
        found["out"][:-1], found["out"][-1] = d @ states, d.sum()
        d_states = np.outer(d, self.weights["out"][:-1])
        d_z = {way: np.zeros((len(x), 4 * self.hidden), np.float32) for way in "fb"}
        carried: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for way, at, h, c, (i, f, o, g, _, t, _) in reversed(kept):
            d_h = d_states[at, : self.hidden] if way == "f" else d_states[at, self.hidden :]
            d_c = np.zeros_like(c)
            if way in carried:
                later_h, later_c = carried[way]
                d_h = d_h.copy()
                d_h[: len(later_h)] += later_h
                d_c[: len(later_c)] += later_c
            d_c += d_h * o * (1 - t * t)
            z = np.concatenate([d_c * g * i * (1 - i), d_c * c * f * (1 - f), d_h * t * o * (1 - o), d_c * i * (1 - g * g)], axis=1)
            d_z[way][at] = z
            found[f"h{way}"] += h.T @ z
            carried[way] = (z @ self.weights[f"h{way}"].T, d_c * f)
        for way in "fb":
            found[f"x{way}"] = x.T @ d_z[way]
            found[f"c{way}"] = d_z[way].sum(axis=0)
        return float(loss), found

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 2) -> Labeller:
        """Adam over batches of pages; a part of the path tokens is hidden at random, so that context counts."""
        rng = np.random.default_rng(seed)
        first = {name: np.zeros_like(w) for name, w in self.weights.items()}
        second = {name: np.zeros_like(w) for name, w in self.weights.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(pages))
            for begin in range(0, len(order), BATCH):
                batch = sorted((_window(*pages[k], rng) for k in order[begin : begin + BATCH]), key=lambda page: -len(page[1]))
                lengths = np.array([len(labels) for _, labels in batch])
                x = np.concatenate([features for features, _ in batch])
                x[:, :PATH_DIM] *= rng.random((len(x), PATH_DIM), np.float32) > 0.1
                x[:, :PATH_DIM] *= rng.random((len(x), 1), np.float32) > 0.05
                _, slopes = self.gradients(x, lengths, np.concatenate([labels for _, labels in batch]))
                step += 1
                rate = RATE * (1 - epoch / (epochs + 1))
                for name, slope in slopes.items():
                    first[name] += 0.1 * (slope - first[name])
                    second[name] += 0.001 * (slope * slope - second[name])
                    scaled = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                    self.weights[name] -= np.float32(rate) * scaled
        return self


def _window(features: np.ndarray, labels: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    begin = int(rng.integers(0, max(len(labels) - WINDOW, 0) + 1))
    return features[begin : begin + WINDOW].copy(), labels[begin : begin + WINDOW]


def fit_labeller(pages: list[str], seed: int = 3) -> Labeller | None:
    """A model fitted on pages as they are and, twice each, as others might write them; none without any block."""
    rng = np.random.default_rng(seed)
    parsed = [blocks for blocks in map(blocks_of, pages) if blocks]
    words = sorted({w for blocks in parsed for b in blocks for w in b.text.split(" ")[:200]})
    if not words:
        return None
    words = np.array(words, object)
    examples = []
    for blocks in parsed:
        labels = labels_of(blocks)
        for k in range(3):
            own, marks = (blocks, labels) if k == 0 else rewritten(blocks, labels, words, rng)
            examples.append((features_of(own), np.array(marks)))
    repeats = max(1, 256 // len(examples))
    return Labeller().fit(examples, EPOCHS * repeats)


def extract(page: list[Block], probabilities: np.ndarray) -> tuple[str, int]:
    kept = [b.text for b, p in zip(page, probabilities.tolist(), strict=True) if p >= 0.5]
    return " ".join(kept), len(kept)


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_kept): the main text of each page, given as (page_id, url, html).

    A block is the text between two tags that are not inline; character references are decoded, white space becomes one
    space. A bidirectional recurrent network reads the blocks of the whole page (tokens of their tag paths, hashed words,
    a few figures) and keeps or drops each; kept blocks are joined by a space in their order.

    The network is fitted in one task, on at most ``SAMPLE_PAGES`` pages of at most ``SAMPLE_CHARS`` characters, those with the smallest hashes.
    No page has labels, so it learns from parts that say what they are (``article``, ``nav``, class ``ad``), also
    in other ways of writing them and beside added parts; it needs no such part in a page it reads.

    Null and empty pages, and pages without a block, have an empty text. Each row is read on its own: repeated
    rows give repeated results. An empty table gives no rows. Other columns are ignored.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    usable = rows.where((F.char_length("html") > 0) & (F.char_length("html") <= SAMPLE_CHARS))
    sample = usable.orderBy(F.xxhash64("url", "html"), "html").select("html").limit(SAMPLE_PAGES).coalesce(1)
    fitted = sample.mapInArrow(_fitted, "model binary").first()
    model = pickle.loads(fitted["model"]) if fitted else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = size = 0
            for k in range(batch.num_rows):
                size += len(batch.column(2)[k].as_py() or "")
                if size >= SLICE_CHARS or k == batch.num_rows - 1:
                    yield _extracted(batch.slice(begin, k + 1 - begin), model)
                    begin, size = k + 1, 0

    return rows.mapInArrow(read, EXTRACTED)


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = fit_labeller([page for batch in batches for page in batch.column(0).to_pylist()])
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])


def _extracted(batch: pa.RecordBatch, model: Labeller | None) -> pa.RecordBatch:
    pages = [blocks_of(page or "") for page in batch.column(2).to_pylist()]
    lengths = np.array([len(page) for page in pages])
    if model is None:
        probabilities = np.zeros(int(lengths.sum()), np.float32)
    else:
        probabilities = model.probabilities(features_of([b for page in pages for b in page]), lengths)
    ends = np.cumsum(lengths)
    found = [extract(page, probabilities[e - len(page) : e]) for page, e in zip(pages, ends.tolist(), strict=True)]
    columns = [
        batch.column(0),
        batch.column(1),
        pa.array([text for text, _ in found], pa.string()),
        pa.array([len(text) for text, _ in found], pa.int64()),
        pa.array(lengths, pa.int64()),
        pa.array([n for _, n in found], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])
