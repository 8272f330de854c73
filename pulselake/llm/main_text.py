"""Main text of web pages from a recurrent labeller of blocks.

A page is cut into its blocks (runs of text between block-level tags) in page order. A
bidirectional LSTM in numpy reads, for each block, a vector of its tag path, one of its hashed words
and a few measures, and labels every block main or not with the whole page as context. Main blocks,
joined by one space, are the text.

The labeller is trained here on a bounded sample of the pages themselves. Labels come from
containers that pages name: inside ``article`` or ``main`` and outside any menu, footer, form, notice
and the like is main; blocks of which no name tells anything are left out of the loss. As pages of one
kind show few of these, each sample page is also read with sections of other names put into it (their
words taken from other blocks) and with its containers renamed, left without any name, or put into
wrappers named after what they also hold (``header-wrapper``, ``has-sidebar``), so that names, words and
places are learnt rather than one layout. Names outside the lists below have no place in a path's
vector, so a page's own names change nothing.

Defined results: null and empty pages and pages without main blocks give an empty text; scripts,
styles and comments are never blocks; character references are decoded; unclosed and stray tags
are taken as browsers do, roughly; very long pages are read whole, many small ones at once; without pages to learn from, every block is refused; rows
that share an id are read one by one; other columns are ignored.
"""

from __future__ import annotations

import html
import pickle
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pulselake.llm.common import smallest_hash

#: Pages learnt from at most (those of smallest hash), each whole.
SAMPLE_PAGES = 320
WORDS, MEASURES, HIDDEN = 32, 6, 24
#: Rounds of training, and blocks after which the pages at hand are labelled.
EPOCHS, BATCH_BLOCKS = 12, 8_192

#: HTML elements that end a run of text, that have no content, and whose content is no text.
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td textarea tfoot th thead title tr ul video".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TEXT = "script|style|noscript|template|svg|math|object"
#: Elements that an opening tag of the same group closes.
CLOSES = {t: g for g in (("p",), ("li",), ("dt", "dd"), ("tr",), ("td", "th"), ("option",)) for t in g}

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({HIDDEN_TEXT})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[!?/a-zA-Z][^>]*(?:>|\Z)|([^<]++|<)",
    re.S | re.I,
)
_NAME = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+")

#: Names of containers, in tags, classes, ids and roles, that tell labels for training.
MAIN = ("article", "main", ".article", ".main", ".content", ".post", ".entry", ".story")
REFUSED = (
    "nav", "header", "footer", "aside", "form", "menu", "button", "select", "dialog", "head", "iframe", "label",
    "textarea", ".ad", ".ads", ".advert", ".advertisement", ".sponsored", ".promo", ".banner", ".sidebar", ".menu",
    ".nav", ".navigation", ".navbar", ".breadcrumb", ".breadcrumbs", ".footer", ".header", ".masthead", ".cookie",
    ".consent", ".notice", ".alert", ".popup", ".modal", ".newsletter", ".subscribe", ".comment", ".comments",
    ".reply", ".discussion", ".related", ".recommended", ".share", ".social", ".tags", ".widget", ".copyright",
)
#: Parts of a name that say that its container holds a named part, not that it is one: ``header-wrapper``, ``has-sidebar``.
AFTER, BEFORE = (".wrapper", ".wrap", ".container", ".layout", ".page"), (".has", ".with", ".no")
#: Sections put into sample pages: paths below the place where they go.
SECTIONS = tuple(
    [(t,) for t in ("nav", "footer", "aside", "form", "menu", "header", "dialog")]
    + [("nav", "ul", "li", "a"), ("form", "label"), ("form", "button"), ("aside", "ul", "li", "a"), ("aside", "p"),
       ("footer", "p"), ("header", "p"), ("footer", "ul", "li", "a")]
    + [("div", name) for name in REFUSED if name[0] == "."] + [("section", name) for name in REFUSED if name[0] == "."]
    + [("div", name, "p") for name in REFUSED if name[0] == "."]
    + [("section", ".comments", "ol", "li", "p"), ("ul", ".comments", "li"), ("div", ".comments", "div", ".comment", "p"),
       ("ul", ".menu", "li", "a"), ("ul", ".share", "li", "a"), ("div", ".sidebar", "ul", "li", "a")]
)
#: Sections without a telling name, put outside the main container: lists of links, and wrappers around no article.
NAMELESS = (
    [("ul", "li", "a"), ("div", "a"), ("div", "ul", "li", "a"), ("p", "a")]
    + [("div", name, part, "p") for name in (".header", ".footer", ".nav", ".menu", ".sidebar") for part in AFTER]
)
CONTAINERS = (
    ("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".post"), ("div", ".entry", ".content"),
    ("section", ".article"), ("div", ".main"), ("div", ".story"), ("article", ".post"), ("article", "section"),
)
UNNAMED = ((), ("div",), ("div", "div"), ("section",), ("div", "section"), ("div", "div", "div"), ("table", "tbody", "tr", "td"))
WRAPPERS = tuple(
    [("div", name, part) for name in (".header", ".footer", ".nav", ".menu", ".sidebar") for part in AFTER]
    + [("div", part, name) for part in BEFORE for name in (".header", ".footer", ".sidebar", ".banner", ".ads", ".comments")]
)
#: The place of each known tag and name in the vector of a path.
SLOTS = {
    n: i for i, n in enumerate(sorted({*BLOCK, *MAIN, *REFUSED, *AFTER, *BEFORE, *"a b strong em i u small span time cite code".split()}))
}
PATH = len(SLOTS)


def blocks_of(page: str | None) -> list[tuple[tuple[str, ...], str, int]]:
    """The page's blocks: path of tags and names from the root, text, and how many of its characters are links."""
    out: list[tuple[tuple[str, ...], str, int]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []  # tag, and itself with its names
    parts: list[str] = []
    linked, path = 0, ()

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((path, text, linked))
            parts.clear()
        linked = 0

    def pop(tags: tuple[str, ...], until: tuple[str, ...] = ()) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                del stack[k:]
                return
            if stack[k][0] in until:
                return

    for m in _TOKEN.finditer(page or ""):
        text = m[5]
        if text is not None:
            if not parts:
                path = tuple(n for _, names in stack for n in names)
            parts.append(text)
            if any(tag == "a" for tag, _ in stack):
                linked += len(text)
            continue
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag in BLOCK:
            close()
        if m[2]:
            if tag not in VOID:
                pop((tag,), () if tag in ("body", "html", "article", "main", "div", "section") else ("article", "main", "body"))
            continue
        if tag in CLOSES:
            pop(CLOSES[tag], ("ul", "ol", "dl", "table", "div", "section", "article", "main", "select", "body"))
        elif tag in BLOCK and tag not in VOID:
            pop(("p",), ("div", "section", "article", "main", "li", "td", "body"))
        if tag not in VOID:
            names = [p for a in _NAME.finditer(m[4] or "") for p in _PART.findall((a[1] or a[2] or a[3] or "").lower())]
            stack.append((tag, (tag, *(f".{n}" for n in dict.fromkeys(names)))))
    close()
    return out


def _hash(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % size


def features(blocks: list[tuple[tuple[str, ...], str, int]]) -> np.ndarray:
    """One row per block: known tags and names of the path, hashed words, measures."""
    out = np.zeros((len(blocks), PATH + WORDS + MEASURES), np.float32)
    known: dict[tuple[str, ...], list[int]] = {}
    for i, (path, text, linked) in enumerate(blocks):
        if path not in known:
            known[path] = [SLOTS[n] for n in path if n in SLOTS]
        out[i, known[path]] = 1
        words = text.split()
        for w, n in Counter(words).items():
            out[i, PATH + _hash(w, WORDS)] += n / len(words)
        out[i, PATH + WORDS :] = (
            np.log1p(len(text)) / 8, np.log1p(len(words)) / 6, linked / (len(text) + 1), sum(text.count(c) for c in ".,") / len(words),
            i / len(blocks), 1,
        )
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """A bidirectional LSTM: input, recurrent and gate weights by direction, and the output layer."""

    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    output: np.ndarray
    trained: bool = False

    @staticmethod
    def fresh(seed: int = 7) -> Labeller:
        rng = np.random.default_rng(seed)
        make = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        wide = PATH + WORDS + MEASURES
        return Labeller([make(wide, 4 * HIDDEN) for _ in range(2)], [make(HIDDEN, 4 * HIDDEN) for _ in range(2)], make(2 * HIDDEN + 1, 1))

    def _run(self, x: np.ndarray, sizes: np.ndarray, d: int, keep: list | None = None) -> np.ndarray:
        """Hidden states of all blocks in one direction; pages advance block by block, longest first."""
        gates = x @ self.inputs[d]
        order = np.argsort(-sizes, kind="stable")
        first, size = (np.cumsum(sizes) - sizes)[order], sizes[order]
        alive = np.searchsorted(-size, -np.arange(size[0]), "left")
        h, c = np.zeros((2, len(sizes), HIDDEN), np.float32)
        out = np.zeros((len(x), HIDDEN), np.float32)
        for i in range(int(size[0])):
            n = alive[i]
            at = first[:n] + (i if d == 0 else size[:n] - 1 - i)
            before, cell = h[:n].copy(), c[:n].copy()
            z = gates[at] + before @ self.recurrent[d]
            s = _sigmoid(z[:, : 3 * HIDDEN])
            new = np.tanh(z[:, 3 * HIDDEN :])
            c[:n] = s[:, HIDDEN : 2 * HIDDEN] * cell + s[:, :HIDDEN] * new
            bent = np.tanh(c[:n])
            h[:n] = s[:, 2 * HIDDEN :] * bent
            out[at] = h[:n]
            if keep is not None:
                keep.append((at, before, cell, s, new, bent))
        return out

    def scores(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The probability that each block is main; ``sizes`` blocks by page."""
        if not len(x):
            return np.zeros(0)
        both = np.concatenate([self._run(x, sizes, 0), self._run(x, sizes, 1), np.ones((len(x), 1), np.float32)], axis=1)
        return _sigmoid(both @ self.output)[:, 0]

    def gradients(self, x: np.ndarray, sizes: np.ndarray, truth: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross entropy over blocks of known truth (not -1), in the order inputs, recurrent, output."""
        kept: list[list] = [[], []]
        hidden = [self._run(x, sizes, d, kept[d]) for d in range(2)]
        both = np.concatenate([*hidden, np.ones((len(x), 1), np.float32)], axis=1)
        known = truth >= 0
        miss = np.where(known, _sigmoid(both @ self.output)[:, 0] - truth, 0) / max(int(known.sum()), 1)
        miss = miss.astype(np.float32)[:, None]
        back = miss @ self.output.T
        inputs, recurrent = [], []
        for d in range(2):
            dh_all = back[:, d * HIDDEN : (d + 1) * HIDDEN]
            dz_all = np.zeros((len(x), 4 * HIDDEN), np.float32)
            dr = np.zeros_like(self.recurrent[d])
            pages = len(sizes)
            dh_next, dc_next = np.zeros((2, pages, HIDDEN), np.float32)
            for at, before, cell, s, new, bent in reversed(kept[d]):
                n = len(at)
                i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
                dh = dh_all[at] + dh_next[:n]
                dc = dc_next[:n] + dh * o * (1 - bent * bent)
                dz = np.concatenate([dc * new * i * (1 - i), dc * cell * f * (1 - f), dh * bent * o * (1 - o), dc * i * (1 - new * new)], axis=1)
                dz_all[at] = dz
                dr += before.T @ dz
                dh_next[:n], dc_next[:n] = dz @ self.recurrent[d].T, dc * f
            inputs.append(x.T @ dz_all)
            recurrent.append(dr)
        return [*inputs, *recurrent, both.T @ miss]

    def extract(self, pages: list[str | None]) -> list[str]:
        """The main text of each page."""
        out: list[str] = []
        held: list[list] = []
        for page in pages:
            held.append(blocks_of(page))
            if sum(map(len, held)) >= BATCH_BLOCKS:
                out += self._texts(held)
                held = []
        return out + self._texts(held)

    def _texts(self, pages: list[list]) -> list[str]:
        full = [b for b in pages if b]
        good = np.zeros(sum(map(len, full)), bool)
        if full and self.trained:
            good = self.scores(np.concatenate([features(b) for b in full]), np.array([len(b) for b in full])) >= 0.5
        marks = iter(good.tolist())
        return [" ".join(text for _, text, _ in blocks if next(marks)) for blocks in pages]


def named(path: tuple[str, ...]) -> int | None:
    """The label that a path's container names give: 1 main, 0 not, None unknown."""
    for i, n in enumerate(path):
        if n in REFUSED and not (n[0] == "." and (path[i - 1] in BEFORE or path[i + 1 : i + 2] and path[i + 1] in AFTER)):
            return 0
    return 1 if any(n in MAIN for n in path) else None


def _varied(blocks: list, labels: list[int], words: list[str], rng: random.Random) -> tuple[list, list[int]]:
    """The page with its main container renamed, unnamed or wrapped, and sections of other names put in."""
    container = rng.choice(CONTAINERS)
    if rng.random() < 0.3:
        container = rng.choice(WRAPPERS) + container
    elif rng.random() < 0.5:
        container = rng.choice(UNNAMED)
    keep = rng.random() < 0.3
    out, marks = [], []
    for (path, text, linked), y in zip(blocks, labels):
        if y == 1 and not keep:
            cut = max(i for i, n in enumerate(path) if n in MAIN)
            path = path[: path.index(next(n for n in path if n in MAIN))] + container + path[cut + 1 :]
        out.append((path, text, linked))
        marks.append(y)
    for _ in range(rng.randint(1, 4)):
        nameless = rng.random() < 0.25
        section = rng.choice(NAMELESS if nameless else SECTIONS)
        place = rng.randint(0, len(out))
        inside = not nameless and rng.random() < 0.5 and 0 < place < len(out) and marks[place - 1] == 1
        base = ("html", "body", *(container if inside and not keep else ("article",) if inside else ()))
        for _ in range(rng.randint(1, 6)):
            n = rng.choice((1, 2, 4) if nameless else (1, 2, 4, 10, 30, 80))
            at = rng.randrange(max(1, len(words) - n))
            text = " ".join(words[at : at + n]) or "x"
            out.insert(place, (base + section, text, len(text) if section[-1] == "a" else 0))
            marks.insert(place, 0)
    return out, marks


def learn(pages: list[str], seed: int = 7) -> Labeller:
    """A labeller trained on pages whose containers tell the labels."""
    rng, model = random.Random(seed), Labeller.fresh(seed)
    data = []
    for page in pages:
        blocks = blocks_of(page)
        labels = [named(p) for p, _, _ in blocks]
        if any(labels):
            data.append((blocks, [-1 if y is None else y for y in labels]))
    if not data:
        return model
    words = [w for blocks, _ in data for _, text, _ in blocks for w in text.split()[:60]]
    weights = [*model.inputs, *model.recurrent, model.output]
    speed, power = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS * min(10, max(1, 200 // len(data)))):  # few pages are read more often
        seen = [x if rng.random() < 0.3 else _varied(*x, words, rng) for x in data]
        rng.shuffle(seen)
        for at in range(0, len(seen), 16):
            part = seen[at : at + 16]
            x = np.concatenate([features(b) for b, _ in part])
            truth = np.concatenate([np.array(y, np.float32) for _, y in part])
            step += 1
            for k, g in enumerate(model.gradients(x, np.array([len(y) for _, y in part]), truth)):
                speed[k] = 0.9 * speed[k] + 0.1 * g
                power[k] = 0.999 * power[k] + 0.001 * g * g
                weights[k] -= 0.01 * (speed[k] / (1 - 0.9**step)) / (np.sqrt(power[k] / (1 - 0.999**step)) + 1e-7)
    model.trained = True
    return model


def main_text(pages: DataFrame, ident: str = "page_id", page: str = "html", sample: int = SAMPLE_PAGES) -> DataFrame:
    """Per page: ``page_id``, ``url``, ``text`` and ``n_chars``."""
    rows = pages.select(F.col(ident).alias("page_id"), "url", F.coalesce(page, F.lit("")).alias("html"))
    chosen = smallest_hash(rows.select("page_id").distinct(), "page_id", sample)
    found = rows.join(F.broadcast(chosen), "page_id").groupBy("page_id").agg(F.min("html").alias("html"))

    def train(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts = pd.concat([pd.DataFrame({"page_id": [], "html": []}), *parts]).sort_values("page_id")["html"]
        yield pd.DataFrame({"model": [pickle.dumps(learn(texts.tolist()))]})

    # The sample is bounded and trained on in one task, where numpy keeps to one core.
    trained = found.coalesce(1).mapInPandas(train, "model binary").first()  # no task, no row, if there is no page
    model = pages.sparkSession.sparkContext.broadcast(pickle.loads(trained["model"]) if trained else Labeller.fresh())

    @F.pandas_udf(StringType())
    def extracted(some: pd.Series) -> pd.Series:
        return pd.Series(model.value.extract(some.tolist()), dtype=object)

    out = rows.select("page_id", "url", extracted("html").alias("text"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
