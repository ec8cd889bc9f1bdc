"""HTML extraction by a recurrent block labeller.

A tolerant scan turns a page into its leaf blocks: runs of text between block-level tags, each
with the path of tags, classes and ids above it. A bidirectional LSTM in numpy reads the blocks
of a page in order (hashed tag path, hashed words, lengths and places) and says for each block
whether it is part of the article; the whole page is its context.

Fitting. There are no labels for pages, so blocks of a bounded sample of pages get them from
names that authors use for parts of pages (``nav``, ``footer``, ``class="sidebar"``, ``article``).
Each page is then shown in several guises: containers are renamed or dropped and notices, forms,
sidebars and comments are put in, so that the model leans on all its inputs.

Edge cases. Null and empty pages and pages without blocks have an empty text. Unclosed tags end
with their parent or where HTML lets them end. Texts are taken whole, whatever their length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of HTML, fixed by the standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg select datalist".split())
# Those that run to the end of the page where nothing closes them.
TEXT_ONLY = frozenset("script style title textarea".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split())
# Parts of formulas, which belong to the text around them.
INLINE |= frozenset("math maction annotation annotation-xml menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table tr td th article section main div aside nav body html form blockquote".split())

# Names by which sample blocks get their labels.
OTHER_TAGS = frozenset("nav footer header aside form button menu dialog fieldset".split())
OTHER_NAMES = frozenset("ad ads advert advertisement banner breadcrumb comment comments cookie consent copyright disclaimer footer form header login menu modal nav navbar navigation newsletter notice popup promo related reply share sidebar social sponsored subscribe tags toolbar widget".split())
OWN_TAGS = frozenset(("article", "main"))
OWN_NAMES = frozenset("article content entry main post story text".split())

TAG = re.compile(r"<(?:!--(.*?)(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'<>])*+)>|[!?][^>]*>)", re.S)
NAMES = re.compile(r"""(?:class|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

PATHS, WORDS, NUMBERS = 128, 64, 8
WIDTH = PATHS + WORDS + NUMBERS
HIDDEN = 16
SAMPLE_PAGES = 250
LONGEST = 60_000  # characters of a page the model is fitted on
GUISES = 3
EPOCHS = 8
BATCH = 32
RATE = 0.02
SEED = 3
GROUP = 64  # pages that go through the network together


@dataclass
class Block:
    path: tuple[str, ...]  # tags, classes and ids above, outermost first, each once
    text: str
    linked: float  # share of characters inside links


def blocks_of(html: str | None) -> list[Block]:
    """Leaf blocks of a page in order."""
    html = html or ""
    found: list[Block] = []
    # Open elements, each with the path down to it, and how many there are of a name.
    stack: list[tuple[str, tuple[str, ...]]] = []
    opened: Counter = Counter()
    parts: list[str] = []
    linked, links = 0, 0
    unclosed: set[str] = set()
    path: tuple[str, ...] = ()

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        if text:
            found.append(Block(path, text, min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked, path
        if not parts and piece.strip():
            path = stack[-1][1] if stack else ()
        if parts or piece.strip():
            parts.append(piece)
            if links:
                linked += len(piece.strip())

    def end(k: int) -> None:
        """End the open element at place k and all inside it."""
        for name, _ in stack[k:]:
            opened[name] -= 1
        del stack[k:]

    def close(names: set[str]) -> None:
        """End an open element of ``names``, unless a container hides it."""
        if not any(opened[name] for name in names):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                end(k)
                return
            if stack[k][0] in SCOPES:
                return

    at = 0
    while True:
        match = TAG.search(html, at)
        add(html[at : match.start()] if match else html[at:])
        if not match:
            break
        at = match.end()
        name = (match[3] or "").lower()
        if not name:
            continue
        if match[2]:
            if name not in INLINE:
                flush()
            elif name == "a":
                links = max(0, links - 1)
            if opened[name]:
                end(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name))
            continue
        if name == "br":
            add(" ")
            continue
        if name not in INLINE:
            flush()
            links = 0
            close({"p"})
            if name in CLOSES:
                close(CLOSES[name])
        if name in VOID or match[4].endswith("/"):
            continue
        if name in RAW:
            # Where nothing closes a name once, nothing does later in the page.
            closing = None if name in unclosed else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            if closing or name in TEXT_ONLY:
                at = closing.end() if closing else len(html)
            else:
                unclosed.add(name)
            continue
        if name == "a":
            links += 1
        above = stack[-1][1] if stack else ()
        if name not in INLINE:
            names = [w for a, b, c in NAMES.findall(match[4]) for w in re.split(r"[\s_-]+", (a or b or c).lower()) if w]
            # Names met before are not repeated, so deep nesting shares one path.
            new = dict.fromkeys(n for n in (name, *(f".{w}" for w in names)) if n not in above)
            above = (*above, *new) if new else above
        stack.append((name, above))
        opened[name] += 1
    flush()
    return found


@lru_cache(maxsize=100_000)
def _hash(word: str, size: int) -> int:
    return crc32(word.encode("utf-8", "surrogatepass")) % size


@lru_cache(maxsize=20_000)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    row = np.zeros(PATHS, dtype=np.float32)
    for name in set(path):
        row[_hash(name, PATHS)] = 1
    return row


def matrix(blocks: list[Block]) -> np.ndarray:
    """One row of features for each block."""
    out = np.zeros((len(blocks), WIDTH), dtype=np.float32)
    for k, block in enumerate(blocks):
        words = block.text.split()
        out[k, :PATHS] = _path_vector(block.path)
        slots = np.fromiter((_hash(w.lower(), WORDS) for w in words), dtype=np.int64, count=len(words))
        out[k, PATHS : PATHS + WORDS] = np.sqrt(np.bincount(slots, minlength=WORDS) / max(1, len(words)))
        out[k, PATHS + WORDS :] = (
            np.log1p(len(words)) / 5,
            block.linked,
            k / len(blocks),
            1 / (1 + k),
            1 / (len(blocks) - k),
            sum(map(block.text.count, ".!?")) / max(1, len(words)),
            "©" in block.text,
            len(block.path) / 10,
        )
    return out


def named_label(path: tuple[str, ...]) -> int | None:
    """1 for the article, 0 for what surrounds it, None if no name tells."""
    names = {p[1:] for p in path if p[0] == "."}
    if OTHER_TAGS & set(path) or OTHER_NAMES & names:
        return 0
    return 1 if OWN_TAGS & set(path) or OWN_NAMES & names else None


class Labeller:
    """Bidirectional LSTM with one logistic output per block."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda a, b: rng.normal(0, 1 / np.sqrt(a), (a, b))
        self.w = [draw(WIDTH, 4 * HIDDEN), draw(WIDTH, 4 * HIDDEN)]
        self.u = [draw(HIDDEN, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN)]
        self.b = [np.zeros(4 * HIDDEN), np.zeros(4 * HIDDEN)]
        for bias in self.b:
            bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
        self.v, self.c = draw(2 * HIDDEN, 1)[:, 0], np.zeros(1)

    def parameters(self) -> list[np.ndarray]:
        return [*self.w, *self.u, *self.b, self.v, self.c]

    def _run(self, side: int, x: np.ndarray, mask: np.ndarray, keep: bool):
        n, steps, _ = x.shape
        h, s = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        fed = x @ self.w[side] + self.b[side]
        states, kept = np.zeros((n, steps, HIDDEN)), []
        order = range(steps) if side == 0 else range(steps - 1, -1, -1)
        for t in order:
            z = fed[:, t] + h @ self.u[side]
            gates = 1 / (1 + np.exp(-np.clip(z[:, : 3 * HIDDEN], -30, 30)))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[:, t, None]
            new_s = m * (f * s + i * g)
            new_h = m * (o * np.tanh(new_s))
            if keep:
                kept.append((t, i, f, o, g, s, h, new_s))
            h, s = new_h, new_s
            states[:, t] = h
        return states, kept

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(k, x, mask, False)[0] for k in (0, 1)], axis=2)
        return 1 / (1 + np.exp(-np.clip(both @ self.v + self.c[0], -30, 30)))

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        runs = [self._run(k, x, mask, True) for k in (0, 1)]
        both = np.concatenate([r[0] for r in runs], axis=2)
        p = 1 / (1 + np.exp(-np.clip(both @ self.v + self.c[0], -30, 30)))
        wrong = (p - y) * weight / max(1.0, weight.sum())
        g_v, g_c = np.einsum("nt,nth->h", wrong, both), np.array([wrong.sum()])
        out_w, out_u, out_b = [], [], []
        for side, (_, kept) in enumerate(runs):
            d_states = wrong[:, :, None] * self.v[side * HIDDEN : (side + 1) * HIDDEN]
            g_u = np.zeros_like(self.u[side])
            d_fed = np.zeros((*x.shape[:2], 4 * HIDDEN))
            d_h, d_s = np.zeros((len(x), HIDDEN)), np.zeros((len(x), HIDDEN))
            for t, i, f, o, g, s, h, new_s in reversed(kept):
                m = mask[:, t, None]
                d_h = (d_h + d_states[:, t]) * m
                tanh = np.tanh(new_s)
                d_s = (d_s + d_h * o * (1 - tanh**2)) * m
                d_z = np.concatenate([d_s * g * i * (1 - i), d_s * s * f * (1 - f), d_h * tanh * o * (1 - o), d_s * i * (1 - g**2)], axis=1)
                d_fed[:, t] = d_z
                g_u += h.T @ d_z
                d_h, d_s = d_z @ self.u[side].T, d_s * f
            out_w.append(np.einsum("ntd,ntg->dg", x, d_fed))
            out_u.append(g_u)
            out_b.append(d_fed.sum(axis=(0, 1)))
        return [*out_w, *out_u, *out_b, g_v, g_c]


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    most = max(len(p) for p in pages)
    x, mask = np.zeros((len(pages), most, WIDTH)), np.zeros((len(pages), most))
    for k, page in enumerate(pages):
        x[k, : len(page)], mask[k, : len(page)] = page, 1
    return x, mask


def guise(blocks: list[Block], labels: list[int], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """The page with containers renamed and other parts put in."""
    pick = lambda options: options[rng.integers(len(options))]
    holder = pick([("article",), ("main",), ("div", ".content"), ("div", ".post", ".body"), ("section", ".entry"), ("div", ".article"), ("div",), ()])
    out = []
    for block, label in zip(blocks, labels):
        path = block.path
        if label:
            kept = tuple(n for n in path if n not in OWN_TAGS and n[1:] not in OWN_NAMES)
            at = next((k + 1 for k, n in enumerate(kept) if n == "body"), 0)
            path = (*kept[:at], *holder, *kept[at:])
        out.append((Block(path, block.text, block.linked), label))
    words = [w for b in blocks for w in b.text.split()] or ["x"]
    said = lambda n: " ".join(words[i] for i in rng.integers(len(words), size=n))
    base = ("html", "body")
    first, last = [], []
    if rng.random() < 0.4:
        first.append(Block((*base, *pick([("header",), ("div", ".header"), ("header", ".site")]), pick(["p", "h1", "div"])), said(rng.integers(1, 12)), 0.0))
    if rng.random() < 0.4:
        first.append(Block((*base, "div", pick([".cookie", ".notice", ".banner", ".consent"]), "p"), said(rng.integers(4, 30)), 0.0))
    for _ in range(rng.integers(0, 3)):
        first.append(Block((*base, *pick([("aside",), ("div", ".sidebar"), ("aside", ".related"), ("div", ".widget")]), pick(["p", "li", "h3"])), said(rng.integers(2, 30)), float(rng.random() < 0.5)))
    for _ in range(rng.integers(0, 3)):
        last.append(Block((*base, *pick([("section", ".comments", "div", ".comment"), ("div", ".comments"), ("ul", ".comments", "li", ".comment"), ("div", ".reply")]), "p"), said(rng.integers(4, 60)), 0.0))
    if rng.random() < 0.4:
        last.append(Block((*base, *pick([("form",), ("form", ".newsletter"), ("div", ".subscribe"), ("form", ".login")]), pick(["p", "div", "fieldset"])), said(rng.integers(2, 20)), 0.0))
    if rng.random() < 0.4:
        last.append(Block((*base, *pick([("aside",), ("div", ".related"), ("div", ".share"), ("div", ".promo")]), "p"), said(rng.integers(2, 25)), 1.0))
    tail = next((k for k in range(len(out) - 1, -1, -1) if out[k][1]), len(out) - 1) + 1
    mixed = [(b, 0) for b in first] + out[:tail] + [(b, 0) for b in last] + out[tail:]
    return [b for b, _ in mixed], [label for _, label in mixed]


def train(pages: list[list[Block]], seed: int = SEED) -> Labeller:
    """A labeller from sample pages, by backpropagation through time and Adam."""
    rng = np.random.default_rng(seed)
    rows = []
    for blocks in pages:
        labels = [named_label(b.path) for b in blocks]
        if not blocks:
            continue
        # Where no name marks the article, unnamed blocks of some length are taken for it.
        marked = 1 in labels
        labels = [v if v is not None else int(not marked and len(b.text.split()) >= 8) for v, b in zip(labels, blocks)]
        rows.append((matrix(blocks), np.array(labels, dtype=float)))
        for _ in range(GUISES - 1):
            other, own = guise(blocks, labels, rng)
            rows.append((matrix(other), np.array(own, dtype=float)))
    model = Labeller(seed)
    moment = [np.zeros_like(p) for p in model.parameters()]
    square = [np.zeros_like(p) for p in model.parameters()]
    order = sorted(range(len(rows)), key=lambda i: len(rows[i][0]))
    batches = [order[a : a + BATCH] for a in range(0, len(order), BATCH)]
    step = 0
    for _ in range(EPOCHS):
        for at in rng.permutation(len(batches)):
            batch = [rows[i] for i in batches[at]]
            x, mask = _padded([m for m, _ in batch])
            y = np.zeros(mask.shape)
            for k, (_, labels) in enumerate(batch):
                y[k, : len(labels)] = labels
            step += 1
            for p, g, m, s in zip(model.parameters(), model.gradients(x, mask, y, mask), moment, square):
                g = np.clip(g, -1, 1)
                m *= 0.9
                m += 0.1 * g
                s *= 0.99
                s += 0.01 * g * g
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return model


def fit_labeller(pages: DataFrame, *, rows: int = SAMPLE_PAGES) -> Labeller:
    """A labeller fitted on about ``rows`` pages of at most LONGEST characters, by a hash of the id."""
    fit = pages.where(F.length("html").between(1, LONGEST)).select("page_id", "html")
    share = min(1.0, rows / max(1, fit.count()))
    chosen = fit.where(F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    texts = sorted(r["html"] for r in chosen.select("html").limit(2 * rows).collect())
    return train([blocks_of(t) for t in texts])


def main_text(html: Column, model: Labeller) -> Column:
    """The article of a page: blocks joined by line ends."""

    @F.arrow_udf("string")
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            pages = [blocks_of(h.as_py()) for h in batch]
            texts = [""] * len(pages)
            order = sorted((k for k, p in enumerate(pages) if p), key=lambda k: len(pages[k]))
            at = 0
            while at < len(order):
                # Long pages go in smaller groups, so that a group's blocks stay bounded.
                some = order[at : at + max(1, min(GROUP, 20_000 // len(pages[order[min(len(order), at + GROUP) - 1]])))]
                at += len(some)
                x, mask = _padded([matrix(pages[k]) for k in some])
                content = model.probabilities(x, mask) >= 0.5
                for row, k in enumerate(some):
                    texts[k] = "\n".join(b.text for b, own in zip(pages[k], content[row]) if own)
            yield pa.array(texts, type=pa.string())

    return extracted(html)
