"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks, the text between two block-level tags, each with the path of elements that
hold it. A bidirectional LSTM, written in numpy, reads the whole sequence of blocks: learned vectors of the
hashed tags, classes and ids on the path, learned vectors of the hashed words, and a few plain measures.
It labels every block as article or not with the whole page as context.

The labeller is trained here, on a bounded sample of the given pages. Elements and class names that say
what they hold label the sampled blocks. So that it also reads pages built otherwise, each page is also
rendered into other layouts: the same blocks under other containers, with other menus, notices, adverts,
forms and comments made from the sampled texts, and with telling names dropped at random.

Defined results: a null or empty page, or one without text, has empty text; scripts, styles, the head and
what else is never shown is no block; a page without any markup is read as one block; unclosed and stray
tags are tolerated: an open head ends at the first tag or text that no head holds, another hidden element at the
end of an element around it, and one that holds no blocks and is never closed at the next block; repeated rows are judged alike; an empty table gives no rows, and if no page can be
sampled the made layouts alone teach; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import texts

#: Bound of the training sample in pages, and the longest page in it in characters.
TRAINING_PAGES, TRAINING_CHARS = 240, 100_000
HASHED, PATH_SIZE, WORD_SIZE, MEASURES, HIDDEN = 512, 16, 8, 8, 16
#: Blocks of a page that one training step reads, from a random place on.
TRAINED_BLOCKS = 64

_BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul".split())
_HIDDEN = frozenset("script style noscript template head title svg iframe select option datalist textarea button".split())
#: Of these, what may hold itself, and what holds no block: left open, the next block ends it.
_NESTED = frozenset("svg template".split())
_NO_BLOCKS = frozenset("svg select option datalist button".split())
#: Any other tag, or text, ends a head that was left open.
_IN_HEAD = frozenset("base link meta noscript script style template title".split())
_RAW = frozenset("script style title textarea iframe".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Opening one of these ends an open element of the same group.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>", re.S)
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[A-Za-z]+")

#: What elements and names say about what they hold.
ARTICLE_TAGS = frozenset("article main".split())
OTHER_TAGS = frozenset("nav header footer aside form menu dialog".split())
OTHER_NAMES = frozenset(
    "ad ads advert advertisement sponsor sponsored promo banner menu nav navbar navigation breadcrumb breadcrumbs sidebar "
    "header masthead footer copyright cookie cookies consent notice alert popup modal newsletter subscribe signup login "
    "comment comments reply replies discussion respond share social related recommended widget toolbar pagination form search".split())


class Leaf:
    """Text between block-level tags; the path's names and the share of the text that is linked."""

    __slots__ = ("linked", "path", "text")

    def __init__(self, path: tuple[str, ...], text: str, linked: float):
        self.path, self.text, self.linked = path, text, linked


def leaves(page: str) -> list[Leaf]:
    """The leaf blocks of a page in order."""
    out: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = in_link = 0
    at = 0
    hidden: list[str] = []  # open elements from the first hidden one on
    next_end: dict[str, int] = {}

    def ended_after(tag: str, at: int) -> bool:
        """Whether an end tag follows; the place of the next one is remembered, so a page is searched once."""
        if next_end.get(tag, -1) < at:
            found = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            next_end[tag] = found.start() if found else len(page) + 1
        return next_end[tag] <= len(page)

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(Leaf(tuple(x for _, names in stack for x in names), text, min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if hidden == ["head"] and raw.strip():
            hidden.clear()
        if raw and not hidden:
            text = entities.unescape(raw)
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    def close(tags: tuple[str, ...], within: frozenset[str] = frozenset()) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                del stack[k:]
                return
            if stack[k][0] in within:
                return

    size = len(page)
    while at < size:
        found = _PIECE.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        end, tag, rest = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            if hidden:
                if tag in hidden:
                    del hidden[len(hidden) - 1 - hidden[::-1].index(tag):]
                    continue
                # The end of an element around the hidden one ends both.
                if hidden[0] == "head" or not any(tag == name for name, _ in stack):
                    continue
                hidden.clear()
            if tag == "a":
                in_link = max(0, in_link - 1)
            elif tag in _BLOCK_TAGS:
                flush()
                close((tag,))
            continue
        closed = rest.endswith("/") and tag not in _BLOCK_TAGS
        if tag in _RAW:
            if not closed:
                stop = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
                at = stop.start() if stop else size
                if stop:
                    at = page.find(">", at) + 1 or size
            continue
        if hidden == ["head"] and tag not in _IN_HEAD or hidden and hidden[0] == "head" and tag == "body":
            hidden.clear()
        if hidden and tag in _BLOCK_TAGS and tag not in _VOID and hidden[0] in _NO_BLOCKS and not ended_after(hidden[0], at):
            hidden.clear()
        if hidden:
            if tag in _BLOCK_TAGS | _HIDDEN and tag not in _VOID and not closed and (tag in _BLOCK_TAGS | _NESTED or tag not in hidden):
                hidden.append(tag)
            continue
        if tag in _HIDDEN:
            if not closed:
                hidden.append(tag)
        elif tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link += 1
        elif tag in _BLOCK_TAGS:
            flush()
            in_link = 0
            if tag == "hr":
                continue
            if stack and stack[-1][0] == "p":
                stack.pop()
            close(_ENDS.get(tag, ()), frozenset({"ul", "ol", "dl", "table"}))
            names = [x.lower() for m in _NAMED.finditer(rest) for x in _PARTS.findall(m[1] or m[2] or m[3] or "")]
            stack.append((tag, (tag, *("." + x for x in names))))
    flush()
    return out


def taught(leaf: Leaf) -> bool:
    """Whether the names on its path call a leaf article text: the innermost telling one decides, but a block
    that is no article inside an article stays none."""
    inside = False
    for name in leaf.path:
        if name in OTHER_TAGS and not (name == "header" and inside) or name[1:] in OTHER_NAMES and name[0] == ".":
            return False
        inside = inside or name in ARTICLE_TAGS
    return inside


def _hash(name: str) -> int:
    return crc32(name.encode("utf-8", "surrogatepass")) % HASHED


class Features:
    """Hashed names and words of a sequence of leaves, packed, and their measures."""

    def __init__(self, blocks: list[Leaf]):
        names = [np.array([_hash(x) for x in b.path], np.int64) for b in blocks]
        words = [np.array([_hash(w) for w in b.text.lower().split()], np.int64) for b in blocks]
        self.names, self.name_of = _packed(names)
        self.words, self.word_of = _packed(words)
        self.word_count = np.maximum(np.array([len(w) for w in words]), 1)
        n = max(1, len(blocks) - 1)
        same = [0.0] + [float(a.path == b.path) for a, b in zip(blocks, blocks[1:])]
        self.measures = np.array([
            [np.log1p(len(b.text)) / 6, b.linked, k / n, float(k == 0), float(k == n), same[k], float(b.text[-1:] in ".!?:;…"),
             min(len(b.path), 20) / 10] for k, b in enumerate(blocks)], np.float32).reshape(-1, MEASURES)


def _packed(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM over the blocks of a page, in numpy."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        size = PATH_SIZE + WORD_SIZE + MEASURES

        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        self.p = {"names": normal(HASHED, PATH_SIZE, scale=0.3), "words": normal(HASHED, WORD_SIZE, scale=0.3),
                  "out": normal(2 * HIDDEN, scale=0.2), "bias": np.zeros(1, np.float32)}
        for way in ("forth", "back"):
            self.p[f"{way}_w"] = normal(size + HIDDEN, 4 * HIDDEN, scale=1 / np.sqrt(size + HIDDEN))
            self.p[f"{way}_b"] = np.zeros(4 * HIDDEN, np.float32)
            self.p[f"{way}_b"][HIDDEN : 2 * HIDDEN] = 1  # remember at first

    def vectors(self, f: Features) -> np.ndarray:
        names = np.zeros((len(f.measures), PATH_SIZE), np.float32)
        np.add.at(names, f.name_of, self.p["names"][f.names])
        words = np.zeros((len(f.measures), WORD_SIZE), np.float32)
        np.add.at(words, f.word_of, self.p["words"][f.words])
        return np.concatenate([names, words / f.word_count[:, None], f.measures], axis=1)

    def _run(self, way: str, x: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """Hidden states (steps, pages, HIDDEN) in one direction; ``keep`` gathers what a backward pass needs."""
        w, b = self.p[f"{way}_w"], self.p[f"{way}_b"]
        steps, pages, size = x.shape
        given = x @ w[:size] + b
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out = np.zeros((steps, pages, HIDDEN), np.float32)
        for t in range(steps) if way == "forth" else range(steps - 1, -1, -1):
            z = given[t] + h @ w[size:]
            gates, fresh = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
            i, f, o = np.split(gates, 3, axis=1)
            m = mask[t][:, None]
            new_c = m * (f * c + i * fresh)
            tanh_c = np.tanh(new_c)
            if keep is not None:
                keep.append((t, h, c, i, f, o, fresh, tanh_c))
            h, c = m * o * tanh_c, new_c
            out[t] = h
        return out

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(way, x, mask, None) for way in ("forth", "back")], axis=2)
        return both @ self.p["out"] + self.p["bias"]

    def label(self, pages: list[list[Leaf]]) -> list[np.ndarray]:
        """For each page, which of its blocks are article text. Pages of like length run together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        while order:
            some = [order.pop()]
            longest = len(pages[some[0]])
            while order and len(some) < 64 and (len(some) + 1) * longest <= 40_000 and 2 * len(pages[order[-1]]) >= longest:
                some.append(order.pop())
            x, mask = self._padded([self.vectors(Features(pages[k])) for k in some])
            scores = self.scores(x, mask)
            for j, k in enumerate(some):
                out[k] = scores[: len(pages[k]), j] > 0
        return out

    @staticmethod
    def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        x = np.zeros((max(map(len, rows)), len(rows), rows[0].shape[1]), np.float32)
        mask = np.zeros(x.shape[:2], np.float32)
        for j, row in enumerate(rows):
            x[: len(row), j], mask[: len(row), j] = row, 1
        return x, mask

    def gradients(self, batch: list[tuple[Features, np.ndarray]]) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log loss over the blocks of a batch and its gradient."""
        x, mask = self._padded([self.vectors(f) for f, _ in batch])
        truth = np.zeros(mask.shape, np.float32)
        for j, (_, y) in enumerate(batch):
            truth[: len(y), j] = y
        kept: dict[str, list] = {"forth": [], "back": []}
        both = np.concatenate([self._run(way, x, mask, kept[way]) for way in kept], axis=2)
        score = both @ self.p["out"] + self.p["bias"]
        n = mask.sum()
        loss = float((np.logaddexp(0, np.where(truth > 0, -score, score)) * mask).sum() / n)
        pull = (_sigmoid(score) - truth) * mask / n
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"], g["bias"] = np.einsum("tp,tph->h", pull, both), np.array([pull.sum()], np.float32)
        on_states = pull[:, :, None] * self.p["out"]
        on_x = np.zeros_like(x)
        size = x.shape[2]
        for half, way in enumerate(kept):
            w = self.p[f"{way}_w"]
            dh, dc = np.zeros(both.shape[1:2] + (HIDDEN,), np.float32), 0.0
            for t, h, c, i, f, o, fresh, tanh_c in reversed(kept[way]):
                m = mask[t][:, None]
                dh = (dh + on_states[t, :, half * HIDDEN : (half + 1) * HIDDEN]) * m
                dc = (dc + dh * o * (1 - tanh_c**2)) * m
                dz = np.concatenate([dc * fresh * i * (1 - i), dc * c * f * (1 - f), dh * tanh_c * o * (1 - o), dc * i * (1 - fresh**2)], axis=1)
                g[f"{way}_w"][:size] += x[t].T @ dz
                g[f"{way}_w"][size:] += h.T @ dz
                g[f"{way}_b"] += dz.sum(0)
                on_x[t] += dz @ w[:size].T
                dh, dc = dz @ w[size:].T, dc * f
        for j, (f, _) in enumerate(batch):
            own = on_x[: len(f.measures), j]
            np.add.at(g["names"], f.names, own[f.name_of, :PATH_SIZE])
            np.add.at(g["words"], f.words, (own[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] / f.word_count[:, None])[f.word_of])
        return loss, g

    def fit(self, examples: list[tuple[list[Leaf], np.ndarray]], rounds: int = 14, rate: float = 0.01, seed: int = 3) -> float:
        """Adam over batches of pages of like length; returns the last round's mean loss."""
        rng = np.random.default_rng(seed)
        first, second, t, mean = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0, 0.0
        ready = [(blocks, y) for blocks, y in examples if blocks]
        for turn in range(rounds):
            cut = []
            for blocks, y in ready:
                start = int(rng.integers(0, max(1, len(blocks) - TRAINED_BLOCKS + 1)))
                cut.append((Features(blocks[start : start + TRAINED_BLOCKS]), y[start : start + TRAINED_BLOCKS]))
            cut.sort(key=lambda e: len(e[1]) + rng.random())
            batches = [cut[k : k + 48] for k in range(0, len(cut), 48)]
            losses = []
            for k in rng.permutation(len(batches)):
                loss, g = self.gradients(batches[k])
                losses.append(loss)
                t += 1
                step = rate * (0.1 if turn >= rounds - 3 else 1.0)
                for name, own in g.items():
                    own = np.clip(own, -1, 1)
                    first[name] = 0.9 * first[name] + 0.1 * own
                    second[name] = 0.99 * second[name] + 0.01 * own**2
                    self.p[name] -= (step * (first[name] / (1 - 0.9**t)) / (np.sqrt(second[name] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
            mean = float(np.mean(losses)) if losses else 0.0
        return mean


_CONTENT = [
    ("article",), ("main",), ("main", "article"), ("article", "div"), ("div", ".content"), ("div", ".main", ".content"), ("div", ".post"),
    ("div", ".article", ".body"), ("section", ".story"), ("div", ".entry", ".text"), ("div",), ("table", "tr", "td"), ("section",), (),
]
_LAYOUT: dict[str, list[tuple[str, ...]]] = {
    "menu": [("nav", "ul", "li"), ("div", ".menu", "ul", "li"), ("ul", ".nav", "li"), ("div", ".navigation"), ("nav",), ("header", "nav", "ul", "li"), ("div", ".breadcrumbs"), ("ul", "li"), ("menu", "li"), ("div", ".pagination")],
    "header": [("header",), ("header", "h1"), ("header", "p"), ("div", ".header"), ("div", ".masthead"), ("header", "div"), ("div", ".site", ".header", "p")],
    "footer": [("footer",), ("footer", "p"), ("div", ".footer"), ("footer", "ul", "li"), ("div", ".copyright"), ("footer", "div")],
    "side": [("aside",), ("aside", "p"), ("div", ".sidebar"), ("aside", "ul", "li"), ("aside", "h2"), ("aside", "h3"), ("div", ".sidebar", "p"), ("div", ".widget"), ("div", ".related", "ul", "li"), ("section", ".recommended")],
    "notice": [("div", ".cookie", ".notice"), ("div", ".cookie", ".banner"), ("div", ".consent"), ("div", ".notice"), ("div", ".alert"), ("div", ".popup"), ("dialog",), ("p", ".notice"), ("div", ".cookies", "p"), ("section", ".notice")],
    "advert": [("div", ".ad"), ("div", ".ads"), ("div", ".advert"), ("div", ".advertisement"), ("aside", ".ad"), ("div", ".sponsored"), ("div", ".promo"), ("p", ".ad"), ("div", ".ad", "p"), ("section", ".ad")],
    "form": [("form",), ("form", "p"), ("div", ".newsletter", "form"), ("form", ".search"), ("div", ".login"), ("form", "label"), ("form", "fieldset"), ("div", ".subscribe"), ("form", "div")],
    "comment": [("section", ".comments"), ("div", ".comments", "p"), ("div", ".comment"), ("ol", ".comments", "li"), ("section", ".comments", "div", ".comment"), ("section", ".comments", "article", ".comment"), ("section", ".comments", "h2"), ("div", ".comments", "ul", "li"), ("div", ".discussion"), ("ul", ".comments", "li"), ("section", ".comments", "article", "p"), ("div", ".comments", "article", "p")],
}
_FRAME = [("html", "body"), ("html", "body", "div"), ("html", "body", "div", ".page"), ("html", "body", "div", ".wrapper", ".container"), ()]


def rendered(content: list[Leaf], words: list[str], rng: np.random.Generator) -> tuple[list[Leaf], np.ndarray]:
    """The same article in another layout, with other parts around and inside it."""
    frame = _FRAME[rng.integers(len(_FRAME))]
    holder = frame + _CONTENT[rng.integers(len(_CONTENT))]
    blocks: list[Leaf] = []
    truth: list[bool] = []

    def text(longest: int) -> str:
        n, start = int(rng.integers(1, longest)), int(rng.integers(len(words)))
        return " ".join(words[start : start + n] or words[:1])

    def part(kind: str, within: tuple[str, ...], copies: int, longest: int) -> None:
        path = within + _LAYOUT[kind][rng.integers(len(_LAYOUT[kind]))]
        linked = float(kind == "menu" or rng.random() < 0.2)
        for _ in range(copies):
            blocks.append(Leaf(path, text(longest), linked))
            truth.append(False)

    def some(kinds: tuple[str, ...], chance: float, within: tuple[str, ...]) -> None:
        for kind in rng.permutation(kinds):
            if rng.random() < chance:
                few = kind in ("header", "notice", "advert", "footer")
                part(str(kind), within, int(rng.integers(1, 3 if few else 8)), {"menu": 4, "comment": 40}.get(str(kind), 25))

    some(("header", "menu", "notice", "advert", "form"), 0.5, frame)
    some(("side",), 0.2, frame)
    for k, leaf in enumerate(content):
        if k and rng.random() < 0.04:
            some(("advert", "side", "notice", "form"), 0.3, holder)
        tag = leaf.path[-1:] if leaf.path and leaf.path[-1][0] != "." and leaf.path[-1] not in ("article", "main", "div") else ("p",)
        if k == 0 and "article" in holder and rng.random() < 0.4:
            tag = [("header", "h1"), ("header", "h2"), ("header", "div")][rng.integers(3)]
        elif rng.random() < 0.1:
            tag = [("blockquote",), ("ul", "li"), ("h2",), ("pre",), ("ol", "li"), ("div",), ("table", "tr", "td"), ("blockquote", "p"), ("figure", "figcaption"), ("h3",), ("section", "p")][rng.integers(11)]
        blocks.append(Leaf(holder + tag, leaf.text, leaf.linked))
        truth.append(True)
    some(("comment", "advert", "form", "menu"), 0.4, frame if rng.random() < 0.5 else holder)
    some(("side", "menu", "footer", "notice", "form", "comment"), 0.5, frame)
    if holder == frame or holder[-1:] in (("div",), ("section",)) or rng.random() > 0.3:
        return blocks, np.array(truth)
    # Telling names of the article's holder are lost: what is left must do.
    plain = frame + ("div",) * (len(holder) - len(frame))
    for k, leaf in enumerate(blocks):
        if truth[k]:
            blocks[k] = Leaf(plain + leaf.path[len(holder):], leaf.text, leaf.linked)
    return blocks, np.array(truth)


def training_pages(pages: DataFrame, limit: int = TRAINING_PAGES, url: str = "url", page: str = "html") -> list[str]:
    """A bounded sample of pages, drawn by a hash of url and page."""
    rows = pages.select(F.col(f"`{page}`").alias("page"), F.xxhash64(F.lit("labeller"), F.col(f"`{url}`"), F.length(F.col(f"`{page}`"))).alias("draw"))
    small = rows.where((F.length("page") > 0) & (F.length("page") <= TRAINING_CHARS))
    # Only draws are ordered over all tasks; pages beyond the last wanted one stay where they are.
    last = small.select("draw").orderBy("draw").limit(limit).agg(F.max("draw")).first()[0]
    if last is None:
        return []
    return [r["page"] for r in small.where(F.col("draw") <= last).orderBy("draw", "page").limit(limit).collect()]


_NO_PAGES = ["<article>" + "".join(f"<p>{'Some words of a text. ' * (1 + k % 5)}</p>" for k in range(n)) + "</article>" for n in range(3, 23)]


def train(sample: list[str], variants: int = 4, seed: int = 9) -> Labeller:
    """Fit the labeller on sampled pages and on other layouts of their articles."""
    rng = np.random.default_rng(seed)
    examples, articles, words = [], [], []
    for blocks in map(leaves, sample):
        truth = np.array([taught(b) for b in blocks], bool)
        if truth.any():
            examples.append((blocks, truth))
            articles.append([b for b, own in zip(blocks, truth, strict=True) if own])
        words += [w for b in blocks[:40] for w in b.text.split()[:60]]
    if not articles:
        articles = [leaves(p) for p in _NO_PAGES]
        words = words or "some words of a text for all other parts".split()
    for article in articles:
        for _ in range(variants):
            start = int(rng.integers(0, max(1, len(article) - 30)))
            examples.append(rendered(article[start : start + int(rng.integers(1, 30))], words, rng))
        examples.append(([Leaf((), article[0].text, 0.0)], np.array([True])))
    labeller = Labeller()
    labeller.fit(examples, rounds=max(14, -(-14 * 1200 // len(examples)) if len(examples) < 1200 else 14))
    return labeller


def extract(pages: DataFrame, labeller: Labeller, keep: list[str], page: str = "html") -> DataFrame:
    """Columns ``keep`` with text and n_chars of every row."""
    from pyspark.sql import types as T

    source = texts.with_id(pages, **{c: c for c in keep}, _page=page)
    shared = pages.sparkSession.sparkContext.broadcast(labeller.p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Labeller()
        own.p = shared.value
        for part in texts.slices(batches, "_page"):
            found = [leaves(p) if p else [] for p in part.column("_page").to_pylist()]
            text = [" ".join(b.text for b, kept in zip(blocks, labels, strict=True) if kept)
                    for blocks, labels in zip(found, own.label(found), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                [*part.schema.names[:-1], "text", "n_chars"])

    fields = [*source.schema.fields[:-1], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return source.mapInArrow(run, T.StructType(fields))
