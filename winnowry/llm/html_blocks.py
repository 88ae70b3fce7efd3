"""Main text of web pages by a recurrent labeller of their blocks.

A page is cut into blocks of text at block-level tags. A bidirectional LSTM, in
numpy, reads the blocks in order, each as a vector of its tag path (hashed tags
and class words), of its hashed words and of a few measures, and labels every
block as main text or not from what it has read on both sides. It is trained
here, always on made-up pages (``made_up``: usual layouts in invented words, with
regions that known tags or classes declare, that unknown classes mark, or that
nothing marks), and besides on a bounded sample of the pages: the regions that
tags and class words declare give the labels, and the sample is varied (regions
renamed, bared or moved in from other pages), so that no single clue is enough.
A table whose pages declare nothing is read by what the made-up pages taught.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.llm.common import Codes, first_by_hash, word_hashes, word_spans

SAMPLE_PAGES = 300
MADE_UP_PAGES = 800
PATH_DIMS, WORD_DIMS, MEASURES = 128, 32, 11
DIMS = PATH_DIMS + WORD_DIMS + MEASURES
HIDDEN = 16
EPOCHS = 16
TOGETHER = 128  # pages read side by side
PIECE = 60  # blocks of a training page that are read at once

#: Content that is never text (beside script and style); content shown only where an element cannot be;
#: tags that do not end a block, tags without an end.
UNREAD_IF_CLOSED = "noscript template svg iframe".split()
STAND_IN = "object canvas audio video".split()
STRUCTURE = "html body main article section div p ul ol table form header footer nav aside h1 h2 h3 h4 h5 h6".split()
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math annotation annotation-xml maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded "
    "mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover "
    "semantics".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr "
    "noscript template svg iframe object canvas audio video".split()  # where no end was found: they hold nothing
)
#: Opening one of these ends an open one of the same group.
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "p": {"p"},
}
LISTS = frozenset("ul ol dl table select article section main div body nav aside header footer form".split())

#: Words of tags and classes that declare a region; the last one inwards counts.
MAIN_WORDS = "article main content post entry story text articlebody".split()
OTHER_WORDS = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs topbar tabs pagination toc".split(),
    "header": "header masthead branding logo head title".split(),
    "footer": "footer colophon copyright bottom legal".split(),
    "sidebar": "aside sidebar widget rail related recommended popular trending".split(),
    "advert": "ad ads advert advertisement sponsored promo promoted sponsor".split(),
    "notice": "cookie cookies consent notice banner alert popup modal newsletter subscribe overlay".split(),
    "form": "form login signup search fieldset button select textarea option share social".split(),
    "comments": "comments comment replies reply discussion disqus respond".split(),
}
TAILS = [
    ("p",), ("div",), ("li",), ("ul", "li"), ("ol", "li"), ("td",), ("table", "tr", "td"), ("table", "tbody", "tr", "th"),
    ("blockquote",), ("blockquote", "p"), ("pre",), ("figure", "figcaption"), ("dl", "dd"), ("h2",), ("h3",), (),
]
_DECLARED = {w: False for words in OTHER_WORDS.values() for w in words} | {w: True for w in MAIN_WORDS}

_ATTRIBUTES = r"[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*"
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?:{'|'.join(UNREAD_IF_CLOSED + STAND_IN)})(?=[\s/>]){_ATTRIBUTES}(?<=/)>"
    r"|<script(?=[\s/>])[^>]*>.*?(?:</script\s*>|\Z)|<style(?=[\s/>])[^>]*>.*?(?:</style\s*>|\Z)"
    rf"|<({'|'.join(UNREAD_IF_CLOSED)})(?=[\s/>])[^>]*>.*?</\1\s*>"
    rf"|<({'|'.join(STAND_IN)})(?=[\s/>])[^>]*>(?:[^<]|<(?!/?(?:{'|'.join(STRUCTURE)})[\s/>]))*?</\2\s*>"
    rf"|<(/?)([a-z][a-z0-9:-]*)({_ATTRIBUTES})(?:>|\Z)"
    r"|<[/!?a-z][^>]*(?:>|\Z)",
    re.S | re.I,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    """Text between two block-level tags, its ancestors' words, and how much of it is links."""

    path: tuple[str, ...]
    text: str
    linked: float
    heading: bool = field(default=False)


def _element(tag: str, attributes: str) -> tuple[str, ...]:
    """A tag and the words of its class, id and role."""
    if "=" not in attributes:
        return (tag,)
    found = [w for m in NAMED.finditer(attributes.lower()) for w in WORD.findall(m[1] or m[2] or m[3] or "")]
    return (tag, *dict.fromkeys(found))


def read_blocks(page: str) -> list[Block]:
    """Blocks of a page in order, with character references decoded and white space made single spaces."""
    blocks: list[Block] = []
    stack: list[tuple[str, ...]] = []
    parts: list[str] = []
    linked = in_link = 0

    def end_block() -> None:
        nonlocal parts, linked
        if parts:
            text = "".join(parts)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                path = tuple(w for element in stack for w in element)
                head = bool(stack) and stack[-1][0] in ("h1", "h2", "h3", "h4", "h5", "h6")
                blocks.append(Block(path, text, min(1.0, linked / len(text)), head))
        parts, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if in_link:
                linked += len(text)

    at = 0
    for m in TAG.finditer(page):
        add(page[at : m.start()])
        at, tag = m.end(), m[4]
        if not tag:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if m[3] else 1
            elif tag == "br":
                parts.append(" ")
            continue
        end_block()
        in_link = 0
        if m[3]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
        elif tag not in VOID:
            if stack and stack[-1][0] == "p":
                stack.pop()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in SIBLINGS.get(tag, ()):
                    del stack[i:]
                    break
                if stack[i][0] in LISTS:
                    break
            stack.append(_element(tag, m[5]))
    add(page[at:])
    end_block()
    return blocks


def declared(block: Block) -> bool | None:
    """What the innermost telling word of the path says: main text, not main text, or nothing."""
    return next((_DECLARED[w] for w in reversed(block.path) if w in _DECLARED), None)


_paths: dict[tuple[str, ...], np.ndarray] = {}


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    found = _paths.get(path)
    if found is None:
        if len(_paths) > 50_000:
            _paths.clear()
        found = np.zeros(PATH_DIMS, np.float32)
        for w in path:
            found[zlib.crc32(w.encode()) % PATH_DIMS] = 1
        _paths[path] = found
    return found


def _among_siblings(blocks: list[Block], page: list[int], size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Share of a page's text under the block's parents, whether they begin or end with it."""
    homes = Codes()
    home, _ = homes.of([[(p, b.path[:-1]) for p, b in zip(page, blocks)]])
    total = np.bincount(page, size)[page]
    share = np.bincount(home, size)[home] / np.maximum(total, 1)
    fresh = np.ones(len(blocks))
    fresh[1:] = home[1:] != home[:-1]
    return share, fresh, np.append(fresh[1:], 1.0)


def block_vectors(pages: list[list[Block]]) -> np.ndarray:
    """One row per block of all pages: path, words, measures."""
    blocks = [b for page in pages for b in page]
    out = np.zeros((len(blocks), DIMS), np.float32)
    if not blocks:
        return out
    out[:, :PATH_DIMS] = [_path_vector(b.path) for b in blocks]
    raw = [b.text.lower().encode() for b in blocks]
    offsets = np.cumsum([0, *map(len, raw)])
    data = np.frombuffer(b"".join(raw), np.uint8)
    starts, ends, first = word_spans(data, offsets)
    words = np.diff(first)
    rows, h = np.repeat(np.arange(len(blocks)), words), word_hashes(data, starts, ends)
    place = rows * WORD_DIMS + (h % np.uint64(WORD_DIMS)).astype(np.int64)
    sign = 1.0 - 2.0 * ((h >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
    hashed = np.bincount(place, sign, len(blocks) * WORD_DIMS).reshape(len(blocks), WORD_DIMS)
    out[:, PATH_DIMS : PATH_DIMS + WORD_DIMS] = hashed / (1 + np.sqrt((hashed * hashed).sum(1)))[:, None]
    size = np.diff(offsets)
    stops = np.bincount(rows, np.isin(data[ends - 1], np.frombuffer(b".!?", np.uint8)), len(blocks))
    sizes = np.array([len(p) for p in pages])
    order = np.arange(len(blocks)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    page = np.repeat(np.arange(len(pages)), sizes).tolist()
    share, fresh, ahead = _among_siblings(blocks, page, size)
    out[:, PATH_DIMS + WORD_DIMS :] = np.column_stack([
        np.log1p(words) / 4, np.log1p(size) / 6, [b.linked for b in blocks], np.log1p(size / np.maximum(words, 1)) / 2,
        np.minimum(stops / np.maximum(words, 1) * 5, 2), order / np.repeat(np.maximum(sizes, 1), sizes), [b.heading for b in blocks],
        share, fresh, ahead, np.ones(len(blocks)),
    ])
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Labeller:
    """A bidirectional LSTM with one logit per block."""

    def __init__(self, seed: int = 42) -> None:
        rng = np.random.default_rng(seed)
        self.weights: dict[str, np.ndarray] = {}
        for d in "fb":
            self.weights[f"x{d}"] = rng.normal(0, DIMS**-0.5, (DIMS, 4 * HIDDEN))
            self.weights[f"h{d}"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
            self.weights[f"c{d}"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)  # gates: in, forget, out, new
        self.weights["v"] = rng.normal(0, 0.3, 2 * HIDDEN)
        self.weights["s"] = np.zeros(1)
        self.weights = {k: w.astype(np.float32) for k, w in self.weights.items()}

    def _read(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """States after each step (steps, pages, HIDDEN), and what the way back needs."""
        w = self.weights
        given = x @ w[f"x{d}"] + w[f"c{d}"]
        h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
        states, kept = np.empty((len(x), x.shape[1], HIDDEN), np.float32), []
        for t in range(len(x)):
            z = given[t] + h @ w[f"h{d}"]
            gates, new = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            before, last = c, h
            c = f * c + i * new
            squashed = np.tanh(c)
            h = o * squashed
            states[t] = h
            kept.append((i, f, o, new, before, squashed, last))
        return states, kept

    def _read_back(self, x: np.ndarray, d: str, kept: list, grown: np.ndarray, out: dict[str, np.ndarray]) -> None:
        """Add the gradient of one direction; ``grown`` is that of its states."""
        w = self.weights
        dh = dc = np.zeros(grown.shape[1:], np.float32)
        dz = np.empty((len(x), x.shape[1], 4 * HIDDEN), np.float32)
        recurrent = np.zeros_like(w[f"h{d}"])
        for t in range(len(x) - 1, -1, -1):
            i, f, o, new, before, squashed, last = kept[t]
            dh = dh + grown[t]
            dc = dc + dh * o * (1 - squashed * squashed)
            dz[t] = np.concatenate(
                (dc * new * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - new * new)), 1
            )
            recurrent += last.T @ dz[t]
            dh, dc = dz[t] @ w[f"h{d}"].T, dc * f
        flat = dz.reshape(-1, 4 * HIDDEN)
        out[f"x{d}"], out[f"h{d}"], out[f"c{d}"] = x.reshape(-1, DIMS).T @ flat, recurrent, flat.sum(0)

    @staticmethod
    def _padded(rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """Rows of pages as (steps, pages, DIMS), forwards and backwards, and where each row went."""
        page = np.repeat(np.arange(len(sizes)), sizes)
        step = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ahead = np.zeros((sizes.max(), len(sizes), DIMS), np.float32)
        back = np.zeros_like(ahead)
        ahead[step, page] = rows
        back[sizes[page] - 1 - step, page] = rows
        return ahead, back, (step, page)

    def logits(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A logit per block; ``rows`` are the blocks of all pages, ``sizes`` how many each page has."""
        out, begins = np.zeros(len(rows), np.float32), np.cumsum(sizes) - sizes
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] > 0]
        first = 0
        while first < len(order):
            few = max(1, min(TOGETHER, 200_000 // int(sizes[order[min(first + TOGETHER, len(order)) - 1]])))
            group = order[first : first + few]
            first += few
            at = np.concatenate([np.arange(begins[p], begins[p] + sizes[p]) for p in group])
            ahead, back, (step, page) = self._padded(rows[at], sizes[group])
            f, b = self._read(ahead, "f")[0], self._read(back, "b")[0]
            states = np.concatenate((f[step, page], b[sizes[group][page] - 1 - step, page]), 1)
            out[at] = states @ self.weights["v"] + self.weights["s"]
        return out

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 42) -> None:
        """Fit to (vectors, labels) of pages by Adam; a page without labels teaches nothing."""
        rng, step = np.random.default_rng(seed), 0
        first = {k: np.zeros_like(w) for k, w in self.weights.items()}
        second = {k: np.zeros_like(w) for k, w in self.weights.items()}
        for epoch in range(epochs):
            rate = 0.02 * (1 - epoch / (epochs + 1))
            order = sorted(rng.permutation(len(pages)).tolist(), key=lambda p: len(pages[p][1]) // 4)
            groups = [order[i : i + 32] for i in range(0, len(order), 32)]
            for g in rng.permutation(len(groups)).tolist():
                chosen = [pages[p] for p in groups[g]]
                sizes = np.array([len(y) for _, y in chosen])
                rows, y = np.concatenate([x for x, _ in chosen]), np.concatenate([y for _, y in chosen])
                ahead, back, (at, page) = self._padded(rows, sizes)
                (f, kept_f), (b, kept_b) = self._read(ahead, "f"), self._read(back, "b")
                mirrored = sizes[page] - 1 - at
                states = np.concatenate((f[at, page], b[mirrored, page]), 1)
                wrong = (_sigmoid(states @ self.weights["v"] + self.weights["s"]) - y) / len(y)
                grads = {"v": states.T @ wrong, "s": wrong.sum(keepdims=True)}
                spread = wrong[:, None] * self.weights["v"]
                grown_f, grown_b = np.zeros_like(f), np.zeros_like(b)
                grown_f[at, page], grown_b[mirrored, page] = spread[:, :HIDDEN], spread[:, HIDDEN:]
                self._read_back(ahead, "f", kept_f, grown_f, grads)
                self._read_back(back, "b", kept_b, grown_b, grads)
                step += 1
                for k, grad in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * grad
                    second[k] = 0.99 * second[k] + 0.01 * grad * grad
                    move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                    self.weights[k] = (self.weights[k] - rate * move).astype(np.float32)


def _region(rnd: random.Random, main: bool) -> tuple[str, ...]:
    """A made-up wrapper that declares a region by tag, or by class in one of its spellings."""
    words = MAIN_WORDS if main else OTHER_WORDS[rnd.choice(sorted(OTHER_WORDS))]
    word = rnd.choice(words)
    tag = rnd.choice(["div", "div", "section", word])
    extra = rnd.choice([(), (), ("page",), ("site",), ("inner",), ("box",), ("wrap",), ("container",)])
    return (tag, *dict.fromkeys((word, *extra))) if tag != word else (word,)


def varied(pages: list[list[Block]], seed: int = 42) -> list[tuple[list[Block], list[bool]]]:
    """Training pages: the declared blocks as they are, renamed, bared, and among regions from elsewhere."""
    rnd = random.Random(seed)
    known = [[(b, declared(b)) for b in page] for page in pages]
    known = [[(b, y) for b, y in page if y is not None] for page in known]
    known = [page for page in known if any(y for _, y in page) and not all(y for _, y in page)]
    others = [b for page in known for b, y in page if not y]
    texts = [b for page in known for b, y in page if y]
    made = list(known)

    def last(b: Block) -> tuple[str, ...]:
        """The block's own tag without telling words."""
        return tuple(w for w in b.path[-1:] if w not in _DECLARED) or ("p",)

    def foreign() -> list[tuple[Block, bool]]:
        """A region of a few blocks that are not main text, some as long as paragraphs."""
        wrapper, n = _region(rnd, False), rnd.randint(1, 6)
        prose = rnd.random() < 0.5
        chosen = [rnd.choice(texts if prose else others) for _ in range(n)]
        tail = rnd.choice(TAILS)
        where = rnd.choice([("html", "body"), ("html", "body", "div"), ("html", "body", "article"), ("html", "body", "main")])
        return [(Block(where + wrapper + tail, b.text, 0.0 if prose else b.linked), False) for b in chosen]

    def touched(b: Block, path: tuple[str, ...]) -> Block:
        """A block of main text elsewhere in the tree, at times shorter or with links."""
        text = " ".join(b.text.split()[: rnd.randint(1, 8)]) if rnd.random() < 0.25 else b.text
        return Block(path, text, rnd.random() if rnd.random() < 0.2 else b.linked, b.heading)

    for page in known:
        wrapper = ("html", "body", *rnd.choice([(), ("div",), ("div", "container")]), *_region(rnd, True))
        renamed, region, before = [], _region(rnd, False), None
        odd = rnd.choice([0, 0, 0.1, 0.4])
        for b, y in page:
            if not y and b.path[:-1] != before:
                region, before = _region(rnd, False), b.path[:-1]
            tail = rnd.choice(TAILS) if y and rnd.random() < odd else last(b)
            path = (*wrapper, *tail) if y else ("html", "body", *region, *last(b))
            renamed.append((touched(b, path) if y else Block(path, b.text, b.linked, b.heading), y))
        made.append(renamed)
        mixed = list(rnd.choice([page, renamed]))
        for _ in range(rnd.randint(1, 3)):
            places = [0, len(mixed)] + [i for i in range(1, len(mixed)) if mixed[i - 1][1] != mixed[i][1] or rnd.random() < 0.2]
            at = rnd.choice(places)
            mixed[at:at] = foreign()
        made.append(mixed)
        root = rnd.choice([("html", "body"), ("html", "body"), ()])
        bare = [
            (Block((*root, *(last(b) if y else ("ul", "li"))), b.text, b.linked if y else 1.0, b.heading), y)
            for b, y in page if y or len(b.text) < 60
        ]
        made.append(bare)
    pieces = [page[i : i + PIECE] for page in made for i in range(0, len(page), PIECE)]
    return [([b for b, _ in page], [y for _, y in page]) for page in pieces]


def _writer(rnd: random.Random):
    """Made-up words, and sentences of them, in an alphabet of their own."""
    letters = rnd.choice(["etaoinshrdlucmfw", "eainrstulodmpbgv", "аеиностврлкдмпуя", "αειοστνρλκπδμυγθ", "的一是不了人我在有他这中大来上国", "ابتدرسعفقكلمنهوي"])
    parts = ["".join(rnd.choices(letters, k=rnd.randint(1, 3))) for _ in range(60)]
    words = ["".join(rnd.choices(parts, k=rnd.randint(1, 4))) for _ in range(200)]

    def phrase(least: int, most: int) -> str:
        return " ".join(rnd.choices(words, k=rnd.randint(least, most))).capitalize()

    def prose(sentences: int) -> str:
        return " ".join(phrase(3, 18) + rnd.choice(["...", ".", ".", ".", "!", "?"])[-1] for _ in range(max(1, sentences)))

    return phrase, prose


def made_up(count: int = MADE_UP_PAGES, seed: int = 7) -> list[tuple[list[Block], list[bool]]]:
    """Invented pages with their labels.

    A page marks its regions in one way: by known tags and classes, by unknown
    classes (one per kind of region), or not at all. Around the article, in the usual
    order, some of these: title, header, menu, notice, advert, side bar, comments,
    form, footer.
    """
    rnd, pages = random.Random(seed), []
    for _ in range(count):
        phrase, prose = _writer(rnd)
        marks = rnd.choice(["known", "unknown", "unknown", "none"])
        invented = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(3, 9))) for _ in range(20)]
        outer = rnd.choice([("html", "body"), ("html", "body"), ("body",), ()])
        outer = (*outer, *rnd.choice([(), (), ("div",), ("div", invented[0]), ("div", invented[0], "div")]))
        blocks: list[tuple[Block, bool]] = []

        def wrapper(kind: str) -> tuple[str, ...]:
            if marks == "known":
                return _region(rnd, kind == "main")
            if marks == "none":
                return rnd.choice([(), ("div",)])
            return (rnd.choice(["div", "div", "section", "td"]), invented[1 + ["main", *sorted(OTHER_WORDS)].index(kind)])

        def add(kind: str, tails: list[tuple[str, ...]], texts: list[tuple[str, float]]) -> None:
            where, heads = (*outer, *wrapper(kind)), ("h1", "h2", "h3")
            for tail, (text, linked) in zip(tails, texts):
                blocks.append((Block((*where, *tail), text, linked, bool(tail) and tail[-1] in heads), kind == "main"))

        def links(kind: str, least: int, most: int) -> None:
            n, tail = rnd.randint(least, most), rnd.choice([("ul", "li"), ("ul", "li"), ("p",), ("div",), ("li",)])
            add(kind, [tail] * n, [(phrase(1, 4), 1.0) for _ in range(n)])

        if rnd.random() < 0.7:
            title = phrase(2, 12)
            blocks.append((Block(("html", "head", "title"), title, 0.0), False))
        if rnd.random() < 0.5:
            linked = rnd.choice([0.0, 1.0]) if marks != "none" else 1.0
            add("header", [rnd.choice([("h1",), ("h2",), ("div",), ("p",)]), ("p",)], [(phrase(1, 3), linked), (phrase(2, 7), 0.0)][: rnd.randint(1, 2)])
        if rnd.random() < 0.85:
            links("menu", 2, 9)
        if rnd.random() < 0.35:
            add("notice", [rnd.choice([("p",), ()]), ("button",)], [(prose(rnd.randint(1, 2)), rnd.choice([0.0, 0.2])), (phrase(1, 2), 0.0)][: rnd.randint(1, 2)])
        if rnd.random() < 0.5:
            add("advert", [rnd.choice([(), ("p",), ("div",)])], [(prose(1), rnd.choice([0.0, 0.0, 1.0]))])
        before = rnd.random() < 0.3
        if before:
            links("sidebar", 2, 7)
        n = rnd.choice([1, 2, 3, 4, 5, 6, 8, 12, 25])
        tails, texts = [("p",)] * n, [(prose(rnd.choice([1, 1, 2, 3, 5, 9])), rnd.choice([0.0, 0.0, 0.0, 0.15])) for _ in range(n)]
        for i in range(n):
            if rnd.random() < 0.15:
                tails[i], texts[i] = rnd.choice([("h2",), ("h3",), ("ul", "li"), ("ol", "li"), ("blockquote", "p"), ("table", "tr", "td"), ("pre",)]), (phrase(2, 9), 0.0)
        if rnd.random() < 0.8:
            tails, texts = [rnd.choice([("h1",), ("h1",), ("h2",)]), *tails], [(phrase(2, 12), 0.0), *texts]
        add("main", tails, texts)
        if not before and rnd.random() < 0.3:
            links("sidebar", 2, 7)
        if rnd.random() < 0.35 and marks != "none":
            n = rnd.randint(1, 6)
            tail = rnd.choice([("ul", "li"), ("div",), ("div", "p"), ("ol", "li"), ("p",)])
            named = rnd.random() < 0.7
            some = [(phrase(1, 4), rnd.choice([0.0, 1.0])) if named and i % 2 else (prose(rnd.randint(1, 3)), 0.0) for i in range(1, 2 * n + 1)]
            head = [(("h3",), (phrase(1, 3), 0.0))] if rnd.random() < 0.6 else []
            add("comments", [t for t, _ in head] + [tail] * len(some), [x for _, x in head] + some)
        if rnd.random() < 0.3:
            add("form", [("label",), ("button",)], [(phrase(1, 4), 0.0), (phrase(1, 2), 0.0)])
        if rnd.random() < 0.85:
            rights = "© " + phrase(1, 5) + rnd.choice(["", ".", " · " + prose(rnd.randint(1, 3))])
            add("footer", [rnd.choice([(), (), ("p",), ("div",)])], [(rights if rnd.random() < 0.6 else phrase(1, 6), rnd.choice([0.0, 0.0, 0.5]))])
            if rnd.random() < 0.4:
                links("footer", 1, 5)
        pages.append(([b for b, _ in blocks], [y for _, y in blocks]))
    return pages


def train_labeller(pages: DataFrame, rows: int = SAMPLE_PAGES) -> Labeller:
    """Fit on the made-up pages, and on at most ``rows`` of the table: the ones first by hash of their id.

    A page without declared regions teaches nothing, and neither do null and empty pages; the
    made-up pages are enough for an answer.
    """
    known = pages.where("html IS NOT NULL").select("page_id", "html", F.xxhash64("html").alias("h"))
    drawn = first_by_hash(known.select(F.col("page_id").alias("id"), F.col("h").alias("k")), rows)
    # at most the sample is sent, and at most the sample comes back: equal rows are one
    found = known.join(F.broadcast(drawn), F.col("page_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("k")))
    texts = sorted(r["html"] for r in found.groupBy("page_id", "h").agg(F.min("html").alias("html")).collect())
    labeller, made = Labeller(), made_up() + varied([read_blocks(t) for t in texts])
    labeller.train([(block_vectors([blocks]), np.array(y, np.float32)) for blocks, y in made])
    return labeller


def main_texts(labeller: Labeller, pages: list[str]) -> list[str]:
    """Blocks labelled as main text, one per line."""
    read = [read_blocks(p) for p in pages]
    sizes = np.array([len(r) for r in read], np.int64)
    main = labeller.logits(block_vectors(read), sizes) > 0
    texts, at = [], 0
    for blocks in read:
        texts.append("\n".join(b.text for b, y in zip(blocks, main[at : at + len(blocks)]) if y))
        at += len(blocks)
    return texts


def extract(pages: DataFrame, labeller: Labeller) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages``; a null or empty page has an empty text."""
    given = pages.sparkSession.sparkContext.broadcast(labeller)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 4 * TOGETHER):
                part = batch.slice(first, 4 * TOGETHER)
                texts = main_texts(given.value, part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return pages.select(F.col("page_id").cast("bigint"), "url", F.coalesce("html", F.lit(""))).mapInArrow(
        per_batch, "page_id bigint, url string, text string, n_chars bigint"
    )
