"""Main text of web pages by a recurrent labeller over their blocks.

A page becomes the sequence of its leaf blocks. A bidirectional LSTM in numpy
reads, for each block, a vector of its tag path and hashed words, and decides with
the whole page as context whether the block is main text. Pages carry no labels,
so the model learns from structure: on a bounded sample, blocks inside an article
or main element count as main text unless something in between says otherwise.
It also learns from changed copies of the sample: with comments, forms and asides put
in that hold article text of other pages, and with the telling tags swapped for plain ones.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.common import whole_text
from sightline.session import cut

# Pages that the model is fitted on.
FIT_PAGES = 384
# The sample is drawn from at least this many times as many distinct pages, where there are so many.
SPARE = 4
PATH = 128
WORDS = 32
NUMBERS = 6
INPUT = PATH + WORDS + NUMBERS
HIDDEN = 20
EPOCHS = 10
GROUP = 64
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span "
    "strike strong sub sup time tt u var".split()
)
_MAIN = frozenset(("article", "main"))
_SET_APART = frozenset(
    "nav header footer aside form script style noscript head title menu button select textarea iframe svg template "
    "dialog".split()
)
_REPLIES = frozenset("comment comments reply replies".split())
_NAMED_APART = _REPLIES | frozenset(
    "nav navbar menu header footer aside ad ads advert adverts advertisement sponsor sponsored promo sidebar "
    "notice cookie cookies banner consent breadcrumb breadcrumbs pagination share social related newsletter".split()
)
# Names such as no-sidebar tell of what is elsewhere.
_ABOUT_OTHERS = frozenset("no has with without".split())

# An element of a path: its tag and the words of each of its names.
Element = tuple[str, tuple[tuple[str, ...], ...]]
Block = tuple[tuple[Element, ...], str, int]


class _Blocks(HTMLParser):
    """Leaf blocks (path, text, characters in links) in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[Element] = []
        self.blocks: list[Block] = []
        self.text: list[str] = []
        self.linked = 0
        self.path: tuple[Element, ...] = ()

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.blocks.append((self.path, text, self.linked))
        self.text, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in _INLINE:
            self.stack.append((tag, ()))
            return
        self.flush()
        if tag in _VOID:
            return
        while self.stack and (self.stack[-1][0] in _INLINE or self.stack[-1][0] == tag in ("p", "li")):
            self.stack.pop()
        named = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role")).lower().split()
        self.stack.append((tag, tuple(tuple(re.findall("[a-z0-9]+", name)) for name in named)))

    def handle_startendtag(self, tag, attrs):
        if tag not in _INLINE:
            self.flush()

    def handle_endtag(self, tag):
        if tag not in _INLINE:
            self.flush()
        if any(name == tag for name, _ in self.stack):
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not self.text:
            self.path = tuple(element for element in self.stack if element[0] not in _INLINE)
        self.text.append(data)
        if any(name == "a" for name, _ in self.stack):
            self.linked += len(data)


def blocks(html: str) -> list[Block]:
    """Leaf blocks of a page; broken markup gives the blocks that can be told."""
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.blocks


def _named(element: Element, words: frozenset[str]) -> bool:
    return any(name and name[0] not in _ABOUT_OTHERS and not words.isdisjoint(name) for name in element[1])


def _apart(element: Element) -> bool:
    return element[0] in _SET_APART or _named(element, _NAMED_APART)


def weak_label(path: tuple[Element, ...]) -> int:
    """1 for a block of an article or main element with nothing set apart around or inside.

    The outermost such element counts, and what it is called tells nothing but that
    it is a comment itself.
    """
    root = next((k for k, (tag, _) in enumerate(path) if tag in _MAIN), None)
    if root is None or any(_named(element, _REPLIES) for element in path):
        return 0
    return int(not any(tag in _SET_APART for tag, _ in path[:root]) and not any(map(_apart, path[root + 1 :])))


def _slot(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % size


@lru_cache(4096)
def _path_vector(path: tuple[Element, ...]) -> tuple[np.ndarray, bool]:
    """The tags and names of a path, and whether one of them sets its text apart."""
    x = np.zeros(PATH, np.float32)
    for tag, names in path:
        x[_slot(tag, PATH)] = 1
        for name in names:
            for word in name[:1] if name and name[0] in _ABOUT_OTHERS else name:
                x[_slot("." + word, PATH)] = 1
    if path:
        x[_slot("/" + path[-1][0], PATH)] = 1
    return x, any(map(_apart, path))


def vectors(found: list[Block]) -> np.ndarray:
    """One input row for each block: tag path, hashed words of the whole block, lengths and place."""
    x = np.zeros((len(found), INPUT), np.float32)
    for k, (path, text, linked) in enumerate(found):
        x[k, :PATH], apart = _path_vector(path)
        words = text.encode("utf-8", "replace").split(b" ")
        total = len(words)
        slots = [crc % WORDS for crc in map(zlib.crc32, words)]
        x[k, PATH : PATH + WORDS] = np.bincount(slots, minlength=WORDS) / total
        x[k, PATH + WORDS :] = (
            np.log1p(len(text)) / 8,
            linked / max(1, len(text)),
            k / max(1, len(found)),
            sum(text.count(c) for c in ".,;:!?") / total,
            len(path) / 8,
            apart,
        )
    return x


# What is put into articles to learn from, as paths below the article.
_INSERTS: tuple[tuple[Element, ...], ...] = (
    (("section", (("comments",),)), ("div", (("comment",),)), ("p", ())),
    (("div", (("comments",),)), ("ul", ()), ("li", (("comment", "body"),))),
    (("div", (("comment",), ("reply",))), ("p", ())),
    (("section", (("replies",),)), ("article", (("comment",),)), ("p", ())),
    (("aside", ()), ("p", ())),
    (("aside", (("related",),)), ("h3", ())),
    (("div", (("sidebar",),)), ("p", ())),
    (("div", (("sponsored",),)), ("p", ())),
    (("div", (("ad",),)),),
    (("div", (("newsletter",),)), ("p", ())),
    (("div", (("cookie", "notice"),)), ("p", ())),
    (("form", ()), ("p", ())),
    (("form", ()), ("label", ())),
    (("nav", ()), ("ul", ()), ("li", ())),
)
_BODIES: tuple[Element, ...] = (
    ("div", ()),
    ("div", (("content",),)),
    ("div", (("post",),)),
    ("div", (("entry", "content"),)),
    ("div", (("story",),)),
    ("section", ()),
    ("main", ()),
)
# Names that an article may have.
_TITLES = ("post", "entry", "hentry", "page", "full", "single", "no", "has", "text", "blog")


def varied(page: list[Block], labels: list[int], others: list[str], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """A changed copy of a page to learn from: blocks that do not belong put in, tags swapped.

    ``others`` are texts of articles, so that words alone do not tell what was put in.
    """
    body, swapped = _BODIES[rng.integers(len(_BODIES))], rng.random() < 0.5
    called = tuple((str(name),) for name in rng.choice(_TITLES, rng.integers(0, 4), replace=False))
    inside = [k for k, y in enumerate(labels) if y]
    if inside and others:
        root = page[inside[0]][0]
        upto = next(k for k, (tag, _) in enumerate(root) if tag in _MAIN) + 1
        made: list[tuple[int, Block]] = []
        for _ in range(rng.integers(1, 4)):
            path = root[:upto] + _INSERTS[rng.integers(len(_INSERTS))]
            place = inside[-1] + 1 if rng.random() < 0.6 else int(rng.choice(inside)) + 1
            for _ in range(rng.integers(1, 4)):
                words = others[rng.integers(len(others))].split(" ")
                made.append((place, (path, " ".join(words[: rng.integers(1, len(words) + 1)]), 0)))
        page, labels = list(page), list(labels)
        for place, block in sorted(made, key=lambda m: -m[0]):
            page.insert(place, block)
            labels.insert(place, 0)

    def changed(element: Element) -> Element:
        if element[0] not in _MAIN or _named(element, _REPLIES):
            return element
        return body if swapped else (element[0], element[1] + called)

    return [(tuple(map(changed, path)), text, linked) for path, text, linked in page], labels


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _start(rng: np.random.Generator) -> dict[str, np.ndarray]:
    model = {"out": rng.normal(0, 0.2, (2 * HIDDEN + 1,))}
    for side in ("f", "b"):
        model[side] = rng.normal(0, 1 / np.sqrt(INPUT), (INPUT + HIDDEN + 1, 4 * HIDDEN))
        model[side][-1, HIDDEN : 2 * HIDDEN] = 1.0
    return model


def _forward(weights: np.ndarray, x: np.ndarray, mask: np.ndarray):
    """One direction over (time, pages, inputs); states do not move where the mask is 0."""
    h = np.zeros((x.shape[1], HIDDEN))
    c = np.zeros_like(h)
    given = x @ weights[:INPUT] + weights[-1]
    steps, states = [], []
    for t in range(len(x)):
        z = given[t] + h @ weights[INPUT:-1]
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        on = mask[t][:, None]
        new_c = on * (f * c + i * g) + (1 - on) * c
        new_h = on * (o * np.tanh(new_c)) + (1 - on) * h
        steps.append((h, c, i, f, o, g, new_c))
        h, c = new_h, new_c
        states.append(h)
    return np.array(states), steps


def _backward(weights: np.ndarray, x: np.ndarray, mask: np.ndarray, steps: list, d_states: np.ndarray) -> np.ndarray:
    grad = np.zeros_like(weights)
    dh = np.zeros((x.shape[1], HIDDEN))
    dc = np.zeros_like(dh)
    for t in reversed(range(len(x))):
        h, c, i, f, o, g, new_c = steps[t]
        on = mask[t][:, None]
        dh = dh + d_states[t]
        tanh_c = np.tanh(new_c)
        live_h = dh * on
        d_new = dc + live_h * o * (1 - tanh_c**2)
        live_c = d_new * on
        dz = np.concatenate(
            [live_c * g * i * (1 - i), live_c * c * f * (1 - f), live_h * tanh_c * o * (1 - o), live_c * i * (1 - g**2)], axis=1
        )
        grad[:INPUT] += x[t].T @ dz
        grad[INPUT:-1] += h.T @ dz
        grad[-1] += dz.sum(axis=0)
        dh = dz @ weights[INPUT:-1].T + dh * (1 - on)
        dc = live_c * f + d_new * (1 - on)
    return grad


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(len(p) for p in pages)
    x = np.zeros((longest, len(pages), INPUT))
    mask = np.zeros((longest, len(pages)))
    for k, p in enumerate(pages):
        x[: len(p), k] = p
        mask[: len(p), k] = 1
    return x, mask


def _scored(model: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray):
    ahead, steps_f = _forward(model["f"], x, mask)
    back, steps_b = _forward(model["b"], x[::-1], mask[::-1])
    both = np.concatenate([ahead, back[::-1]], axis=2)
    return _sigmoid(both @ model["out"][:-1] + model["out"][-1]), both, steps_f, steps_b


def train(pages: list[np.ndarray], labels: list[np.ndarray], seed: int = 20_240_311) -> dict[str, np.ndarray]:
    """Fit by Adam on the log loss of every block. Pages without blocks are left out."""
    rng = np.random.default_rng(seed)
    model = _start(rng)
    known = [(p, y) for p, y in zip(pages, labels, strict=True) if len(p)]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(known))
        for at in range(0, len(order), 16):
            chosen = [known[k] for k in order[at : at + 16]]
            x, mask = _padded([p for p, _ in chosen])
            y = np.zeros_like(mask)
            for k, (_, label) in enumerate(chosen):
                y[: len(label), k] = label
            p, both, steps_f, steps_b = _scored(model, x, mask)
            d = (p - y) * mask / mask.sum()
            d_both = d[:, :, None] * model["out"][:-1]
            grads = {
                "out": np.concatenate([np.einsum("tp,tph->h", d, both), [d.sum()]]),
                "f": _backward(model["f"], x, mask, steps_f, d_both[:, :, :HIDDEN]),
                "b": _backward(model["b"], x[::-1], mask[::-1], steps_b, d_both[::-1, :, HIDDEN:]),
            }
            step += 1
            for k, g in grads.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                model[k] -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def label(model: dict[str, np.ndarray], pages: list[np.ndarray]) -> list[np.ndarray]:
    """Whether each block of each page is main text; pages of like length go together."""
    out = [np.zeros(0, bool)] * len(pages)
    order = [k for k in np.argsort([len(p) for p in pages], kind="stable") if len(pages[k])]
    for at in range(0, len(order), GROUP):
        group = order[at : at + GROUP]
        x, mask = _padded([pages[k] for k in group])
        p = _scored(model, x, mask)[0]
        for column, k in enumerate(group):
            out[k] = p[: len(pages[k]), column] >= 0.5
    return out


def sample(pages: DataFrame, html_column: str = "html") -> list[str]:
    """At most ``FIT_PAGES`` distinct pages, those whose html has the least hashes.

    Hashes over a limit that follows the number of distinct pages are left out first,
    so that partitions do not each send a sample of their own.
    """
    hashed = pages.select(whole_text(html_column).alias("html")).withColumn("hash", F.xxhash64("html"))
    distinct = hashed.agg(F.approx_count_distinct("hash")).head()[0]
    share = min(1.0, SPARE * FIT_PAGES / max(1, distinct))
    if share < 1:
        hashed = hashed.where(F.col("hash") < int(-(2**63) + share * 2**64))
    chosen = cut(hashed.groupBy("hash").agg(F.min("html").alias("html"))).orderBy("hash").limit(FIT_PAGES)
    return [r["html"] for r in chosen.collect()]


def learnt(htmls: list[str], seed: int = 20_240_311) -> dict[str, np.ndarray]:
    """The model of some pages and of a changed copy of each."""
    rng = np.random.default_rng(seed)
    found = [blocks(html) for html in htmls]
    labels = [[weak_label(path) for path, _, _ in page] for page in found]
    others = [text for page, known in zip(found, labels, strict=True) for (_, text, _), y in zip(page, known, strict=True) if y]
    pairs = list(zip(found, labels, strict=True))
    # A few pages are changed more often, so that every kind of change is met.
    changed = FIT_PAGES if pairs else 0
    pairs += [varied(*pairs[k % len(found)], others, rng) for k in range(changed)]
    return train([vectors(page) for page, _ in pairs], [np.array(known, np.float64) for _, known in pairs])


def fit(pages: DataFrame, html_column: str = "html") -> dict[str, np.ndarray]:
    """Fit on at most ``FIT_PAGES`` distinct pages and changed copies of them."""
    return learnt(sample(pages, html_column))


def extract(
    pages: DataFrame,
    model: dict[str, np.ndarray] | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """page_id, url, text, n_chars for every row.

    A null or empty html, and a page without main text, give an empty text. Line
    breaks part blocks; characters are decoded and white space inside a block is
    one space. Nothing is cut off. Repeated rows are extracted each; an empty table
    gives an empty result.
    """
    model = fit(pages, html_column) if model is None else model
    chosen = pages.select(
        F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), whole_text(html_column).alias("html")
    )
    kinds = [chosen.schema[c].dataType.simpleString() for c in ("page_id", "url")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 256):
                batch = big.slice(at, 256)
                found = [blocks(h.as_py()) for h in batch.column("html")]
                kept = label(model, [vectors(page) for page in found])
                texts = [
                    "\n\n".join(text for (_, text, _), k in zip(page, keep, strict=True) if k)
                    for page, keep in zip(found, kept, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
                )

    out = chosen.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
