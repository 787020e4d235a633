"""HTML extraction with a recurrent block labeller.

A page becomes its leaf blocks in order: runs of text without a block element between them. Each block is a vector
of its tag path (hashed tags and class names of its ancestors), its words (hashed, signed, averaged) and a few sizes.
A bidirectional LSTM, in numpy, reads the whole sequence both ways and labels every block as main text or not.

It is trained here, on a bounded sample of pages (`pages` of them, chosen by a hash of the id). Their blocks are
labelled by the page's own marks where it has an article or main element, and the same texts are laid out again in
other ways, with the menus, notices, adverts, forms, sidebars and comments of the templates below, so that the labeller
relies on no single layout. All pages are then labelled where they are read.

A raw element (script, style and their like) is one whose name is just that: svg-icon is an element like others. A
self-closed svg has no content, so that what follows it is text of the page.

Rows: a null or empty page, or one without a main block, has the text ''. Repeated rows get the same result each. If no
sampled page has an article or main element there is nothing to learn, and all blocks count as main text.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML's inline and void elements, and those whose content is not text of the page.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg iframe".split())
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
# Attributes of a tag. A quote opens a value only after "=" and where another closes it; values are of any length.
_ATTRIBUTES = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)|=)*+""")
_RAW_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
# The quoted values of other attributes are passed over whole: they may hold markup.
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|=\s*(?:"[^"]*+"|'[^']*+')""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")

#: What a page's own marks say, for training: elements and class words that hold no main text.
ASIDE_TAGS = frozenset("nav header footer aside form button select head menu dialog".split())
ASIDE_WORDS = frozenset("ad ads advert banner breadcrumb byline comment comments cookie discussion disqus feedback footer header login menu nav navbar newsletter notice popup promo related replies responses share sidebar signup social sponsor sponsored subscribe toolbar widget".split())
MAIN_TAGS = frozenset(("article", "main"))
SECTIONS = frozenset("nav article section aside footer header main".split())

PATH_DIMS, WORD_DIMS, SIZES = 160, 24, 6


@dataclass(frozen=True)
class Settings:
    pages: int = 160
    most_chars: int = 60_000
    hidden: int = 20
    epochs: int = 10
    rate: float = 0.01
    seed: int = 7


class Node:
    """An open element: its name, its class words and the element around it, which inner ones share."""

    __slots__ = ("inside", "places", "tag", "words")

    def __init__(self, tag: str, words: tuple[str, ...], inside: Node | None) -> None:
        self.tag, self.words, self.inside = tag, words, inside
        self.places = [_place(f"<{tag}>"), *map(_place, words)]


@lru_cache(maxsize=20_000)
def _place(name: str) -> int:
    return zlib.crc32(name.encode()) % PATH_DIMS


@dataclass(frozen=True)
class Block:
    text: str
    linked: int  # characters in links
    element: Node | None
    features: bytes  # which hashed names of elements and class words it is in, as bits
    label: float  # 1 for main text by the page's own marks

    @property
    def tag(self) -> str:
        return self.element.tag if self.element else ""

    @property
    def path(self) -> tuple[tuple[str, tuple[str, ...]], ...]:
        """Elements and class words, the outermost first."""
        found, node = [], self.element
        while node:
            found.append((node.tag, node.words))
            node = node.inside
        return tuple(reversed(found))


def tokens(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """The page in one pass: the text before each tag, the tag's name in small letters, whether it ends an element, and
    its attributes. Comments and declarations have the name '!', raw elements with their content '?'; '' is the end.

    Every step starts behind what the one before it has read. A tag that only ends within a quoted value ends at its
    first > instead, and from there on quotes mean nothing in the page.
    """
    text, at, quotes, last = 0, 0, True, page.rfind(">")
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            end = len(page) if end < 0 else end + 3
            yield page[text:start], "!", False, ""
            text = at = end
            continue
        if start > last:
            break
        if page[start + 1] in "!?":
            end = page.index(">", start) + 1
            yield page[text:start], "!", False, ""
            text = at = end
            continue
        m = _NAME.match(page, start)
        if not m or m.end() > last:
            at = start + 1 if not m else m.end()
            continue
        end = _ATTRIBUTES.match(page, m.end()).end() if quotes else -1
        if not quotes or end >= len(page):
            quotes = False
            end = page.index(">", m.end())
        name, attributes = m[1].lower(), page[m.end() : end]
        closes = page[start + 1] == "/"
        end += 1
        if name in RAW and not closes:
            if not (name == "svg" and attributes.endswith("/")):
                close = _RAW_ENDS[name].search(page, end)
                end = close.end() if close else len(page)
            name = "?"
        yield page[text:start], name, closes, attributes
        text = at = end
    yield page[text:], "", False, ""


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page, in order, with character references decoded and white space made single spaces."""
    found: list[Block] = []
    stack: list[Node] = []
    opened: Counter[str] = Counter()
    names = np.zeros(PATH_DIMS, np.int64)  # how many open elements have a name
    aside = main = link = linked = 0
    pieces: list[str] = []

    def end_block() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split()) if pieces else ""
        if text:
            found.append(Block(text, linked, stack[-1] if stack else None, np.packbits(names > 0).tobytes(), float(main > 0 and not aside)))
        pieces.clear()
        linked = 0

    def turn(node: Node, by: int) -> None:
        nonlocal aside, main
        opened[node.tag] += by
        for k in node.places:
            names[k] += by
        aside += by * (node.tag in ASIDE_TAGS or not ASIDE_WORDS.isdisjoint(node.words))
        main += by * (node.tag in MAIN_TAGS)

    for text, name, closes, attributes in tokens(page or ""):
        if text:
            pieces.append(text)
            if link:
                linked += len(text)
        if name == "!":
            continue
        if name == "?":
            pieces.append(" ")
            continue
        if name in INLINE:
            if name == "a":
                link = int(not closes)
            elif name == "br":
                pieces.append(" ")
            continue
        end_block()
        if closes:
            while opened[name] and (node := stack.pop()):
                turn(node, -1)
                if node.tag == name:
                    break
            continue
        if name in VOID or not name:
            continue
        if stack and stack[-1].tag == "p":  # a block ends an open paragraph
            turn(stack.pop(), -1)
        if name == "li":
            while opened["li"] and stack[-1].tag not in ("ul", "ol", "menu"):
                turn(stack.pop(), -1)
        words = tuple(w for named in _NAMES.findall(attributes) for w in _SPLIT.split("".join(named).lower()) if w)
        stack.append(Node(name, words, stack[-1] if stack else None))
        turn(stack[-1], 1)
        if name in SECTIONS:
            link = 0
    return found


def own_label(block: Block) -> float:
    """1 for main text by the page's own marks."""
    return block.label


# Layouts for training. {0} is filled with a page's own main blocks, {menu}, {links} and {a} to {f} with its other texts.
WRAPPERS = ('<article>{0}</article>', '<main>{0}</main>', '<div class="content">{0}</div>', '<div class="post entry">{0}</div>', '<div id="story">{0}</div>', '<div class="page"><section>{0}</section></div>', '<main><article class="body text">{0}</article></main>', '<article>{0}</article>', '<table><tr><td><ul>{menu}</ul></td><td>{0}</td></tr></table>', '<table class="layout"><tr><td>{links}</td><td>{0}</td><td>{c}</td></tr></table>')
BEFORE = ('<header><h1>{a}</h1></header>', '<div class="header">{a}</div>', '<nav><ul>{menu}</ul></nav>', '<div class="menu"><ul>{menu}</ul></div>', '<ul id="nav">{menu}</ul>', '<div class="notice">{b}</div>', '<div class="cookie banner"><p>{b}</p></div>', '<aside>{c}</aside>', '<div class="ad">{d}</div>', '<form><p>{e}</p></form>', '<div>{links}</div>', '<table><tr><td>{links}</td></tr></table>', '<div class="site header">{f}</div>', '<div class="top"><a href="/">{f}</a></div>')
AFTER = ('<footer>{a}</footer>', '<div id="footer"><p>{a}</p></div>', '<aside class="sidebar"><h2>{b}</h2><p>{c}</p></aside>', '<div class="sidebar">{c}</div>', '<section class="comments"><h2>{b}</h2><p>{d}</p><p>{c}</p></section>', '<div id="comments"><div class="comment"><p>{d}</p></div><div class="comment">{e}</div></div>', '<div class="related"><ul>{menu}</ul></div>', '<div class="advert"><p>{d}</p></div>', '<form class="newsletter">{e}</form>', '<div class="share">{a}</div>', '<div class="promo sponsored">{b}</div>', '<div class="discussion"><p>{d}</p><p>{e}</p></div>', '<section id="responses"><ol><li><p>{d}</p></li><li>{e}</li></ol></section>', '<div class="feedback"><h3>{b}</h3><p>{c}</p></div>')
WITHIN = ('<aside>{c}</aside>', '<div class="ad">{d}</div>', '<div class="notice">{b}</div>', '<nav><ul>{menu}</ul></nav>', '<form>{e}</form>', '<div class="comments"><p>{d}</p></div>', '<section id="comments"><p>{c}</p></section>', '<div class="share related">{a}</div>', '<div class="discussion"><p>{d}</p></div>')

FORMS = ("<p>{0}</p>",) * 12 + ("<ul><li>{0}</li></ul>", "<ol><li>{0}</li></ol>", "<blockquote>{0}</blockquote>", "<blockquote><p>{0}</p></blockquote>", *("<h2>{0}</h2>",) * 3, *("<h3>{0}</h3>",) * 2, "<h4>{0}</h4>", "<div>{0}</div>", "<table><tr><td>{0}</td></tr></table>", "<table><tr><th>{0}</th></tr></table>", "<section><p>{0}</p></section>", "<pre>{0}</pre>", "<pre><code>{0}</code></pre>", "<figure><img src='x'><figcaption>{0}</figcaption></figure>", "<figure><figcaption>{0}</figcaption></figure>", "<dl><dt>{0}</dt></dl>", "<dl><dd>{0}</dd></dl>", "<details><summary>{0}</summary></details>", "<p>{0} <code>x</code></p>")


def laid_out(main: list[Block], other: list[str], rng: np.random.Generator) -> tuple[list[Block], list[float]]:
    """A page's texts in another layout, and its labels. Some main blocks are cut to a few words, as captions and terms are."""
    wanted = {b.text for b in main}
    lines = [t for t in [*other, *(" ".join(b.text.split()[:12]) for b in main)] if t and t not in wanted] or ["menu"]
    pick = lambda: html.escape(lines[rng.integers(len(lines))])
    links = lambda: "".join(f'<a href="#">{pick()}</a> ' for _ in range(2))
    fill = lambda s, inner="": s.format(inner, links=links(), menu="".join(f'<li><a href="#">{pick()}</a></li>' for _ in range(3)), f=" ".join(pick().split()[:2]), **{k: pick() for k in "abcde"})
    some = lambda options, most: "".join(fill(options[k]) for k in rng.permutation(len(options))[: rng.integers(1, most + 1)])
    parts, marked = [], set()
    for b in main:
        text = b.text
        if b.tag == "h1":
            form = "<h1>{0}</h1>"
        else:
            form = FORMS[rng.integers(len(FORMS))]
            if rng.random() < 0.3:
                words = text.split()
                at = rng.integers(len(words))
                text = " ".join(words[at : at + 1 + rng.integers(5)])
        parts.append(form.format(html.escape(text)))
        marked |= {text, f"{text} x"}
    for _ in range(rng.integers(0, 3)):
        parts.insert(rng.integers(len(parts) + 1), fill(WITHIN[rng.integers(len(WITHIN))]))
    page = f"<html><head><title>{pick()}</title></head><body>{some(BEFORE, 4)}{fill(WRAPPERS[rng.integers(len(WRAPPERS))], ''.join(parts))}{some(AFTER, 4)}</body></html>"
    found = blocks(page)
    return found, [float(b.text in marked) for b in found]


def vectors(found: list[Block]) -> np.ndarray:
    """A row for each block."""
    out = np.zeros((len(found), PATH_DIMS + WORD_DIMS + SIZES), np.float32)
    bits = np.frombuffer(b"".join(b.features for b in found), np.uint8).reshape(len(found), -1)
    out[:, :PATH_DIMS] = np.unpackbits(bits, axis=1)[:, :PATH_DIMS]
    for k, b in enumerate(found):
        if b.element:
            out[k, _place(f"last {b.tag}")] = 1
        words = b.text.encode("utf-8", "replace").split()
        hashes = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
        out[k, PATH_DIMS : PATH_DIMS + WORD_DIMS] = np.bincount(hashes % WORD_DIMS, 1.0 - 2.0 * (hashes >> 20 & 1), WORD_DIMS) / max(len(words), 1)
        n = len(b.text)
        out[k, PATH_DIMS + WORD_DIMS :] = (np.log1p(n) / 8, np.log1p(len(words)) / 6, min(b.linked / n, 1), b.text[-1] in ".!?", k / len(found), 1)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM over sequences of block vectors, one output for each block."""

    def __init__(self, settings: Settings) -> None:
        rng = np.random.default_rng(settings.seed)
        dims, self.h = PATH_DIMS + WORD_DIMS + SIZES, settings.hidden
        self.p: dict[str, np.ndarray] = {"out": rng.normal(0, 0.2, (2 * self.h, 1)), "bias": np.zeros(1)}
        for d in "fb":
            self.p |= {f"x{d}": rng.normal(0, 0.1, (dims, 4 * self.h)), f"h{d}": rng.normal(0, 0.1, (self.h, 4 * self.h)), f"o{d}": np.repeat([0.0, 1.0, 0.0, 0.0], self.h)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """x: steps, sequences, dims. The state of a sequence stands still where its mask is 0."""
        steps, n, _ = x.shape
        h = c = np.zeros((n, self.h), np.float32)
        into, out, tape = x @ self.p[f"x{d}"] + self.p[f"o{d}"], np.empty((steps, n, self.h), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            gates = into[t] + h @ self.p[f"h{d}"]
            i, f, o = (_sigmoid(gates[:, k * self.h : (k + 1) * self.h]) for k in range(3))
            g, m = np.tanh(gates[:, 3 * self.h :]), mask[t][:, None]
            new = f * c + i * g
            th = np.tanh(new)
            if keep:
                tape.append((t, h, c, i, f, o, g, th))
            h, c = m * (o * th) + (1 - m) * h, m * new + (1 - m) * c
            out[t] = h
        return out, tape

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, mask, d, False)[0] for d in "fb"], axis=2)
        return (both @ self.p["out"])[:, :, 0] + self.p["bias"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        runs = {d: self._run(x, mask, d, True) for d in "fb"}
        both = np.concatenate([runs[d][0] for d in "fb"], axis=2)
        z = (both @ self.p["out"])[:, :, 0] + self.p["bias"]
        dz = ((_sigmoid(z) - y) * mask / max(mask.sum(), 1)).astype(np.float32)[:, :, None]
        grad = {"out": np.tensordot(both, dz, ([0, 1], [0, 1])), "bias": dz.sum(axis=(0, 1))}
        dboth = dz @ self.p["out"].T
        for k, d in enumerate("fb"):
            dgates = np.zeros((*x.shape[:2], 4 * self.h), np.float32)
            gh = np.zeros_like(self.p[f"h{d}"])
            dh = dc = np.zeros((x.shape[1], self.h), np.float32)
            for t, h, c, i, f, o, g, th in reversed(runs[d][1]):
                m = mask[t][:, None]
                dh = dh + dboth[t, :, k * self.h : (k + 1) * self.h]
                through = m * dh
                dnew = through * o * (1 - th * th) + m * dc
                dgates[t] = np.hstack([dnew * g * i * (1 - i), dnew * c * f * (1 - f), through * th * o * (1 - o), dnew * i * (1 - g * g)])
                gh += h.T @ dgates[t]
                dh, dc = (1 - m) * dh + dgates[t] @ self.p[f"h{d}"].T, (1 - m) * dc + dnew * f
            grad |= {f"x{d}": np.tensordot(x, dgates, ([0, 1], [0, 1])), f"h{d}": gh, f"o{d}": dgates.sum(axis=(0, 1))}
        return grad

    def train(self, sequences: list[tuple[np.ndarray, np.ndarray]], settings: Settings) -> None:
        rng = np.random.default_rng(settings.seed)
        first, second, step = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2)), None, 0
        first, second = first
        for epoch in range(settings.epochs):
            order = sorted(rng.permutation(len(sequences)), key=lambda k: len(sequences[k][0]) // 8)
            groups = [order[k : k + 16] for k in range(0, len(order), 16)]
            for g in rng.permutation(len(groups)):
                x, mask = padded([sequences[k][0] for k in groups[g]])
                y = padded([sequences[k][1][:, None] for k in groups[g]])[0][:, :, 0]
                step += 1
                rate = settings.rate * (1 - epoch / (settings.epochs + 1))
                for k, v in self.gradients(x, mask, y).items():
                    first[k] = 0.9 * first[k] + 0.1 * v
                    second[k] = 0.99 * second[k] + 0.01 * v * v
                    self.p[k] = self.p[k] - (rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Steps, sequences, dims; and which steps there are."""
    steps = max(map(len, sequences))
    x = np.zeros((steps, len(sequences), sequences[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(sequences)), np.float32)
    for k, s in enumerate(sequences):
        x[: len(s), k], mask[: len(s), k] = s, 1
    return x, mask


#: Other layouts that each page of the sample is trained in, and how many there are at least of all pages together.
LAYOUTS, LEAST_SEQUENCES = 5, 240


def fit(pages: DataFrame, settings: Settings = Settings(), content: str = "html") -> Labeller | None:
    """A labeller trained on a bounded sample of pages; None if they have no marks to learn from.

    The sample are the `pages` distinct contents with the least hashes: repeats of a page count once.
    """
    usable = pages.filter(F.col(content).isNotNull() & (F.length(content) <= settings.most_chars)).select(F.pmod(F.xxhash64(content), F.lit(1 << 31)).alias("h"), F.col(content).alias("t"))
    # about twice as many contents have a hash below the bound, whatever the number of tasks; the limit makes it exact
    share = min(1.0, 2 * settings.pages / max(usable.agg(F.approx_count_distinct("h")).first()[0], 1))
    hashed = usable.filter(F.col("h") <= int(share * (1 << 31))).groupBy("h").agg(F.min("t").alias("t"))
    rng, sequences = np.random.default_rng(settings.seed), []
    sample = [r.t for r in hashed.orderBy("h").limit(settings.pages).collect()]
    layouts = max(LAYOUTS, -(-LEAST_SEQUENCES // max(len(sample), 1)))
    for page in sample:
        found = blocks(page)
        labels = [own_label(b) for b in found]
        main = [b for b, y in zip(found, labels, strict=True) if y]
        if not main:
            continue
        sequences.append((vectors(found), np.array(labels, np.float32)))
        for _ in range(layouts):
            again, y = laid_out(main, [b.text for b, y in zip(found, labels, strict=True) if not y], rng)
            sequences.append((vectors(again), np.array(y, np.float32)))
    if not sequences:
        return None
    model = Labeller(settings)
    model.train(sequences, settings)
    return model


def main_texts(pages: list[str | None], model: Labeller | None) -> list[str]:
    """The main text of each page: its main blocks, with an empty line between them."""
    found = [blocks(p) for p in pages]
    keep = [np.ones(len(b), bool) for b in found]
    order = sorted((k for k in range(len(found)) if found[k]), key=lambda k: len(found[k]))
    start = 0
    while model and start < len(order):
        end = start + 1  # pages of like length together, within bounds for the padded array
        while end < len(order) and end - start < 64 and len(found[order[end]]) * (end - start + 1) <= max(4096, len(found[order[start]])):
            end += 1
        x, mask = padded([vectors(found[k]) for k in order[start:end]])
        scores = model.scores(x, mask)
        for column, k in enumerate(order[start:end]):
            keep[k] = scores[: len(found[k]), column] > 0
        start = end
    return ["\n\n".join(b.text for b, y in zip(some, own, strict=True) if y) for some, own in zip(found, keep, strict=True)]


def extract(pages: DataFrame, model: Labeller | None, content: str = "html") -> DataFrame:
    """pages without their markup, with text and n_chars (its code points); other columns of these names are replaced."""
    rest = [c for c in pages.columns if c not in ("text", "n_chars", content)]
    shared = pages.sparkSession.sparkContext.broadcast(model)  # its size is set by the settings
    fields = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = main_texts(part.column(len(rest)).to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*rest, "text", "n_chars"])

    return pages.select(*rest, content).mapInArrow(run, f"{fields}, text string, n_chars bigint")
