"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into blocks at block-level tags.  Each block is described by its word count
and link density, those of its neighbours, and what encloses it; a decision tree trained
on the small labelled table of ``labelled_pages`` decides which blocks are main text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tags that end a text block (fixed by the HTML standard's rendering rules).
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav noscript ol optgroup option p pre search section select summary table "
    "tbody td textarea tfoot th thead title tr ul".split()
)
#: Tags without an end tag.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags whose content is no text of the page.
HIDDEN_TAGS = frozenset(
    "audio button canvas datalist head iframe math noframes noscript object option script select style "
    "svg template textarea title video".split()
)
#: Tags that hold what surrounds an article.
AROUND_TAGS = frozenset("aside dialog footer form header menu nav search".split())
#: Words in class, id and role names of what surrounds an article.
AROUND_NAMES = frozenset(
    "ad ads adv advert advertisement advertising alert banner breadcrumb breadcrumbs byline comment "
    "comments consent cookie cookies copyright disqus dialog footer gdpr header hidden login masthead menu "
    "modal nav navbar navigation newsletter notice notification overlay pager pagination popup promo "
    "promoted promotion recommend recommended related reply replies share sharing sidebar signup skip "
    "social sponsor sponsored subscribe subscription tags toolbar widget contentinfo complementary".split()
)
#: Words in names of what holds an article.
MAIN_NAMES = frozenset("article articlebody body content entry main maincontent post story text".split())

_RAW_TAGS = "script|style|textarea|title|iframe|noframes|template|svg|math"
# Each character is taken in one way only, so a tag that is cut off costs one pass.
_INSIDE = r"(?>=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+"
_MARK = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<(?P<raw>{_RAW_TAGS})\b{_INSIDE}>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<more>{_INSIDE})(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_UNSEEN = re.compile(r"(?:^|\s)hidden(?:[\s=]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORD = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

FEATURES = [
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
    "around", "inside_article", "any_article", "heading", "list_item",
]


@dataclass
class Block:
    """One run of text between block-level tags."""

    text: str
    words: int
    linked: int
    around: bool
    article: bool
    heading: bool
    item: bool

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


@dataclass
class _Open:
    tag: str
    around: bool
    article: bool
    unseen: bool


@dataclass
class _Reader:
    blocks: list[Block] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    links: int = 0  # 1 inside a link; an unclosed one ends with its block

    def text(self, raw: str) -> None:
        if not raw or (self.stack and self.stack[-1].unseen):
            return
        text = unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        if self.links:
            self.linked += len(text.split())

    def flush(self) -> None:
        if self.parts:
            words = "".join(self.parts).split()
            if words:
                inner = self.stack[-1] if self.stack else _Open("", False, False, False)
                tags = [o.tag for o in self.stack[-6:]]
                heading = any(len(t) == 2 and t[0] == "h" and t[1] in "123456" for t in tags)
                self.blocks.append(
                    Block(
                        " ".join(words), len(words), min(self.linked, len(words)), inner.around,
                        inner.article, heading, "li" in tags or "td" in tags,
                    )
                )
        self.parts, self.linked = [], 0

    def open(self, tag: str, more: str) -> None:
        if tag == "p" and self.stack:
            self.close_until("p", within=BLOCK_TAGS - {"p"})
        names: set[str] = set()
        if more:
            for _, a, b, c in _NAMES.findall(more):
                for name in (a or b or c).split():
                    names.add(name.lower().replace("-", "").replace("_", ""))
                    names.update(w.lower() for w in _WORD.findall(_CAMEL.sub(" ", name)))
        up = self.stack[-1] if self.stack else _Open("", False, False, False)
        article = tag in ("article", "main") or bool(names & MAIN_NAMES and tag not in ("html", "body"))
        wraps = tag in ("html", "body", "article", "main")
        around = not wraps and (tag in AROUND_TAGS or bool(names & AROUND_NAMES))
        # an article's own header holds its title
        around = around and not (tag == "header" and up.article and not names & AROUND_NAMES)
        unseen = up.unseen or tag in HIDDEN_TAGS or bool(more and _UNSEEN.search(more))
        self.stack.append(_Open(tag, up.around or around, up.article or article, unseen))

    def close_until(self, tag: str, within: frozenset[str] | None = None) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return
            if within is not None and self.stack[i].tag in within:
                return


def text_blocks(html: str) -> list[Block]:
    """The visible text blocks of a page in order, references decoded."""
    reader = _Reader()
    last = 0
    for mark in _MARK.finditer(html):
        reader.text(html[last : mark.start()])
        last = mark.end()
        tag = mark["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            reader.text(" ")
            continue
        if tag in BLOCK_TAGS:
            reader.flush()
        if mark["end"]:
            if tag == "a" or tag in ("article", "li", "nav", "p", "section", "td", "ul"):
                reader.links = 0
            if tag not in VOID_TAGS:
                reader.close_until(tag)
        elif tag not in VOID_TAGS:
            if tag == "a":
                reader.links = 1
            reader.open(tag, mark["more"])
    reader.text(html[last:])
    reader.flush()
    return reader.blocks


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block in the order of ``FEATURES``."""
    n = len(blocks)
    words = np.array([b.words for b in blocks], float)
    density = np.array([b.density for b in blocks], float)
    article = np.array([b.article for b in blocks], float)
    return np.column_stack(
        [
            words, density,
            np.append(0, words[:-1])[:n], np.append(0, density[:-1])[:n],
            np.append(words[1:], 0)[:n], np.append(density[1:], 0)[:n],
            np.array([b.around for b in blocks], float), article,
            np.full(n, float(article.any())),
            np.array([b.heading for b in blocks], float), np.array([b.item for b in blocks], float),
        ]
    )


@dataclass
class Node:
    """A leaf (``answer``) or a split of a decision tree."""

    answer: float
    column: int = -1
    limit: float = 0.0
    low: Node | None = None
    high: Node | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.low is None or self.high is None:
            return np.full(len(x), self.answer)
        out = np.empty(len(x))
        left = x[:, self.column] <= self.limit
        out[left] = self.low.predict(x[left])
        out[~left] = self.high.predict(x[~left])
        return out


def _impurity(y: np.ndarray, w: np.ndarray) -> float:
    total = w.sum()
    p = (y * w).sum() / total if total else 0.0
    return float(total * 2 * p * (1 - p))


def grow_tree(x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int = 6, least: int = 2) -> Node:
    """A tree by least Gini impurity; ``w`` weighs the rows."""
    node = Node(float((y * w).sum() / w.sum()))
    whole = _impurity(y, w)
    if depth == 0 or whole == 0 or len(y) < 2 * least:
        return node
    best = (whole - 1e-9, -1, 0.0)
    for column in range(x.shape[1]):
        values = np.unique(x[:, column])
        for limit in (values[:-1] + values[1:]) / 2:
            left = x[:, column] <= limit
            if least <= left.sum() <= len(y) - least:
                left_over = _impurity(y[left], w[left]) + _impurity(y[~left], w[~left])
                if left_over < best[0] - 1e-12:
                    best = (left_over, column, float(limit))
    if best[1] < 0:
        return node
    left = x[:, best[1]] <= best[2]
    node.column, node.limit = best[1], best[2]
    node.low = grow_tree(x[left], y[left], w[left], depth - 1, least)
    node.high = grow_tree(x[~left], y[~left], w[~left], depth - 1, least)
    return node


def _words(n: int) -> str:
    return " ".join(["word"] * n)


def labelled_pages() -> list[tuple[str, list[int]]]:
    """The labelled table: small pages and, per text block, whether it is main text."""
    menu = "<nav><ul><li><a href='/a'>One</a></li><li><a href='/b'>Two more</a></li></ul></nav>"
    links = "<div><a href='/x'>{}</a> <a href='/y'>{}</a></div>".format(_words(3), _words(4))
    pages: list[tuple[str, list[int]]] = []
    for short, long in ((1, 30), (3, 60), (8, 120), (15, 25)):
        body = f"<h1>{_words(6)}</h1><p>{_words(long)}</p><p>{_words(short)}</p><p>{_words(long)}</p>"
        item = f"<p>{_words(long)}</p><ul><li>{_words(short)}</li><li>{_words(12)}</li></ul><p>{_words(short)}</p>"
        foot = f"<footer>{_words(short + 6)}</footer>"
        advert = f"<div class='ad'>{_words(short + 5)}</div>"
        comments = f"<section id='comments'><h3>Comments</h3><p>{_words(long)}</p><p>{_words(short)}</p></section>"
        pages += [
            (f"<body>{menu}{advert}<article>{body}</article>{foot}</body>", [0, 0, 0, 1, 1, 1, 1, 0]),
            (f"<body>{menu}{advert}<article><h1>{_words(5)}</h1></article>{foot}</body>", [0, 0, 0, 1, 0]),
            (f"<body>{menu}<main>{item}</main>{comments}{foot}</body>", [0, 0, 1, 1, 1, 1, 0, 0, 0, 0]),
            (f"<body><article>{body}{advert}<p>{_words(long)}</p>{comments}</article></body>", [1, 1, 1, 1, 0, 1, 0, 0, 0]),
            (f"<body>{menu}<div class='content'>{body}</div><aside><p>{_words(long)}</p></aside>{foot}</body>", [0, 0, 1, 1, 1, 1, 0, 0]),
            (f"<body><header><p>{_words(short + 4)}</p></header>{links}<div>{body}</div>{links}{foot}</body>", [0, 0, 1, 1, 1, 1, 0, 0]),
            (f"<body>{links}<p>{_words(long)}</p><p>{_words(long)}</p>{links}</body>", [0, 1, 1, 0]),
            (f"<body><form><p>{_words(long)}</p></form><div class='cookie-notice'><p>{_words(long)}</p></div><article><p>{_words(long)}</p></article></body>", [0, 0, 1]),
            (f"<body><article><p>{_words(long)} <a href='/z'>{_words(3)}</a> {_words(9)}</p></article><div>{_words(short)}</div><div>{_words(long)}</div></body>", [1, 0, 0]),
            (f"<body><div>{_words(long)}</div><div>{_words(long)}</div><div>{_words(5)}</div><div>{_words(long)}</div></body>", [1, 1, 1, 1]),
            (f"<body><article><ul><li><a href='/q'>{_words(6)}</a></li></ul><p>{_words(short)}</p></article><ul><li><a href='/q'>{_words(6)}</a></li></ul></body>", [1, 1, 0]),
            (f"<body><article>{body}</article></body>", [1, 1, 1, 1]),
            (f"<body><article>{item}</article><p>{_words(short)}</p></body>", [1, 1, 1, 1, 0]),
            (f"<body><p>{_words(long)}</p><article>{body}</article><p>{_words(long)}</p></body>", [0, 1, 1, 1, 1, 0]),
            (f"<body><article><p>{_words(short)}</p></article></body>", [1]),
            (f"<body><article><p>{_words(short)}</p><p>{_words(2)}</p></article></body>", [1, 1]),
            (f"<body><p>{_words(long)}</p></body>", [1]),
            (f"<body><p>{_words(short)}</p></body>", [1]),
        ]
    return pages


def train_tree() -> Node:
    """The tree of the labelled table."""
    x, y = [], []
    for html, labels in labelled_pages():
        blocks = text_blocks(html)
        if len(blocks) != len(labels):
            raise ValueError(f"{len(blocks)} blocks, {len(labels)} labels: {html}")
        x.append(features(blocks))
        y += labels
    return grow_tree(np.concatenate(x), np.array(y, float), np.ones(len(y)))


def main_text(html: str | None, tree: Node) -> str:
    """Main-text blocks of a page joined by newlines; empty if there are none."""
    blocks = text_blocks(html) if html else []
    if not blocks:
        return ""
    keep = tree.predict(features(blocks)) >= 0.5
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract(pages: DataFrame, tree: Node | None = None) -> DataFrame:
    """Adds ``text``, the main text of the whole ``html``, in one narrow step.

    A null or empty page, and one without main text, gives an empty text.  Pages cut off
    in the middle of a tag end there.  Other columns pass unchanged; a column ``text`` is
    replaced.  Repeated rows give a row each.
    """
    tree = tree or train_tree()
    pages = pages.drop("text")
    names = pages.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), tree) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*names, "text"]
            )

    return pages.mapInArrow(emit, f"{schema}, text string")


def extracted_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    found = extract(pages.select("page_id", "url", F.col("html").cast("string")))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
