"""Main-text extraction: flat text blocks, classified by a decision tree.

A page becomes a line of text blocks, cut at block-level tags and at two line breaks in a row. A block has its number of words, its
link density, those of the block before and after it, and what its enclosing elements say: kinds of tags, and words in
their class, id and role. A decision tree (Gini impurity) is trained on ``html_blocks.tsv``, a small table of blocks labelled by
hand, each with its path of elements, words and linked words; it decides for every block whether it belongs to the main text.
Each page is read once, within its own task; nothing is shuffled.

Defined results: null and empty pages have an empty text; a page without tags is one block; unclosed elements end where
the element around them ends, an unclosed comment, script or style at the end of the page; tables that repeat rows or ids give a
row each; an empty table gives no rows; very long pages are read whole. Columns other than the page's id, url and html are not read.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from html import unescape
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELLED = Path(__file__).with_name("html_blocks.tsv")
DEPTH = 6
LEAST_LEAF = 4
PROSE = 10

# What HTML says of its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SKIPPED = frozenset("script style title textarea noscript template iframe object svg math canvas audio video select".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: An opening tag closes an open element of these kinds, up to the element that holds them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
# Kinds of elements, and words that names of elements use for them.
SIDE_TAGS = frozenset("nav aside footer menu dialog address".split())
FORM_TAGS = frozenset("form fieldset button label legend".split())
CONTENT_TAGS = frozenset("article main".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
SIDE_NAMES = frozenset(
    "ad ads adv advert advertisement advertisements advertising adsense alert banner breadcrumb breadcrumbs byads consent "
    "cookie cookies copyright disclaimer donate follow foot footer gdpr header legal links login masthead menu modal mostread nav navbar "
    "navigation navi newsletter notice notices notification outbrain pager pagination paywall popular popup privacy promo "
    "promoted promotion recommended related rss search share sharing sidebar signin signup skip skyscraper social sponsor sponsored sponsors "
    "subscribe subscription taboola tagcloud tags teaser teasers toolbar topbar trending warning widget widgets".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist disqus discussion guestbook replies reply respond".split())
CONTENT_NAMES = frozenset("article content entry main post prose story text".split())
#: Names with these words say something of the whole page.
STATES = frozenset("closed disabled enabled has hide no none off on open with without wrapper".split())

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)>"
    r"|<[!?/][^>]*+>",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

SIDE, NAMED_SIDE, COMMENT, FORM, CONTENT, HEADING, ITEM = (1 << i for i in range(7))
FEATURES = (
    "words density words_before density_before words_after density_after side named_side comment form content heading item "
    "known outside side_share"
).split()


@dataclass
class Block:
    """A text block; ``flags`` are those of the elements around it, ``side`` is the outermost of these that is no content."""

    text: str
    words: int
    linked: int
    flags: int
    side: int


def named(tag: str, names: str, role: str, flags: int) -> int:
    """Flags of an element, with those of its parent."""
    own = flags
    if tag in SIDE_TAGS or role in SIDE_ROLES or (tag == "header" and not flags & CONTENT):
        own |= SIDE
    if tag in FORM_TAGS:
        own |= FORM
    if tag in CONTENT_TAGS or role in CONTENT_TAGS:
        own |= CONTENT
    if tag[:1] == "h" and tag[1:].isdigit():
        own |= HEADING
    if tag in ("li", "dt", "dd", "td", "th"):
        own |= ITEM
    if tag not in ("html", "body"):
        for name in names.split():
            words = {w.lower() for w in NAME_WORD.findall(name)}
            if words & STATES:
                continue
            if words & COMMENT_NAMES:
                own |= COMMENT
            found, content = words & SIDE_NAMES, words & CONTENT_NAMES
            # the header of an entry holds its title
            if found and not (content and found <= {"header"}):
                own |= NAMED_SIDE
            elif content:
                own |= CONTENT
    return own


@dataclass
class Reader:
    """Collects the blocks of one page."""

    blocks: list[Block] = field(default_factory=list)
    #: open elements: tag, flags, number of the outermost element that is no content (0: none)
    open: list[tuple[str, int, int]] = field(default_factory=lambda: [("", 0, 0)])
    parts: list[tuple[str, bool]] = field(default_factory=list)
    links: bool = False
    #: number of elements that were open around the link at hand
    link_at: int = 0
    breaks: int = 0
    sides: int = 0

    def cut(self) -> None:
        """Ends the block at hand."""
        if self.parts:
            text = " ".join(unescape("".join([t for t, _ in self.parts])).split())
            if text:
                linked = unescape(" ".join([t for t, linked in self.parts if linked])) if any(x for _, x in self.parts) else ""
                _, flags, side = self.open[-1]
                words = text.count(" ") + 1
                self.blocks.append(Block(text, words, min(len(linked.split()), words), flags, side))
            self.parts = []
        self.breaks = 0

    def push(self, tag: str, attributes: str) -> None:
        names = role = ""
        if attributes and "=" in attributes:
            for key, *values in ATTRIBUTE.findall(attributes):
                value = unescape("".join(values))
                if key.lower() == "role":
                    role = value.strip().lower()
                else:
                    names += f" {value}"
        _, flags, side = self.open[-1]
        flags = named(tag, names, role, flags)
        if not side and flags & (SIDE | NAMED_SIDE | FORM):
            self.sides += 1
            side = self.sides
        self.open.append((tag, flags, side))

    def pop(self, tags: set[str], until: set[str] = frozenset()) -> None:
        """Closes the innermost open element of ``tags`` with all in it, unless one of ``until`` is met first."""
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] in tags:
                del self.open[at:]
                # a link ends with the element it stands in
                self.links = self.links and len(self.open) >= self.link_at
                return
            if self.open[at][0] in until:
                return

    def text(self, text: str) -> None:
        if text:
            if self.breaks and not text.isspace():
                self.breaks = 0
            self.parts.append((text, self.links))

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.breaks += 1
            self.cut() if self.breaks > 1 else self.parts.append((" ", False))
            return
        if tag == "a":
            self.links, self.link_at = True, len(self.open)
        if tag in BLOCK:
            self.cut()
            if tag in CLOSES:
                self.pop(*CLOSES[tag])
            elif self.open[-1][0] == "p":
                self.open.pop()
        if tag in VOID:
            return
        if tag in BLOCK or "=" in attributes and tag != "a":
            self.push(tag, attributes)

    def end(self, tag: str) -> None:
        if tag == "a":
            self.links = False
            return
        if tag in BLOCK:
            self.cut()
        self.pop({tag})


@cache
def skipper(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I)


def blocks_of(page: str | None) -> list[Block]:
    """The text blocks of a page, in its order."""
    reader, at, page = Reader(), 0, page or ""
    while found := TOKEN.search(page, at):
        reader.text(page[at : found.start()])
        at, tag = found.end(), found[2]
        if not tag:
            continue
        tag = tag.lower()
        if found[1]:
            reader.end(tag)
        elif tag in SKIPPED:
            if not found[3].endswith("/"):
                closing = skipper(tag).search(page, at)
                at = closing.end() if closing else len(page)
            reader.parts.append((" ", False))
        else:
            reader.start(tag, found[3])
    reader.text(page[at:])
    reader.cut()
    return reader.blocks


def features_of(blocks: list[Block]) -> list[list[float]]:
    """A row of ``FEATURES`` per block of one page."""
    total, within, content = 0, {}, 0
    for b in blocks:
        plain = b.words - b.linked
        total += plain
        if b.side:
            within[b.side] = within.get(b.side, 0) + plain
        if b.flags & CONTENT and not b.flags & (SIDE | NAMED_SIDE | COMMENT):
            content += plain
    edges = [(b.words, b.linked / b.words) for b in blocks]
    rows = []
    for i, b in enumerate(blocks):
        before = edges[i - 1] if i else (0, 1.0)
        after = edges[i + 1] if i + 1 < len(edges) else (0, 1.0)
        has = [float(b.flags & flag > 0) for flag in (SIDE, NAMED_SIDE, COMMENT, FORM, CONTENT, HEADING, ITEM)]
        known = float(content > 0)
        outside = float(content > 0 and not b.flags & CONTENT)
        share = within[b.side] / max(total, 1) if b.side else 0.0
        rows.append([*edges[i], *before, *after, *has, known, outside, share])
    return rows


@dataclass(frozen=True)
class Node:
    """A leaf has a ``verdict``; else rows with ``feature`` of at most ``limit`` go to ``low``."""

    verdict: bool | None = None
    feature: int = 0
    limit: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grown(rows: np.ndarray, labels: np.ndarray, depth: int = DEPTH, least: int = LEAST_LEAF) -> Node:
    """A decision tree by Gini impurity; ties between cuts go to the first feature, then the lowest limit."""
    positive = int(labels.sum())
    leaf = Node(verdict=2 * positive > len(labels))
    if depth == 0 or positive in (0, len(labels)):
        return leaf
    best = (positive * (len(labels) - positive) / len(labels) - 1e-9, 0, 0.0)
    for feature in range(rows.shape[1]):
        order = np.argsort(rows[:, feature], kind="stable")
        values, ones = rows[order, feature], np.cumsum(labels[order])
        cuts = np.flatnonzero(values[1:] > values[:-1])
        n = cuts + 1
        low, high = ones[cuts], positive - ones[cuts]
        left = len(labels) - n
        impurity = low * (n - low) / n + high * (left - high) / left
        impurity[(n < least) | (left < least)] = np.inf
        if len(cuts) and impurity.min() < best[0]:
            at = int(impurity.argmin())
            best = (impurity[at], feature, (values[cuts[at]] + values[cuts[at] + 1]) / 2)
            leaf = None
    if leaf:
        return leaf
    _, feature, limit = best
    below = rows[:, feature] <= limit
    return Node(
        None, feature, float(limit),
        grown(rows[below], labels[below], depth - 1, least), grown(rows[~below], labels[~below], depth - 1, least),
    )


def verdict(tree: Node, row: list[float]) -> bool:
    while tree.verdict is None:
        tree = tree.low if row[tree.feature] <= tree.limit else tree.high
    return tree.verdict


def labelled_pages(path: Path = LABELLED) -> Iterator[tuple[list[Block], list[bool]]]:
    """Pages of the labelled table as blocks and labels.

    A row gives page, path of elements (``tag#name.name``, separated by blanks), words, linked words, whether it is main text,
    and how many such blocks stand in a row. Elements of a page with equal paths are one."""
    pages: dict[str, list[dict[str, str]]] = {}
    with open(path, encoding="utf-8", newline="") as file:
        for row in csv.DictReader((line for line in file if not line.startswith("#")), delimiter="\t"):
            pages.setdefault(row["page"], []).append(row)
    for rows in pages.values():
        blocks, labels, sides = [], [], {}
        for row in rows:
            flags = side = 0
            for depth, element in enumerate(elements := row["path"].split()):
                tag, *names = re.split(r"[#.]", element)
                flags = named(tag, " ".join(names), "", flags)
                if not side and flags & (SIDE | NAMED_SIDE | FORM):
                    side = sides.setdefault(" ".join(elements[: depth + 1]), len(sides) + 1)
            for _ in range(int(row["times"])):
                blocks.append(Block("", int(row["words"]), int(row["linked"]), flags, side))
                labels.append(row["main"] == "1")
        yield blocks, labels


def trained(path: Path = LABELLED, depth: int = DEPTH) -> Node:
    """The tree of the labelled table. Each page is learned twice: as it is, and as if its elements said nothing, then
    without the longer texts, such as reader comments, that only their elements tell from main text.

    The root is given: pages with an element known to hold content, and pages without."""
    rows, labels = [], []
    for blocks, main in labelled_pages(path):
        plain = [Block(b.text, b.words, b.linked, b.flags & (HEADING | ITEM), 0) for b in blocks]
        told = [m or b.linked > 0 or b.words < PROSE for b, m in zip(blocks, main)]
        rows += features_of(blocks) + [row for row, tells in zip(features_of(plain), told) if tells]
        labels += main + [m for m, tells in zip(main, told) if tells]
    rows, labels, root = np.array(rows), np.array(labels), FEATURES.index("known")
    known = rows[:, root] > 0
    parts = [grown(rows[some], labels[some], depth) for some in (~known, known)]
    return Node(None, root, 0.5, *parts)


def main_text(page: str | None, tree: Node) -> str:
    blocks = blocks_of(page)
    return "\n".join([b.text for b, row in zip(blocks, features_of(blocks)) if verdict(tree, row)])


def extract(pages: DataFrame, tree: Node | None = None) -> DataFrame:
    """(page_id, url, text, n_chars), a row per row of ``pages``."""
    tree = tree or trained()
    columns = [F.col("page_id"), F.col("url"), F.col("html").cast("string").alias("html")]
    schema = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url")) + ", text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), tree) for page in batch.column(2)]
            sizes = pa.array(map(len, texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"]
            )

    return pages.select(*columns).mapInArrow(run, schema)
