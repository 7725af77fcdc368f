"""Operator 2: main text of HTML pages from flat text blocks.

A page is cut at block-level tags into flat blocks. Each block is described by its word count
and link density and those of the blocks beside it, and by whether it stands inside markup
that names an article or its surroundings. A decision tree, trained on the small labelled
table below, says which blocks are main text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import in_batches, slices, table

TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])
TEXT_DDL = "page_id long, url string, text string"

# A quote opens a value only after an equals sign; nothing is tried twice, so a page with any number
# of open quotes or tags is read in one go.
PIECE = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<![^>]*+(?:>|\Z)|<\?[^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)",
    re.S,
)
SPACE = re.compile(r"\s+")
WORD = re.compile(r"\w+")
NAMES = re.compile(r"""(?<![\w-])(class|id|role|itemprop|data-role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# Elements whose content is no text of the page.
SKIPPED = frozenset("script style noscript template head title textarea select option svg math iframe object canvas audio video button datalist".split())
CLOSING = {name: re.compile(rf"</{name}\s*(?:>|\Z)", re.I) for name in SKIPPED}
# Of these, what ends a line of text; the others stand within one.
APART = frozenset("head title textarea".split())
# Elements that stand within a line of text; any other tag ends a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose end may be left out; they end with the element around them.
LOOSE = frozenset("p li dt dd tr td th thead tbody tfoot option colgroup".split())
CONTENT = frozenset(["article", "main"])
AROUND = frozenset("nav aside footer form menu dialog fieldset".split())
# Words in class, id or role that name what surrounds an article, or the article.
AROUND_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar"
    " breadcrumb breadcrumbs sidebar aside widget footer foot masthead cookie cookies consent gdpr notice notices alert popup modal dialog overlay"
    " comment comments commentlist disqus discussion reply replies respond form search searchbox login signup subscribe subscription newsletter share"
    " sharing social related recommended recommendations trending popular pagination pager toolbar skip copyright contentinfo complementary".split()
)
CONTENT_NAMES = frozenset("article content story post entry main body articlebody maintext text".split())
# Words that say no more of a name than its place, and words that make a name a mere setting.
FILLERS = CONTENT_NAMES | frozenset(
    "area bar block bottom box center col column container desktop div first global group head header holder inner item items large last left line link links list mobile"
    " module outer page panel posts right row section site slot small tabs title top unit view wrap wrapper zone".split()
)
SETTINGS = frozenset("no not non has have with without off on is hide hidden show enabled disabled open closed".split())
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "within", "around")

# The labelled table: the features of a block, in the order above, and 1 for main text.
# Fixed values, labelled by hand for blocks as they occur on news, forum and shop pages.
LABELLED = (
    # Inside article markup: paragraphs long and short, headings, list items, link-rich text.
    (10, 0.0, 12, 0.0, 80, 0.0, 1, 0, 1), (80, 0.0, 10, 0.0, 45, 0.0, 1, 0, 1), (1, 0.0, 60, 0.0, 70, 0.0, 1, 0, 1),
    (2, 0.0, 1, 0.0, 3, 0.0, 1, 0, 1), (45, 0.1, 80, 0.0, 5, 1.0, 1, 0, 1), (5, 1.0, 45, 0.1, 12, 0.0, 1, 0, 1),
    (1, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1), (120, 0.0, 2, 0.0, 8, 0.0, 1, 0, 1), (9, 0.0, 3, 1.0, 30, 0.0, 1, 0, 1),
    (6, 0.0, 110, 0.0, 9, 0.0, 1, 0, 1), (30, 0.6, 40, 0.0, 25, 0.0, 1, 0, 1), (3, 1.0, 4, 1.0, 50, 0.0, 1, 0, 1),
    # Inside surrounding markup, in an article or not: menus, adverts, notices, comments, forms.
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0), (8, 0.0, 1, 1.0, 11, 0.0, 0, 1, 0), (12, 0.1, 60, 0.0, 0, 0.0, 0, 1, 0),
    (25, 0.0, 8, 0.0, 30, 0.0, 0, 1, 0), (40, 0.0, 90, 0.0, 35, 0.0, 0, 1, 0), (70, 0.0, 4, 0.0, 55, 0.0, 0, 1, 0),
    (60, 0.0, 70, 0.0, 80, 0.0, 1, 1, 0), (9, 0.0, 45, 0.0, 50, 0.0, 1, 1, 0), (3, 1.0, 90, 0.0, 4, 1.0, 1, 1, 0),
    (2, 0.5, 3, 1.0, 60, 0.0, 0, 1, 0), (15, 0.3, 0, 0.0, 40, 0.0, 0, 1, 0), (150, 0.0, 120, 0.0, 2, 1.0, 0, 1, 0),
    # No markup tells: long text, and short text between long text, is main text.
    (60, 0.0, 9, 0.0, 75, 0.0, 0, 0, 1), (110, 0.05, 60, 0.0, 90, 0.0, 0, 0, 1), (28, 0.0, 95, 0.0, 6, 0.0, 0, 0, 1),
    (22, 0.0, 40, 0.0, 30, 0.1, 0, 0, 1), (7, 0.0, 50, 0.0, 60, 0.0, 0, 0, 1), (1, 0.0, 45, 0.0, 85, 0.0, 0, 0, 1),
    (12, 0.0, 3, 0.2, 70, 0.0, 0, 0, 1), (35, 0.2, 8, 0.0, 20, 0.0, 0, 0, 1), (18, 0.0, 65, 0.0, 30, 0.0, 0, 0, 1),
    (9, 0.0, 30, 0.0, 28, 0.0, 0, 0, 1), (25, 0.0, 2, 1.0, 0, 0.0, 0, 0, 1), (19, 0.0, 12, 0.0, 26, 0.0, 0, 0, 1),
    (54, 0.0, 2, 0.0, 3, 1.0, 0, 0, 1), (48, 0.0, 2, 1.0, 4, 1.0, 0, 0, 1), (33, 0.0, 40, 0.0, 2, 1.0, 0, 0, 1),
    # No markup tells: link lists, lone short lines and captions are not.
    (2, 1.0, 1, 1.0, 3, 1.0, 0, 0, 0), (20, 0.9, 2, 1.0, 25, 0.8, 0, 0, 0), (45, 0.7, 6, 1.0, 9, 1.0, 0, 0, 0),
    (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0), (6, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0), (3, 0.0, 4, 0.0, 5, 0.0, 0, 0, 0),
    (8, 0.0, 6, 0.0, 0, 0.0, 0, 0, 0), (5, 0.5, 90, 0.0, 2, 1.0, 0, 0, 0), (11, 0.0, 1, 1.0, 4, 0.0, 0, 0, 0),
    (7, 0.0, 5, 0.0, 8, 0.0, 0, 0, 0), (1, 1.0, 80, 0.0, 70, 0.0, 0, 0, 0), (6, 0.8, 55, 0.0, 40, 0.0, 0, 0, 0),
)


def train_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 6) -> tuple:
    """A decision tree by Gini impurity: ``(feature, bound, at most, above)`` or a leaf's label."""
    if depth == 0 or len(set(labels.tolist())) == 1:
        return (int(labels.mean() >= 0.5),)
    best = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for bound in (values[:-1] + values[1:]) / 2:
            low = rows[:, f] <= bound
            cost = sum(len(part) * part.mean() * (1 - part.mean()) for part in (labels[low], labels[~low]))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, float(bound), low)
    if best is None:
        return (int(labels.mean() >= 0.5),)
    _, f, bound, low = best
    return f, bound, train_tree(rows[low], labels[low], depth - 1), train_tree(rows[~low], labels[~low], depth - 1)


@lru_cache(maxsize=4)
def trained_tree(labelled: tuple = LABELLED) -> tuple:
    rows = np.array(labelled, dtype=float)
    return train_tree(rows[:, :-1], rows[:, -1])


def is_main(tree: tuple, features: tuple) -> bool:
    while len(tree) > 1:
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return bool(tree[0])


def _kind(name: str, rest: str) -> int:
    """2 for an element around an article, 1 for one that holds it, 0 for any other.

    A name counts if all its words belong to names of that kind: ``cookie-notice`` is around,
    ``advertising-history`` is not, and ``no-sidebar`` is a setting of something else.
    """
    if name in AROUND:
        return 2
    if name in CONTENT:
        return 1
    if name in ("body", "html") or "=" not in rest:
        return 0
    found = 0
    for attribute, *values in NAMES.findall(rest):
        for token in "".join(values).split():
            words = {w.lower() for w in NAME_WORD.findall(token)}
            if words & SETTINGS:
                continue
            if words & AROUND_NAMES and words <= AROUND_NAMES | FILLERS:
                return 2
            if words & CONTENT_NAMES and words <= FILLERS:
                found = 1
    return found


class _Blocks:
    """Collects the flat blocks of one page."""

    def __init__(self):
        self.blocks: list[tuple[str, int, float, int, int]] = []  # text, words, link density, within, around
        self.open: list[tuple[str, int, int]] = []  # name, kind, forms that do not count inside
        self.within = self.around = self.forms = self.links = 0
        self.text: list[str] = []
        self.linked: list[str] = []

    def add(self, text: str) -> None:
        self.text.append(text)
        if self.links:
            self.linked.append(text)

    def end_block(self) -> None:
        if self.text:
            text = SPACE.sub(" ", html.unescape("".join(self.text))).strip()
            if text:
                words = max(1, len(WORD.findall(text)))
                links = len(WORD.findall(html.unescape(" ".join(self.linked)))) if self.linked else 0
                self.blocks.append((text, words, min(1.0, links / words), int(self.within > 0), int(self.around > 0)))
            self.text, self.linked = [], []

    def start(self, name: str, rest: str) -> None:
        if name == "a":
            self.links = 1
        if name in INLINE:
            return
        self.end_block()
        self.links = 0
        if name in VOID or rest.endswith("/"):
            return
        while self.open and self.open[-1][0] in LOOSE and name not in ("ul", "ol", "dl", "table") and (name in LOOSE or self.open[-1][0] == "p"):
            if name in LOOSE and name[0] in "t" and self.open[-1][0] not in LOOSE:
                break
            self._close()
        kind = _kind(name, rest)
        if name == "header":
            kind = 0 if self.within else 2
        # A form around a whole page is no surroundings of the article in it.
        aside = self.forms if kind == 1 else 0
        self.open.append((name, kind, aside))
        self.within += kind == 1
        self.around += (kind == 2) - aside
        self.forms += (name == "form") - aside

    def end(self, name: str) -> None:
        if name == "a":
            self.links = 0
        if name in INLINE:
            return
        self.end_block()
        self.links = 0
        if any(entry[0] == name for entry in self.open):
            while self._close() != name:
                pass

    def _close(self) -> str:
        name, kind, aside = self.open.pop()
        self.within -= kind == 1
        self.around += aside - (kind == 2)
        self.forms += aside - (name == "form")
        return name


def flat_blocks(page: str) -> list[tuple[str, int, float, int, int]]:
    """The text blocks of a page in order: text, words, link density, within, around."""
    out, at, n, closed = _Blocks(), 0, len(page), set()
    while at < n:
        m = PIECE.search(page, at)
        if m is None:
            out.add(page[at:])
            break
        if m.start() > at:
            out.add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            out.end(name)
        elif name in SKIPPED:
            if not m[3].endswith("/"):
                if name in APART:
                    out.end_block()
                if name not in closed:
                    close = CLOSING[name].search(page, at)
                    if close:
                        at = close.end()
                    else:
                        closed.add(name)  # none further on, so none is sought again
                if name in closed and name in ("script", "style", "textarea", "title"):
                    at = n
        else:
            out.start(name, m[3])
    out.end_block()
    return out.blocks


def main_text(page: str | None, tree: tuple) -> str:
    blocks = flat_blocks(page or "")
    sides = [("", 0, 0.0, 0, 0), *blocks, ("", 0, 0.0, 0, 0)]
    kept = []
    for before, block, after in zip(sides, blocks, sides[2:]):
        if is_main(tree, (block[1], block[2], before[1], before[2], after[1], after[2], block[3], block[4])):
            kept.append(block[0])
    return "\n".join(kept)


def _extracted(batches: Iterator[pa.RecordBatch], tree: tuple) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in slices(batches):
            for page_id, url, page in zip(*(c.to_pylist() for c in batch.columns)):
                yield page_id, url, main_text(page, tree)

    yield from in_batches(rows(), TEXT, 2)


def extract_main_text(
    pages: DataFrame, labelled: tuple = LABELLED, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``(page_id, url, text)``: the main text of each page, its blocks joined by newlines.

    Character references are decoded and white space inside a block becomes one space. A null
    or empty page, and one without main text, has an empty text; null ids and URLs are kept;
    repeated rows are extracted each; other columns are not read. Pages of any length are
    read whole. Unclosed elements end with the element around them or with the page. An empty
    table gives an empty result.
    """
    tree = trained_tree(labelled)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(lambda batches: _extracted(batches, tree), TEXT_DDL)


def query(spark, folder: str) -> DataFrame:
    return extract_main_text(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))
