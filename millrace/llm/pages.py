"""Main text of HTML pages from flat blocks and a decision tree.

A page is cut into flat text blocks at block-level tags.  Each block has its number of
words and its link density, those of the blocks before and after it, and where it stands:
inside an article, inside a container that is named as something else (menu, header,
footer, sidebar, notice, advert, form, comments), whether the page marks an article at
all.  A decision tree, grown on the small labelled table below, says which blocks are
main text.

Defined results for unusual rows: a null or empty page has an empty text; tags that are
never closed, closed twice or cut off at the end do no harm; a script or style that is
never closed takes the rest of the page; a page of any length is read whole; repeated
rows give repeated results; an empty table gives an empty result; columns of the input
are kept, the added column replaces one of the same name.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import query, table

# Fixed values of the markup language: elements that begin and end a block, elements whose
# content is not text of the page, elements that hold controls.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
SILENT_TAGS = frozenset("script style title textarea template noscript iframe object svg math canvas audio video select".split())
CONTROL_TAGS = frozenset("nav aside footer form menu dialog button fieldset label".split())
CONTAINERS = (BLOCK_TAGS | CONTROL_TAGS) - frozenset("p hr h1 h2 h3 h4 h5 h6 html body head".split())
# A page's header is not main text, an article's own header is.
OUTER_TAGS = frozenset(["header"])
ARTICLE_TAGS = frozenset(["article", "main"])

# Words of a class, id or role that name a container as something other than main text.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disqus dialog disclaimer discussion feedback footer form login menu modal nav navbar navigation "
    "newsletter notice notification overlay pagination pager popup promo promoted promotion recommended related replies "
    "reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe teaser toolbar tracking "
    "warning widget complementary contentinfo alert alertdialog".split()
)
OUTER_HINTS = frozenset(["header", "masthead"])

# In a tag a quote encloses a value only after an equals sign; elsewhere it is a character.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)",
    re.S,
)
NAMING = re.compile(r"""(?:^|\s)(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=\s|/|\Z)""", re.I)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
WORDS = re.compile(r"\S+")

FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "in_article", "named_other", "has_article")

# The labelled table, one block a row: the features in order, then 1 for main text.
LABELLED = np.array(
    [
        # articles: paragraphs, headings, one-word paragraphs, a paragraph that is a link
        (8, 0.0, 0, 0.0, 60, 0.0, 1, 0, 1, 1),
        (60, 0.0, 8, 0.0, 45, 0.05, 1, 0, 1, 1),
        (45, 0.05, 60, 0.0, 1, 0.0, 1, 0, 1, 1),
        (1, 0.0, 45, 0.05, 120, 0.0, 1, 0, 1, 1),
        (120, 0.0, 1, 0.0, 6, 1.0, 1, 0, 1, 1),
        (6, 1.0, 120, 0.0, 80, 0.1, 1, 0, 1, 1),
        (80, 0.1, 6, 1.0, 3, 0.0, 1, 0, 1, 1),
        (3, 0.0, 80, 0.1, 12, 0.0, 1, 0, 1, 1),
        (12, 0.5, 3, 0.0, 5, 0.0, 1, 0, 1, 1),
        (300, 0.0, 12, 0.5, 12, 0.0, 1, 0, 1, 1),
        (2, 0.0, 1, 1.0, 9, 0.0, 1, 0, 1, 1),
        (9, 0.0, 1, 1.0, 4, 1.0, 1, 0, 1, 1),
        # the ends of articles, and short blocks beside short blocks or links
        (1, 0.0, 60, 0.0, 0, 0.0, 1, 0, 1, 1),
        (14, 0.0, 200, 0.0, 1, 1.0, 1, 0, 1, 1),
        (5, 0.0, 1, 0.0, 2, 0.0, 1, 0, 1, 1),
        (1, 0.0, 2, 0.0, 1, 0.0, 1, 0, 1, 1),
        (20, 0.0, 1, 0.0, 0, 0.0, 1, 0, 1, 1),
        (33, 0.1, 3, 0.0, 2, 0.0, 1, 0, 1, 1),
        (4, 1.0, 2, 1.0, 2, 1.0, 1, 0, 1, 1),
        (2, 0.0, 2, 1.0, 1, 0.0, 1, 0, 1, 1),
        (1, 1.0, 3, 0.0, 1, 1.0, 1, 0, 1, 1),
        (28, 0.9, 5, 0.8, 2, 1.0, 1, 0, 1, 1),
        (70, 0.3, 0, 0.0, 0, 0.0, 1, 0, 1, 1),
        (3, 0.4, 9, 0.9, 9, 0.9, 1, 0, 1, 1),
        # inside an article, but named as something else
        (7, 0.0, 60, 0.0, 60, 0.0, 1, 1, 1, 0),
        (25, 0.0, 80, 0.0, 12, 0.0, 1, 1, 1, 0),
        (40, 0.1, 25, 0.0, 1, 1.0, 1, 1, 1, 0),
        (3, 1.0, 60, 0.0, 3, 1.0, 1, 1, 1, 0),
        (90, 0.0, 10, 0.0, 5, 0.0, 1, 1, 1, 0),
        # menus, headers, adverts, sidebars, footers, notices, forms, comments by name
        (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 1, 0),
        (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0),
        (2, 1.0, 1, 1.0, 8, 0.0, 0, 1, 1, 0),
        (8, 0.0, 2, 1.0, 10, 0.0, 0, 1, 1, 0),
        (35, 0.0, 70, 0.0, 20, 0.0, 0, 1, 0, 0),
        (50, 0.0, 35, 0.0, 60, 0.0, 0, 1, 1, 0),
        (60, 0.2, 50, 0.0, 9, 0.1, 0, 1, 1, 0),
        (120, 0.0, 60, 0.2, 40, 0.0, 0, 1, 0, 0),
        (9, 0.1, 120, 0.0, 0, 0.0, 0, 1, 1, 0),
        (5, 0.0, 45, 0.0, 0, 0.0, 0, 1, 0, 0),
        (25, 0.0, 2, 1.0, 30, 0.0, 0, 1, 0, 0),
        (30, 0.1, 45, 0.0, 60, 0.0, 0, 1, 0, 0),
        (45, 0.0, 60, 0.0, 45, 0.05, 0, 1, 0, 0),
        (60, 0.0, 25, 0.0, 7, 0.0, 0, 1, 0, 0),
        (90, 0.0, 4, 0.0, 2, 1.0, 0, 1, 0, 0),
        (200, 0.0, 90, 0.0, 35, 0.0, 0, 1, 0, 0),
        (7, 0.0, 1, 1.0, 60, 0.0, 0, 1, 0, 0),
        (14, 0.0, 60, 0.0, 50, 0.0, 0, 1, 0, 0),
        # outside the article of a page that has one, without a name
        (4, 0.0, 0, 0.0, 8, 0.0, 0, 0, 1, 0),
        (15, 0.0, 1, 1.0, 9, 0.0, 0, 0, 1, 0),
        (30, 0.0, 80, 0.0, 30, 0.0, 0, 0, 1, 0),
        (70, 0.0, 30, 0.0, 4, 0.0, 0, 0, 1, 0),
        (2, 1.0, 70, 0.0, 2, 1.0, 0, 0, 1, 0),
        (6, 0.4, 2, 1.0, 0, 0.0, 0, 0, 1, 0),
        (12, 0.0, 0, 0.0, 40, 0.0, 0, 0, 1, 0),
        (45, 0.0, 12, 0.0, 90, 0.0, 0, 0, 1, 0),
        (8, 0.0, 45, 0.0, 60, 0.0, 0, 0, 1, 0),
        (20, 0.1, 20, 0.1, 20, 0.1, 0, 0, 1, 0),
        (150, 0.0, 20, 0.0, 25, 0.0, 0, 0, 1, 0),
        # pages without an article: running text, and short blocks beside it
        (60, 0.0, 7, 0.0, 45, 0.0, 0, 0, 0, 1),
        (45, 0.05, 60, 0.0, 30, 0.0, 0, 0, 0, 1),
        (30, 0.1, 45, 0.05, 25, 0.0, 0, 0, 0, 1),
        (25, 0.0, 30, 0.1, 3, 0.0, 0, 0, 0, 1),
        (150, 0.0, 2, 1.0, 4, 0.0, 0, 0, 0, 1),
        (22, 0.0, 1, 1.0, 90, 0.0, 0, 0, 0, 1),
        (26, 0.1, 120, 0.0, 5, 0.0, 0, 0, 0, 1),
        (120, 0.0, 60, 0.2, 40, 0.0, 0, 0, 0, 1),
        (300, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
        (40, 0.0, 300, 0.0, 0, 0.0, 0, 0, 0, 1),
        (20, 0.1, 70, 0.0, 2, 1.0, 0, 0, 0, 1),
        (90, 0.2, 4, 0.0, 1, 1.0, 0, 0, 0, 1),
        (7, 0.0, 1, 1.0, 60, 0.0, 0, 0, 0, 1),
        (3, 0.0, 25, 0.0, 40, 0.0, 0, 0, 0, 1),
        (8, 0.0, 40, 0.0, 35, 0.1, 0, 0, 0, 1),
        (14, 0.2, 60, 0.0, 50, 0.0, 0, 0, 0, 1),
        (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0),
        (2, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0),
        (3, 0.9, 2, 1.0, 7, 0.0, 0, 0, 0, 0),
        (12, 0.8, 40, 0.0, 10, 0.9, 0, 0, 0, 0),
        (30, 0.9, 8, 1.0, 25, 0.8, 0, 0, 0, 0),
        (25, 0.8, 30, 0.9, 2, 1.0, 0, 0, 0, 0),
        (4, 0.0, 2, 1.0, 1, 1.0, 0, 0, 0, 0),
        (5, 0.3, 3, 1.0, 0, 0.0, 0, 0, 0, 0),
        (6, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0),
        (9, 0.0, 6, 0.0, 0, 0.0, 0, 0, 0, 0),
    ],
    dtype=np.float64,
)


def grow(rows: np.ndarray, least: int = 2):
    """A decision tree: a leaf is 0 or 1, a node (feature, threshold, below, above)."""
    labels = rows[:, -1]
    if len(set(labels)) == 1 or len(rows) < least:
        return int(labels.mean() >= 0.5)

    def impurity(part: np.ndarray) -> float:
        share = part.mean()
        return len(part) * share * (1 - share)

    best = None
    for feature in range(rows.shape[1] - 1):
        seen = np.unique(rows[:, feature])
        for threshold in (seen[1:] + seen[:-1]) / 2:
            below = rows[:, feature] <= threshold
            cost = impurity(labels[below]) + impurity(labels[~below])
            if best is None or cost < best[0] - 1e-12:
                best = cost, feature, float(threshold), below
    if best is None:
        return int(labels.mean() >= 0.5)
    _, feature, threshold, below = best
    return feature, threshold, grow(rows[below], least), grow(rows[~below], least)


@functools.cache
def _tree():
    return grow(LABELLED)


def is_main(block: tuple, tree=None) -> bool:
    node = _tree() if tree is None else tree
    while not isinstance(node, int):
        feature, threshold, below, above = node
        node = below if block[feature] <= threshold else above
    return node == 1


class _Blocks:
    """Blocks of one page, collected tag by tag."""

    def __init__(self) -> None:
        self.blocks: list[tuple[str, int, int, bool, bool]] = []
        self.pieces: list[str] = []
        self.linked: list[str] = []
        self.in_link = False
        # Open containers: tag, whether text in it is in an article, whether it is named;
        # and how many of each tag are open.
        self.open: list[tuple[str, bool, bool]] = []
        self.depth: Counter[str] = Counter()

    def text(self, raw: str) -> None:
        if raw:
            raw = html.unescape(raw) if "&" in raw else raw
            self.pieces.append(raw)
            if self.in_link:
                self.linked.append(raw)

    def flush(self) -> None:
        if self.pieces:
            words = "".join(self.pieces).split()
            if words:
                linked = len(" ".join(self.linked).split())
                _, article, named = self.open[-1] if self.open else ("", False, False)
                self.blocks.append((" ".join(words), len(words), min(linked, len(words)), article, named))
            self.pieces, self.linked = [], []

    def begin(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self.in_link = True
            return
        if tag == "br":
            self.text(" ")
            return
        if tag in BLOCK_TAGS or tag in CONTROL_TAGS:
            if tag in BLOCK_TAGS or tag == "button":
                self.flush()
                self.in_link = False
        if tag in CONTAINERS:
            _, article, named = self.open[-1] if self.open else ("", False, False)
            article_here = tag in ARTICLE_TAGS
            article = article or article_here
            # An article begins anew inside whatever holds it.
            named = (named and not article_here) or tag in CONTROL_TAGS or (tag in OUTER_TAGS and not article)
            if attributes:
                named = named or _named(attributes, article)
            self.open.append((tag, article, named))
            self.depth[tag] += 1

    def end(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
            return
        if tag in BLOCK_TAGS or tag == "button":
            self.flush()
            self.in_link = False
        if self.depth[tag]:
            closed = None
            while closed != tag:
                closed = self.open.pop()[0]
                self.depth[closed] -= 1


def _named(attributes: str, article: bool) -> bool:
    for match in NAMING.finditer(attributes):
        name = match[1].lower()
        value = match[2] or match[3] or match[4] or ""
        if name == "hidden":
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        elif name == "aria-hidden":
            if value.lower() == "true":
                return True
        else:
            parts = {part.lower() for part in NAME_PARTS.findall(value)}
            if parts & HINTS or (not article and parts & OUTER_HINTS):
                return True
    return False


@functools.cache
def _closing(tag: str) -> re.Pattern:
    return re.compile(f"</{tag}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I)


def blocks(page: str) -> list[tuple[str, int, int, bool, bool]]:
    """Blocks in page order: text, words, linked words, in an article, named as other."""
    out, at, unclosed = _Blocks(), 0, set()
    while True:
        match = TOKEN.search(page, at)
        if match is None:
            out.text(page[at:])
            break
        out.text(page[at : match.start()])
        at = match.end()
        tag = match["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        attributes = match["attributes"] or ""
        if match["end"]:
            out.end(tag)
        elif tag in SILENT_TAGS and not attributes.endswith("/"):
            # Once there is no closing tag ahead, there is none later either.
            close = None if tag in unclosed else _closing(tag).search(page, at)
            if close is not None:
                at = close.end()
            elif tag in ("script", "style"):
                break
            else:
                unclosed.add(tag)
        else:
            out.begin(tag, attributes)
    out.flush()
    return out.blocks


def main_text(page: str | None) -> str:
    """Texts of the main blocks, joined by a line feed."""
    found = blocks(page or "")
    has_article = any(block[3] for block in found)
    sizes = [(0, 0.0), *[(words, linked / words) for _, words, linked, _, _ in found], (0, 0.0)]
    kept = []
    for n, (text, _, _, article, named) in enumerate(found):
        if is_main((*sizes[n + 1], *sizes[n], *sizes[n + 2], article, named, has_article)):
            kept.append(text)
    return "\n".join(kept)


def extract(pages: DataFrame, page: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of each page."""

    @F.arrow_udf("string")
    def run(values: pa.Array) -> pa.Array:
        return pa.array([main_text(value.as_py()) for value in values], pa.string())

    kept = [c for c in pages.columns if c != into]
    packed = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("page"), run.asNondeterministic()(F.col(page).cast("string")).alias("out"))
    return packed.select(*[F.col("page").getField(c).alias(c) for c in kept], F.col("out").alias(into))


@query("op5_extract_text")
def op5_extract_text(spark, sf_dir):
    found = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
