"""Main text of web pages from flat text blocks.

A page is read as a flat sequence of blocks: text between block-level tags.  Each block has its word count
and link density, those of the blocks before and after it, and whether an enclosing element is marked as
page furniture (by its kind, or by a name if it is only a part of the page) or as article.  A decision tree (Gini, trained on the labelled table below when the job starts)
keeps or drops each block; the kept ones are joined by newlines in page order.

Edge cases: a null or empty html gives an empty text; scripts, styles, comments and other unseen elements give no
blocks; unclosed elements end where an enclosing one does; character references are decoded once; a page without
a kept block gives an empty string.  Nothing is dropped for length.  Extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SCHEMA = "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long"
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+|[^>]*)>|<[!?/][^>]*>", re.S)
UNSEEN = {"script", "style", "noscript", "template", "title", "textarea", "iframe", "svg", "math", "object", "canvas", "video", "audio", "xmp", "noembed", "noframes"}
BLOCK = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements whose end a block may be waiting for; the others need no place on the stack.
NESTING = BLOCK - {"p", "hr", "li", "dd", "dt", "option", "tr", "td", "th", "thead", "tbody", "tfoot", "html", "body", "head"} | {"body", "a", "label"}
FURNITURE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "fieldset", "search", "label"}
#: Elements that may also wrap a whole page, so they count as a name does.
WRAPPERS = {"form", "fieldset", "label"}
FURNITURE = set("ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies copyright disclaimer discussion disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promotion recommended recommendations related replies reply respond search share sharing sidebar sidenav signup skip social sponsor sponsored sponsors subscribe subscription tags toolbar topbar toc widget widgets".split())
FURNITURE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu", "menubar"}
ARTICLE = set("article content post entry story main body text".split())
MARKED = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
PARTS = re.compile(r"[a-z]+")

FEATURES = ["words", "links", "prev_words", "prev_links", "next_words", "next_links", "furniture", "article"]
#: The labelled table: the eight features of a block, in the order of FEATURES, and 1 for main text.
LABELLED = [
    (6, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0), (1, 1.0, 1, 1.0, 9, 0.0, 1, 0, 0), (2, 1.0, 1, 1.0, 2, 1.0, 0, 0, 0),
    (9, 0.0, 1, 1.0, 12, 0.0, 1, 0, 0), (20, 0.0, 2, 1.0, 8, 0.0, 1, 0, 0), (60, 0.0, 1, 1.0, 8, 0.0, 1, 0, 0), (150, 0.0, 80, 0.0, 40, 0.0, 1, 0, 0),
    (8, 0.0, 9, 0.0, 70, 0.0, 0, 1, 1), (1, 0.0, 70, 0.0, 90, 0.0, 0, 1, 1), (1, 0.0, 2, 0.0, 1, 0.0, 0, 1, 1), (40, 0.0, 8, 0.0, 60, 0.0, 0, 1, 1),
    (200, 0.0, 60, 0.0, 9, 0.0, 0, 1, 1), (12, 0.0, 1, 1.0, 3, 0.0, 0, 1, 1), (30, 0.2, 50, 0.0, 60, 0.1, 0, 1, 1), (3, 0.0, 90, 0.0, 6, 0.0, 0, 1, 1),
    (3, 1.0, 60, 0.0, 3, 1.0, 0, 1, 0), (4, 1.0, 3, 1.0, 4, 1.0, 0, 1, 0), (2, 0.5, 50, 0.0, 80, 0.0, 0, 1, 1), (5, 1.0, 90, 0.0, 70, 0.0, 0, 1, 1),
    (80, 0.0, 3, 1.0, 60, 0.0, 0, 0, 1), (35, 0.1, 40, 0.0, 55, 0.0, 0, 0, 1), (25, 0.0, 30, 0.0, 4, 1.0, 0, 0, 1), (120, 0.05, 0, 0.0, 0, 0.0, 0, 0, 1),
    (7, 0.0, 50, 0.0, 60, 0.0, 0, 0, 1), (4, 0.0, 30, 0.0, 45, 0.0, 0, 0, 1), (6, 0.0, 3, 1.0, 60, 0.0, 0, 0, 1), (18, 0.0, 40, 0.0, 35, 0.0, 0, 0, 1),
    (5, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0), (4, 0.0, 60, 0.0, 2, 1.0, 0, 0, 0), (3, 0.0, 1, 1.0, 2, 0.0, 0, 0, 0), (9, 0.0, 4, 0.0, 3, 0.0, 0, 0, 0),
    (25, 0.8, 3, 1.0, 20, 0.7, 0, 0, 0), (40, 0.9, 50, 0.0, 30, 0.9, 0, 0, 0), (12, 0.6, 10, 0.6, 14, 0.7, 0, 0, 0), (8, 0.5, 5, 1.0, 4, 1.0, 0, 0, 0),
    (5, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0), (300, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1), (1, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1), (300, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0), (2, 0.0, 0, 0.0, 0, 0.0, 0, 1, 1),
    (2, 1.0, 2, 1.0, 40, 0.0, 0, 0, 0), (3, 1.0, 0, 0.0, 60, 0.0, 0, 0, 0), (1, 1.0, 1, 1.0, 8, 0.0, 0, 0, 0), (4, 0.9, 60, 0.0, 70, 0.0, 0, 0, 0),
    (110, 0.0, 120, 0.0, 3, 0.0, 0, 0, 1), (60, 0.0, 90, 0.0, 2, 1.0, 0, 0, 1), (45, 0.0, 50, 0.0, 0, 0.0, 0, 0, 1), (4, 0.0, 1, 1.0, 120, 0.0, 0, 0, 1),
    (6, 0.0, 2, 1.0, 60, 0.0, 0, 0, 1), (90, 0.0, 5, 0.0, 110, 0.0, 0, 0, 1), (70, 0.1, 80, 0.0, 4, 0.5, 0, 0, 1), (130, 0.0, 6, 0.0, 1, 1.0, 0, 0, 1),
    (2, 0.0, 1, 1.0, 60, 0.0, 1, 0, 0), (2, 0.0, 60, 0.0, 40, 0.0, 1, 0, 0), (2, 0.0, 50, 0.0, 1, 1.0, 1, 0, 0), (12, 0.0, 1, 1.0, 60, 0.0, 1, 0, 0),
    (12, 0.0, 60, 0.0, 40, 0.0, 1, 0, 0), (12, 0.0, 50, 0.0, 1, 1.0, 1, 0, 0), (45, 0.0, 1, 1.0, 60, 0.0, 1, 0, 0), (45, 0.0, 60, 0.0, 40, 0.0, 1, 0, 0),
    (45, 0.0, 50, 0.0, 1, 1.0, 1, 0, 0), (120, 0.0, 1, 1.0, 60, 0.0, 1, 0, 0), (120, 0.0, 60, 0.0, 40, 0.0, 1, 0, 0), (120, 0.0, 50, 0.0, 1, 1.0, 1, 0, 0),
    (6, 0.0, 60, 0.0, 3, 1.0, 0, 1, 1), (10, 0.0, 8, 0.0, 2, 1.0, 0, 1, 1), (4, 0.0, 40, 0.0, 2, 0.0, 0, 1, 1), (15, 0.0, 30, 0.0, 1, 1.0, 0, 1, 1),
    (2, 0.0, 12, 0.0, 2, 0.0, 0, 1, 1), (9, 0.0, 1, 1.0, 3, 0.0, 0, 1, 1), (2, 0.0, 5, 0.0, 3, 0.0, 0, 1, 1), (1, 0.0, 1, 1.0, 2, 0.0, 0, 1, 1), (7, 0.0, 20, 0.0, 2, 1.0, 0, 1, 1),
    (5, 0.8, 110, 0.0, 0, 0.0, 0, 0, 0), (4, 1.0, 90, 0.0, 0, 0.0, 0, 0, 0), (8, 0.7, 60, 0.0, 3, 1.0, 0, 0, 0), (3, 1.0, 120, 0.0, 5, 0.0, 0, 0, 0),
    (14, 0.0, 70, 0.0, 5, 0.0, 1, 1, 0), (70, 0.0, 90, 0.0, 60, 0.0, 1, 1, 0), (3, 1.0, 90, 0.0, 60, 0.0, 1, 1, 0), (10, 0.0, 40, 0.0, 90, 0.0, 1, 1, 0),
]


def train(rows=LABELLED, depth: int = 8):
    """A binary tree as nested tuples (feature, cut, below, above) or the label of a leaf."""
    x = np.array([r[:-1] for r in rows], float)
    y = np.array([r[-1] for r in rows])

    def grow(at: np.ndarray, left: int):
        n, ones = len(at), int(y[at].sum())
        if not left or ones in (0, n):
            return int(2 * ones >= n)
        best = (n + 1.0, 0, 0.0)
        for f in (6, 7, 0, 1, 2, 3, 4, 5):
            for cut in (lambda v: (v[1:] + v[:-1]) / 2)(np.unique(x[at, f])):
                low = at[x[at, f] < cut]
                p, q, m = int(y[low].sum()), ones - int(y[low].sum()), n - len(low)
                gini = 2 * p * (len(low) - p) / len(low) + 2 * q * (m - q) / m
                if gini < best[0] - 1e-12:
                    best = (gini, f, float(cut))
        if best[0] > n:
            return int(2 * ones >= n)
        f, cut = best[1:]
        return f, cut, grow(at[x[at, f] < cut], left - 1), grow(at[x[at, f] >= cut], left - 1)

    return grow(np.arange(len(y)), depth)


def predict(tree, x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), bool)

    def walk(node, at):
        if not isinstance(node, tuple):
            out[at] = bool(node)
        elif len(at):
            f, cut, low, high = node
            below = x[at, f] < cut
            walk(low, at[below])
            walk(high, at[~below])

    walk(tree, np.arange(len(x)))
    return out


def marks(tag: str, attributes: str, inside_article: bool) -> tuple[bool, bool, bool]:
    """(page furniture by its kind, page furniture by its name, article) as an element's tag and attributes say."""
    furniture = tag in FURNITURE_TAGS - WRAPPERS or tag == "header" and not inside_article
    named, article = tag in WRAPPERS, tag in ("article", "main")
    if attributes:
        if HIDDEN.search(attributes):
            furniture = True
        for m in MARKED.finditer(attributes):
            value = (m[1] or m[2] or m[3] or "").lower()
            names = set(PARTS.findall(value))
            if tag not in ("article", "main", "body", "html") and (names & FURNITURE or value in FURNITURE_ROLES):
                named = True
            article = article or tag in ("div", "section") and bool(names & ARTICLE)
    return furniture, named, article


def blocks(page: str | None) -> list[tuple[str, int, int, bool, bool]]:
    """(text, words, linked words, furniture, article) of every text block, in page order.

    A name marks an element as furniture only if it is a part of the page: not if the element holds the page's main element or first heading, or over half of all words
    (a wrapper called after the sidebar that it also holds, a form round the whole page)."""
    page, found = page or "", []
    pieces: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, tuple[int, ...], bool]] = []
    furniture = article = False
    named: tuple[int, ...] = ()
    whole: list[bool] = []  # of every named element: whether it holds the main element or first heading
    held: list[int] = []  # and its words
    links, headings = 0, 0

    def flush():
        if pieces:
            words = html.unescape("".join(pieces)).split()
            if words:
                n = len(words)
                found.append((" ".join(words), n, min(n, len(html.unescape(" ".join(linked)).split())), furniture, named, article))
                for e in named:
                    held[e] += n
            pieces.clear()
            linked.clear()

    def say(text: str):
        pieces.append(text)
        if links:
            linked.append(text)

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if not m:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                say(html.escape(m[0][9:-3]))
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in UNSEEN and not closing and not m[3].endswith("/"):
            over = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = over.end() if over else end
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in BLOCK:
            flush()
        if tag not in NESTING or tag in VOID or m[3].endswith("/") and tag not in BLOCK:
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if tag == "a" and any(s[0] in BLOCK for s in stack[i:]):
                        break
                    del stack[i:]
                    break
        else:
            f, by_name, a = marks(tag, m[3], article)
            first = tag == "h1" and not furniture and not headings
            headings += first
            if tag == "main" or first:
                for e in named:
                    whole[e] = True
            inner = named
            if by_name:
                inner = (*named, len(whole))
                whole.append(False)
                held.append(0)
            stack.append((tag, furniture or f, inner, article or a))
        furniture, named, article = stack[-1][1:] if stack else (False, (), False)
        links = sum(s[0] == "a" for s in stack)
    flush()
    half = sum(b[1] for b in found) / 2
    part = [not w and h <= half for w, h in zip(whole, held, strict=True)]
    return [(text, n, linked_words, kind or any(part[e] for e in names), main) for text, n, linked_words, kind, names, main in found]


def features(found: list[tuple[str, int, int, bool, bool]]) -> np.ndarray:
    x = np.zeros((len(found), len(FEATURES)))
    for i, (_, words, links, furniture, article) in enumerate(found):
        x[i, 0], x[i, 1], x[i, 6], x[i, 7] = words, links / words, furniture, article
    x[1:, 2:4] = x[:-1, :2]
    x[:-1, 4:6] = x[1:, :2]
    return x


def extract(page: str | None, tree) -> tuple[str, int, int]:
    """(main text, blocks, kept blocks) of one page."""
    found = blocks(page)
    keep = predict(tree, features(found)) if found else []
    kept = [b[0] for b, k in zip(found, keep, strict=True) if k]
    return "\n".join(kept), len(found), len(kept)


def main_text(pages: DataFrame, *, id_col="page_id", url_col="url", html_col="html", labelled=LABELLED) -> DataFrame:
    tree = train(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [extract(h, tree) for h in batch.column(2).to_pylist()]
            text, n, k = (list(c) for c in zip(*got, strict=True)) if got else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()), pa.array(n, pa.int64()), pa.array(k, pa.int64())],
                ["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"],
            )

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")).mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
