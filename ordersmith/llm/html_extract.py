"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is read as a sequence of words and tags. Words score positive and tags negative,
with weights by where they stand: for every kind of element, labelled pages (those that
mark their article) tell how much of its words and tags lies in the article, and
the log odds move its words' and tags' scores. One linear scan finds the contiguous
stretch with the highest sum; it is the content region, and what elements of another
kind (menus, adverts, forms, comments, ...) hold inside it is left out.

Weights are fitted on a bounded sample of pages and reach the tasks as a small
dictionary (kinds of elements, a closed set). Pages are read where they lie: no shuffle.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .staging import require

SAMPLE_PAGES = 2000
INTERRUPTION = -0.02
ADDED = ["text", "n_chars"]

_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)"
                  r"/?>|[!?][^>]*>)", re.S)
_UNFINISHED = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")       # a tag that the page's end cuts off
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true",
                     re.I)
_WORD = re.compile(r"[a-z]+")
_TOKEN = re.compile(r"\S+")
#: elements whose content is no text
RAW = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "textarea",
       "select", "option", "title"}
#: elements that hold no article text
NOISE = {"nav", "footer", "aside", "form", "header", "menu", "dialog", "button", "head", "label",
         "fieldset", "input"}
#: words in class, id or role that mark such elements
NOISE_NAMES = {
    "ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "consent", "cookie", "cookies", "discussion", "disqus", "footer", "form", "header",
    "masthead", "menu", "menus", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "notices", "popup", "promo", "promoted", "promotion", "related", "replies", "reply", "responses",
    "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe",
    "thread", "threads", "toolbar", "widget",
}
ARTICLE = {"article", "main"}
#: elements that stand inside a line; all others begin a new block
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
          "font", "i", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span",
          "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr"}
#: elements that an opening tag of the same group closes
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}}
#: block elements that end an open paragraph
ENDS_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure",
          "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol",
          "p", "pre", "section", "table", "ul"}


def _kind(name: str, attrs: str) -> tuple[str, bool, bool]:
    """Kind of an element, whether it holds no article text by its name or marks, and whether
    that is doubtful: a form, or a mark that is only part of a name ("has-sidebar"), may as
    well stand around the whole page."""
    hit = whole = False
    if attrs:
        if _HIDDEN.search(attrs):
            return name + ".hidden", True, False
        for m in _NAMES.finditer(attrs):
            for token in _TOKEN.findall((m[1] or m[2] or m[3] or "").lower()):
                hit = hit or not NOISE_NAMES.isdisjoint(_WORD.findall(token))
                whole = whole or token in NOISE_NAMES
    if hit and name not in ARTICLE and name not in ("html", "body"):
        return name + ".noise", True, not whole and (name == "form" or name not in NOISE)
    return name, name in NOISE, name == "form"


def _wrappers(page: str) -> set[int]:
    """Where the elements begin that hold the page's main article, or over half of its words
    if the page marks no article. Doubtful marks say nothing of these. The main
    article is the marked one with the most words; a mark inside a certain menu, sidebar or
    comment list counts too, but frees only doubtful elements."""
    stack: list[tuple[str, int, int]] = []             # name, start, words before
    spans: list[tuple[int, int, int, str]] = []        # start, end, words, name
    at, words, raw = 0, 0, None

    def close(depth: int, end: int) -> None:
        while len(stack) > depth:
            name, start, before = stack.pop()
            spans.append((start, end, words - before, name))

    for m in _TAG.finditer(page):
        if m.start() < at:
            continue
        name = (m[2] or "").lower()
        if raw is not None:
            if m[1] and name == raw:
                raw, at = None, m.end()
            continue
        words += len(page[at:m.start()].split())
        at = m.end()
        if not name or name in VOID or name in INLINE:
            continue
        if name in RAW:
            if not m[1] and not m[0].endswith("/>"):
                raw = name
        elif not m[1]:
            stack.append((name, m.start(), words))
        else:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    close(depth, m.end())
                    break
    if raw is None:
        words += len(page[at:].split())
    close(0, len(page))
    marked = [s for s in spans if s[3] in ARTICLE]
    if marked:
        start, end, _, _ = max(marked, key=lambda s: (s[2], -s[0]))
        return {s[0] for s in spans if s[0] <= start and s[1] >= end}
    return {s[0] for s in spans if 2 * s[2] > words}


def tokens(page: str) -> Iterator[tuple[str, str, bool, bool, bool]]:
    """(tag or text, kind, noise, inside the marked article, begins a block), in page order.

    Tags come with an empty text. The kind of a text is that of its innermost
    block element; noise holds within all elements below one that is.
    """
    stack: list[tuple[str, str, bool, bool]] = []     # name, kind, noise, in article
    at, raw, wrappers = 0, None, None
    state = ("", "page", False, False)
    for m in _TAG.finditer(page):
        if m.start() < at:
            continue
        name = (m[2] or "").lower()
        if raw is not None:
            if not (m[1] and name == raw):
                continue
            raw, at = None, m.end()
            yield "", raw or name, True, state[3], True
            continue
        if m.start() > at:
            yield page[at:m.start()], state[1], state[2], state[3], False
        at = m.end()
        if not name:
            continue
        if name in RAW and not m[1]:
            if not m[0].endswith("/>"):
                raw = name
            yield "", name, True, state[3], True
            continue
        inline = name in INLINE
        if m[1]:
            if any(s[0] == name for s in stack):
                while stack and stack.pop()[0] != name:
                    pass
            state_after = stack[-1] if stack else ("", "page", False, False)
            yield "", state[1] if inline else name, state[2], state[3] and state_after[3], not inline
            state = state_after
            continue
        if name in VOID:
            yield "", name, state[2], state[3], not inline
            continue
        if name in ENDS_P and any(s[0] == "p" for s in stack):
            depth = max(i for i, s in enumerate(stack) if s[0] == "p")
            if all(s[0] in INLINE or s[0] == "p" for s in stack[depth:]):
                del stack[depth:]
        elif stack and stack[-1][0] in CLOSES.get(name, ()):
            stack.pop()
        state = stack[-1] if stack else ("", "page", False, False)
        kind, noise, doubtful = _kind(name, m[3])
        if doubtful:
            wrappers = _wrappers(page) if wrappers is None else wrappers
            if m.start() in wrappers:
                kind, noise = name, False
        in_article = state[3] or name in ARTICLE
        new = (name, state[1] if inline and not noise else kind, state[2] or noise, in_article)
        yield "", new[1], new[2], state[3], not inline
        stack.append(new)
        state = new
    rest = _UNFINISHED.sub("", page[at:]) if raw is None else ""
    if rest:
        yield rest, state[1], state[2], state[3], False


def _counts(page: str, into: dict) -> None:
    """Words and tags by (kind, noise), inside and outside the marked article."""
    if not re.search(r"<(?:article|main)\b", page, re.I):
        return
    for text, kind, noise, inside, _ in tokens(page):
        n = len(text.split()) if text else 1
        if n:
            row = into.setdefault((bool(text), kind, noise), [0, 0])
            row[not inside] += n


WEIGHTS = "word boolean, kind string, noise boolean, inside long, outside long"


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict = {}
    for batch in batches:
        for page in batch.column(0).to_pylist():
            if page:
                _counts(page, total)
    keys = list(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.bool_()), pa.array([k[1] for k in keys], pa.string()),
         pa.array([k[2] for k in keys], pa.bool_()),
         pa.array([total[k][0] for k in keys], pa.int64()),
         pa.array([total[k][1] for k in keys], pa.int64())],
        names=["word", "kind", "noise", "inside", "outside"])


def fit_weights(pages: DataFrame, html_col: str = "html", max_pages: int = SAMPLE_PAGES) -> dict:
    """Score of a word or tag by (is a word, kind of element, noise).

    ``max_pages`` (about) bounds the sample, chosen by the hash of the whole row, so that a
    page that many rows share is sampled like any other. A word scores
    1 plus its log odds of lying in an article, a tag -1 plus its own, between
    -8 and 8; tags never score above 0. Words and tags of noise elements, which no text
    is taken from, score ``INTERRUPTION``, so that an advert does not cut an article in two.
    """
    share = min(1.0, max_pages / max(1, pages.count()))
    row = [F.col(f"`{f.name}`") for f in pages.schema if not re.search("map<|variant", f.dataType.simpleString())]
    rows = (pages.where(F.pmod(F.xxhash64(*row), F.lit(1 << 30)) < int(share * (1 << 30)))
            .select(F.col(html_col).cast("string").alias("h")).mapInArrow(_count_rows, WEIGHTS)
            .groupBy("word", "kind", "noise").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o"))
            .orderBy(F.desc(F.col("i") + F.col("o")), "word", "kind", "noise").limit(4096).collect())
    weights = {}
    for r in rows:
        odds = max(-8.0, min(8.0, math.log((r["i"] + 0.5) / (r["o"] + 0.5))))
        if r["word"]:
            weights[True, r["kind"], r["noise"]] = INTERRUPTION if r["noise"] else 1 + odds
        else:
            weights[False, r["kind"], r["noise"]] = INTERRUPTION if r["noise"] else min(0.0, odds - 1)
    return weights


#: before any labelled page is seen
PRIOR = {**{(True, k, False): 2.0 for k in ("p", "h1", "h2", "h3", "h4", "blockquote", "pre", "article",
                                             "main", "td", "dd", "figcaption")},
         **{(True, k, False): 1.0 for k in ("div", "section", "page", "body", "span")},
         **{(True, k, False): -1.0 for k in ("li", "ul", "a")}}


def _score(weights: dict, word: bool, kind: str, noise: bool) -> float:
    w = weights.get((word, kind, noise))
    if w is None:
        w = PRIOR.get((True, kind, noise), 1.0)
        if not word:
            w = -0.25 if w > 1 else -1.0
        if noise:
            w = INTERRUPTION
    return w


def extract(page: str | None, weights: dict) -> str:
    """The page's main text ('' if it has none)."""
    if not page:
        return ""
    seq = list(tokens(page))
    best = total = 0.0
    begin = start = end = 0
    for i, (text, kind, noise, _, _) in enumerate(seq):
        if text:
            n = len(text.split())
            total += n * _score(weights, True, kind, noise) if n else 0.0
        else:
            total += _score(weights, False, kind, noise)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, begin, end = total, start, i + 1
    blocks, line = [], []
    for text, _, noise, _, breaks in seq[begin:end]:
        if breaks and line:
            blocks.append("".join(line))
            line = []
        if text and not noise:
            line.append(html.unescape(text) if "&" in text else text)
    blocks.append("".join(line))
    return " ".join(" ".join(blocks).split())


def extract_main_text(pages: DataFrame, html_col: str = "html", weights: dict | None = None) -> DataFrame:
    """``pages`` with text (main text, empty if none) and n_chars (its code points).

    Null and empty pages give an empty text. Whole pages are read, however long. Input
    columns named like the added ones are replaced; all others, repeated rows and
    rows without an id pass through one by one.
    """
    require(pages, html_col)
    weights = fit_weights(pages, html_col) if weights is None else weights
    rows = pages.select(*[c for c in pages.columns if c not in ADDED or c == html_col])
    at = rows.columns.index(html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                text = [extract(p, weights) for p in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    part.columns + [pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                    names=list(part.schema.names) + ADDED)

    schema = StructType(rows.schema.fields + StructType.fromDDL("text string, n_chars long").fields)
    return rows.mapInArrow(run, schema)
