"""Main text of web pages: the best contiguous region of scored words and tags."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import share

# Labelled pages the weights are taken from, in expectation: the bound of the fit.
FIT_PAGES = 500
# Every tag costs this at least.
LEAST_COST = 0.05
# Word weights that are tried on the labelled pages.
WORD_WEIGHTS = (0.02, 0.05, 0.1, 0.2, 0.5, 1.0)

_EVENT = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|object|textarea|select)\b.*?(?:</\1\s*>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*?)(?:>|\Z)"
    r"|([^<]+|<)",
    re.S | re.I,
)
# A name, and its value in quotes or up to white space.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
# What is never part of an article, by element and by class, id and role. A name of one word
# counts as a whole; of several words, joined by signs, the first or last one counts.
_APART = frozenset("head nav footer aside form button dialog menu header title".split())
_ALWAYS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored nav navbar navigation menu breadcrumb "
    "breadcrumbs pagination pager toc masthead footer sidebar aside complementary contentinfo comment comments "
    "commentlist respond replies disqus cookie cookies consent popup newsletter".split()
)
# The same, unless the element holds most of the page's words: then it is a name of its content.
_MOSTLY = _ALWAYS | frozenset(
    "promo promotion banner header topbar bottom side rail reply discussion review reviews notice notices alert "
    "alerts warning disclaimer modal overlay subscribe subscription signup login search share sharing social "
    "related recommended widget toolbar tools hidden copyright".split()
)
# A name with one of these tells how a page is laid out, not what an element is.
_STATES = frozenset("has have no not with without is by".split())
_JOINED = re.compile(r"[-_]+")
_ARTICLE = frozenset(["article", "main"])
# No class, id or role sets these apart.
_WHOLE = _ARTICLE | {"html", "body"}
_BLOCK = frozenset(
    "address article aside blockquote body br button center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li link main menu meta nav ol "
    "option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


@dataclass
class Event:
    """A tag (its kind is the name, with the first class for opening tags) or a text."""

    kind: str
    name: str
    opens: bool
    text: str = ""
    words: int = 0
    apart: bool = False  # it stands in an element that is never part of an article
    bars: bool = False  # it opens such an element
    may_bar: bool = False  # it does, unless it holds most of the page's words


def events_of(page: str) -> list[Event]:
    """Tags and texts in page order, with scripts, styles and comments gone."""
    found = []
    for m in _EVENT.finditer(page):
        raw, closing, name, attributes, text = m.groups()
        if text is not None:
            text = html.unescape(text)
            found.append(Event("", "", False, text, len(text.split())))
        elif name:
            name = name.lower()
            kind, bars = name, False
            if closing:
                found.append(Event("/" + name, name, False))
                continue
            may_bar = False
            if attributes and not attributes.isspace():
                values = {n.lower(): a or b or c for n, a, b, c in _ATTRIBUTE.findall(attributes)}
                classes = values.get("class", "").lower().split()
                if classes:
                    kind = f"{name}.{classes[0]}"
                if name not in _WHOLE:
                    bars, may_bar = _barred([*classes, values.get("id", "").lower(), values.get("role", "").lower()])
                bars |= "hidden" in values or values.get("aria-hidden", "").lower() == "true"
                bars |= "display:none" in values.get("style", "").replace(" ", "").lower()
            bars = (bars and name not in ("html", "body")) or name in _APART
            inner = name not in _VOID
            found.append(Event(kind, name, True, bars=bars and inner, may_bar=may_bar and inner))
    _settle(found)
    _mark_apart(found)
    return found


def _barred(names: list[str]) -> tuple[bool, bool]:
    """Whether one of the names is always that of something apart, and whether mostly."""
    mostly = False
    for name in names:
        if name in _ALWAYS:
            return True, True
        words = _JOINED.split(name)
        mostly |= name in _MOSTLY
        if len(words) > 1 and not _STATES & set(words):
            mostly |= words[0] in _MOSTLY or words[-1] in _MOSTLY
    return False, mostly


def _settle(found: list[Event]) -> None:
    """Elements that mostly are apart are so if they hold at most half of the words that no
    element which always is apart has, and no article or main part."""
    doubtful = [k for k, e in enumerate(found) if e.may_bar and not e.bars]
    if not doubtful:
        return
    words = [e.words for e in found]
    i = 0
    while i < len(found):
        end = _end(found, i) if found[i].bars and found[i].name != "header" else i + 1
        if end > i + 1:
            words[i:end] = [0] * (end - i)
        i = end
    total, upto = sum(words), [0, *accumulate(words)]
    for k in doubtful:
        end = _end(found, k)
        holds = any(e.opens and e.name in _ARTICLE for e in found[k:end])
        found[k].bars = not holds and 2 * (upto[end] - upto[k]) <= total


def _mark_apart(found: list[Event]) -> None:
    inside, i = 0, 0
    while i < len(found):
        e = found[i]
        if e.name in _ARTICLE and not e.bars:
            inside += 1 if e.opens else -1
        # The heading of an article may stand in a header element of its own.
        if not e.bars or (e.kind == "header" and inside > 0):
            i += 1
            continue
        end = _end(found, i)
        for k in range(i, end):
            found[k].apart = True
        i = end


def _end(found: list[Event], i: int) -> int:
    """The event after the element that opens at ``i``. One that is never closed ends where
    an article, a main part or a first heading opens, a paragraph at the next block."""
    name, depth = found[i].name, 0
    for k in range(i, len(found)):
        e = found[k]
        if name == "p" and k > i and e.opens and e.name in _BLOCK and e.name != "br":
            return k
        if e.name == name:
            depth += 1 if e.opens else -1
            if not depth:
                return k + 1
    for k in range(i + 1, len(found)):
        if found[k].opens and (found[k].name in _ARTICLE or found[k].name == "h1"):
            return k
    return len(found)


@dataclass(frozen=True)
class Weights:
    word: float
    tags: dict[str, float]
    unknown: float

    def of(self, e: Event) -> float:
        if e.apart:
            return 0.0
        if not e.kind:
            return self.word * e.words
        return self.tags.get(e.kind, self.tags.get(e.name, self.unknown))


DEFAULT = Weights(0.2, {}, -0.2)


def best_region(found: list[Event], weights: Weights) -> tuple[int, int]:
    """The contiguous events of the largest sum, (0, 0) if no word counts. One linear scan;
    of equal sums the first, of those the shortest."""
    best, at, run, start = 0.0, (0, 0), 0.0, 0
    for k, e in enumerate(found):
        if run <= 0:
            run, start = 0.0, k
        run += weights.of(e)
        if run > best + 1e-12:
            best, at = run, (start, k + 1)
    return at


def region_text(found: list[Event], start: int, end: int) -> str:
    blocks, now = [], []
    for e in found[start:end]:
        if e.kind:
            if e.name in _BLOCK and now:
                blocks.append("".join(now))
                now = []
        elif not e.apart:
            now.append(e.text)
    blocks.append("".join(now))
    return " ".join(b for b in (" ".join(block.split()) for block in blocks) if b)


def main_text(page: str | None, weights: Weights) -> str:
    if not page:
        return ""
    found = events_of(page)
    return region_text(found, *best_region(found, weights))


def labelled_region(found: list[Event]) -> tuple[int, int] | None:
    """Where a page says itself that its only article is."""
    opened = [k for k, e in enumerate(found) if e.opens and e.name in _ARTICLE and not e.apart]
    if not opened:
        return None
    name = found[opened[0]].name
    if sum(found[k].name == name for k in opened) != 1:
        return None
    closed = [k for k, e in enumerate(found) if e.kind == f"/{name}"]
    return (opened[0], closed[-1] + 1) if closed and closed[-1] > opened[0] else None


def _count_tags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        inside, outside = Counter(), Counter()
        for page in batch.column(0).to_pylist():
            found = events_of(page)
            region = labelled_region(found)
            if region:
                for k, e in enumerate(found):
                    if e.kind and not e.apart:
                        (inside if region[0] <= k < region[1] else outside)[e.kind] += 1
        for which, counts in ((1, inside), (0, outside)):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([which] * len(counts), pa.int32()),
                    pa.array(list(counts), pa.string()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["inside", "kind", "n"],
            )


def fit(pages: DataFrame, column: str = "html") -> Weights:
    """Weights from pages that mark their article: a bounded sample of `FIT_PAGES` expected.

    A tag costs the logarithm of how much oftener it stands outside than inside articles,
    `LEAST_COST` at least, so tags of articles cost little and those of menus much. The
    weight of a word is the one of `WORD_WEIGHTS` under which the scan finds the marked
    articles best, the middle one of equals. Without a labelled page the weights are `DEFAULT`.
    """
    marked = pages.select(F.col(column).alias("html")).filter(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    n = marked.count()
    if not n:
        return DEFAULT
    drawn = marked.filter(share("html", seed=3) < min(1.0, FIT_PAGES / n))
    counts = drawn.mapInArrow(_count_tags, "inside int, kind string, n long")
    rows = counts.groupBy("kind").agg(
        F.sum(F.col("n") * F.col("inside")).alias("a"), F.sum(F.col("n") * (1 - F.col("inside"))).alias("b")
    ).filter("a + b >= 5").collect()
    if not rows:
        return DEFAULT
    tags = {r.kind: -max(LEAST_COST, math.log((r.b + 1) / (r.a + 1))) for r in rows}
    unknown = -max(LEAST_COST, sum(-w for w in tags.values()) / len(tags))
    tried = [Weights(w, tags, unknown) for w in WORD_WEIGHTS]
    errors = drawn.mapInArrow(_errors(tried), "k int, missed long").groupBy("k").agg(F.sum("missed"))
    missed = dict(errors.collect())
    least = min(missed.get(k, 0) for k in range(len(tried)))
    best = [w for k, w in enumerate(tried) if missed.get(k, 0) == least]
    return best[len(best) // 2]


def _errors(tried: list[Weights]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            missed = [0] * len(tried)
            for page in batch.column(0).to_pylist():
                found = events_of(page)
                region = labelled_region(found)
                if not region:
                    continue
                for k, weights in enumerate(tried):
                    a, b = best_region(found, weights)
                    missed[k] += sum(
                        e.words
                        for i, e in enumerate(found)
                        if not e.apart and (a <= i < b) != (region[0] <= i < region[1])
                    )
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(tried)), pa.int32()), pa.array(missed, pa.int64())],
                names=["k", "missed"],
            )

    return count


def extract(
    pages: DataFrame,
    weights: Weights,
    page_id: str = "page_id",
    url: str = "url",
    column: str = "html",
) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points), from the whole html.

    Words score positive, tags negative; one scan finds the contiguous region of the
    largest sum. Elements that are never part of an article (menus, headers, footers, sidebars,
    forms, adverts, notices, comments, scripts, styles, what is hidden) neither score
    nor show; classes, ids and roles tell such elements too, but never an article or main part, and
    doubtful names not the element that holds most of the words. Character references are decoded, white space in a block becomes one
    space, blocks are trimmed and joined by one space.

    Null, empty and wordless pages have the empty text. Pages that break off are read
    as far as they go, very long ones whole. Null ids and urls are kept, repeated rows give
    repeated rows, an empty table gives none, further columns are ignored.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py(), weights) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    own = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(column).alias("html")
    )
    return own.mapInArrow(convert, "page_id long, url string, text string, n_chars long")
