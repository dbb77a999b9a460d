"""Main text of HTML pages as a maximum-scoring subsequence (operator 8).

A page is a sequence of words and tags.  Words score positive, tags negative;
the contiguous stretch with the largest sum is the content, found in one
linear scan.  The weights are learned from the pages that label themselves:
where a page has exactly one ``article`` or ``main`` element, what is inside
is content and the rest is not, and a word (by the element it stands in) or a
tag weighs the logarithm of how many times as often it stood inside.

What the HTML vocabulary itself names as something else (navigation, footers,
asides, forms, scripts, elements whose class says advert or comments, ...)
never counts and does not interrupt the content around it.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import batches, columns, small_batches

# Element names of the HTML standard and common class words.
BLOCK = set(
    "address article blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol option p pre section summary table tbody td tfoot "
    "th thead title tr ul".split()
)
INLINE = set("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
ASIDE = set(
    "aside button canvas datalist dialog footer form head iframe label map menu nav noembed noframes noscript object "
    "script select style svg template textarea title xmp audio video math".split()
)
ROLES = set("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NAMES = set(
    "ad ads advert advertisement advertising adsbygoogle alert author-bio banner breadcrumb breadcrumbs byline comment "
    "comments commentlist consent cookie cookies disclaimer disqus dropdown footer gdpr header login masthead menu modal "
    "nav navbar navigation newsletter notice notices notification pagination pager popup promo promoted promotion "
    "related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "tags toolbar topbar widget widgets".split()
)
CONTENT = {"article", "main"}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
# One attribute after the other, so that nothing within a quoted value is read as a name.
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']+))?|"[^"]*"|'[^']*'""")
# Class words that begin so speak of the page around (with-sidebar, has-comments, no-ads).
SPEAKS = {"no", "non", "not", "with", "without", "has", "hide", "is"}
# The head of an article, not of a site.
OWN_HEAD = {"entry", "post", "article", "story", "content", "headline"}
# Never content, whatever they hold: others' texts.
OTHERS = set("comment comments commentlist disqus related replies reply respond".split())
_SKIP = re.compile(r"<!--|<!|<\?|<(?=[/a-zA-Z])")

TEXT, OPEN, CLOSE = 0, 1, 2
# Quotes are paired within this many characters of a tag's start; a tag that is
# longer, or whose quotes do not pair, ends at the first ">".
TAG_CHARS = 1 << 14


def tokens(page: str) -> Iterator[tuple[int, str, str]]:
    """(TEXT, characters, ""), (OPEN, name, attributes) and (CLOSE, name, "")
    in page order; comments, declarations and the content of raw-text elements
    are left out.  What is never closed runs to the end."""
    at, size, last = 0, len(page), page.rfind(">")
    lower = None
    while at < size:
        found = _SKIP.search(page, at)
        if not found:
            yield TEXT, page[at:], ""
            return
        if found.start() > at:
            yield TEXT, page[at : found.start()], ""
        at = found.start()
        mark = found.group()
        if mark == "<!--":
            end = page.find("-->", at + 4)
            at = size if end < 0 else end + 3
        elif mark != "<":
            end = page.find(">", at + 2)
            at = size if end < 0 else end + 1
        else:
            tag = at < last and (_TAG.match(page, at, at + TAG_CHARS) or _LOOSE.match(page, at))
            if not tag:  # a sign, not a tag
                yield TEXT, "<", ""
                at += 1
                continue
            at = tag.end()
            name = tag.group(2).lower()
            if tag.group(1):
                yield CLOSE, name, ""
                continue
            yield OPEN, name, tag.group(3)
            if name in RAW and not tag.group(3).endswith("/"):
                lower = lower if lower is not None else page.lower()
                end = lower.find(f"</{name}", at) if len(lower) == size else page.find(f"</{name}", at)
                at = size if end < 0 else end


def _named(word: str) -> str:
    """The name by which a class or id word says boilerplate, or nothing."""
    if word in NAMES:
        return word
    pieces = re.split(r"[-_]", word)
    if pieces[0] in SPEAKS or (pieces[-1] == "header" and pieces[0] in OWN_HEAD):
        return ""
    return next((p for p in (pieces[0], pieces[-1]) if p in NAMES), "")


def _boilerplate(name: str, attributes: str) -> str:
    """Why an element is no content: "always" (its name, or hidden), "form", the
    name its class, id or role gives it, or nothing."""
    if name in ASIDE:
        return "form" if name == "form" else "always"
    found = ""
    for key, value in _ATTRIBUTE.findall(attributes):
        key, values = key.lower(), value.strip("\"'").lower()
        if key == "hidden":
            return "always"
        if key == "role" and values in ROLES:
            found = found or values
        if key in ("class", "id") and name not in ("html", "body"):
            found = found or next(filter(None, map(_named, values.split())), "")
    return found


def _matches(page: list[tuple[int, str, str]]) -> dict[int, int]:
    """For each opening tag that is closed, the place of its closing tag.  A
    closing tag closes the last open element of its name and leaves unclosed
    whatever was opened since."""
    opened: dict[str, list[int]] = {}
    out, floor = {}, []
    for i, (kind, name, _) in enumerate(page):
        if kind == OPEN and name not in VOID:
            opened.setdefault(name, []).append(i)
            floor.append((i, name))
        elif kind == CLOSE and opened.get(name):
            start = opened[name][-1]
            while floor and floor[-1][0] >= start:
                _, inner = floor.pop()
                opened[inner].pop()
            out[start] = i
    return out


def _holds(page: list[tuple[int, str, str]], start: int, stop: int, reason: str, own: list[int]) -> bool:
    """Whether a wrapper named like boilerplate is around the content: it holds
    every element that labels itself so, or, for a form on a page without any,
    most of the words."""
    if reason in OTHERS or reason == "always" or not reason:
        return False
    if own:
        return start < own[0] and own[-1] < stop
    if reason != "form":
        return False
    words = [len(text.split()) if kind == TEXT else 0 for kind, text, _ in page]
    return 2 * sum(words[start:stop]) > sum(words)


class Page:
    """The scored tokens of a page: ``features`` and, alongside, ``pieces`` of
    text; a piece of "\n" separates blocks."""

    def __init__(self, source: str):
        page = list(tokens(source))
        closes = _matches(page)
        reasons = {i: _boilerplate(name, attributes) for i, (kind, name, attributes) in enumerate(page) if kind == OPEN}
        # What labels itself as the content; a wrapper that holds all of it is none of the rest.
        own = [i for i, (kind, name, _) in enumerate(page) if kind == OPEN and name in CONTENT and not reasons[i]]
        self.features: list[str] = []
        self.pieces: list[str] = []
        self.words: list[int] = []  # words of the item; 0 for a tag
        self.content: list[tuple[int, int]] = []  # item ranges of article and main elements
        inside, links = [], 0
        skip_to = -1
        marks: dict[int, int] = {}
        for i, (kind, name, attributes) in enumerate(page):
            if i <= skip_to:
                continue
            if kind == TEXT:
                text = html.unescape(name)
                count = len(text.split())
                block = inside[-1] if inside else "body"
                self._add(f"w:{block}{':a' if links else ''}", text, count)
                continue
            site_header = name == "header" and CONTENT.isdisjoint(inside)
            if kind == OPEN and (site_header or reasons[i]) and not _holds(page, i, closes.get(i, i), reasons[i], own):
                # Not content; an element that is never closed hides nothing but its own tag.
                skip_to = closes.get(i, i)
                self._add("", "\n" if name not in INLINE else "", 0)
                continue
            known = name if name in BLOCK or name in INLINE or name in VOID else "other"
            if kind == OPEN and name in CONTENT:
                marks[closes.get(i, i)] = len(self.features) + 1
            if kind == CLOSE and i in marks:
                self.content.append((marks[i], len(self.features)))
            self._add(("/" if kind == CLOSE else "") + known, "\n" if known not in INLINE else "", 0)
            if name == "a":
                links = max(0, links + (1 if kind == OPEN else -1))
            elif name in BLOCK and name not in VOID:
                if kind == OPEN:
                    inside.append(name)
                elif name in inside:
                    while inside.pop() != name:
                        pass
                    links = 0

    def _add(self, feature: str, piece: str, words: int) -> None:
        self.features.append(feature)
        self.pieces.append(piece)
        self.words.append(words)

    def text(self, start: int, stop: int) -> str:
        blocks = "".join(p if w == 0 and p == "\n" else p.replace("\n", " ") for p, w in zip(self.pieces[start:stop], self.words[start:stop]))
        return " ".join(t for t in (" ".join(b.split()) for b in blocks.split("\n")) if t)

    def counts(self) -> dict[str, tuple[int, int]]:
        """(inside, outside) of the content per feature, for a page that labels
        itself; else nothing."""
        if len(self.content) != 1:
            return {}
        start, stop = self.content[0]
        inside: Counter = Counter()
        outside: Counter = Counter()
        for i, (feature, words) in enumerate(zip(self.features, self.words)):
            if feature:
                (inside if start <= i < stop else outside)[feature] += words if feature.startswith("w:") else 1
        return {f: (inside[f], outside[f]) for f in {*inside, *outside}}

    def best(self, weights: dict[str, float]) -> tuple[int, int]:
        """The range of items with the largest sum; the first of equals.  (0, 0)
        without words."""
        best, most, start, sum_ = (0, 0), 0.0, 0, 0.0
        for i, (feature, words) in enumerate(zip(self.features, self.words)):
            if feature.startswith("w:"):
                sum_ += words * weights.get(feature, DEFAULT_WORD)
            elif feature:
                sum_ += weights.get(feature, DEFAULT_TAG)
            if sum_ <= 0:
                sum_, start = 0.0, i + 1
            elif sum_ > most:
                most, best = sum_, (start, i + 1)
        return best


# For what no labelled page shows, and the ranges learned weights keep.
DEFAULT_WORD, DEFAULT_TAG = 1.0, -0.4
WORD_RANGE, TAG_RANGE = (0.05, 2.0), (-12.0, -0.2)


def learn(pages: DataFrame) -> dict[str, float]:
    """Weights from all self-labelled pages: counts add up in Spark, one row per
    feature (element names of the standard) reaches the driver."""
    schema = pa.schema([("feature", pa.string()), ("inside", pa.int64()), ("outside", pa.int64())])

    def run(source):
        for batch in source:
            total: dict[str, list[int]] = {}
            for (page,) in zip(*columns(batch, "html")):
                for feature, (a, b) in Page(page).counts().items():
                    own = total.setdefault(feature, [0, 0])
                    own[0] += a
                    own[1] += b
            yield from batches([(f, a, b) for f, (a, b) in total.items()], schema)

    counted = pages.mapInArrow(run, "feature string, inside long, outside long").groupBy("feature")
    rows = counted.agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    return weights({r.feature: (r.inside, r.outside) for r in rows})


def weights(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """The logarithm of how many times as often a feature stood inside, kept
    positive for words and negative for tags."""
    out = {}
    for feature, (inside, outside) in counts.items():
        low, high = WORD_RANGE if feature.startswith("w:") else TAG_RANGE
        out[feature] = min(high, max(low, math.log((inside + 1) / (outside + 1))))
    return out


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``.

    Whole pages.  A null or empty html, or one without words, has the empty
    text; repeated rows come out repeated, a null page_id or url stays null;
    other columns are left out.
    """
    small_batches(pages.sparkSession)
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html")
    )
    learned = learn(own.select("html"))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(source):
        for batch in source:
            rows = []
            for page_id, url, source_html in zip(*columns(batch, "page_id", "url", "html")):
                page = Page(source_html)
                text = page.text(*page.best(learned))
                rows.append((page_id, url, text, len(text)))
            yield from batches(rows, schema)

    return own.mapInArrow(run, "page_id long, url string, text string, n_chars long")
