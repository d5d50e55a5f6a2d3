"""Main text of web pages as the maximum-scoring run of tokens.

A page is read as words and tags. Words score positive, tags and words of links
negative; the contiguous run with the largest sum, found in one pass, is the
main text. An element that is page furniture by its tag (nav, footer, form ...)
scores as its two tags, and its words are never part of the text. A mark of the
main text (article, main) is evidence, not a verdict: inside it links and tags do
not speak against the text, and a run that crosses its edge pays for it.

Words of class, id and role are tokens with weights too. Where they speak against
an element (sidebar, advert, comments ...), it is read as a region of its own: the
text around it goes on without it, and its own best run counts less by the
weight of its names. The best run of all regions is the main text, so such a name
on a wrapper of the body does not hide the body. Elements of the same names
within a region are one region.

The weights are log likelihood ratios counted on labelled pages: pages that mark
their main text with an article or main element.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspace.llm.common import Sent, columns_as
from termspace.session import remove, scratch_path, settle

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)"""
    r"""|</?[a-zA-Z][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)|(?P<text>[^<]+|<)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

# Facts of HTML: elements by how they are read.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
_SAME_CLOSES = frozenset("li dd dt tr td th option".split())
_SCOPE = frozenset("article aside body div section main td th table ul ol dl blockquote form footer header nav".split())
_MAIN = ("article", "main")
# Page furniture by element.
_FURNITURE = frozenset(
    "head script style noscript template nav footer aside form button select option textarea title iframe svg canvas "
    "object embed applet dialog menu fieldset xmp noembed noframes audio video map".split()
)
# Words of class, id and role that speak against an element, until pages tell more.
_SUSPECT_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted banner "
    "sidebar sidebars aside reply replies cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe subscription signup login share sharing sharebar "
    "social related recommended recommendations breadcrumb breadcrumbs nav navbar navigation menu menus footer foot "
    "masthead toolbar pagination pager widget widgets contentinfo complementary search dialog alertdialog skip".split()
)
_COMMENT_WORDS = frozenset("comment comments disqus respond".split())
_HEADER_WORDS = frozenset(["header", "topbar"])
# Text in a form makes it a wrapper of the page.
_FORM_TEXT = re.compile(r"<(?:p|article|main)(?=[\s/>])", re.IGNORECASE)
_FORM_END = re.compile(r"</form(?=[\s/>])", re.IGNORECASE)
_KNOWN = _VOID | _RAW | _INLINE | _CLOSES_P | _SAME_CLOSES | _SCOPE | _FURNITURE | frozenset(
    "html tbody thead tfoot caption summary details picture center label legend".split()
)

WORD, LINK_WORD, FURNITURE = "#word", "#link word", "#furniture"
_FURNITURE_TAG, _UNSEEN_TAG = "#furniture tag", "#unseen tag"
# Without labelled pages.
_DEFAULT = {WORD: 1.0, LINK_WORD: -0.5, _FURNITURE_TAG: -0.2, _UNSEEN_TAG: -0.2}
_LEAST = 0.05
# What the edge of a marked main text costs, in words.
_EDGE = 8.0
_TAG_SHARE = 0.75
# Before labelled pages tell: how much less the words of a suspected element count.
_SUSPECT, _COMMENT = -math.log(16), -math.log(64)
# An element whose names weigh less is a region of its own; no names weigh less than the second.
_DOUBT, _LOWEST = -1.0, -8.0
# How much more a run counts in which a main text is marked.
_MARK = 16.0
# Words that the prior of a name is worth.
_PRIOR_WORDS = 200.0
# Names with learned weights: the most frequent ones that speak against an element, and the fixed ones above.
MAX_NAMES = 65_536
# Names that a task counts before it hands its counts on.
_HELD_NAMES = 100_000
_NAME = "#name "


def _prior(name: str) -> float:
    return _COMMENT if name in _COMMENT_WORDS else _SUSPECT if name in _SUSPECT_WORDS else 0.0


def names_of(values: dict[str, str]) -> set[str]:
    """The words of class, id and role; numbers are none."""
    given = " ".join(values.get(k, "") for k in ("class", "id", "role")).lower()
    return {word for word in re.split(r"[^a-z0-9]+", given) if word and len(word) <= 30 and not word.isdigit()}


@dataclass
class _Piece:
    """A tag, or text between two tags."""

    kind: str
    text: str = ""
    n: int = 1
    article: bool = False
    main: bool = False

    def parts(self) -> bool:
        """Whether it parts blocks: a tag that is not inline."""
        return not self.text and self.n > 0


@dataclass
class _Region:
    """The page, or elements of the same names that speak against them, without the regions inside."""

    weight: float
    pieces: list[_Piece]
    inner: dict[frozenset[str], _Region]


class _Page:
    """The pieces of a page by region, and whether it marks its main text."""

    def __init__(self, source: str, weights: dict[str, float] | None = None):
        self.source, self.weights = source, weights or {}
        # Places of text and of the ends of forms, looked for at the first form.
        self.form_marks: tuple[list[int], list[int]] | None = None
        self.regions = [_Region(0.0, [], {})]
        # Regions of the open elements that have their own, outermost first.
        self.within = [self.regions[0]]
        # Marks of the main text: outside all suspected elements, and inside.
        self.marks: set[str] = set()
        self.doubtful: set[str] = set()
        # Open elements: (name, furniture, link).
        self.open: list[tuple[str, bool, bool]] = []
        # Of each: its own region, its names, and the words before it outside and inside marks.
        self.around: list[tuple[_Region | None, set[str], int, int]] = []
        # Depths of the open elements of a name, and of those that hold blocks.
        self.depths: defaultdict[str, list[int]] = defaultdict(list)
        self.scopes: list[int] = []
        # Open furniture elements, links, and main elements, by number.
        self.furniture = self.links = 0
        self.inside = Counter()
        # Words so far outside and inside marks, and those below elements of a name.
        self.words = [0, 0]
        self.named: Counter = Counter()
        at, length = 0, len(source)
        while at < length:
            token = _TOKEN.match(source, at)
            at = token.end()
            if token["text"] is not None:
                self._text(token["text"])
            elif token["name"]:
                name = token["name"].lower()
                if token["end"]:
                    self._close(name)
                    continue
                self._start(name, token["rest"], at)
                if name in _RAW:
                    # Up to its end tag nothing is markup; it is furniture as a whole.
                    end = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(source, at)
                    at = end.start() if end else length

    def _text(self, text: str) -> None:
        n = len(text.split())
        kind = FURNITURE if self.furniture else LINK_WORD if self.links else WORD
        piece = _Piece(kind, text, n)
        piece.article, piece.main = bool(self.inside["article"]), bool(self.inside["main"])
        if not self.furniture:
            self.words[piece.article or piece.main] += n
        self.within[-1].pieces.append(piece)

    def _tag(self, name: str) -> None:
        known = name in _KNOWN or name == _FURNITURE_TAG
        kind = FURNITURE if self.furniture else name if known else "other"
        piece = _Piece(kind, n=0 if name in _INLINE else 1)
        piece.article, piece.main = bool(self.inside["article"]), bool(self.inside["main"])
        self.within[-1].pieces.append(piece)

    def _start(self, name: str, rest: str, at: int) -> None:
        if name in _CLOSES_P:
            self._close_within("p")
        if name in _SAME_CLOSES:
            self._close_within(name)
        values = self._values(rest)
        furniture = self._is_furniture(name, rest, values, at)
        names = set() if furniture or self.furniture else names_of(values)
        region = self._region_of(name, names)
        if name in _MAIN and not (furniture or self.furniture):
            (self.doubtful if region or len(self.within) > 1 else self.marks).add(name)
        self._tag(_FURNITURE_TAG if furniture or region else name)
        if name not in _VOID and not rest.endswith("/"):
            self.depths[name].append(len(self.open))
            if name in _SCOPE:
                self.scopes.append(len(self.open))
            # Only an element around a mark tells what its names mean; one inside may be an advert in the text.
            around = set() if self.inside["article"] or self.inside["main"] else names
            self.open.append((name, furniture, name == "a"))
            self.around.append((region, around, *self.words))
            self.furniture += furniture
            self.links += name == "a"
            self.inside[name] += name in _MAIN
            if region:
                self.within.append(region)
                # Blocks of one region do not run together.
                self._tag(_FURNITURE_TAG)

    def _region_of(self, name: str, names: set[str]) -> _Region | None:
        """The region of an element whose names speak against it."""
        if not names or (name in ("html", "body", *_MAIN) and not names & _COMMENT_WORDS):
            return None
        inside = self.inside["article"] or self.inside["main"]
        weights = [self.weights.get(_NAME + n, _prior(n)) for n in names]
        if not inside and names & _HEADER_WORDS:
            weights.append(_SUSPECT)
        weight = max(_LOWEST, sum(weights))
        if weight > _DOUBT:
            return None
        outer, key = self.within[-1], frozenset(names)
        if key not in outer.inner:
            outer.inner[key] = _Region(max(2 * _LOWEST, outer.weight + weight), [], {})
            self.regions.append(outer.inner[key])
        return outer.inner[key]

    def _holds_text(self, at: int) -> bool:
        """Whether the form whose start tag ends at ``at`` holds paragraphs or a main text."""
        if self.form_marks is None:
            texts, ends = ([m.start() for m in pattern.finditer(self.source)] for pattern in (_FORM_TEXT, _FORM_END))
            self.form_marks = texts, ends
        texts, ends = self.form_marks
        end = bisect_left(ends, at)
        return bisect_left(texts, at) < bisect_left(texts, ends[end] if end < len(ends) else len(self.source))

    @staticmethod
    def _values(rest: str) -> dict[str, str]:
        values: dict[str, str] = {}
        if "=" in rest:
            for key, a, b, c in _ATTRIBUTE.findall(rest):
                values.setdefault(key.lower(), a or b or c)
        return values

    def _is_furniture(self, name: str, rest: str, values: dict[str, str], at: int) -> bool:
        if name in _FURNITURE and not (name == "form" and self._holds_text(at)):
            return True
        if name in ("html", "body", *_MAIN):
            return False
        if name == "header" and not (self.inside["article"] or self.inside["main"]):
            return True
        if "hidden" in rest and re.search(r"\shidden(?=[\s/>]|$)", re.sub(r"""=\s*("[^"]*"|'[^']*')""", "=", rest)):
            return True
        style = values.get("style", "").replace(" ", "").lower()
        return values.get("aria-hidden") == "true" or bool(re.search(r"(?:^|;)display:none(?=[;!]|$)", style))

    def _pop(self) -> None:
        name, furniture, link = self.open.pop()
        region, names, outside, inside = self.around.pop()
        for word in names:
            self.named[word, False] += self.words[False] - outside
            self.named[word, True] += self.words[True] - inside
        if region:
            self._tag(_FURNITURE_TAG)
            self.within.pop()
        self.depths[name].pop()
        if name in _SCOPE:
            self.scopes.pop()
        self.furniture -= furniture
        self.links -= link
        self.inside[name] -= name in _MAIN

    def _close_within(self, name: str) -> None:
        """Close an open element whose end tag may be left out, if nothing that holds blocks is open inside it."""
        depths = self.depths[name]
        if depths and (not self.scopes or depths[-1] >= self.scopes[-1]):
            depth = depths[-1]
            while len(self.open) > depth:
                self._pop()

    def _close(self, name: str) -> None:
        furniture = False
        if self.depths[name]:
            last = None
            while last != name:
                last, furniture, _ = self.open[-1]
                furniture = furniture or self.around[-1][0] is not None
                self._pop()
        self._tag(_FURNITURE_TAG if furniture else name)

    def names(self) -> Counter:
        """Words below the elements of each name, inside and outside marks; closes what is open."""
        while self.open:
            self._pop()
        return self.named

    def labelled(self) -> tuple[str, list[_Piece]] | None:
        """The mark of the main text, and the pieces that it labels."""
        for marks, regions in ((self.marks, self.regions[:1]), (self.doubtful, self.regions)):
            for name in _MAIN:
                if name in marks:
                    return name, [piece for region in regions for piece in region.pieces]
        return None


def token_counts(source: str) -> Counter:
    """(kind, inside) counts of a page that marks its main text; of others nothing.

    A name counts the words below its elements, inside and outside marks.
    """
    page = _Page(source)
    counts: Counter = Counter()
    found = page.labelled()
    if found:
        mark, pieces = found
        for piece in pieces:
            if piece.kind != FURNITURE:
                counts[piece.kind, piece.article if mark == "article" else piece.main] += piece.n
        for (name, inside), n in page.names().items():
            if n:
                counts[_NAME + name, inside] += n
    return counts


def best_run(pieces: list[_Piece], weights: dict[str, float]) -> tuple[float, int, int]:
    """(score, begin, end) of the run of pieces with the largest sum, the first of equal ones; (0, 0, 0) if none is positive."""
    best = total = 0.0
    first = begin = end = 0
    for place, piece in enumerate(pieces):
        score = 0.0
        inside = piece.article or piece.main
        if piece.kind == FURNITURE:
            pass
        elif piece.text:
            # In a marked main text a link is as much text as any other word.
            score = weights[WORD if inside else piece.kind] * piece.n
        elif piece.kind in _MAIN:
            score = -_EDGE * weights[WORD]
        else:
            # Inside a marked main text no tag speaks against what follows it.
            score = (-_LEAST if inside else weights.get(piece.kind, weights[_UNSEEN_TAG])) * piece.n
        if total <= 0:
            total, first = 0.0, place
        total += score
        if total > best:
            best, begin, end = total, first, place + 1
    return best, begin, end


def main_text(source: str | None, weights: dict[str, float]) -> str:
    """The main text of one page: the best run of the region where it counts most, of the first such."""
    page = _Page(source or "", weights)
    most, pieces, begin, end = 0.0, [], 0, 0
    for region in page.regions:
        score, first, last = best_run(region.pieces, weights)
        if score:
            marked = any(piece.article or piece.main for piece in region.pieces[first:last])
            score *= math.exp(region.weight) * (_MARK if marked else 1.0)
        if score > most:
            most, pieces, begin, end = score, region.pieces, first, last
    # The run does not cut a block: a link at either end of it belongs to it.
    while most and begin and not pieces[begin - 1].parts():
        begin -= 1
    while most and end < len(pieces) and not pieces[end].parts():
        end += 1
    out = []
    for piece in pieces[begin:end]:
        if not piece.text:
            if piece.parts():
                out.append(" ")
        elif piece.kind != FURNITURE:
            out.append(piece.text)
    return " ".join(html.unescape("".join(out)).split())


def fit_weights(pages: DataFrame, source: str = "html") -> dict[str, float]:
    """Weights by kind of token from all pages that mark their main text.

    Counts are summed per task before they are shuffled. There are as many kinds
    of tags as HTML has elements. Of names (words of class, id and role) those
    whose weight differs from what holds without a count are kept: the fixed
    ones, and the ``MAX_NAMES`` most frequent others that speak against an
    element. Words stay positive and tags negative. Null pages count nothing;
    without a labelled page the weights are fixed ones.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                if page:
                    counts.update(token_counts(page))
                if len(counts) > _HELD_NAMES:
                    yield _count_batch(counts)
                    counts = Counter()
        yield _count_batch(counts)

    rows = pages.select(source).mapInArrow(count, "kind string, inside boolean, n long").groupBy("kind")
    rows = rows.agg(*[F.sum(F.when(F.col("inside") == side, F.col("n")).otherwise(0)).alias(name) for side, name in ((True, "within"), (False, "around"))])
    work = scratch_path(pages.sparkSession, "page-tokens")
    rows = settle(rows, "counts", work)
    is_name = F.startswith("kind", F.lit(_NAME))
    tags = {r["kind"]: (r["within"], r["around"]) for r in rows.filter(~is_name).collect()}
    counts = {(kind, inside): n for kind, both in tags.items() for inside, n in zip((True, False), both)}
    if not counts:
        remove(pages.sparkSession, work)
        return dict(_DEFAULT)
    words = [sum(counts.get((kind, i), 0) for kind in (WORD, LINK_WORD)) for i in (True, False)]
    # As if there were as many words inside marks as outside.
    scale = max(1, words[1]) / max(1, words[0])
    fixed = F.col("kind").isin([_NAME + name for name in sorted(_SUSPECT_WORDS | _COMMENT_WORDS)])
    names = rows.filter(is_name).withColumn("within", F.col("within") * scale)
    against = names.filter(~fixed & (F.log((F.col("within") + _PRIOR_WORDS) / (F.col("around") + _PRIOR_WORDS)) < _DOUBT))
    chosen = names.filter(fixed).unionByName(against.orderBy(F.desc("around"), "kind").limit(MAX_NAMES)).collect()
    remove(pages.sparkSession, work)
    kinds = {kind for kind, _ in counts} | {WORD, LINK_WORD}
    totals = {i: sum(n for (_, j), n in counts.items() if i == j) + len(kinds) for i in (True, False)}
    weights = {}
    for kind in kinds:
        inside, outside = ((counts.get((kind, i), 0) + 1) / totals[i] for i in (True, False))
        ratio = math.log(inside / outside)
        weights[kind] = max(_LEAST, ratio) if kind == WORD else min(-_LEAST, ratio)
    # Two tags between two blocks never outweigh two words.
    least = -_TAG_SHARE * weights[WORD]
    weights = {kind: max(least, weight) for kind, weight in weights.items()}
    # Furniture is known as such and left out; it parts its surroundings but little.
    weights[_FURNITURE_TAG] = max(weights.get(_FURNITURE_TAG, -_LEAST), least / 4)
    weights[_UNSEEN_TAG] = least / 2
    return weights | {r["kind"]: name_weight(r["kind"].removeprefix(_NAME), r["within"], r["around"]) for r in chosen}


def name_weight(name: str, within: float, around: float) -> float:
    """Weight of a name with so many words below its elements inside and outside marks; never above 0."""
    odds = math.exp(_prior(name))
    return min(0.0, math.log((within + _PRIOR_WORDS * 2 * odds / (1 + odds)) / (around + _PRIOR_WORDS * 2 / (1 + odds))))


def _count_batch(counts: Counter) -> pa.RecordBatch:
    rows = sorted(counts.items())
    return pa.record_batch(
        [[k for (k, _), _ in rows], [i for (_, i), _ in rows], [n for _, n in rows]],
        schema=pa.schema([("kind", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())]),
    )


def extract(pages: DataFrame, weights: dict[str, float], keep: list[str], source: str = "html") -> DataFrame:
    """(keep..., text): the main text of every row, empty if there is none.

    Character references are decoded, white space becomes single spaces, blocks
    are joined by one. Null and empty pages have no text; whole pages are read,
    of any length; repeated rows get equal texts, and an empty table none.
    Columns other than ``keep`` are not read. Nothing is shuffled.
    """
    sent = Sent(pages.sparkSession, weights)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = sent.get()
        for batch in batches:
            yield pd.Series([main_text(page, weights) for page in batch], dtype=object)

    given = columns_as(pages, **{f"_{i}": c for i, c in enumerate(keep)}, _source=source)
    found = given.withColumn("_text", text("_source"))
    return found.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], F.col("_text").alias("text"))
