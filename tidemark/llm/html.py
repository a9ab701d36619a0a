"""Main text of web pages by a maximum-scoring subsequence of words and tags.

A page becomes a row of tokens: words and tags in order.  Words score positive and tags negative;
how much is learnt from labelled pages, that is pages which mark their article by ``<article>`` or
``<main>`` themselves, as log odds of a token to stand inside it.  One linear scan finds the
contiguous region with the largest sum.  Text in elements that by name or class are no content
(menus, headers, notices, adverts, forms, comments ...) is left out.  It scores 0 with its tags, so
that it does not cut what stands around it.  On a page that marks its article, tags inside it score
0 and links as other words, so it is kept whole; words outside it score negative before the first
and after the last marked text, and are left out between them.

Weights are for pages that mark nothing, so they are learnt as such pages are read: classes, ids
and roles are not looked at, and an advert in a plain ``div`` counts as text outside the article.
Parsing and scan take time linear in the length of a page, whatever its markup.

Labelled pages are a bounded sample (``max_labelled``, by hash of the page id); what the driver
gets is one count per known tag.  Extraction is one scan without a shuffle.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import plain_text, ship

MAX_LABELLED = 5_000

RAW = frozenset("script style noscript template iframe svg object textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meta "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr link input".split()
)
ARTICLE = frozenset(("article", "main"))
NO_CONTENT = frozenset(
    "head nav aside footer form dialog menu button select option fieldset audio video canvas".split()
)
# Elements that other elements close when they are left open.
CLOSED_BY = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "option": ("option", ("select",)),
}
PARTS = (
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|adbox|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|"
    r"consent|gdpr|notices?|alert|sidebar|rail|menu|nav|navbar|navigation|breadcrumbs?|footer|"
    r"masthead|topbar|site-?header|page-?header|comments?|commentlist|disqus|repl(?:y|ies)|respond|share|"
    r"sharing|social|related|recommend(?:ed|ations?)?|newsletter|subscribe|subscription|signup|login|popup|"
    r"modal|overlay|widget|toolbar|pagination|pager|copyright|skip-?link|tags?-?list|author-?bio)"
    r"(?:$|[\s_-])"
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split()
)
TAG = re.compile(
    r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|(?<==)"[^"]*"|(?<==)'[^']*'|["'])*+)>|<!--|<[!?/][^>]*>"""
)
UNQUOTED = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<!--|<[!?/][^>]*>")
ATTRIBUTE = re.compile(
    r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?"""
)
NAMES = re.compile(PARTS, re.IGNORECASE)


@dataclass(frozen=True)
class Weights:
    """Scores: of a word in plain text, in a link, in an element that is no content; and of tags."""

    word: float = 1.0
    link_word: float = -0.5
    other_word: float = -0.5
    tags: dict[str, float] = field(default_factory=dict)
    unknown_tag: float = -0.3


@dataclass
class Token:
    """A tag, or the text between two tags.  A closing tag stands in the element that it closes."""

    tag: str = ""
    text: str = ""
    closing: bool = False
    no_content: bool = False
    link: bool = False
    article: bool = False


class OpenElements:
    """The elements that stand open, found by name without a search."""

    def __init__(self) -> None:
        self.items: list[tuple[str, bool, bool, bool]] = []
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []

    def last(self, names: Iterable[str]) -> int:
        """Place of the innermost open element with one of the names, or -1."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def push(self, name: str, *within: bool) -> None:
        self.places[name].append(len(self.items))
        if name not in INLINE:
            self.blocks.append(len(self.items))
        self.items.append((name, *within))

    def close(self, place: int) -> None:
        """Close the element at the place and all inside it."""
        while len(self.items) > place:
            name = self.items.pop()[0]
            self.places[name].pop()
            if name not in INLINE:
                self.blocks.pop()


def _no_content(name: str, attributes: str, in_article: bool, names: bool) -> bool:
    if name in NO_CONTENT:
        return True
    if name == "header":
        return not in_article
    if not names or not attributes or name in ARTICLE or name in ("html", "body"):
        return False
    for found in ATTRIBUTE.finditer(attributes):
        key, value = found[1].lower(), (found[2] or "").strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "role" and value.lower() in ROLES:
            return True
        if key in ("class", "id") and NAMES.search(value):
            return True
    return False


def _next_tag(page: str) -> Callable[[int], re.Match | None]:
    """A search for the next tag that reads no part of the page again and again.

    A tag that never ends is text.  After the first that runs to the page's end only because of its
    quotes, quotes are no longer looked at.
    """
    last = page.rfind(">")
    comment = re.compile("<!--")
    tag = TAG

    def search(at: int) -> re.Match | None:
        nonlocal tag
        while at <= last:
            start = page.find("<", at)
            if start < 0:
                return None
            found = tag.match(page, start)
            if found is None and page[start + 1 : start + 3].lstrip("/")[:1].isalpha():
                tag = UNQUOTED
                found = tag.match(page, start)
            if found is not None:
                return found
            at = start + 1
        return comment.search(page, at)

    return search


def tokens(page: str, names: bool = True) -> Iterator[Token]:
    """Tags and texts of a page in order, with what they stand in.

    Comments, declarations, and scripts, styles and other elements whose content is no text are
    left out; one that is not closed ends with the page.  Elements left open end with the page or
    with what encloses them, as browsers do; stray closing tags do nothing.  Without ``names`` it is
    read as if no element had a class, an id or a role.
    """
    still = OpenElements()
    at, size, last = 0, len(page), page.rfind(">")
    next_tag = _next_tag(page)
    no_content = link = article = False
    while at < size:
        found = next_tag(at)
        if found is None:
            yield Token(text=page[at:], no_content=no_content, link=link, article=article)
            return
        if found.start() > at:
            text = page[at : found.start()]
            yield Token(text=text, no_content=no_content, link=link, article=article)
        at = found.end()
        if found[0] == "<!--":
            end = page.find("-->", at)
            at = size if end < 0 else end + 3
            continue
        if found[2] is None:
            continue
        name, closing, own = found[2].lower(), bool(found[1]), None
        if name in RAW and not closing:
            if not found[3].endswith("/") or name not in ("svg", "object", "iframe"):
                # No closing tag ends behind the last ">".
                end = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(page, at, last + 1)
                at = size if end is None else end.end()
            continue
        if closing:
            place = still.last((name,))
            # A link ends at its block's end; it does not end blocks.
            if place >= 0 and not (name in INLINE and still.blocks and still.blocks[-1] > place):
                own = still.items[place][1:]
                still.close(place)
        elif name in CLOSED_BY:
            ends, within = CLOSED_BY[name]
            border = still.last(within)
            while (place := still.last(ends.split())) > border:
                still.close(place)
        no_content, link, article = still.items[-1][1:] if still.items else (False, False, False)
        if not closing and name not in VOID and (name not in INLINE or name == "a" or "class" in found[3]):
            if name != "p":  # paragraphs hold no blocks and are mostly left open
                inner = (
                    no_content or _no_content(name, found[3], article, names),
                    link or name == "a",
                    article or name in ARTICLE,
                )
                still.push(name, *inner)
                no_content, link, article = inner
        within = own or (no_content, link, article)
        yield Token(tag=name, closing=closing, no_content=within[0], link=within[1], article=within[2])


def _marked(found: list[Token]) -> list[int]:
    """Places of the texts in a marked article."""
    return [
        at for at, t in enumerate(found)
        if t.article and not t.no_content and t.text and not t.text.isspace()
    ]


def _score(token: Token, weights: Weights) -> float:
    if token.tag:
        in_article = token.article and not token.no_content
        return 0.0 if in_article else weights.tags.get(token.tag, weights.unknown_tag)
    n = len(html.unescape(token.text).split())
    if token.no_content:
        return n * weights.other_word
    return n * (weights.link_word if token.link and not token.article else weights.word)


def scores(found: list[Token], weights: Weights) -> list[float]:
    """Scores of a page's tokens."""
    marked = _marked(found)
    if not marked:
        return [0.0 if t.no_content else _score(t, weights) for t in found]

    def score(at: int, t: Token) -> float:
        if t.article and not t.no_content:
            return _score(t, weights)
        between = marked[0] <= at <= marked[-1]
        return 0.0 if between else -abs(_score(t, weights))

    return [score(at, t) for at, t in enumerate(found)]


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous part with the largest positive sum; the first of equals."""
    best = total = 0.0
    start = region_start = region_end = 0
    for at, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, at
        total += score
        if total > best:
            best, region_start, region_end = total, start, at + 1
    return region_start, region_end


def main_text(page: str | None, weights: Weights) -> str:
    """Blocks of the best region, one a line, each with its white space made single blanks."""
    found = list(tokens(page or ""))
    start, end = best_region(scores(found, weights))
    strict = bool(_marked(found))
    blocks: list[str] = []
    parts: list[str] = []
    for token in [*found[start:end], Token(tag="p")]:
        if token.tag == "br":
            parts.append(" ")
        elif token.tag and token.tag not in INLINE:
            block = " ".join(html.unescape("".join(parts)).split())
            if block:
                blocks.append(block)
            parts = []
        elif token.text and not token.no_content and (token.article or not strict):
            parts.append(token.text)
    return "\n".join(blocks)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inside: Counter = Counter()
    outside: Counter = Counter()
    for batch in batches:
        for page in batch.column("html").to_pylist():
            for side, name, n in evidence(page):
                (inside if side else outside)[name] += n
    names = sorted(inside | outside)
    yield pa.RecordBatch.from_pydict(
        {"token": pa.array(names, pa.string()),
         "inside": pa.array([inside[x] for x in names], pa.int64()),
         "outside": pa.array([outside[x] for x in names], pa.int64())}
    )


def evidence(page: str) -> Iterator[tuple[bool, str, int]]:
    """Words and tags of a page that marks its article: if inside of it, which, and how many.

    What stands in elements that are no content by their tag is not counted, as the scan gives it no
    score either.  A tag outside counts if plain words stand next to it: around links the words of
    the links say enough, and the same tags stand around lists in articles.
    """
    found = [t for t in tokens(page, names=False) if t.tag or not t.text.isspace()]
    named = [t for t in tokens(page) if t.tag or not t.text.isspace()]
    plain = [bool(t.text) and not t.link and not t.no_content for t in found]
    for at, (bare, full) in enumerate(zip(found, named)):
        if bare.no_content:
            continue
        side = full.article and not full.no_content
        if not bare.tag:
            yield side, "link_word" if bare.link else "word", len(html.unescape(bare.text).split())
        elif bare.tag in KNOWN_TAGS and (side or any(plain[max(0, at - 1) : at + 2])):
            yield side, bare.tag, 1


KNOWN_TAGS = INLINE | NO_CONTENT | frozenset(
    "p div section header h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "blockquote pre figure figcaption address details summary hr center body html".split()
)
# Words score above zero and tags below; no other bounds.
LEAST_WORD, MOST_TAG = 0.01, -0.01
# What unlabelled corpora start from, as pseudo-counts inside and outside of articles.
PRIOR = 5.0
USUAL = {"li": -1.5, "ul": -1.0, "a": -1.0, "div": -0.5, "td": -0.5, "tr": -0.5, "table": -0.5}


def learn(pages: DataFrame, max_labelled: int = MAX_LABELLED) -> Weights:
    """Weights from at most ``max_labelled`` pages that mark their article."""
    labelled = pages.select("page_id", "html").where(F.col("html").rlike("(?i)<(article|main)[ >]"))
    # Ids alone are sorted, and at most max_labelled of them are broadcast.
    chosen = labelled.select(F.col("page_id").alias("_chosen")).distinct()
    chosen = chosen.orderBy(F.xxhash64("_chosen")).limit(max_labelled)
    sample = labelled.join(
        F.broadcast(chosen), F.col("page_id").eqNullSafe(F.col("_chosen")), "left_semi"
    )
    counts = (
        sample.select("html").repartition(16)
        .mapInArrow(_counts, "token string, inside long, outside long")
        .groupBy("token").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        .collect()  # one row per known tag
    )
    return weights_of({r.token: (r.inside, r.outside) for r in counts})


def weights_of(seen: dict[str, tuple[int, int]]) -> Weights:
    """Log odds of the tokens, from how often each stood inside and outside of articles.

    A token starts with ``PRIOR`` pseudo-counts that say what is usual, so one that no page holds
    has its usual weight and one that pages hold often has theirs.
    """
    n_in, n_out = (max(1, sum(n[side] for n in seen.values())) for side in (0, 1))

    def odds(token: str, usual: float) -> float:
        i, o = seen.get(token, (0, 0))
        # The pseudo-counts stand in the same proportion as the two sides.
        total = i + o + PRIOR
        even_in, even_out = n_in / (n_in + n_out), n_out / (n_in + n_out)
        share = even_in * math.exp(usual) / (even_in * math.exp(usual) + even_out)
        inside, outside = i + PRIOR * share, o + PRIOR * (1 - share)
        return math.log(inside / total / even_in) - math.log(outside / total / even_out)

    usual = Weights()
    return Weights(
        word=max(LEAST_WORD, odds("word", usual.word)),
        link_word=odds("link_word", usual.link_word),
        tags={t: min(MOST_TAG, odds(t, USUAL.get(t, -0.05))) for t in sorted(KNOWN_TAGS)},
    )


def extract(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; ``n_chars`` counts code points.

    Null and empty pages, and pages without a word in a content element, give the empty text.
    Character references are decoded.  Repeated rows are extracted as often as they occur; an
    empty table gives no rows; other columns are not read.
    """
    known = learn(pages) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page.as_py(), known) for page in batch.column("html")]
            found = [t.encode("utf-8", "replace").decode() for t in found]
            yield pa.RecordBatch.from_pydict(
                {"page_id": batch.column("page_id"), "url": batch.column("url"),
                 "text": pa.array(found, pa.string()),
                 "n_chars": pa.array(map(len, found), pa.int64())}
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", plain_text("html").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


ship(__name__)
