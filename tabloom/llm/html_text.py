"""Main text of web pages by a maximum-scoring subsequence over words and tags.

Words score by the block they stand in (its tag, link share and length), tags score
against the text; the weights are log-odds counted over all labelled pages by one
grouped aggregation. Labels come from the article element, features do not name it, so
that the weights hold for pages without one. One linear scan finds the best contiguous
region; what is marked as boilerplate inside it is left out.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>""", re.S)
HINT = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HINT_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: HTML elements by their part on a page.
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
NEVER = frozenset("head script style textarea title xmp noembed noframes iframe noscript template svg math canvas object audio video select option button input datalist dialog nav menu footer aside form fieldset".split())
HOLDERS = frozenset("article main body header section div table ul ol dl".split())
WORDS_OF_BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside widget widgets footer masthead comment comments reply replies respond disqus "
    "share sharing social newsletter subscribe subscription signup login related recommended pagination pager toolbar skip form search contentinfo complementary".split()
)
#: Share of words inside the main text, by whether they are mostly links, before any page is counted.
PRIOR = {0: 0.75, 1: 0.25}
#: Words that the share of all tags (or the prior) stands for beside what is counted.
STRENGTH = 100.0
#: Bounds of a word's weight and of a tag's cost; what a page's own article says about a word.
HIGHEST, TAG_COST, TAG_MOST, HELD = 2.0, 0.05, 0.5, 3.0
#: Blocks of 2**LONG words and more are counted as one length.
LONG = 6


def _marked(attributes: str) -> bool:
    return any(
        part.lower() in WORDS_OF_BOILERPLATE for found in HINT.findall(attributes) for value in found for part in HINT_PART.findall(value)
    )


class Page:
    """A page as one sequence: tags ("t", name, dead), and blocks ("b", place, text, inside, dead)."""

    def __init__(self, html: str | None):
        self.tokens: list[tuple] = []
        self.article = 0  # number of article or main elements
        self.stack: list[tuple[str, bool]] = []  # (tag, its content is boilerplate)
        self.parts: list[str] = []
        self.links = self.plain = 0
        self._read(html or "")

    def _read(self, html: str) -> None:
        at = 0
        while True:
            found = TAG.search(html, at)
            self._text(html[at : found.start() if found else len(html)])
            if not found:
                break
            at = found.end()
            name = (found[2] or "").lower()
            if not name:
                continue
            if found[1]:
                self._close(name)
            else:
                self._open(name, found[3])
                if name in RAW:
                    end = re.compile(f"</{re.escape(name)}\\b", re.I).search(html, at)
                    at = end.start() if end else len(html)
        self._end_block()

    def _text(self, text: str) -> None:
        if text and not (self.stack and self.stack[-1][1] and self.stack[-1][0] in RAW):
            self.parts.append(text)
            words = len(text.split())
            if any(t == "a" for t, _ in self.stack):
                self.links += words
            else:
                self.plain += words

    def _end_block(self) -> None:
        text = " ".join(entities.unescape("".join(self.parts)).split())
        if text:
            tag = next((t for t, _ in reversed(self.stack) if t not in INLINE), "body")
            holder = next((t for t, _ in reversed(self.stack) if t in ("article", "main")), "body")
            dead = bool(self.stack) and self.stack[-1][1]
            long = min(len(text.split()).bit_length(), LONG)
            self.tokens.append(("b", (tag if tag in KNOWN_TAGS else "other", int(self.links > self.plain), long), text, holder != "body" and not dead, dead))
        self.parts, self.links, self.plain = [], 0, 0

    def _open(self, name: str, attributes: str) -> None:
        if name not in INLINE:
            self._end_block()
            if name in ("p", "li", "td", "th", "tr", "dt", "dd", "option"):
                self._leave(name, HOLDERS)
        within = any(t in ("article", "main") for t, _ in self.stack)
        dead = bool(self.stack) and self.stack[-1][1]
        if name in VOID or attributes.endswith("/") and name in ("svg", "path"):
            self.tokens.append(("t", name, dead))
            return
        if name in ("article", "main"):
            self.article += 1
            marked = self.article > 1 and _marked(attributes)
            # a wrapper that merely mentions a sidebar does not take the first article with it
            dead = dead and (self.article > 1 or any(t in NEVER for t, _ in self.stack))
        else:
            marked = name in NEVER or name == "header" and not within or name not in ("html", "body") and _marked(attributes)
        self.tokens.append(("t", name, dead or marked))
        self.stack.append((name, dead or marked))

    def _leave(self, name: str, until: frozenset) -> None:
        """Close an open element of this name, unless a holder stands between."""
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == name:
                del self.stack[k:]
                return
            if self.stack[k][0] in until:
                return

    def _close(self, name: str) -> None:
        if name not in INLINE:
            self._end_block()
        self.tokens.append(("t", "/" + name, bool(self.stack) and self.stack[-1][1]))
        self._leave(name, frozenset() if name in HOLDERS or name in NEVER else HOLDERS)


    @property
    def labelled(self) -> bool:
        """Exactly one article or main element, with text that is no boilerplate."""
        return self.article == 1 and any(t[0] == "b" and t[3] for t in self.tokens)


def _tag_feature(name: str) -> tuple[str, int, int]:
    name = name.lstrip("/")
    return (name if name in KNOWN_TAGS else "other", 0, 0)  # no block has no words


#: Names beyond these are counted as one, which bounds the table of weights.
KNOWN_TAGS = RAW | VOID | INLINE | NEVER | HOLDERS | frozenset("html h1 h2 h3 h4 h5 h6 p li td th tr dt dd pre blockquote figure figcaption center hgroup address thead tbody tfoot caption details summary".split())


def counted(pages: DataFrame, html_col: str) -> DataFrame:
    """(tag, in_link, long, inside, n) over all self-labelled pages: words by place, tags at length 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for html in batch.column(0).to_pylist():
                page = Page(html)
                if not page.labelled:
                    continue
                open_article = False
                for token in page.tokens:
                    if token[0] == "t":
                        if token[1] in ("article", "main", "/article", "/main"):
                            open_article = token[1][0] != "/"
                        elif not token[2]:
                            seen[(*_tag_feature(token[1]), open_article)] += 1
                    elif not token[4]:
                        seen[(*token[1], token[3])] += len(token[2].split())
            rows = [(*key, n) for key, n in seen.items()]
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["tag", "in_link", "long", "inside", "n"])

    made = pages.select(html_col).mapInArrow(count, "tag string, in_link int, long int, inside boolean, n bigint")
    return made.groupBy("tag", "in_link", "long", "inside").agg(F.sum("n").alias("n"))


def _odds(inside: float, outside: float, share: float) -> tuple[float, float]:
    """Log-odds, and share inside, where ``share`` counts as much as ``STRENGTH`` words."""
    inside, outside = inside + STRENGTH * share, outside + STRENGTH * (1 - share)
    return math.log(inside / outside), inside / (inside + outside)


def weights(pages: DataFrame, html_col: str = "html") -> dict[tuple[str, int, int], float]:
    """Log-odds of words by place and of tags; at most some hundred, whatever the number of pages.

    The odds of a tag's blocks start from those of all blocks with the same link share
    and length, which stand under the empty tag.
    """
    inside, outside = Counter(), Counter()
    for row in counted(pages, html_col).collect():
        for tag in ("", row["tag"]):
            (inside if row["inside"] else outside)[(tag, row["in_link"], row["long"])] += row["n"]
    bounded = lambda odds: max(-HIGHEST, min(odds, HIGHEST))
    share, out = {}, {}
    for link in PRIOR:
        for long in range(1, LONG + 1):
            key = ("", link, long)
            odds, share[key] = _odds(inside[key], outside[key], PRIOR[link])
            out[key] = bounded(odds)
    for key in inside.keys() | outside.keys():
        if key[0] and key[2] == 0:
            out[key] = max(-TAG_MOST, min(_odds(inside[key], outside[key], 0.5)[0], -TAG_COST))
        elif key[0]:
            out[key] = bounded(_odds(inside[key], outside[key], share[("", *key[1:])])[0])
    return out


def main_text(html: str | None, weight: dict[tuple[str, int, int], float]) -> tuple[str, float]:
    """Text of the best contiguous region, without the boilerplate inside it, and the region's score."""
    page = Page(html)
    best, best_range, running, first = 0.0, (0, 0), 0.0, 0
    labelled = page.labelled
    for k, token in enumerate(page.tokens):
        if token[0] == "t":
            free = token[2] or labelled or token[1] in ("article", "main")
            gain = 0.0 if free else weight.get(_tag_feature(token[1]), -TAG_COST)
        else:
            place = token[1]
            held = 0.0 if not labelled and not token[3] else HELD if token[3] else -HELD
            gain = 0.0 if token[4] else len(token[2].split()) * (held + weight.get(place, weight[("", *place[1:])]))
        if running <= 0:
            running, first = 0.0, k
        running += gain
        if running > best:
            best, best_range = running, (first, k + 1)
    blocks = [t[2] for t in page.tokens[slice(*best_range)] if t[0] == "b" and not t[4]]
    return " ".join(blocks), best


def extract_text(pages: DataFrame, labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars, score.

    Weights come from ``labelled`` pages (by default ``pages``): pages with exactly one
    article or main element label their own words, and their text is that element's. On
    other pages the weights decide, words in one of several articles preferred. NULL or empty html, and pages
    without a region of positive score, give the empty text. Broken markup, unclosed
    elements and truncated pages are read as far as they go; repeated pages give
    repeated rows; an empty table gives none. Whole pages are read, whatever their length.
    """
    weight = weights(pages if labelled is None else labelled, html_col)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(html, weight) for html in batch.column(2).to_pylist()]
            texts = [t.encode("utf-8", "replace").decode() for t, _ in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([s for _, s in found], pa.float64())],
                names=["page_id", "url", "text", "n_chars", "score"],
            )

    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = [source.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return source.mapInArrow(read, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint, score double")
