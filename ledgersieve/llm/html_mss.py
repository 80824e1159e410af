"""Main text of web pages as a maximum-scoring run of words and tags.

A page is a sequence of words, which score one each, and tags, which score below zero. One linear
scan finds the run with the largest sum, and its words are the text. The weights of tags come from
pages that label themselves by an article or main element: a tag seen outside that element more
often than inside costs more, so a run does not cross menus, adverts or footers to gain their words.

Three things keep the weights from punishing what they have not seen. Inline tags are never learned.
What lies in a menu or another element that is no article by its name teaches nothing about the
tags in it, and neither do the elements around the article. Inside an article or main element tags
cost next to nothing, so that a list or a table does not end the run; elements beside the text are
cut out of it there.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersieve.llm.sampling import bounded_sample

# Labelled pages that weights are learned from: those with the least hashes of their ids.
FIT_PAGES = 500
# What a tag costs at least, what one of unknown kind costs, and the most that a tag can cost, in words.
LEAST_COST, UNKNOWN_COST, MOST_COST = 0.1, 1.0, 30.0
# What a tag inside an article or main element costs.
WITHIN_COST = 0.01
# Words that a doubling of the odds of being outside is worth.
ODDS_COST = 8.0
# A named kind of element that costs this much lies beside the text, with all it holds.
BESIDE_COST = 20.0
# A form with fewer words than this to a field is a form to fill in; others only wrap a page.
FORM_WORDS = 20

# Fixed values of the page format: elements whose content is no markup, elements without readable
# text, elements without an end, elements that are never part of an article, elements that label
# one, elements that start text, and elements that do not end a block.
RAW = ("script", "style", "title", "textarea")
UNREAD = ("template", "noscript", "iframe", "svg", "select", "button")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BESIDE = {"nav", "aside", "footer", "menu", "dialog"}
LABEL = {"article", "main"}
FIELDS = {"input", "label", "option", "fieldset"}
TEXT_START = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q",
    "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
# Names that pages give to elements beside the text, and to what readers wrote below it.
BESIDE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "alert", "alertdialog", "banner", "breadcrumb", "breadcrumbs",
    "complementary", "contentinfo", "cookie", "cookies", "cookie-banner", "cookie-notice", "dialog", "disclaimer", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pager", "pagination", "popup", "promo", "related",
    "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
COMMENT_NAMES = {
    "comment", "comments", "comment-list", "comment-section", "commentlist", "comments-area", "comments-section",
    "discussion", "disqus_thread", "reader-comments", "replies", "respond", "user-comments",
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<tag>/?[a-z][a-z0-9:-]*)(?P<attrs>(?:\"[^\"<]*\"|'[^'<]*'|[^'\"<>])*)>"
    r"|<[/!?a-z][^<>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.I | re.S)
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


@dataclass
class Token:
    """A stretch of text, or a tag with its name (a slash before an end tag) and its more exact kinds."""

    text: str = ""
    name: str = ""
    kinds: tuple[str, ...] = ()
    words: int = 0
    unread: bool = False
    end: int | None = None  # where the element of a start tag ends, if its end tag is found

    @property
    def bare(self) -> str:
        return self.name.lstrip("/")


def tokens(page: str) -> list[Token]:
    """Texts and tags in page order; text of elements that show none is marked `unread`.

    An element without readable text that is closed at once or never, or that runs into the start of
    a text, is its tag alone.
    """
    out: list[Token] = []
    starts: dict[str, list[int]] = {}
    for m in _TOKEN.finditer(page):
        if m["text"]:
            text = html.unescape(m["text"])
            out.append(Token(text=text, words=len(text.split())))
        elif m["tag"]:
            name = m["tag"].lower()
            names = (k for found in _NAMES.findall(m["attrs"]) for k in "".join(found).lower().split())
            closed = m["attrs"].endswith("/") and name in UNREAD
            bare = name.lstrip("/")
            if bare in LABEL or bare in TEXT_START:
                for other in ("iframe", "svg", "select", "button"):
                    starts.pop(other, None)
            if name in ("button", "select"):
                starts.pop(name, None)
            if name[0] == "/" and starts.get(bare):
                out[starts[bare].pop()].end = len(out)
            elif name[0] != "/" and name not in VOID and not closed:
                starts.setdefault(name, []).append(len(out))
            out.append(Token(name=name, kinds=tuple(f"{name}.{k}" for k in names)))
    until = 0
    for i, t in enumerate(out):
        if t.name in UNREAD and t.end is not None:
            until = max(until, t.end)
        t.unread = i < until
    return out


@dataclass
class Weights:
    """Score of each kind of tag, below zero, and the kinds whose elements surely ended before an article or began after it."""

    scores: dict[str, float] = field(default_factory=dict)
    apart: set[str] = field(default_factory=set)

    def of(self, token: Token) -> float:
        if token.bare in LABEL:
            return -MOST_COST
        exact = [self.scores[k] for k in token.kinds if k in self.scores]
        if exact:
            return min(exact)
        return -LEAST_COST if token.bare in INLINE else self.scores.get(token.name, -UNKNOWN_COST)

    def beside(self, token: Token) -> bool:
        return any(k in self.apart and self.scores.get(k, 0.0) <= -BESIDE_COST for k in token.kinds)


def _names(token: Token) -> set[str]:
    return {k.partition(".")[2] for k in token.kinds}


def _comments(token: Token) -> bool:
    return token.name not in ("html", "body", "main") and bool(_names(token) & COMMENT_NAMES)


def regions(found: list[Token], weights: Weights | None = None) -> list[tuple[bool, bool]]:
    """For every token: whether it lies beside the text, and whether in an article or main element."""
    words, fields = [0], [0]
    for t in found:
        words.append(words[-1] + (0 if t.unread else t.words))
        fields.append(fields[-1] + (t.name in FIELDS or t.name in UNREAD and t.name in ("select", "button")))
    out: list[tuple[bool, bool]] = []
    beside: list[tuple[str, int | None, bool]] = []  # name, end, whether readers wrote it
    labels: list[str] = []
    for i, t in enumerate(found):
        while beside and beside[-1][1] is not None and beside[-1][1] < i:
            beside.pop()
        start = bool(t.name) and t.name[0] != "/"
        by_readers = start and _comments(t)
        if t.bare in LABEL and not by_readers:
            if start and not any(readers for _, _, readers in beside) and not (labels and beside):
                beside.clear()  # an article that starts closes what was left open before it
                labels.append(t.name)
            elif not start and labels and labels[-1] == t.bare and not any(e is not None and e >= i for _, e, _ in beside):
                beside.clear()
                labels.pop()
        elif start and t.name in TEXT_START and beside and beside[-1][1] is None and beside[-1][0] != "footer":
            beside.pop()
        elif start and t.name not in VOID and t.name not in ("html", "body"):
            end = t.end if t.end is not None else len(found)
            if (by_readers or t.name in BESIDE or _names(t) & BESIDE_NAMES or weights and weights.beside(t)
                    or t.name == "header" and not labels
                    or t.name == "form" and t.end is not None
                    and words[end] - words[i] < FORM_WORDS * (fields[end] - fields[i])):
                beside.append((t.name, t.end, by_readers))
        out.append((bool(beside), bool(labels)))
    return out


def learn(pages: list[str]) -> Weights:
    """Weights from pages that hold exactly one labelled element; others teach nothing."""
    inside: Counter[str] = Counter()
    outside: Counter[str] = Counter()
    apart: set[str] = set()
    for page in pages:
        found = tokens(page)
        for label in ("article", "main"):
            at = [i for i, t in enumerate(found) if t.bare == label]
            if len(at) == 2 and found[at[0]].end == at[1]:
                break
        else:
            continue
        around = {e for t in found[: at[0]] if t.end is not None and t.end > at[1] for e in (id(t), id(found[t.end]))}
        beside = regions(found)
        for i, t in enumerate(found):
            if not t.name or t.bare in INLINE or t.bare in LABEL or t.unread or id(t) in around:
                continue
            opens = beside[i][0] and not (i and beside[i - 1][0])
            if at[0] < i < at[1]:
                inside.update([t.name, *t.kinds])
            elif t.kinds:  # a named element says nothing about others of its tag
                outside.update(t.kinds)
                if i > at[1] or t.end is not None and t.end < at[0]:
                    apart.update(t.kinds)
            elif opens or not beside[i][0]:
                outside.update([t.name])
    scores = {
        k: -min(MOST_COST, max(LEAST_COST, ODDS_COST * math.log2((outside[k] + 1) / (inside[k] + 1))))
        for k in inside.keys() | outside.keys()
    }
    return Weights(scores, apart)


def scored(found: list[Token], weights: Weights) -> list[tuple[float, bool]]:
    """Score of every token, and whether its words are left out of a run that holds it."""
    out = []
    for t, (beside, within) in zip(found, regions(found, weights)):
        if t.bare in LABEL and not (beside and within):
            score = -MOST_COST
        elif within:
            score = -WITHIN_COST if t.name else 0.0 if beside or t.unread else float(t.words)
        elif t.name:
            score = weights.of(t)
        else:
            score = 0.0 if t.unread else float(-t.words if beside else t.words)
        out.append((score, beside or t.unread))
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the first run with the largest sum above zero, by one scan; (0, 0) without any."""
    best, best_range, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        total += score
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, best_range = total, (start, i + 1)
    return best_range


def main_text(page: str | None, weights: Weights) -> str:
    """The words of the best run; blocks and white space become one space. Empty if nothing scores above zero."""
    found = tokens(page or "")
    marks = scored(found, weights)
    run = slice(*best_run([score for score, _ in marks]))
    parts = []
    for t, (_, left_out) in zip(found[run], marks[run]):
        if not t.name:
            parts.append("" if left_out else t.text)
        elif t.bare not in INLINE:
            parts.append(" ")
    return " ".join("".join(parts).split())


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Weights:
    """Weights from at most FIT_PAGES labelled pages of the table."""
    labelled = pages.where(F.col(html_col).rlike("(?i)<(article|main)[ >]"))
    sample = bounded_sample(labelled, FIT_PAGES, F.col(id_col), F.xxhash64(html_col))
    return learn([r[0] for r in sample.select(html_col).collect()])


def extract(
    pages: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per row of `pages`: id, url, text.

    A NULL or empty page, and one without a run above zero, has the empty text. Repeated rows get
    equal texts; a NULL id or URL stays. Other columns are not read. An empty table gives an empty
    table.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, weights) for page in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["url"], pa.array(texts, pa.string())], names=[id_col, url_col, "text"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(
        read, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string")
