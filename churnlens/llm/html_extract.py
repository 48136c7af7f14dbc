"""Main text of web pages by line-block distribution.

A page becomes lines: markup is stripped, and every block element starts a new line. Lines inside
elements that never hold article text (navigation, headers, footers, sidebars, forms, scripts, or a
class, id or role that says advert, notice, comments and the like, unless the element is or holds the page's only
article, or the word is part of a compound such as has-comments or no-sidebar) and lines outside the article
element, where the page has one, are never kept and count as length 0; elsewhere lines made mostly of links
count as length 0 too. Sums of text length over a sliding window of lines form the block distribution: a surge is
where the sum rises from nothing, a dive is where it falls back to it. The text between a surge and its dive is
kept, with the lines of links in it: one or two such lines between lines of text belong to the article, three or
more in a row, or those before and after all text, are a menu.

Lines are trimmed with inner white space made one space, character references decoded, and joined by an
empty line. Defined results: null and empty html, and pages without text, give the empty text; whole
pages are read; repeated rows give repeated results; an empty table gives an empty table; an output
column replaces an input column of its name.
"""

from __future__ import annotations

import html as _html
import re
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_columns

#: Lines per window of the block distribution.
WINDOW = 3
#: Share of link text from which a line outside an article counts as navigation.
LINK_SHARE = 0.5

RAW_TEXT = ("script", "style", "noscript", "template", "svg", "math", "iframe", "textarea", "select", "object", "canvas",
            "audio", "video", "title")
BOILERPLATE = frozenset(("nav", "header", "footer", "aside", "form", "menu", "button", "dialog", "head", "fieldset", "label"))
#: Words of a class, id or role that mark an element as not part of the article.
CUES = frozenset(("ad", "ads", "advert", "adverts", "advertisement", "advertisements", "banner", "breadcrumb", "breadcrumbs",
                  "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer",
                  "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
                  "pagination", "popup", "promo", "promoted", "reactions", "related", "replies", "reply", "respond", "search",
                  "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
                  "widgets"))
#: First parts of a compound that says something else than its cue, as in has-comments or tag-social.
COMPOUNDS = frozenset(("has", "no", "not", "with", "without", "tag"))
INLINE = frozenset(("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i",
                    "img", "input", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
                    "strong", "sub", "sup", "td", "th", "time", "tt", "u", "var", "wbr"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
ARTICLE = frozenset(("article", "main"))
#: Elements whose end tag may be left out: the next block ends them.
OPTIONAL_END = frozenset(("p", "li", "dt", "dd", "option", "tr"))

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
                    r"|<(" + "|".join(RAW_TEXT) + r")\b[^>]*>.*?(?:</\1\s*>|\Z)"
                    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")
_NAME = re.compile(r"\S+")


@dataclass
class Line:
    text: str
    skipped: bool
    in_article: bool
    link_chars: int


def _has_cue(said: str) -> bool:
    """Whether a name among those said has a cue that no compound takes back."""
    for m in _NAME.finditer(said):
        words = _WORD.findall(m[0])
        if not CUES.isdisjoint(words) and words[0] not in COMPOUNDS:
            return True
    return False


def _is_boilerplate(name: str, attributes: str, in_article: bool, holds_article: Callable[[], bool]) -> bool:
    if name in BOILERPLATE and not (name == "header" and in_article):
        return True
    if not attributes or name in ARTICLE and not _ATTRIBUTE.search(attributes) or name in ("html", "body"):
        return False
    said = " ".join(x for m in _ATTRIBUTE.finditer(attributes) for x in m.groups() if x).lower()
    return _has_cue(said) and not holds_article() or bool(_HIDDEN.search(attributes))


def lines_of(page: str) -> list[Line]:
    """The page's lines with what the distribution needs to know of each."""
    tokens = list(_TOKEN.finditer(page))
    closes = _closing(tokens)
    articles = [i for i, m in enumerate(tokens) if m[3] and not m[2] and m[3].lower() in ARTICLE]
    mains = [i for i in articles if tokens[i][3].lower() == "main"]
    lines: list[Line] = []
    parts: list[str] = []
    links = article = link = 0
    skip_until = -1   # index of the token that ends the element being skipped

    def flush() -> None:
        nonlocal links
        text = " ".join(_html.unescape("".join(parts)).split())
        if text:
            lines.append(Line(text, skip_until >= 0, article > 0, links))
        parts.clear()
        links = 0

    def holds_article() -> bool:
        """Whether the element of token i is or holds an article, and no other is there but a main element around it."""
        inside = bisect_left(articles, closes[i]) - bisect_left(articles, i)
        return inside > 0 and inside + sum(j < i < closes[j] for j in mains) == len(articles)

    at = 0
    for i, m in enumerate(tokens):
        piece = page[at:m.start()]
        parts.append(piece)
        if link:
            links += len(piece.strip())
        at = m.end()
        name = (m[3] or "").lower()
        if not name:   # comments, declarations and raw-text elements leave no text
            if m[1]:
                parts.append(" ")
            continue
        end = bool(m[2])
        if i == skip_until:
            flush()
            skip_until = -1
        if name == "a":
            link = 0 if end else 1
        if name == "br" or name in ("td", "th"):
            parts.append(" ")
        if name in INLINE and not (skip_until < 0 and not end and name not in VOID and closes[i] > i
                                   and _is_boilerplate(name, m[4] or "", article > 0, holds_article)):
            continue
        flush()
        if skip_until < 0 and not end and name not in VOID and not (m[4] or "").endswith("/") \
                and _is_boilerplate(name, m[4] or "", article > 0, holds_article) and closes[i] > i:
            skip_until = closes[i]
            if skip_until >= len(tokens):
                skip_until = len(tokens)
        elif name in ARTICLE and skip_until < 0:
            article = max(0, article + (-1 if end else 1))
    parts.append(page[at:])
    flush()
    return lines


def _closing(tokens: list[re.Match]) -> list[int]:
    """For each start tag the token that ends its element: the matching end tag, the end tag of an element around
    it, or for elements with an optional end tag the next block. An element that nothing ends takes the next
    block as its end, so an unclosed advert doesn't swallow the page."""
    closes = [0] * len(tokens)
    stack: list[tuple[str, int]] = []
    depth: dict[str, int] = {}
    block_after = [len(tokens)] * (len(tokens) + 1)
    for i in range(len(tokens) - 1, -1, -1):
        name = (tokens[i][3] or "").lower()
        block_after[i] = i if name and name not in INLINE else block_after[i + 1]

    def pop(i: int) -> None:
        name, k = stack.pop()
        depth[name] -= 1
        closes[k] = i

    for i, m in enumerate(tokens):
        name = (m[3] or "").lower()
        if not name or name in VOID:
            continue
        if not m[2]:
            if name not in INLINE and stack and stack[-1][0] in OPTIONAL_END and (name == stack[-1][0] or stack[-1][0] == "p"):
                pop(i)
            stack.append((name, i))
            depth[name] = depth.get(name, 0) + 1
        elif depth.get(name):
            while stack[-1][0] != name:
                pop(i)
            pop(i)
    while stack:
        k = stack[-1][1]
        pop(block_after[k + 1])
    return closes


def surges(lengths: np.ndarray, window: int = WINDOW) -> list[tuple[int, int]]:
    """(surge, dive) of each run: first and last-plus-one line of text between windows that hold none."""
    n = len(lengths)
    if n == 0:
        return []
    total = np.concatenate(([0], np.cumsum(lengths)))
    first = np.arange(n + window - 1) - window + 1           # windows overhang both ends
    sums = total[np.clip(first + window, 0, n)] - total[np.clip(first, 0, n)]
    full = np.concatenate(([False], sums > 0, [False]))
    up, down = np.flatnonzero(full[1:] & ~full[:-1]), np.flatnonzero(~full[1:] & full[:-1])
    out = []
    for a, b in zip(up, down):   # windows a..b-1 hold text: trim to the lines that do
        own = np.flatnonzero(lengths[max(0, a - window + 1):b]) + max(0, a - window + 1)
        out.append((int(own[0]), int(own[-1]) + 1))
    return out


def main_text(page: str | None) -> str:
    lines = lines_of(page) if page else []
    if not lines:
        return ""
    has_article = any(x.in_article and not x.skipped for x in lines)
    kept = [not x.skipped and (x.in_article or not has_article) for x in lines]
    lengths = np.array([len(x.text) if k and (has_article or x.link_chars < LINK_SHARE * len(x.text)) else 0 for x, k in zip(lines, kept)])
    return "\n\n".join(lines[i].text for a, b in surges(lengths) for i in range(a, b) if kept[i])


def extract(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """Adds ``text``: the page's main text."""
    def make():
        return lambda col: [pa.array([main_text(x) for x in col.to_pylist()], pa.string())]

    return map_columns(df, [html], [T.StructField(text, T.StringType())], make)
