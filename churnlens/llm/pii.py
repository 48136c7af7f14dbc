"""Personal data by anchor expansion.

One Aho-Corasick pass finds the anchors: at-signs, plus signs, digits, schemes and identifier cues.
Deterministic local parsers expand each anchor to its boundaries and validate it:

* ``email``: from the at-sign left over local characters, right over at least two dotted labels;
* ``ip``: from a digit over the chain of dot-joined digit groups, cut in fours from the left, parts <= 255;
* ``card``: from a digit over the chain of digits with single space or hyphen, 16 to 19 digits, Luhn;
* ``phone``: from a plus sign over digits and phone punctuation, 8 to 15 digits;
* ``secret``: from an identifier cue (token, password, ...) over ``=`` or ``:`` to its value;
* ``url``: from a scheme to the end of the address.

Each parser takes the leftmost match and goes on behind it, so spans of one kind never overlap; a match
that fails validation is dropped and not retried. Positions are code points, end exclusive.

Defined results: null and empty text have no spans; whole texts are scanned; repeated rows give
repeated results; an empty table gives an empty table; an output column replaces an input column of
its name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_columns, quoted, texts

#: The kinds whose rules are fixed, then those that the anchors add; spans are listed in this order.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "url")
#: Kinds that masking replaces.
MASKED_KINDS = (*BASE_KINDS, "secret")
CUES = ("access_key", "api_key", "apikey", "auth", "credential", "passwd", "password", "private_key", "pwd", "secret", "token")
SCHEMES = ("http://", "https://", "ftp://")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT_GROUPS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGIT_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+")
_SECRET = re.compile(r"""["']?\s?[=:]\s?["']?([A-Za-z0-9_\-./+]{8,})""")
_URL = re.compile(r"""[^\s<>"'|]+""")
SPAN_TYPE = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                      T.StructField("end", T.LongType())]))


def luhn(digits: str) -> bool:
    """Check digit of card numbers: every second digit from the right counts double."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


class Finder:
    """Spans of a text; one automaton for all anchors, one parser for each kind of anchor."""

    def __init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for c in "0123456789":
            self.automaton.add_word(c, ("digit", 1))
        self.automaton.add_word("@", ("at", 1))
        self.automaton.add_word("+", ("plus", 1))
        for s in SCHEMES:
            for form in {s, s.upper()}:
                self.automaton.add_word(form, ("scheme", len(s)))
        for s in CUES:
            for form in {s, s.upper(), s.capitalize()}:
                self.automaton.add_word(form, ("cue", len(s)))
        self.automaton.make_automaton()

    def __call__(self, text: str) -> dict[str, list[tuple[int, int]]]:
        found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        ip_done = card_done = phone_done = email_done = secret_done = url_done = 0
        for last, (anchor, length) in self.automaton.iter(text):
            at = last - length + 1
            if anchor == "digit":
                if at >= ip_done:
                    m = _DIGIT_GROUPS.match(text, at)
                    ip_done = m.end()
                    found["ip"] += _addresses(m.group(), at)
                if at >= card_done:
                    m = _DIGIT_CHAIN.match(text, at)
                    card_done = m.end()
                    if m.end() - at >= 16:
                        digits = m.group().replace(" ", "").replace("-", "")
                        if 16 <= len(digits) <= 19 and luhn(digits):
                            found["card"].append(m.span())
            elif anchor == "plus":
                if at >= phone_done and (m := _PHONE.match(text, at)):
                    end = m.end()
                    while text[end - 1] not in "0123456789":
                        end -= 1
                    if end - at >= 4:
                        phone_done = end
                        if 8 <= sum(c in "0123456789" for c in text[at:end]) <= 15:
                            found["phone"].append((at, end))
            elif anchor == "at":
                start = at
                while start > email_done and text[start - 1] in _LOCAL_CHARS:
                    start -= 1
                if start < at and (m := _DOMAIN.match(text, at + 1)):
                    email_done = m.end()
                    found["email"].append((start, m.end()))
            elif anchor == "cue":
                if at >= secret_done and (m := _SECRET.match(text, last + 1)):
                    secret_done = m.end(1)
                    found["secret"].append(m.span(1))
            elif at >= url_done and (m := _URL.match(text, last + 1)):
                url_done = m.end()
                found["url"].append((at, m.end()))
        return found


def _addresses(chain: str, at: int) -> Iterator[tuple[int, int]]:
    """Every four groups of a dotted chain, from the left."""
    groups, start = chain.split("."), at
    for i in range(0, len(groups) - 3, 4):
        four = groups[i:i + 4]
        end = start + sum(map(len, four)) + 3
        if all(map(_at_most_255, four)):
            yield start, end
        start = end + 1


def find_spans(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Adds ``spans``: array of (kind, start, end), by kind in the order of KINDS, then start."""
    def make():
        finder = Finder()

        def fn(col):
            sizes, kinds, starts, ends = [0], [], [], []
            for x in texts(col):
                for kind, own in finder(x).items():
                    for a, b in own:
                        kinds.append(kind)
                        starts.append(a)
                        ends.append(b)
                sizes.append(len(kinds))
            rows = pa.StructArray.from_arrays([pa.array(kinds, pa.string()), pa.array(starts, pa.int64()),
                                               pa.array(ends, pa.int64())], names=["kind", "start", "end"])
            return [pa.ListArray.from_arrays(pa.array(np.array(sizes, np.int32)), rows)]
        return fn

    return map_columns(df, [text], [T.StructField(spans, SPAN_TYPE)], make)


def mask(df: DataFrame, text: str = "text", kinds: tuple[str, ...] = MASKED_KINDS) -> DataFrame:
    """Replaces ``text`` by the text with each span of ``kinds`` as ``<KIND>``; overlapping spans become one,
    named after the first. Null stays null."""
    def make():
        finder = Finder()

        def fn(col):
            out = []
            for x in col.to_pylist():
                spans = sorted((a, -b, k) for k, own in finder(x or "").items() if k in kinds for a, b in own)
                parts, done = [], 0
                for a, b, k in spans:
                    b = -b
                    if a >= done:
                        parts += [x[done:a], f"<{k.upper()}>"]
                    done = max(done, b)
                out.append(x if not spans else "".join([*parts, x[done:]]))
            return [pa.array(out, pa.string())]
        return fn

    order = df.columns
    return map_columns(df, [text], [T.StructField(text, T.StringType())], make).select([quoted(c) for c in order])


def of_kind(*kinds: str):
    """Predicate on a span, for the array functions."""
    return lambda s: s["kind"].isin(*kinds)


def span_text(spans: str, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of the spans (of ``kinds``), comma-joined."""
    own = F.col(spans) if kinds is None else F.filter(spans, of_kind(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
