"""Clue spans: sentence splitting, splitting at semicolons, and the merging of spans that are no clues of their own.

All spans are half-open character ranges. A word is what white space separates. Splitters are functions text -> spans.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Span = tuple[int, int]
#: The thresholds in words and the ratios of span lengths.
MIN_WORDS, MAX_WORDS, QUOTE_WORDS, LONG_WORDS, SEMICOLON_WORDS = 5, 40, 45, 40, 5
LONGER, SHORTER = 1.5, 0.3

_STOP = re.compile(r"(?:\.{3,}|[.?!])[\"'”’)\]]*(?=\s+|$)")
_BLANK = re.compile(r"\s*")
_RULE_ABBREVIATIONS = frozenset("dr mr mrs ms prof st mt ft gen capt rev jr sr vs no op c ca cf e.g i.e et al inc ltd co u.s a.m p.m ph.d".split())


class Words:
    """Word counts of any range of a text, from one pass over it."""

    def __init__(self, text: str):
        found = list(re.finditer(r"\S+", text))
        self.starts, self.ends = [m.start() for m in found], [m.end() for m in found]

    def count(self, a: int, b: int) -> int:
        """Words that a slice from a to b shows, cut ones included."""
        if b <= a:
            return 0
        first = bisect_left(self.ends, a + 1)
        return max(0, bisect_left(self.starts, b) - first)


def _sentences(text: str, ends: list[int]) -> list[Span]:
    out, a = [], 0
    for b in [*ends, len(text)]:
        s, e = a, b
        while s < e and text[s].isspace():
            s += 1
        while e > s and text[e - 1].isspace():
            e -= 1
        if e > s:
            out.append((s, e))
        a = b
    return out


def _next(text: str, at: int) -> str:
    """The first character from ``at`` on that is no white space."""
    k = _BLANK.match(text, at).end()
    return text[k : k + 1]


def untrained_split(text: str) -> list[Span]:
    """Statistical splitting without statistics: marks end sentences, except after initials, numbers and pauses before a lower-case word."""
    ends = []
    for m in _STOP.finditer(text):
        after = _next(text, m.end())
        before = re.search(r"(\S*)$", text[max(0, m.start() - 40) : m.start()])[1]
        if m[0][0] == "." and (len(before) == 1 and before.isalpha() or m[0].startswith("...") or re.fullmatch(r"[\d.,]+", before)) and not (after.isupper() and not (len(before) == 1)):
            continue
        ends.append(m.end())
    return _sentences(text, ends)


def rule_split(text: str) -> list[Span]:
    """Marks end sentences, except after abbreviations and initials and before lower-case words."""
    ends = []
    for m in _STOP.finditer(text):
        after = _next(text, m.end())
        before = re.search(r"([^\s(\[\"“]*)$", text[max(0, m.start() - 40) : m.start()])[1].lower()
        if m[0][0] == "." and (before in _RULE_ABBREVIATIONS or (len(before) == 1 and before.isalpha())):
            continue
        if after.islower() and m[0][0] == ".":
            continue
        ends.append(m.end())
    return realigned(text, [text[a:b] for a, b in _sentences(text, ends)])


def realigned(text: str, sentences: list[str]) -> list[Span]:
    """Places of a splitter's sentences. One that starts with a slash, or follows "v." with a capital, joins the one before."""
    out: list[Span] = []
    at, before = 0, ""
    for raw in sentences:
        s = raw.strip()
        if not s:
            continue
        k = text.find(s, at)
        if k < 0:
            raise RuntimeError("a sentence is not in the text")
        at = k + len(s)
        if out and (s.startswith("/") or (before.endswith(" v.") and s[0].isupper())):
            out[-1] = (out[-1][0], at)
        else:
            out.append((k, at))
        before = s
    return out


def semicolon_spans(text: str, min_words: int = SEMICOLON_WORDS) -> list[Span]:
    """Cuts after semicolons outside quotes when the piece has enough words; contiguous, untrimmed. Any of the two quote signs opens, the same closes."""
    words, out, a, quote = Words(text), [], 0, ""
    for m in re.finditer(r"[\"';]", text):
        c = m[0]
        if c == ";":
            if not quote and words.count(a, m.start()) >= min_words:
                out.append((a, m.end()))
                a = m.end()
        elif not quote:
            quote = c
        elif quote == c:
            quote = ""
    if a < len(text):
        out.append((a, len(text)))
    return out


def merge_short(text: str, spans: list[Span], min_words: int = MIN_WORDS, max_words: int = MAX_WORDS) -> list[Span]:
    """Short spans take in the next one; so do spans before a slash, or before a lower-case start while they stay short enough."""
    words, out = Words(text), []
    for s, e in spans:
        if out:
            a, b = out[-1]
            head = text[s:e].lstrip()[:1]
            if words.count(a, b) <= min_words or head == "/" or (head.islower() and words.count(a, e) <= max_words):
                out[-1] = (a, e)
                continue
        out.append((s, e))
    return out


def open_quote(text: str) -> str:
    """The closing sign that is missing: of an odd straight quote first, then of a curly one."""
    if text.count('"') % 2:
        return '"'
    return "”" if text.count("“") > text.count("”") else ""


def merge_quotes(text: str, spans: list[Span], max_words: int = QUOTE_WORDS) -> tuple[list[Span], bool]:
    """Spans with an open quote take in the next ones up to its end. Also whether a quote of a balanced text stayed open."""
    words, out, missing = Words(text), [], ""
    for s, e in spans:
        if out and missing and words.count(out[-1][0], e) <= max_words:
            out[-1] = (out[-1][0], e)
            if missing in text[s:e]:
                missing = ""
            continue
        out.append((s, e))
        missing = open_quote(text[s:e])
    return out, bool(missing) and not open_quote(text)


def resplit(text: str, spans: list[Span], splitter: Callable[[str], list[Span]], merge: bool, long_words: int = LONG_WORDS) -> list[Span]:
    """Long spans are split again."""
    words, out = Words(text), []
    for s, e in spans:
        if words.count(s, e) < long_words:
            out.append((s, e))
            continue
        part = text[s:e]
        found = splitter(part)
        if merge:
            found = merge_quotes(part, merge_short(part, found))[0]
        out += [(s + a, s + b) for a, b in found]
    return out


def untrained_pipeline(text: str) -> list[Span]:
    spans = merge_quotes(text, merge_short(text, untrained_split(text)))[0]
    return resplit(text, resplit(text, spans, rule_split, True), semicolon_spans, False)


def rule_pipeline(text: str) -> list[Span]:
    return resplit(text, merge_quotes(text, merge_short(text, rule_split(text)))[0], semicolon_spans, False)


def better(a: list[Span], b: list[Span]) -> list[Span]:
    """b if a has a much longer or a much shorter span than any of b, else a."""
    if not a or not b:
        return a or b
    la, lb = [e - s for s, e in a], [e - s for s, e in b]
    return b if max(la) > LONGER * max(lb) or min(la) < SHORTER * min(lb) else a


PIPELINES: dict[str, Callable[[str], list[Span]]] = {"rule": rule_pipeline, "untrained": untrained_pipeline, "best": lambda q: better(rule_pipeline(q), untrained_pipeline(q))}


def spans_udf(function: Callable[[str], list[Span]]) -> Callable[[Column], Column]:
    """A column function text -> array of spans; null and blank texts have none."""

    @F.pandas_udf("array<struct<start:int,end:int>>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"start": a, "end": b} for a, b in function(t)] if t and not t.isspace() else [])

    return run


def unclosed(text: str) -> bool:
    """Whether a quotation that the whole text closes stays open over the spans of either pipeline, in which case they are doubtful."""
    text = text.translate({0x201C: '"', 0x201D: '"'})
    return any(merge_quotes(text, merge_short(text, split(text)))[1] for split in (rule_split, untrained_split))


def unclosed_flag(text: Column) -> Column:
    @F.pandas_udf("boolean")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unclosed(t) if t and not t.isspace() else False).astype(bool)

    return run(text)


def clue_spans(text: Column, scheme: str = "best", supplied: Column | None = None) -> Column:
    """Spans by scheme. ``supplied`` takes the given spans, over the text as it is; a text without any then fails the query."""
    if scheme == "supplied":
        if supplied is None:
            raise ValueError("the scheme needs spans")
        return F.when(F.size(supplied) > 0, supplied).otherwise(F.raise_error(F.lit("a text has no supplied spans")).cast("array<struct<start:int,end:int>>"))
    if scheme not in PIPELINES:
        raise ValueError(f"unknown scheme {scheme!r}")
    pipeline = PIPELINES[scheme]
    return spans_udf(lambda t: pipeline(t.translate({0x201C: '"', 0x201D: '"'})))(text)
