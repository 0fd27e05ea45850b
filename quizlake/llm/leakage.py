"""Evaluation passages inside training text, by winnowing.

Both sides are normalised to words, hashed in k-grams of ``GRAM`` words, and of every window of ``WINDOW`` consecutive
k-grams the least hash is kept as a fingerprint. Two texts that share GRAM + WINDOW - 1 = 12 consecutive words share a
whole window and so its fingerprint: no such span is missed. Equal fingerprints are extended to both sides, word by
word; a pair counts when the run has at least 12 words.

The fingerprints of items and documents are joined by key; then the texts of the pairs so found, and only these, are fetched
and extended. A document's fingerprint travels only if one of the windows that chose it is likely to stand in an item: a bitmap of
fixed size has a bit for the leading ``BITS`` bits of the hash of each window of 12 words of the items. A single k-gram in common is
frequent, a window is not, so hardly any other pair is fetched. The corpus is read once for the fingerprints, however many items there are.

Defined results: null and empty texts share nothing; texts under 12 words share nothing; every one of repeated items
and documents is reported under its own id; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlake.session import cut, spread

MIN_WORDS = 12
GRAM = 5
WINDOW = MIN_WORDS - GRAM + 1
#: the bitmap has 2 ** BITS bits (2 MB)
BITS = 24
#: words whose hash a worker remembers; it forgets all of them when there are more
REMEMBERED = 400_000
_TAG = re.compile(r"<[^>]*>")
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Lower-case words without tags and combining marks."""
    if "<" in text:
        text = _TAG.sub("", text)
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
        text = "".join(c for c in text if not unicodedata.category(c).startswith("M"))
    return _WORD.findall(text)


class _Hashes(dict):
    """64-bit hash of a word, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word) >> 1
        return h


def gram_hashes(h: np.ndarray) -> np.ndarray:
    """Hashes of the k-grams of word hashes: position i covers words i to i + GRAM - 1."""
    n = len(h) - GRAM + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def winnow(g: np.ndarray) -> np.ndarray:
    """The least hash of each window of WINDOW k-grams."""
    if len(g) < WINDOW:
        return g[:0]
    span, have = g, 1
    while have < WINDOW:
        step = min(have, WINDOW - have)
        span, have = np.minimum(span[: len(span) - step], span[step:]), have + step
    return span


def window_hashes(g: np.ndarray) -> np.ndarray:
    """A hash of all MIN_WORDS words of each window of WINDOW k-grams, from as many of its k-grams as cover them."""
    n = max(len(g) - WINDOW + 1, 0)
    out = np.zeros(n, dtype=np.uint64)
    for k in (*range(0, WINDOW - 1, GRAM), WINDOW - 1):
        out = out * np.uint64(0x9E3779B97F4A7C15) + g[k : k + n]
    return out


def run_length(a: list[str], i: int, b: list[str], j: int) -> int:
    """Length of the common run of words through a[i] and b[j]."""
    n, x, y = 0, i, j
    while x < len(a) and y < len(b) and a[x] == b[y]:
        n, x, y = n + 1, x + 1, y + 1
    if not n:
        return 0
    x, y = i - 1, j - 1
    while x >= 0 and y >= 0 and a[x] == b[y]:
        n, x, y = n + 1, x - 1, y - 1
    return n


def grams(w: list[str], hashes: _Hashes) -> np.ndarray:
    """Hashes of the k-grams of words."""
    return gram_hashes(np.fromiter(map(hashes.__getitem__, w), dtype=np.uint64, count=len(w)))


def leading(h: np.ndarray, n: int) -> np.ndarray:
    """The place of each hash in a bitmap of 2 ** n bits."""
    return (h >> np.uint64(64 - n)).astype(np.int64)


def prints(text: str, hashes: _Hashes, bits: np.ndarray | None = None, n: int = BITS) -> np.ndarray:
    """The distinct fingerprints of a text (of its windows whose bit is set, if a bitmap of 2 ** n bits is given)."""
    w = words(text)
    if len(w) < MIN_WORDS:
        return np.zeros(0, dtype=np.uint64)
    g = grams(w, hashes)
    if bits is None:
        return np.unique(winnow(g))
    k = leading(window_hashes(g), n)
    meant = (bits[k >> 3] >> (k & 7).astype(np.uint8)) & 1 == 1
    return np.unique(winnow(g)[meant]) if meant.any() else g[:0]


class Side:
    """A text's words and the places of its k-grams, for any number of comparisons."""

    __slots__ = ("at", "g", "sorted", "w")

    def __init__(self, text: str, hashes: _Hashes):
        self.w = words(text)
        self.g = grams(self.w, hashes)
        self.sorted, self.at = np.unique(self.g), None

    def places(self) -> dict[int, list[int]]:
        if self.at is None:
            self.at = {}
            for j, x in enumerate(self.g.tolist()):
                self.at.setdefault(x, []).append(j)
        return self.at


def share(a: Side, b: Side) -> bool:
    """Whether the texts have MIN_WORDS consecutive words in common: equal k-grams are extended to both sides."""
    if not len(a.g) or not len(b.g):
        return False
    k = np.searchsorted(b.sorted, a.g)
    common = np.nonzero(b.sorted[np.minimum(k, len(b.sorted) - 1)] == a.g)[0].tolist()
    if len(common) < WINDOW:  # a shared span has WINDOW k-grams
        return False
    at, done = b.places(), set()  # done: places of runs that were followed
    for i in common:
        for j in at[int(a.g[i])]:
            if (i - 1, j - 1) not in done and run_length(a.w, i, b.w, j) >= MIN_WORDS:
                return True
            done.add((i, j))
    return False


def fingerprints(rows: DataFrame, wanted: Broadcast | None = None) -> DataFrame:
    """id, print of each text's fingerprints (of windows whose bit is set in ``wanted``, if given). rows: id, text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        bits = None if wanted is None else np.frombuffer(wanted.value, dtype=np.uint8)
        for b in batches:
            ids, found = [], []
            for i, t in zip(b.id, b.text):
                f = prints(t, hashes, bits, BITS)
                if len(f):
                    ids.append(np.full(len(f), i, dtype=np.int64))
                    found.append(f.view(np.int64))
            yield pd.DataFrame({"id": np.concatenate(ids), "print": np.concatenate(found)} if ids else {"id": [], "print": []}, dtype="int64")

    return rows.mapInPandas(run, "id long, print long")


def bitmap(rows: DataFrame) -> bytes:
    """A bit for each leading pattern of BITS bits that the hash of a window has: 2 ** BITS bits however many there are. rows: text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        for b in batches:
            for t in b.text:
                yield pd.DataFrame({"k": np.unique(leading(window_hashes(grams(words(t), hashes)), BITS)) + 1})

    k = rows.select("text").mapInPandas(run, "k long")
    parts = k.groupBy(F.bitmap_bucket_number("k").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("k")).alias("bits"))
    out = bytearray(1 << (BITS - 3))
    for r in parts.toLocalIterator():
        at = (r.bucket - 1) * len(r.bits)
        out[at : at + len(r.bits)] = r.bits
    return bytes(out)


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id of every document and item that share MIN_WORDS consecutive words."""
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(doc_text).alias("text")).where("text is not null")
    held = items.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")).where("text is not null")
    own = cut(fingerprints(spread(held)).distinct())
    wanted = spark.sparkContext.broadcast(bitmap(spread(held)))
    theirs = fingerprints(spread(texts), wanted).select(F.col("id").alias("doc_id"), "print")
    pairs = cut(theirs.join(own.select(F.col("id").alias("item_id"), "print"), "print").select("doc_id", "item_id").distinct())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        for b in batches:
            seen = {t: Side(t, hashes) for t in {*b.text, *b.item_text}}
            ok = [share(seen[x], seen[y]) for x, y in zip(b.text, b.item_text)]
            yield b.loc[ok, ["doc_id", "item_id"]]

    both = pairs.join(texts.withColumnRenamed("id", "doc_id"), "doc_id").join(held.select(F.col("id").alias("item_id"), F.col("text").alias("item_text")), "item_id")
    return both.select("doc_id", "item_id", "text", "item_text").mapInPandas(run, "doc_id long, item_id long").distinct()
