"""Filling fixed-capacity containers with texts: harmonic packing of token counts.

Lengths are put into reciprocal-capacity classes: class k holds the sizes in (C/(k+1), C/k], so any k of them fit into
one container. Each class fills containers of its own with exactly k items; only the order of the items in a class
matters, so workers fill theirs independently. The room that a full container has left is again a container of a
smaller capacity: room r takes one item of the largest class j with C/j <= r, whatever the item, and so on down.
Sizes below C / CLASSES go one after another into what room is left, then into containers of their own.

A worker packs a chunk: about ``CHUNK_ITEMS`` items, dealt at random, so no task depends on the size of a class. Each chunk
leaves at most one container per class open.

A text larger than the capacity is divided into full containers and a rest, by token positions; concatenating the
pieces' tokens gives the text's tokens again. Nothing else is divided.

Defined results: null and empty texts go into no container (a text of white space has tokens and does); repeated
texts and repeated ids are items of their own; an empty table gives no containers; further columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlake.session import cut, spread

CAPACITY = 2048
CLASSES = 64
CHUNK_ITEMS = 16_384
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pre-splitting pattern that belongs to the vocabulary file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoding(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and n_tokens of every text that is not null or empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(vocabulary)
        for b in batches:
            yield pd.DataFrame({"doc_id": b.doc_id, "n_tokens": [len(enc.encode_ordinary(t)) for t in b.text]})

    return spread(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("text is not null and text <> ''")).mapInPandas(run, "doc_id long, n_tokens long")


def pieces(counts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, token_start, n_tokens: a text whole, or in pieces of the capacity and a rest."""
    n = F.col("n_tokens")
    starts = F.when(n > capacity, F.sequence(F.lit(0).cast("long"), n - 1, F.lit(capacity).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    return counts.select("doc_id", n.alias("total"), F.explode(starts).alias("token_start")).select("doc_id", "token_start", F.least(F.lit(capacity).cast("long"), F.col("total") - F.col("token_start")).alias("n_tokens"))


def harmonic(sizes: np.ndarray, capacity: int = CAPACITY, classes: int = CLASSES) -> np.ndarray:
    """The container of each item; sizes are between 1 and the capacity."""
    sizes = np.asarray(sizes, dtype=np.int64)
    bins = np.full(len(sizes), -1, dtype=np.int64)
    kind = np.minimum(capacity // np.maximum(sizes, 1), classes)
    queue: list[list[int]] = [[] for _ in range(classes + 1)]
    for i in np.argsort(sizes, kind="stable"):  # the largest of a class are taken first
        queue[kind[i]].append(int(i))
    n, room = 0, []
    for k in range(1, classes):
        while queue[k]:
            left = capacity
            for _ in range(min(k, len(queue[k]))):
                i = queue[k].pop()
                bins[i], left = n, left - sizes[i]
            while left * classes > capacity:
                j = -(-capacity // int(left))
                while j < classes and not queue[j]:
                    j += 1
                if j >= classes:
                    break
                i = queue[j].pop()
                bins[i], left = n, left - sizes[i]
            room.append((int(left), n))
            n += 1
    room.sort(reverse=True)
    small = queue[classes]
    for left, b in room:
        while small and sizes[small[-1]] <= left:
            i = small.pop()
            bins[i], left = b, left - int(sizes[i])
        if not small:
            break
    left = 0
    for i in reversed(small):
        if sizes[i] > left:
            n, left = n + 1, capacity
        bins[i], left = n - 1, left - int(sizes[i])
    return bins


def pack(items: DataFrame, capacity: int = CAPACITY, chunk_items: int = CHUNK_ITEMS) -> DataFrame:
    """container_id, doc_id, token_start, n_tokens for each row of ``items`` (as ``pieces`` gives them)."""
    items = cut(items)
    chunks = max(1, round(items.count() / chunk_items))
    # seeded, over materialised rows: a task that runs again deals the same chunks, and repeated rows spread as well
    keyed = items.withColumn("chunk", F.floor(F.rand(7) * chunks))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "token_start", "n_tokens"], kind="stable")
        return pd.DataFrame({"container_id": pdf.chunk.astype(str) + "-" + pd.Series(harmonic(pdf.n_tokens.to_numpy(), capacity), index=pdf.index).astype(str), "doc_id": pdf.doc_id, "token_start": pdf.token_start, "n_tokens": pdf.n_tokens})

    return keyed.groupBy("chunk").applyInPandas(run, "container_id string, doc_id long, token_start long, n_tokens long")


def containers(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    return pack(pieces(token_counts(docs, vocabulary=vocabulary), capacity), capacity)
