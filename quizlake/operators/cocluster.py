"""Spectral co-clustering of the reach matrix.

The matrix is dense, so it is neither stored nor turned into pairs: ``coverage.Reach`` makes it in slabs of players, and a slab meets
vectors while it is in memory. ``Blocks.both`` multiplies it from both sides at once: a slab's products with item vectors are whole as
soon as the slab is, so their image can go back to the items before the slab is dropped. A round of scaling or of subspace iteration is
one such pass, and so are the sums of both axes' clusters. Rows and columns are scaled to equal sums (only the two scaling vectors are
kept), leading singular vectors are found by subspace iteration, and k-means groups rows and columns by them. Vectors are tables of
blocks; the driver holds only k x k matrices. After each pass the partial sums, and before the first the pairs and the shuffle files that
they came through, are removed from disk.

Clusters are numbered in the leaf order of Ward linkage over the distances of their mean vectors, so similar ones are neighbours.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlake.operators.coverage import Reach
from quizlake.session import cut, swept

CLUSTERS, SEED = 6, 0
#: items after which the start's random numbers repeat; rows whose bits are floats at a time
BITS, ROWS = 32768, 512
#: the eight bits of each byte
FLOATS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float32)


def _matrix(data: bytes, k: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.float64).reshape(-1, k)


def _floats(bits: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """The rows of words as floats, some at a time, in one buffer."""
    by = bits.view(np.uint8)
    buffer = np.empty((ROWS * by.shape[1], 8), dtype=np.float32)
    for a in range(0, len(by), ROWS):
        some = by[a : a + ROWS]
        np.take(FLOATS, some.ravel(), axis=0, out=buffer[: some.size], mode="clip")
        yield slice(a, a + len(some)), buffer[: some.size].reshape(len(some), -1)


class Blocks:
    """The reach matrix of pairs (player, item). A vector set is a table (block, data): k columns over the block's rows, a block being a slab of players or
    a chunk of items. Single products of up to ``ROWS`` terms are made in single precision and summed in double."""

    def __init__(self, pairs: DataFrame):
        swept(pairs.sparkSession)
        self.reach = Reach(pairs, over="player", whole=True)
        self.numbers = self.reach.numbers
        self.size = {"player": self.reach.width, "item": self.reach.per}

    def both(self, step: Callable[[np.ndarray | None, np.ndarray | None], tuple[np.ndarray | None, np.ndarray | None]], items: DataFrame | None, ki: int, players: DataFrame | None, kp: int) -> tuple[DataFrame, DataFrame]:
        """One pass. For each slab ``step`` gets the matrix times the item vectors and the slab of the player vectors, and returns player vectors that
        are multiplied by the transpose, and those that are kept. Gives the kept ones and the products, a block each."""
        cores = self.numbers["player"].sparkSession.sparkContext.defaultParallelism

        def seen(slab: int, chunk: int, bits: np.ndarray, held: dict) -> Iterator[pd.DataFrame]:
            held[chunk] = bits
            if items is not None:
                x = np.ascontiguousarray(_matrix(held["item", chunk], ki).T, dtype=np.float32)
                y = held.setdefault("y", np.zeros((ki, bits.shape[1] * 64)))
                for rows, f in _floats(bits):
                    for k in range(ki):
                        y[k] += x[k, rows] @ f
            yield from ()

        def end(slab: int, held: dict) -> Iterator[pd.DataFrame]:
            w, kept = step(held["y"].T if items is not None else None, _matrix(held["player", slab], kp) if players is not None else None)
            if w is not None:
                w = np.ascontiguousarray(w.T, dtype=np.float32)
                for chunk in [c for c in held if isinstance(c, int)]:
                    z = held["task"].setdefault(chunk, np.zeros((len(w), len(held[chunk]))))
                    for rows, f in _floats(held[chunk]):
                        for k in range(len(w)):
                            z[k, rows] += f @ w[k]
            if kept is not None:
                yield pd.DataFrame({"axis": ["player"], "block": [slab], "k": [kept.shape[1]], "data": [np.ascontiguousarray(kept, dtype=np.float64).tobytes()]})

        def last(task: dict) -> Iterator[pd.DataFrame]:
            for chunk, z in task.items():
                yield pd.DataFrame({"axis": ["item"], "block": [chunk], "k": [len(z)], "data": [z.T.astype(np.float32).tobytes()]})

        def total(parts: pd.DataFrame) -> pd.DataFrame:
            x = np.sum([np.frombuffer(d, dtype=np.float32) for d in parts.data], axis=0, dtype=np.float64)
            return pd.DataFrame({"block": [parts.block.iloc[0]], "data": [x.tobytes()]})

        given = {"item": items, "player": players}
        sent = [df.select(F.lit(axis).alias("axis"), "block", "data") for axis, df in given.items() if df is not None]
        want_items, want_players = items is not None, players is not None
        items, players = want_items or None, want_players or None  # the closures take no tables along
        out = cut(self.reach.slabwise(seen, end, "axis string, block long, k int, data binary", last, sent[0].unionByName(sent[1]) if len(sent) > 1 else sent[0], cores))
        kept, products = cut(out.where("axis = 'player'").select("block", "data")), cut(out.where("axis = 'item'").groupBy("block").applyInPandas(total, "block long, data binary"))
        del out
        swept(kept.sparkSession)
        return kept, products

    def times(self, x: DataFrame, k: int, axis: str) -> DataFrame:
        """Matrix by vectors over the items (axis player: a result per player), or its transpose by vectors over the players."""
        if axis == "player":
            return self.both(lambda y, _: (None, y), x, k, None, 0)[0]
        return self.both(lambda _, w: (w, None), None, 0, x, k)[1]

    def ones(self, axis: str) -> DataFrame:
        size, n = self.size[axis], self.reach.count[axis]

        def run(batches):
            for b in batches:
                yield pd.DataFrame({"block": b.id, "data": [np.ones((size, 1)).tobytes()] * len(b)})

        return self.reach.chunks.sparkSession.range(0, -(-n // size)).mapInPandas(run, "block long, data binary")

    def rows(self, x: DataFrame, k: int, axis: str) -> DataFrame:
        """axis, x (array): the vectors' values of each player or item."""
        size = self.size[axis]

        def run(batches):
            for b in batches:
                for block, data in zip(b.block, b.data):
                    v = _matrix(data, k)
                    yield pd.DataFrame({"n": block * size + np.arange(len(v)) + 1, "x": list(v)})

        return x.mapInPandas(run, "n long, x array<double>").join(self.numbers[axis], "n").select(axis, "x")

    def one_hot(self, labels: DataFrame, axis: str, k: int) -> DataFrame:
        """Vectors that are 1 where a player or item (axis, cluster) is in the cluster."""
        size = self.size[axis]

        def run(b: pd.DataFrame) -> pd.DataFrame:
            v = np.zeros((size, k))
            v[b.pos.to_numpy(), b.cluster.to_numpy()] = 1.0
            return pd.DataFrame({"block": [b.block.iloc[0]], "data": [v.tobytes()]})

        placed = labels.join(self.numbers[axis], axis).select(F.floor((F.col("n") - 1) / size).alias("block"), ((F.col("n") - 1) % size).cast("int").alias("pos"), "cluster")
        return placed.groupBy("block").applyInPandas(run, "block long, data binary")


def _zipped(x: DataFrame, y: DataFrame, f: Callable[[np.ndarray, np.ndarray], np.ndarray], kx: int, ky: int) -> DataFrame:
    """f of two vector sets, block by block."""

    def run(batches):
        for b in batches:
            yield pd.DataFrame({"block": b.block, "data": [f(_matrix(p, kx), _matrix(q, ky)).tobytes() for p, q in zip(b.data, b.other)]})

    return x.join(y.select("block", F.col("data").alias("other")), "block").mapInPandas(run, "block long, data binary")


def _gram(x: DataFrame, k: int) -> np.ndarray:
    """The k x k products of the vectors."""

    def run(batches):
        for b in batches:
            yield pd.DataFrame([(i, j, float(g[i, j])) for d in b.data for g in [_matrix(d, k).T @ _matrix(d, k)] for i in range(k) for j in range(k)], columns=["i", "j", "g"])

    out = np.zeros((k, k))
    for r in x.mapInPandas(run, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).collect():  # k * k rows
        out[r.i, r.j] = r.g
    return out


def _upright(gram: np.ndarray) -> np.ndarray:
    """What turns vectors of these products into orthonormal ones, the strongest first."""
    w, q = np.linalg.eigh(gram)
    return (q / np.sqrt(np.maximum(w, 1e-12)))[:, ::-1]


def _turned(x: DataFrame, t: np.ndarray, k: int) -> DataFrame:
    return cut(_zipped(x, x, lambda a, _: a @ t, k, k))


def _over(a: np.ndarray) -> np.ndarray:
    return np.divide(1.0, a, out=np.zeros_like(a), where=a > 0)


def vectors(m: Blocks, k: int = 5, rounds: int = 3) -> tuple[DataFrame, DataFrame]:
    """(player, x) and (item, x): leading singular vectors of the scaled matrix without the first, which is constant."""
    c = m.ones("item")
    for _ in range(rounds):
        r, sums = m.both(lambda y, _: (_over(y), _over(y)), c, 1, None, 0)
        c = cut(_zipped(sums, sums, lambda a, _: _over(a), 1, 1))
    size = m.size["item"]

    def start(batches):
        random = np.random.default_rng(SEED).standard_normal((BITS, k - 1))
        for b in batches:
            for block, data in zip(b.block, b.data):
                a = _matrix(data, 1)
                x = np.concatenate([np.sqrt(a), random[(block * size + np.arange(len(a))) % BITS] * (a > 0)], axis=1)
                yield pd.DataFrame({"block": [block], "data": [x.tobytes()]})

    scaled = lambda x: _zipped(x, c, lambda a, b: a * np.sqrt(b), k, 1)
    items = cut(c.mapInPandas(start, "block long, data binary"))
    items = _turned(items, _upright(_gram(items, k)), k)
    for _ in range(rounds):
        # the players' vectors are turned upright after the pass, and what came of them with them
        players, sums = m.both(lambda y, r: (y * r, y * np.sqrt(r)), scaled(items), k, r, 1)
        t = _upright(_gram(players, k))
        items = cut(scaled(sums))
        items = _turned(items, t @ _upright(t.T @ _gram(items, k) @ t), k)
    players = _turned(players, t, k)
    cut_first = lambda x, axis: m.rows(x, k, axis).select(axis, F.slice("x", 2, k - 1).alias("x"))
    return cut_first(players, "player"), cut_first(items, "item")


def _grouped(x: DataFrame, key: str, clusters: int) -> DataFrame:
    ready = cut(x.select(key, array_to_vector("x").alias("features")))
    n = ready.limit(clusters).count()
    if n < 2:
        return ready.select(key, F.lit(0).alias("cluster"))
    return KMeans(k=min(clusters, n), seed=SEED, maxIter=20).fit(ready).transform(ready).select(key, F.col("prediction").alias("cluster"))


def ward_order(points: np.ndarray) -> list[int]:
    """Leaf order under Ward linkage of a few points."""
    groups = [([i], np.asarray(c, dtype=float), 1) for i, c in enumerate(points)]
    while len(groups) > 1:
        best = min(((a, b) for a in range(len(groups)) for b in range(a + 1, len(groups))), key=lambda p: groups[p[0]][2] * groups[p[1]][2] / (groups[p[0]][2] + groups[p[1]][2]) * ((groups[p[0]][1] - groups[p[1]][1]) ** 2).sum())
        (la, ca, na), (lb, cb, nb) = groups[best[0]], groups[best[1]]
        groups = [g for k, g in enumerate(groups) if k not in best] + [(la + lb, (na * ca + nb * cb) / (na + nb), na + nb)]
    return groups[0][0] if groups else []


def distances(gram: np.ndarray) -> np.ndarray:
    """Euclidean distances of vectors from their products."""
    d = np.diag(gram)
    return np.sqrt(np.maximum(d[:, None] + d[None, :] - 2 * gram, 0))


def _ordered(m: Blocks, labels: DataFrame, sums: DataFrame, axis: str, clusters: int) -> tuple[DataFrame, DataFrame]:
    """(labels in leaf order, mean vectors: cluster, key of the other axis, mean), given the clusters' sums over the other axis."""
    other = "item" if axis == "player" else "player"
    sizes = np.zeros(clusters)
    for r in labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect():  # a row per cluster
        sizes[r.cluster] = r.n
    means = cut(_zipped(sums, sums, lambda a, _: a / np.maximum(sizes, 1), clusters, clusters))
    used = [k for k in range(clusters) if sizes[k]]
    order = [used[k] for k in ward_order(distances(_gram(means, clusters))[np.ix_(used, used)])]
    new = F.create_map(*(F.lit(x) for old, k in zip(order, range(len(order))) for x in (old, k))) if order else F.create_map()
    each = F.posexplode("x").alias("old", "mean")
    table = m.rows(means, clusters, other).select(other, each).where(F.col("old").isin(order)).select(new[F.col("old")].alias("cluster"), F.col(other).alias("key"), "mean")
    return cut(labels.select(axis, new[F.col("cluster")].alias("cluster"))), table


def clustered(pairs: DataFrame, clusters: int = CLUSTERS) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(player, cluster), (item, cluster), mean rows by row cluster, mean columns by column cluster."""
    m = Blocks(cut(pairs))
    swept(pairs.sparkSession)  # of the pairs, the chunks are left
    players, items = vectors(m)
    labels = {axis: cut(_grouped(x, axis, clusters)) for axis, x in (("player", players), ("item", items))}
    hot = {axis: cut(m.one_hot(x, axis, clusters)) for axis, x in labels.items()}
    by_player, by_item = m.both(lambda y, w: (w, y), hot["item"], clusters, hot["player"], clusters)
    rows, means = _ordered(m, labels["player"], by_item, "player", clusters)
    columns, column_means = _ordered(m, labels["item"], by_player, "item", clusters)
    return rows, columns, means, column_means


def biclusters(pairs: DataFrame, clusters: int = CLUSTERS) -> DataFrame:
    """row_cluster, column_cluster, n_players, n_items, density (the share of reached pairs)."""
    rows, columns, means, _ = clustered(pairs, clusters)
    sizes = rows.groupBy(F.col("cluster").alias("row_cluster")).agg(F.count(F.lit(1)).alias("n_players"))
    both = means.select(F.col("cluster").alias("row_cluster"), F.col("key").alias("item"), "mean").join(columns.select("item", F.col("cluster").alias("column_cluster")), "item")
    return both.groupBy("row_cluster", "column_cluster").agg(F.count(F.lit(1)).alias("n_items"), F.avg("mean").alias("density")).join(sizes, "row_cluster").select("row_cluster", "column_cluster", "n_players", "n_items", "density")


def cluster_means(pairs: DataFrame, clusters: int = CLUSTERS) -> DataFrame:
    """axis, cluster, key, mean: the mean vector of every row and column cluster."""
    _, _, rows, columns = clustered(pairs, clusters)
    return rows.select(F.lit("row").alias("axis"), "cluster", F.col("key").cast("string").alias("key"), "mean").unionByName(columns.select(F.lit("column").alias("axis"), "cluster", F.col("key").cast("string").alias("key"), "mean"))
