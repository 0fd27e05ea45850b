"""Which players met which tossups: response pairs, reach over shared tossups, activity, density.

The reach matrix has a cell for every player and item and is dense, so it is never stored or sent: ``sums`` makes it in slabs of
columns, one task a slab, and only its row and column sums leave the tasks. The pairs lie once in chunks of whole rows in the
checkpoint and are read from there by each task (``session.beside``), so disk grows with the pairs alone; work grows with pairs times
the number of players (or items, if they are fewer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quizlake.operators.dedup import ranked
from quizlake.session import beside, cut

#: Fixed value: fewer tossups than this is low activity.
LOW = 300
#: pairs of a chunk, about
CHUNK = 262144
#: most words of 64 columns in a slab, and of a slab over all rows
WORDS, HELD = 64, 1 << 24


def response_pairs(buzzes: DataFrame, player: str = "player_id", item: str = "tossup_id") -> DataFrame:
    return buzzes.select(F.col(player).alias("player"), F.col(item).alias("item")).where("player is not null and item is not null").distinct()


def numbered(pairs: DataFrame, column: str) -> DataFrame:
    """The values of a column with their positions n from 1."""
    return ranked(pairs.select(column).distinct(), F.col(column)).withColumnRenamed("rank", "n")


def reach_bitmaps(pairs: DataFrame, numbers: DataFrame | None = None, player: str = "player", item: str = "item") -> DataFrame:
    """player, bucket, bits: the items (by their ``numbers``) that a player meets through the players that share an item.
    With the two names exchanged it gives the matrix by columns.

    Players' items are bitmaps; they are ORed over the players of each item and again over the items of each player, so
    nothing grows with the number of pairs of players.
    """
    items = numbered(pairs, item) if numbers is None else numbers
    with_n = cut(pairs.join(items, item))
    own = cut(with_n.groupBy(player, F.bitmap_bucket_number("n").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")))
    by_item = cut(pairs.join(own, player).groupBy(item, "bucket").agg(F.bitmap_or_agg("bits").alias("bits")))
    return pairs.join(by_item, item).groupBy(player, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def unions(table: np.ndarray, members: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each k the OR of the rows ``members[starts[k]:starts[k + 1]]`` of a table of words."""
    n = np.diff(starts)
    order = np.argsort(-n, kind="stable")
    n, first, acc, k = n[order], starts[:-1][order], np.zeros((len(n), table.shape[1]), dtype=np.uint64), 0
    # the k-th members of all that have so many at a time, the few longest one by one
    while (many := int(np.searchsorted(-n, -k))) >= 64:
        acc[:many] |= table[members[first[:many] + k]]
        k += 1
    for j in range(many):
        for at in range(first[j] + k, first[j] + n[j], 4096):
            acc[j] |= np.bitwise_or.reduce(table[members[at : min(at + 4096, first[j] + n[j])]], axis=0)
    out = np.empty_like(acc)
    out[order] = acc
    return out


def column_sums(x: np.ndarray) -> np.ndarray:
    """How many rows have each bit, by adding three rows to a sum and a carry until two are left."""
    out, weight = np.zeros(x.shape[1] * 64, dtype=np.int64), 1
    while len(x):
        carries = [x[:0]]
        while len(x) > 2:
            m = len(x) // 3
            a, b, c = x[:m], x[m : 2 * m], x[2 * m : 3 * m]
            u = a ^ b
            carries.append((a & b) | (u & c))
            x = np.concatenate([u ^ c, x[3 * m :]])
        for row in x:
            out += weight * np.unpackbits(np.ascontiguousarray(row).view(np.uint8), bitorder="little").astype(np.int64)
        x, weight = np.concatenate(carries), 2 * weight
    return out


class Reach:
    """The reach matrix of pairs (player, item): ``by`` its rows' axis, ``over`` that of its columns, which are fewer; chunks of ``per`` rows, slabs of
    ``width`` columns."""

    def __init__(self, pairs: DataFrame, over: str | None = None, whole: bool = False):
        """over: the columns' axis, if it is not to be the shorter one. whole: slabs are so narrow that a task can hold one over all rows."""
        self.numbers = {axis: cut(numbered(pairs, axis)) for axis in ("player", "item")}
        self.count = {axis: df.count() for axis, df in self.numbers.items()}
        self.over = over or min(("player", "item"), key=self.count.get)
        self.by = "item" if self.over == "player" else "player"
        n, cores = self.count[self.over], pairs.sparkSession.sparkContext.defaultParallelism
        at = {axis: df.select(axis, (F.col("n") - 1).cast("int").alias(f"{axis}_at")) for axis, df in self.numbers.items()}
        placed = pairs.join(at["player"], "player").select("player_at", "item").join(at["item"], "item").select("player_at", "item_at")
        self.per = min(max(CHUNK * self.count[self.by] // max(pairs.count(), 1), 1), 16384)
        words = max(min(WORDS, HELD // max(n, 1), HELD // max(whole * self.count[self.by], 1), -(-n // (128 * cores))), 1)
        self.width, self.slabs = 64 * words, -(-n // (64 * words))
        by, over, per = f"{self.by}_at", f"{self.over}_at", self.per

        def pack(x: pd.DataFrame) -> pd.DataFrame:
            x = x.sort_values([by, over])
            chunk = int(x[by].iloc[0]) // per
            starts = np.searchsorted(x[by].to_numpy() - chunk * per, np.arange(per + 1))
            return pd.DataFrame({"chunk": [chunk], "starts": [starts.astype(np.int32).tobytes()], "members": [x[over].to_numpy().astype(np.int32).tobytes()]})

        self.chunks = cut(placed.groupBy(F.floor(F.col(by) / per)).applyInPandas(pack, "chunk long, starts binary, members binary"))

    def slabwise(self, seen, end, schema: str, last=None, sent: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
        """A task for each slab of columns: what ``seen(slab, chunk, bits, held)`` gives for each chunk, bits being its rows of the matrix as words, and
        ``end(slab, held)`` after them; held is a dict that the slab's calls share. With fewer ``tasks`` each has several slabs, held["task"] is a dict of the
        task, and ``last(task)`` gives its last rows. held[axis, block] is the data of ``sent`` (axis, block, data): all of the rows' axis, the slab's of the other."""
        n, words, width, n_chunks = self.count[self.over], self.width // 64, self.width, self.chunks.count()

        def near(table: np.ndarray, slab: int, starts: np.ndarray, members: np.ndarray) -> None:
            """ORs the slab's members of each row into all members of that row."""
            here = np.nonzero(members // width == slab)[0]
            if not len(here):
                return
            rows, own = np.unique(np.searchsorted(starts, here, side="right") - 1, return_inverse=True)
            bits, pos = np.zeros((len(rows), words * 8), dtype=np.uint8), members[here] - slab * width
            np.bitwise_or.at(bits, (own, pos >> 3), (1 << (pos & 7)).astype(np.uint8))
            lengths = starts[rows + 1] - starts[rows]
            source = np.repeat(np.arange(len(rows)), lengths)
            target = members[np.arange(len(source)) + np.repeat(starts[rows] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)]
            order = np.argsort(target, kind="stable")
            target = target[order]
            first = np.concatenate([[0], np.nonzero(np.diff(target))[0] + 1, [len(target)]])
            table[target[first[:-1]]] |= unions(bits.view(np.uint64), source[order], first)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
            task: dict = {}
            table, met, held = np.zeros((n, words), dtype=np.uint64), {1: 0, 2: 0}, {"task": task}
            for b in batches:
                slabs_, turns, axes, blocks = (b.column(c).to_pylist() for c in ("slab", "turn", "axis", "block"))
                for k, (slab, turn, axis, chunk) in enumerate(zip(slabs_, turns, axes, blocks)):
                    if axis is not None:
                        held[axis, chunk] = b.column("data")[k].as_py()
                        continue
                    starts, members = (np.frombuffer(b.column(c)[k].as_buffer(), dtype=np.int32) for c in ("starts", "members"))
                    met[turn] += 1
                    if turn == 1:
                        near(table, slab, starts, members)
                        continue
                    if met[1] != n_chunks:
                        raise RuntimeError("the chunks came out of order")
                    yield from seen(slab, chunk, unions(table, members, starts), held)
                    if met[2] == n_chunks:
                        yield from end(slab, held)
                        table[:], met, held = 0, {1: 0, 2: 0}, {"task": task}
            if last:
                yield from last(task)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x in rows(batches):
                yield pa.RecordBatch.from_pandas(x, schema=out, preserve_index=False)

        out = to_arrow_schema(StructType.fromDDL(schema))
        two = self.chunks.select(F.lit(None).cast("string").alias("axis"), F.col("chunk").alias("block"), F.lit(None).cast("binary").alias("data"), "starts", "members")
        if sent is not None:
            none = F.lit(None).cast("binary")
            two = sent.select("axis", F.col("block").cast("long").alias("block"), "data", none.alias("starts"), none.alias("members")).unionByName(two)
        slabs = self.chunks.sparkSession.range(0, self.slabs, 1, max(min(self.slabs, tasks or self.slabs), 1)).select(F.col("id").alias("slab"), F.explode(F.array(F.lit(1), F.lit(2))).alias("turn"))
        meant = None if sent is None else F.col("axis").isNull() | ((F.col("turn") == 1) & ((F.col("axis") == self.by) | (F.col("block") == F.col("slab"))))
        return beside(slabs, two.coalesce(1), meant).select("slab", "turn", "axis", "block", "data", "starts", "members").mapInArrow(run, schema)

    def sums(self) -> dict[str, DataFrame]:
        by, over, size = self.by, self.over, {self.by: self.per, self.over: self.width}

        def seen(slab: int, chunk: int, bits: np.ndarray, held: dict) -> Iterator[pd.DataFrame]:
            held["total"] = held.get("total", 0) + column_sums(bits)
            yield pd.DataFrame({"axis": [by], "block": [chunk], "data": [np.bitwise_count(bits).sum(axis=1, dtype=np.int32).tobytes()]})

        def end(slab: int, held: dict) -> Iterator[pd.DataFrame]:
            yield pd.DataFrame({"axis": [over], "block": [slab], "data": [held["total"].tobytes()]})

        def add(x: pd.DataFrame) -> pd.DataFrame:
            axis, block = x.axis.iloc[0], int(x.block.iloc[0])
            n = np.sum([np.frombuffer(d, dtype=np.int32 if axis == by else np.int64) for d in x.data], axis=0, dtype=np.int64)
            return pd.DataFrame({"axis": axis, "n": block * size[axis] + np.arange(len(n)) + 1, "n_reached": n})

        all_sums = cut(self.slabwise(seen, end, "axis string, block long, data binary").groupBy("axis", "block").applyInPandas(add, "axis string, n long, n_reached long"))
        return {axis: all_sums.where(F.col("axis") == axis).join(df, "n").select(axis, "n_reached") for axis, df in self.numbers.items()}


def sums(pairs: DataFrame) -> dict[str, DataFrame]:
    """Row sums of the reach matrix (player, n_reached), and its column sums (item, n_reached)."""
    return Reach(pairs).sums()


def reach_activity(pairs: DataFrame, by: str = "player") -> DataFrame:
    """Row sums of the reach matrix (player, n_reached), or its column sums (item, n_reached)."""
    return sums(pairs)[by]


def density(pairs: DataFrame) -> DataFrame:
    """Players, items, reached pairs, and these in percent of all possible ones."""
    p = reach_activity(pairs).agg(F.count(F.lit(1)).alias("n_players"), F.coalesce(F.sum("n_reached"), F.lit(0)).alias("n_pairs"))
    i = pairs.select("item").distinct().agg(F.count(F.lit(1)).alias("n_items"))
    # two single rows
    return p.join(i, F.lit(True)).select("n_players", "n_items", "n_pairs", (F.lit(100.0).cast("double") * F.col("n_pairs") / (F.col("n_players") * F.col("n_items"))).alias("density"))


def low_activity(pairs: DataFrame, below: int = LOW) -> DataFrame:
    """item, n_reached of the items that few players reach."""
    return reach_activity(pairs, "item").where(F.col("n_reached") < below)


def activity_ranks(pairs: DataFrame, by: str, reached: dict[str, DataFrame] | None = None) -> DataFrame:
    """Position of each player or item by falling activity in the reach matrix (its ``sums``, if they are known), ties by key."""
    return ranked((reached or sums(pairs))[by], F.col("n_reached").desc(), F.col(by))
