"""References to records that do not exist, kept as incremental keyed state.

State: the parent index (one row per parent_table and key: first and last arrival), the pending orphans, and the settled
ones, which later batches leave alone. ``advance`` takes one batch of new references, arriving parents and deletions, in
whatever order they reach it:

* new references probe the index; one whose parent is unknown, or arrived after the reference was recorded, is opened
  as an orphan (reason ``missing`` or ``late``);
* arriving parents resolve the waiting orphans of their key. A parent that turns out to be older than the reference
  withdraws the orphan: it was never one;
* deletions reopen the references to the deleted parent (reason ``deleted``) until the parent arrives again; a reference
  recorded after the deletion is ``missing``.

Defined results: null keys are no references; a reference without a record time is an orphan only while its parent is
missing, and its period is ``unknown``; equal times are no orphan; a parent without an arrival time counts as always
there; repeated parents count once, with their earliest arrival; repeated references give one case per row id; empty
tables give no rows (references without any parents are all orphans); further columns are ignored.

Scale: references are first reduced to one row per key (map-side), so hot keys never meet in one task; only the keys
that can hold an orphan go back to the rows, salted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlake.session import cut

#: child table, time column, {key column: parent table}
REFERENCES = (
    ("buzz", "recorded_at", {"tossup_id": "tossup", "player_id": "player", "game_id": "game"}),
    ("packet_question", "recorded_at", {"question_id": "question"}),
)
SALTS = 16
KEY = ["parent_table", "key"]


@dataclass
class OrphanState:
    """parents: the index, one row per parent_table and key. deleted: parent_table, key, deleted_at. pending: the orphans that may still
    change, open or resolved. settled: those that may not. references: all references so far, for deletions to come back to."""

    parents: DataFrame | None = None
    pending: DataFrame | None = None
    references: DataFrame | None = None
    deleted: DataFrame | None = None
    settled: DataFrame | None = None

    def save(self, path: str) -> None:
        """Writes every part but the references."""
        for name in ("parents", "pending", "deleted", "settled"):
            if (df := getattr(self, name)) is not None:
                df.write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> OrphanState:
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        there = {f.getPath().getName() for f in fs.listStatus(root)}
        return cls(**{n: spark.read.parquet(f"{path}/{n}") for n in ("parents", "pending", "deleted", "settled") if n in there})


def period(time: Column) -> Column:
    return F.coalesce(F.date_format(time, "yyyy-MM"), F.lit("unknown"))


def references(tables: Mapping[str, DataFrame], specs: Iterable = REFERENCES) -> DataFrame:
    """One row per non-null key: table_name, field_name, row_id, parent_table, key, recorded_at. One scan per child."""
    out = None
    for child, time, keys in specs:
        if child not in tables:
            continue
        refs = F.array(*(F.struct(F.lit(k).alias("field_name"), F.lit(p).alias("parent_table"), F.col(k).cast("long").alias("key")) for k, p in keys.items()))
        one = (
            tables[child]
            .select(F.lit(child).alias("table_name"), F.col("id").alias("row_id"), F.col(time).alias("recorded_at"), F.explode(refs).alias("r"))
            .where(F.col("r.key").isNotNull())
            .select("table_name", "r.field_name", "row_id", "r.parent_table", "r.key", "recorded_at")
        )
        out = one if out is None else out.unionByName(one)
    return out


def parents(tables: Mapping[str, DataFrame], specs: Iterable = REFERENCES) -> DataFrame:
    """The parents' arrivals: parent_table, key, loaded_at."""
    out = None
    for name in sorted({p for _, _, keys in specs for p in keys.values()}):
        if name not in tables:
            continue
        one = tables[name].select(F.lit(name).alias("parent_table"), F.col("id").cast("long").alias("key"), F.col("loaded_at"))
        out = one if out is None else out.unionByName(one)
    return out


def deletions(log: DataFrame) -> DataFrame:
    """A deletion log (table_name, row_id, deleted_at) as parent_table, key, deleted_at; the last deletion of a key counts."""
    return log.select(F.col("table_name").alias("parent_table"), F.col("row_id").cast("long").alias("key"), "deleted_at").where("key is not null").groupBy(*KEY).agg(F.max("deleted_at").alias("deleted_at"))


def _index(arrivals: DataFrame) -> DataFrame:
    """Earliest and last arrival of each key; a parent without a time was always there, so its arrival stays null."""
    return (
        arrivals.where("key is not null")
        .groupBy(*KEY)
        .agg(F.min("loaded_at").alias("first_at"), F.max("loaded_at").alias("last_at"), F.bool_or(F.col("loaded_at").isNull()).alias("always"))
        .select(*KEY, F.when(~F.col("always"), F.col("first_at")).alias("loaded_at"), "last_at", F.lit(True).alias("present"))
    )


def _together(one: DataFrame | None, two: DataFrame) -> DataFrame:
    """An index with the rows of another one taken in, one row per key."""
    if one is None:
        return two
    return (
        one.unionByName(two).groupBy(*KEY)
        .agg(F.min("loaded_at").alias("first_at"), F.max("last_at").alias("last_at"), F.bool_or(F.col("loaded_at").isNull()).alias("always"))
        .select(*KEY, F.when(~F.col("always"), F.col("first_at")).alias("loaded_at"), "last_at", F.lit(True).alias("present"))
    )


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _rows_of(refs: DataFrame, keys: DataFrame) -> DataFrame:
    """The references to ``keys`` (one row per key), with the keys' columns; a hot key is spread over the salts."""
    salted = refs.withColumn("salt", F.pmod(F.xxhash64("table_name", "row_id"), F.lit(SALTS)).cast("int"))
    return salted.join(_salted(keys), [*KEY, "salt"]).drop("salt")


def _gone(index: DataFrame, deleted: DataFrame) -> DataFrame:
    """The deleted keys that no parent has arrived for since: parent_table, key, deleted_at."""
    last = deleted.groupBy(*KEY).agg(F.max("deleted_at").alias("deleted_at"))
    return last.join(index.select(*KEY, "last_at"), KEY, "left").where(F.col("last_at").isNull() | (F.col("last_at") <= F.col("deleted_at"))).select(*KEY, "deleted_at")


def probe(refs: DataFrame, index: DataFrame, gone: DataFrame | None = None) -> DataFrame:
    """References that are orphans against ``index`` (parent_table, key, loaded_at, present) without the keys ``gone`` before them."""
    touched = refs.groupBy(*KEY).agg(F.min("recorded_at").alias("first_ref"), F.max("recorded_at").alias("last_ref")).join(index, KEY, "left")
    touched = touched.withColumn("deleted_at", F.lit(None).cast("timestamp_ntz")) if gone is None else touched.join(gone, KEY, "left")
    suspects = (
        touched.where(F.col("present").isNull() | (F.col("loaded_at") > F.col("first_ref")) | (F.col("deleted_at") < F.col("last_ref")))
        .select(*KEY, "loaded_at", "deleted_at", F.col("present").isNull().alias("absent"))
    )
    return (
        _rows_of(refs, suspects)
        .withColumn("missing", F.col("absent") | F.coalesce(F.col("recorded_at") > F.col("deleted_at"), F.lit(False)))
        .where(F.col("missing") | (F.col("loaded_at") > F.col("recorded_at")))
        .select(
            "table_name", "field_name", "row_id", *KEY, "recorded_at",
            F.when(F.col("missing"), "missing").otherwise("late").alias("reason"),
            F.col("recorded_at").alias("opened_at"),
            F.when(~F.col("missing"), F.col("loaded_at")).alias("resolved_at"),
        )
    )


def resolve(pending: DataFrame, arrived: DataFrame) -> DataFrame:
    """Waiting orphans meet arriving parents (parent_table, key, loaded_at, present)."""
    seen = pending.join(arrived.select(*KEY, F.col("loaded_at").alias("arrived_at"), "present"), KEY, "left")
    waiting = F.col("resolved_at").isNull()
    late = F.col("arrived_at") > F.col("opened_at")
    never = waiting & F.col("present").isNotNull() & ~F.coalesce(late, F.lit(False)) & (F.col("reason") != "deleted")
    earlier = (F.col("reason") == "late") & F.col("present").isNotNull() & ~F.coalesce(late, F.lit(False))
    met = waiting & F.col("present").isNotNull() & F.coalesce(late, F.lit(False))
    return seen.where(~(never | earlier)).select(
        "table_name", "field_name", "row_id", *KEY, "recorded_at",
        F.when(met & (F.col("reason") == "missing"), "late").otherwise(F.col("reason")).alias("reason"),
        "opened_at",
        F.when(met, F.col("arrived_at")).otherwise(F.when(F.col("reason") == "late", F.least("resolved_at", F.coalesce("arrived_at", "resolved_at"))).otherwise(F.col("resolved_at"))).alias("resolved_at"),
    )


def reopen(refs: DataFrame, pending: DataFrame, gone: DataFrame) -> DataFrame:
    """References whose parent is ``gone``, missing if they were recorded after that; those already waiting stay as they are."""
    waiting = pending.where(F.col("resolved_at").isNull()).select("table_name", "field_name", "row_id").distinct()
    after = F.coalesce(F.col("recorded_at") > F.col("deleted_at"), F.lit(False))
    return (
        _rows_of(refs, gone)
        .join(waiting, ["table_name", "field_name", "row_id"], "left_anti")
        .select(
            "table_name", "field_name", "row_id", *KEY, "recorded_at",
            F.when(after, "missing").otherwise("deleted").alias("reason"),
            F.greatest("deleted_at", "recorded_at").alias("opened_at"),
            F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        )
    )


def advance(state: OrphanState, refs: DataFrame, arrivals: DataFrame, deleted: DataFrame | None = None, horizon: dt.datetime | None = None) -> OrphanState:
    """One batch. ``deleted`` names parents that the source has deleted and that are not among its rows any more. No arrival of this
    or a later batch is older than the ``horizon``, so what was resolved before it is settled."""
    arrived = cut(_index(arrivals))
    index = arrived if state.parents is None else cut(_together(state.parents, arrived))
    logged = state.deleted if deleted is None else deleted if state.deleted is None else state.deleted.unionByName(deleted)
    gone = None if logged is None else cut(_gone(index, logged))
    pending, settled = probe(refs, index, gone), state.settled
    if state.pending is not None:
        still = state.pending
        if horizon is not None:
            over = F.coalesce(F.col("resolved_at") < F.lit(horizon), F.lit(False))
            still, done = state.pending.where(~over), state.pending.where(over)
            settled = done if settled is None else settled.unionByName(done)
        pending = resolve(still, arrived).unionByName(pending)
    seen = refs if state.references is None else state.references.unionByName(refs)
    pending = cut(pending)
    if deleted is not None:
        pending = pending.unionByName(cut(reopen(seen, pending, gone.join(deleted.select(*KEY), KEY, "left_semi"))))
    return OrphanState(index, pending, seen, logged, settled)


def states(tables: Mapping[str, DataFrame], cuts: Iterable = (), specs: Iterable = REFERENCES, log: DataFrame | None = None) -> Iterator[OrphanState]:
    """The state after each batch of the tables, cut at the given times (rows without a time come with the first batch).

    ``log`` is a deletion log. A logged key that is not among the parents' rows was there until it was deleted; one that
    is among them was restored, and its row tells since when it is there.
    """
    refs, arrivals, deleted = references(tables, specs), parents(tables, specs), None
    if log is not None:
        names = sorted({p for _, _, keys in specs for p in keys.values()})
        deleted = cut(deletions(log).where(F.col("parent_table").isin(names)).join(arrivals.select(*KEY), KEY, "left_anti"))
        arrivals = arrivals.unionByName(deleted.select(*KEY, F.lit(None).cast("timestamp_ntz").alias("loaded_at")))
    state, low = OrphanState(), None
    for high in [*cuts, None]:
        def within(c: str, low=low, high=high) -> Column:
            own = F.lit(True) if low is None else F.col(c) >= F.lit(low)
            own = own if high is None else own & (F.col(c) < F.lit(high))
            return F.coalesce(own, F.lit(low is None))
        batch = refs.where(within("recorded_at")), arrivals.where(within("loaded_at")), None if log is None else deleted.where(within("deleted_at"))
        state = advance(state, *batch, horizon=low)
        # the same rows as the batches so far, read in one scan
        state = replace(state, references=refs.where(within("recorded_at", low=None)), deleted=None if log is None else deleted.where(within("deleted_at", low=None)))
        yield state
        low = high


def replay(tables: Mapping[str, DataFrame], cuts: Iterable = (), specs: Iterable = REFERENCES, log: DataFrame | None = None) -> OrphanState:
    """The state after the last of the batches (``states``)."""
    for state in states(tables, cuts, specs, log):
        pass
    return state


def found(state: OrphanState) -> DataFrame:
    """All orphans, pending and settled."""
    return state.pending if state.settled is None else state.pending.unionByName(state.settled)


def cases(state: OrphanState) -> DataFrame:
    """table_name, field_name, row_id, period of every reference that was an orphan when it was recorded."""
    return found(state).where(F.col("reason") != "deleted").select("table_name", "field_name", "row_id", period(F.col("recorded_at")).alias("period")).distinct()


def snapshot(state: OrphanState) -> DataFrame:
    """Counts by table, field and period: all cases, those still open, and those reopened by a deletion."""
    return (
        found(state).groupBy("table_name", "field_name", period(F.col("recorded_at")).alias("period"))
        .agg(
            F.count_if(F.col("reason") != "deleted").alias("n_cases"),
            F.count_if(F.col("resolved_at").isNull() & (F.col("reason") != "deleted")).alias("n_open"),
            F.count_if(F.col("reason") == "late").alias("n_late"),
            F.count_if(F.col("reason") == "deleted").alias("n_reopened"),
        )
    )
