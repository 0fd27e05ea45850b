"""Differences between two copies of a table, by characteristic-polynomial set reconciliation.

Each side reduces its rows to one per id and hashes them; rows fall into buckets of about ``BUCKET_ROWS`` by id. A side
sends, per bucket, only the number of rows, a checksum and the values of its characteristic polynomial at a few sample
points of a finite field. From the two sides' values the rational function num / den is interpolated; its numerator
has the hashes of the rows found on the left side only as roots, its denominator those of the right side only. A
bucket is settled when spare points verify it and each side finds exactly as many of its own rows among the roots as
the degree says; else the degree bound is doubled, the hashes are salted anew, and only the open buckets go again.
The rows so found are fetched from both sides and compared field by field.

Defined results: null equals only null; the latest row per id by the order column counts, and of several with the same
order value the one that is greatest by content (rows repeated in full count once); a null id is an id of its own;
columns that only one side has are not compared; an empty side gives ``only_in_...`` for every row of the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlake.functions import gf
from quizlake.session import cut

BUCKET_ROWS = 256
FIRST_BOUND = 16
CHECK_POINTS = 2
MAX_ROUNDS = 24
#: stands for a null id among the buckets' ids, which are strings
NO_ID = "\0"


def latest(df: DataFrame, key: str, columns: list[str], order: str | None) -> DataFrame:
    """One row per key: key and columns."""
    first = [F.col(order).alias("__order")] if order else []
    rest = F.struct(*first, *(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)))
    return df.groupBy(F.col(key).alias("__id")).agg(F.max(rest).alias("r")).select(F.col("__id").alias(key), *(F.col(f"r.c{i}").alias(c) for i, c in enumerate(columns)))


def _hashed(df: DataFrame, key: str, columns: list[str], n_buckets: int, name: str) -> DataFrame:
    """table_name, bucket, id, fp: fp hashes the key and every column, nulls marked."""
    parts = [x for c in [key, *columns] for x in (F.col(c).isNull(), F.col(c))]
    return df.select(F.lit(name).alias("table_name"), F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(NO_ID))), F.lit(n_buckets)).alias("bucket"), F.coalesce(F.col(key).cast("string"), F.lit(NO_ID)).alias("id"), F.xxhash64(*parts).alias("fp"))


def _elements(fp: np.ndarray, seed: int) -> np.ndarray:
    """Field elements of 64-bit hashes, anew for each seed."""
    x = fp.astype(np.int64).view(np.uint64) ^ np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return (x % np.uint64(gf.P - gf.POINTS)).astype(np.int64)


def _points(bound: int) -> np.ndarray:
    return np.arange(gf.P - gf.POINTS, gf.P - gf.POINTS + bound + CHECK_POINTS, dtype=np.int64)


def buckets(hashed: DataFrame) -> DataFrame:
    """One row per bucket: its ids and hashes. Buckets are cut by hash of the id, so their size is bounded."""
    return hashed.groupBy("table_name", "bucket").agg(F.collect_list("id").alias("ids"), F.collect_list("fp").alias("fps"), F.bit_xor("fp").alias("total"))


def sketch(side: DataFrame, bound: int, seed: int, suffix: str) -> DataFrame:
    """What a side sends of each bucket: size, checksum, values at the sample points."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        z = _points(bound)
        for b in batches:
            yield pd.DataFrame({
                "table_name": b.table_name, "bucket": b.bucket, "n": [len(x) for x in b.fps], "total": b.total,
                "values": [gf.evaluations(_elements(np.asarray(x, dtype=np.int64), seed), z) for x in b.fps],
            })

    return side.mapInPandas(run, "table_name string, bucket long, n long, total long, values array<long>").select("table_name", "bucket", *(F.col(c).alias(c + suffix) for c in ("n", "total", "values")))


def interpolate(left: DataFrame, right: DataFrame, bound: int) -> DataFrame:
    """The differing buckets: num and den, both null where the bound is too low."""
    pairs = left.join(right, ["table_name", "bucket"], "full_outer").where("n_l is null or n_r is null or n_l <> n_r or total_l <> total_r or values_l <> values_r")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        z = _points(bound)
        one = np.ones(len(z), dtype=np.int64)
        for b in batches:
            nums, dens = [], []
            for n1, n2, v1, v2 in zip(b.n_l, b.n_r, b.values_l, b.values_r):
                n1, n2 = (0 if pd.isna(n) else int(n) for n in (n1, n2))
                v1, v2 = (one if v is None else np.asarray(v, dtype=np.int64) for v in (v1, v2))
                f = v1 * np.array([gf.inverse(v) for v in v2], dtype=np.int64) % gf.P
                found = gf.rational(f, z, n1 - n2, CHECK_POINTS)
                nums.append(None if found is None else found[0])
                dens.append(None if found is None else found[1])
            yield pd.DataFrame({"table_name": b.table_name, "bucket": b.bucket, "num": nums, "den": dens})

    return pairs.mapInPandas(run, "table_name string, bucket long, num array<long>, den array<long>")


def _own_roots(side: DataFrame, solved: DataFrame, poly: str, seed: int) -> DataFrame:
    """The ids of a side's rows whose hashes are roots, and whether they are as many as the degree."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found, right = [], []
            for p, ids, fps in zip(b.poly, b.ids, b.fps):
                ids, fps = (ids, np.asarray(fps, dtype=np.int64)) if fps is not None else ([], np.zeros(0, dtype=np.int64))
                hit = gf.value(np.asarray(p, dtype=np.int64), _elements(fps, seed)) == 0
                found.append([i for i, h in zip(ids, hit) if h])
                right.append(len(found[-1]) == len(p) - 1)
            yield pd.DataFrame({"table_name": b.table_name, "bucket": b.bucket, "found": found, "right": right})

    joined = solved.where(F.col(poly).isNotNull()).select("table_name", "bucket", F.col(poly).alias("poly")).join(side, ["table_name", "bucket"], "left")
    return joined.mapInPandas(run, "table_name string, bucket long, found array<string>, right boolean")


def differing_ids(left: DataFrame, right: DataFrame) -> DataFrame:
    """table_name, id (as a string) of every row that the two sides' buckets do not share."""
    left, right = cut(left), cut(right)
    found, open_l, open_r, bound = [], left, right, FIRST_BOUND
    for seed in range(MAX_ROUNDS):
        differing = cut(interpolate(sketch(open_l, bound, seed, "_l"), sketch(open_r, bound, seed, "_r"), bound))
        roots = cut(
            _own_roots(open_l, differing, "num", seed).select("table_name", "bucket", F.col("found").alias("found_l"), F.col("right").alias("right_l"))
            .join(_own_roots(open_r, differing, "den", seed).select("table_name", "bucket", F.col("found").alias("found_r"), F.col("right").alias("right_r")), ["table_name", "bucket"])
        )
        # an unequal checksum without a differing element means a collision: go again with other hashes
        done = F.col("right_l") & F.col("right_r") & (F.size("found_l") + F.size("found_r") > 0)
        found.append(roots.where(done).select("table_name", F.explode(F.concat("found_l", "found_r")).alias("id")))
        still = cut(differing.select("table_name", "bucket").join(roots.where(done).select("table_name", "bucket"), ["table_name", "bucket"], "left_anti"))
        if still.isEmpty():
            break
        open_l, open_r = (x.join(still, ["table_name", "bucket"], "left_semi") for x in (open_l, open_r))
        bound = min(2 * bound, gf.POINTS // 2)
    else:  # hashes that keep colliding: the rows themselves
        rows = [x.select("table_name", F.explode(F.arrays_zip("ids", "fps")).alias("r")).select("table_name", F.col("r.ids").alias("id"), F.col("r.fps").alias("fp")) for x in (open_l, open_r)]
        found.append(rows[0].exceptAll(rows[1]).unionByName(rows[1].exceptAll(rows[0])).select("table_name", "id"))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return cut(out.distinct())


def field_differences(main: DataFrame, copy: DataFrame, ids: DataFrame, key: str, columns: list[str], order: str | None = None) -> DataFrame:
    """row_id, field_name: the rows of the ids, fetched before they are reduced to one per id, compared by field."""
    one, two = (
        latest(df.join(ids.select(F.col("id").alias("__wanted id")), F.col(key).eqNullSafe(F.col("`__wanted id`")), "left_semi"), key, columns, by).select(F.col(key).alias(f"{s}id"), F.lit(True).alias(f"{s}here"), *(F.col(c).alias(f"{s}{i}") for i, c in enumerate(columns)))
        for df, s, by in ((main, "l", None), (copy, "r", order))
    )
    both = one.join(two, F.col("lid").eqNullSafe(F.col("rid")), "full_outer")
    fields = F.array_compact(F.array(*(F.when(~F.col(f"l{i}").eqNullSafe(F.col(f"r{i}")), c) for i, c in enumerate(columns))))
    name = F.when(F.col("rhere").isNull(), F.array(F.lit("only_in_main"))).when(F.col("lhere").isNull(), F.array(F.lit("only_in_copy"))).otherwise(fields)
    return both.select(F.coalesce("lid", "rid").alias("row_id"), F.explode(name).alias("field_name"))


def reconcile(pairs: dict[str, tuple[DataFrame, DataFrame]], key: str = "id", order: str | None = "synced_at") -> DataFrame:
    """table_name, row_id, field_name for each named pair (main, copy); all pairs go through one reconciliation."""
    sides, ready = [None, None], {}
    for name, (main, copy) in pairs.items():
        columns = sorted((set(main.columns) & set(copy.columns)) - {key, order})
        by = order if order in copy.columns else None
        m, c = latest(main, key, columns, None), latest(copy, key, columns, by)
        n = max(1, -(-max(main.count(), copy.count()) // BUCKET_ROWS))
        ready[name] = (main, copy, columns, by)
        for k, df in enumerate((m, c)):
            h = _hashed(df, key, columns, n, name)
            sides[k] = h if sides[k] is None else sides[k].unionByName(h)
    ids = differing_ids(*(buckets(s) for s in sides))
    out = None
    for name, (m, c, columns, by) in ready.items():
        one = field_differences(m, c, ids.where(F.col("table_name") == name).select(F.when(F.col("id") != NO_ID, F.col("id")).cast(m.schema[key].dataType).alias("id")), key, columns, by).select(F.lit(name).alias("table_name"), "row_id", "field_name")
        out = one if out is None else out.unionByName(one)
    return out.distinct()
