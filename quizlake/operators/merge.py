"""Merging databases: rows that agree on the natural key are one row, ids are assigned anew, references follow.

A null in a natural key is a wildcard: a row agrees with every row that has the same values where it has any. The rows of
all sources in order (source, id) get a sequence; ``first(r)`` is the least sequence among the rows that agree with r.
Row r is kept if that is its own, else it is mapped to it. This equals inserting row by row, and needs one aggregation:
each row is entered once for every pattern of null keys that occurs (at most 2**keys, in practice one or two).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlake.operators.dedup import ranked
from quizlake.schema import TABLES, Table, levels
from quizlake.session import cut


def stacked(sources: list[DataFrame], spec: Table) -> DataFrame:
    """src (position of the source), old_id and the columns, of all sources."""
    out = None
    for k, df in enumerate(sources):
        one = df.select(F.lit(k).alias("src"), F.col(spec.pk).alias("old_id"), *(F.col(c) for c in spec.names if c != spec.pk))
        out = one if out is None else out.unionByName(one)
    return out


def remap(rows: DataFrame, id_maps: Mapping[str, DataFrame], spec: Table, strict: bool = True) -> DataFrame:
    """References replaced by the new ids. strict: a null or unmatched reference fails the query; else it becomes null."""
    for column, parent in spec.fks.items():
        if parent not in id_maps:
            continue
        m = id_maps[parent].select("src", F.col("old_id").alias(column), F.col("new_id").alias("__new"))
        new = F.col("__new")
        if strict:
            new = F.coalesce(new, F.raise_error(F.concat(F.lit(f"no {parent} for {column} of row "), F.col("old_id").cast("string"))).cast("bigint"))
        rows = rows.join(m, ["src", column], "left").withColumn(column, new).drop("__new")
    return rows


def matched(rows: DataFrame, keys: list[str], wildcard: bool = True) -> DataFrame:
    """rows (src, old_id, columns) with seq and first_seq."""
    rows = cut(ranked(rows, F.col("src"), F.col("old_id")).withColumnRenamed("rank", "seq"))
    if not wildcard:
        first = rows.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.min("seq").alias("first_seq"))
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
        return rows.join(first, on).drop(*(f"__{k}" for k in keys))
    bit = {k: F.when(F.col(k).isNotNull(), 1 << i).otherwise(0) for i, k in enumerate(keys)}
    own = sum(bit.values(), F.lit(0))
    rows = rows.withColumn("__p", own)
    patterns = [r[0] for r in rows.select("__p").distinct().collect()]  # at most 2 ** len(keys)

    def key(pattern: int):
        """The key of a pattern, as text with the lengths of its parts."""
        parts = [F.col(k).cast("string") for i, k in enumerate(keys) if pattern >> i & 1]
        return F.concat(F.lit(f"{pattern}|"), *(x for v in parts for x in (F.length(v).cast("string"), F.lit(":"), v)))

    entered = F.array_compact(F.array(*(F.when(F.col("__p").bitwiseAND(p) == p, key(p)) for p in patterns)))
    first = rows.select("seq", F.explode(entered).alias("__key")).groupBy("__key").agg(F.min("seq").alias("first_seq"))
    mine = F.coalesce(*(F.when(F.col("__p") == p, key(p)) for p in patterns)) if patterns else F.lit(None).cast("string")
    return rows.withColumn("__key", mine).join(first, "__key").drop("__key", "__p")


def merge_table(rows: DataFrame, spec: Table, wildcard: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id map: src, old_id, new_id; merged table; differences: src, old_id, new_id, column_name, old_value, new_value)."""
    m = cut(matched(rows, spec.natural_key, wildcard))
    kept = ranked(m.where("seq = first_seq"), F.col("seq")).withColumnRenamed("rank", "new_id")
    id_map = m.select("src", "old_id", "first_seq").join(kept.select(F.col("seq").alias("first_seq"), "new_id"), "first_seq").select("src", "old_id", "new_id")
    columns = [c for c in spec.names if c != spec.pk]
    merged = kept.select(F.col("new_id").alias(spec.pk), *columns)
    before = kept.select(F.col("seq").alias("first_seq"), "new_id", F.struct(*columns).alias("o"))
    changed = F.array_compact(F.array(*(F.when(~F.col(f"o.{c}").eqNullSafe(F.col(c)), F.struct(F.lit(c).alias("column_name"), F.col(f"o.{c}").cast("string").alias("old_value"), F.col(c).cast("string").alias("new_value"))) for c in columns)))
    diffs = m.where("seq <> first_seq").join(before, "first_seq").select("src", "old_id", "new_id", F.explode(changed).alias("d")).select("src", "old_id", "new_id", "d.*")
    return id_map, merged, diffs


def with_parents(names: Iterable[str], tables: Mapping[str, Table] = TABLES) -> dict[str, Table]:
    """The tables and all that they refer to, directly or not."""
    need, todo = set(), list(names)
    while todo:
        if (t := todo.pop()) not in need:
            need.add(t)
            todo += tables[t].fks.values()
    return {t: spec for t, spec in tables.items() if t in need}


def merge_databases(sources: list[Mapping[str, DataFrame]], tables: Mapping[str, Table] = TABLES, strict: bool = True, wildcard: bool = True) -> tuple[dict[str, DataFrame], dict[str, DataFrame], dict[str, DataFrame]]:
    """(id maps, merged tables, differences), by table. Parents come before children; the maps are materialised per level."""
    maps: dict[str, DataFrame] = {}
    merged: dict[str, DataFrame] = {}
    diffs: dict[str, DataFrame] = {}
    for level in levels(dict(tables)):
        for t in level:
            spec = tables[t]
            rows = remap(stacked([s[t] for s in sources if t in s], spec), maps, spec, strict)
            id_map, merged[t], diffs[t] = merge_table(rows, spec, wildcard)
            maps[t] = cut(id_map)
    return maps, merged, diffs


def difference_text(diffs: DataFrame) -> DataFrame:
    """One text per row that was merged into another."""
    line = F.concat(F.lit("\t"), "column_name", F.lit(": "), F.coalesce("old_value", F.lit("None")), F.lit(" -> "), F.coalesce("new_value", F.lit("None")))
    lines = F.array_sort(F.collect_list(F.struct("column_name", line.alias("line"))))
    return diffs.groupBy("src", "old_id", "new_id").agg(F.concat(F.lit("Differences:\n"), F.array_join(F.transform(lines, lambda x: x["line"]), "\n")).alias("text"))
