"""Duplicates, key sets, counts. Nulls are equal to each other in keys unless said otherwise; every "first" is the least id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: str = "id") -> DataFrame:
    """One row per key, the one with the least ``order``. Map-side aggregation keeps a hot key from meeting in one task."""
    rest = [c for c in df.columns if c not in keys]
    ranked = F.min_by(F.struct(*rest), F.struct(F.col(order).isNull(), order)).alias("__r")
    return df.groupBy(*keys).agg(ranked).select(*keys, "__r.*").select(*df.columns)


def duplicated(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of the groups with more than one row."""
    groups = df.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    return df.join(groups, condition, "left_semi")


def value_counts(df: DataFrame, column: str | Column, name: str = "value") -> DataFrame:
    c = F.col(column) if isinstance(column, str) else column
    return df.select(c.alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: distinct values without null. Each value is counted by a partial aggregation of (column, value)."""
    pairs = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns))).alias("x")).select("x.*")
    return pairs.where("v is not null").distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))


def group_lists(df: DataFrame, keys: list[str], item: Column, name: str = "items") -> DataFrame:
    """Groups with more than one row and their sorted items. A list is as long as its group, so keys should be near-unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(item)).alias(name)).where("n > 1")


def conflicting_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with several distinct values."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_set(value)).alias("values")).where(F.size("values") > 1)


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def key_intersection(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).intersect(right.select(key))


def unique_key(columns: list[str]) -> Column:
    """The values joined by a comma, null as None."""
    return F.concat_ws(", ", *(F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in columns))


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """Dense positions from 1 in a total order, in parallel: sorted ranges, then each range's offset. Ties should be broken by ``order``."""
    from quizlake.session import cut

    part = cut(df.orderBy(*order).withColumn("__p", F.spark_partition_id()).withColumn("__m", F.monotonically_increasing_id()))
    sizes = part.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"), F.min("__m").alias("__first"))
    # one row per partition of the sort
    offsets = sizes.withColumn("__offset", F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)))
    return part.join(F.broadcast(offsets), "__p").withColumn("rank", F.coalesce("__offset", F.lit(0)) + F.col("__m") - F.col("__first") + 1).select(*df.columns, F.col("rank").cast("long"))
