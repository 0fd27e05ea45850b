"""A database as a set of named DataFrames: loading, introspection, scans, filters, pruning copies, comparison."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlake.schema import DOCUMENTED, TABLES


class Catalog:
    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame]):
        self.spark, self.tables = spark, dict(tables)

    @classmethod
    def load(cls, spark: SparkSession, path: str, names: list[str] | None = None) -> Catalog:
        """Parquet tables of a directory, as file or folder; all of them unless named."""
        if names is None:
            fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            files = fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(fs_path)
            names = sorted(n.removesuffix(".parquet") for n in (f.getPath().getName() for f in files) if n.endswith(".parquet"))
        return cls(spark, {n: spark.read.parquet(f"{path}/{n}.parquet") for n in names})

    @classmethod
    def load_sqlite(cls, spark: SparkSession, path: str, names: list[str] | None = None) -> Catalog:
        """Tables of a SQLite file, through the data source of this package."""
        from quizlake.sources.sqlite import SQLiteSource, table_names

        spark.dataSource.register(SQLiteSource)
        return cls(spark, {n: spark.read.format("quizlake_sqlite").option("path", path).option("table", n).load() for n in names or table_names(path)})

    @classmethod
    def empty(cls, spark: SparkSession) -> Catalog:
        """Every modelled table without rows."""
        return cls(spark, {n: spark.createDataFrame([], t.schema) for n, t in (TABLES | DOCUMENTED).items()})

    def list_tables(self) -> list[str]:
        return sorted(self.tables)

    def column_exists(self, name: str, column: str) -> bool:
        return column in self.tables[name].columns

    def sql(self, query: str) -> DataFrame:
        for n, df in self.tables.items():
            df.createOrReplaceTempView(n)
        return self.spark.sql(query)

    def table(self, name: str, n_rows: int = -1) -> DataFrame:
        """All rows, or the first n_rows by id. A stored ``index`` column has to equal the id and is left out."""
        df = self.tables[name]
        if {"index", "id"} <= set(df.columns):
            ok = F.col("index").eqNullSafe(F.col("id"))
            df = df.withColumn("id", F.when(ok, F.col("id")).otherwise(F.raise_error(F.lit("index and id differ")).cast("bigint"))).drop("index")
        return df.orderBy("id").limit(n_rows) if n_rows > 0 else df

    def head(self, name: str, n_rows: int = 10) -> DataFrame:
        return self.table(name, n_rows)

    def save(self, path: str) -> None:
        """Writes every table beside its place first and moves them there once all are written, so a failed save changes nothing."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        fresh = f"{path}/.writing-{uuid.uuid4().hex}"
        root = jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(conf)
        try:
            for n, df in self.tables.items():
                df.write.parquet(f"{fresh}/{n}.parquet")
            for n in self.tables:
                old, new = (jvm.org.apache.hadoop.fs.Path(f"{p}/{n}.parquet") for p in (path, fresh))
                fs.delete(old, True)
                if not fs.rename(new, old):
                    raise OSError(f"could not move {n} to {path}")
        finally:
            fs.delete(jvm.org.apache.hadoop.fs.Path(fresh), True)

    def pruned(self, prefix: str) -> Catalog:
        """Only the prefixed tables, without the prefix; empty tables stay."""
        return Catalog(self.spark, {n.removeprefix(prefix): df for n, df in self.tables.items() if n.startswith(prefix)})


def matching(df: DataFrame, criteria: dict, limit: int | None = None) -> DataFrame:
    """Rows equal to the criteria; unknown columns are ignored, None means null, a limit of 0 or None none."""
    for c, v in criteria.items():
        if c in df.columns:
            df = df.where(F.col(c).isNull() if v is None else F.col(c) == v)
    return df.orderBy("id").limit(limit) if limit else df


def exactly_one(df: DataFrame, criteria: dict) -> DataFrame:
    """The row equal to the criteria; a LookupError unless there is exactly one."""
    found = matching(df, criteria)
    if (n := found.limit(2).count()) != 1:
        raise LookupError(f"{'no row' if n == 0 else 'several rows'} for {criteria}")
    return found


def console_table(df: DataFrame, n_rows: int = 20) -> str:
    """The first rows as a table of text between lines, numbers to the right."""
    rows = df.limit(n_rows).collect()
    cells = [["" if v is None else str(v) for v in r] for r in rows]
    widths = [max([len(c), *(len(r[k]) for r in cells)]) for k, c in enumerate(df.columns)]
    right = [t.startswith(("int", "bigint", "smallint", "tinyint", "double", "float", "decimal")) for _, t in df.dtypes]
    line = "+" + "+".join("-" * (w + 2) for w in widths) + "+"
    head = "| " + " | ".join(c.ljust(w) for c, w in zip(df.columns, widths)) + " |"
    body = ["| " + " | ".join(v.rjust(w) if r else v.ljust(w) for v, w, r in zip(row, widths, right)) + " |" for row in cells]
    return "\n".join([line, head, line.replace("+--", "|--", 1)[:-1] + "|", *body, line])


def contains_text(column: str, text: str) -> Column:
    """Case-insensitive substring search in which % and _ keep their meaning of LIKE."""
    return F.col(column).ilike(f"%{text}%")


def with_column_if_absent(df: DataFrame, column: str, kind: str) -> DataFrame:
    return df if column in df.columns else df.withColumn(column, F.lit(None).cast(kind))


def shared_fields(left: DataFrame, right: DataFrame) -> list[str]:
    """Comparable columns: in both, no ids or references."""
    return sorted(c for c in set(left.columns) & set(right.columns) if c != "id" and not c.endswith("_id"))


def differing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either side that the other has not, as often as they are missing; none for equal tables."""
    columns = left.columns
    if sorted(columns) != sorted(right.columns):
        raise ValueError("the tables have different columns")
    right = right.select(*columns)
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))
