"""SQLite files as a Spark data source: one table, read in ranges of its row ids, pruned to the wanted columns."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BooleanType, DateType, DoubleType, LongType, StringType, StructField, StructType

ROWS_PER_PARTITION = 500_000


def table_names(path: str) -> list[str]:
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as con:
        return [r[0] for r in con.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'sqlite_%' ORDER BY name")]


def _kind(declared: str):
    d = declared.upper()
    if "BOOL" in d or d == "BIT":
        return BooleanType()
    if "INT" in d:
        return LongType()
    if any(x in d for x in ("REAL", "FLOA", "DOUB", "NUMERIC", "DECIMAL")):
        return DoubleType()
    return DateType() if d == "DATE" else StringType()


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class SQLiteReader(DataSourceReader):
    def __init__(self, path: str, table: str, schema: StructType):
        self.path, self.name, self.schema = path, table, schema

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as con:
            low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.name)}").fetchone()
        if low is None:
            return [Range(0, 0)]
        return [Range(k, min(k + ROWS_PER_PARTITION, high + 1)) for k in range(low, high + 1, ROWS_PER_PARTITION)]

    def read(self, partition: Range) -> Iterator[tuple]:
        import datetime

        def convert(v, kind):
            if v is None:
                return None
            if isinstance(kind, DateType):
                return datetime.date.fromisoformat(str(v)[:10])
            if isinstance(kind, BooleanType):
                return bool(v)
            return str(v) if isinstance(kind, StringType) else int(v) if isinstance(kind, LongType) else float(v)

        kinds = [f.dataType for f in self.schema]
        columns = ", ".join(_quoted(f.name) for f in self.schema)
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as con:
            for row in con.execute(f"SELECT {columns} FROM {_quoted(self.name)} WHERE rowid >= ? AND rowid < ?", (partition.low, partition.high)):
                yield tuple(convert(v, k) for v, k in zip(row, kinds))


class SQLiteSource(DataSource):
    """Options: path, table."""

    @classmethod
    def name(cls) -> str:
        return "quizlake_sqlite"

    def schema(self) -> StructType:
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as con:
            info = con.execute(f"PRAGMA table_info({_quoted(self.options['table'])})").fetchall()
        return StructType([StructField(r[1], _kind(r[2] or "")) for r in info])

    def reader(self, schema: StructType) -> DataSourceReader:
        return SQLiteReader(self.options["path"], self.options["table"], schema)
