"""SQLite databases as a data source: spark.read.format("sqlite_rows") and df.write.format("sqlite_rows").

A path is a database file or a folder of them, on a file system that driver and executors mount; all hold the table of option
`table` (default rows). Reading splits every file into ranges of rowid of about `rows_per_task` rows, one task each, and hands
filters on single columns to SQLite. Writing makes one file for each task, under a name of its own that is put in place when
the job commits; tasks that run again leave nothing behind.

Defined results: INTEGER, REAL, TEXT and BLOB columns are bigint, double, string and binary; a value of another storage class
than its column's is converted, or null where it cannot be. A table without rowid is one task. A folder without databases needs
a schema and gives no rows. Columns of other types are refused when written; NaN is stored as null.
"""

from __future__ import annotations

import os
import sqlite3
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, StringContains, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import BinaryType, ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructType

NAME = "sqlite_rows"
_ORDERED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def local(path: str) -> str:
    """The file system's path; any other scheme is refused."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"SQLite needs a mounted file system, not {path}")
    return path


def files(path: str) -> list[str]:
    at = local(path)
    if os.path.isdir(at):
        return sorted(f"{at}/{x}" for x in os.listdir(at) if not x.startswith(("_", ".")))
    return [at]


def opened(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def type_of(declared: str) -> DataType:
    """By SQLite's own rule of column affinity."""
    d = declared.upper()
    if "INT" in d:
        return LongType()
    if any(x in d for x in ("CHAR", "CLOB", "TEXT")):
        return StringType()
    if "BLOB" in d or not d:
        return BinaryType()
    return DoubleType()


@dataclass
class Range(InputPartition):
    path: str
    low: int | None
    high: int | None


class Reader(DataSourceReader):
    def __init__(self, path: str, table: str, schema: StructType, rows: int):
        self.path, self.table, self.schema, self.rows = path, table, schema, rows
        self.where: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """SQLite tests what it can; the rest stays with Spark."""
        kinds = {f.name: f.dataType for f in self.schema}
        for f in filters:
            attribute = getattr(f, "attribute", None)
            if not attribute or len(attribute) != 1 or attribute[0] not in kinds or not self._push(quoted(attribute[0]), kinds[attribute[0]], f):
                yield f

    def _push(self, column: str, kind: DataType, f: Filter) -> bool:
        fits = lambda v: isinstance(v, str) if kind == StringType() else isinstance(v, (int, float)) and not isinstance(v, bool) and kind in (LongType(), DoubleType())
        if isinstance(f, (IsNull, IsNotNull)):
            self.where.append(f"{column} IS {'NOT ' if isinstance(f, IsNotNull) else ''}NULL")
        elif type(f) in _ORDERED and fits(f.value):
            self.where.append(f"{column} {_ORDERED[type(f)]} ?")
            self.values.append(f.value)
        elif isinstance(f, In) and f.value and all(map(fits, f.value)):
            self.where.append(f"{column} IN ({', '.join('?' * len(f.value))})")
            self.values += f.value
        elif isinstance(f, (StringStartsWith, StringContains)) and fits(f.value):
            self.where.append(f"instr({column}, ?) {'= 1' if isinstance(f, StringStartsWith) else '> 0'}")
            self.values.append(f.value)
        else:
            return False
        return True

    def partitions(self) -> list[Range]:
        out = []
        for path in files(self.path):
            with opened(path) as db:
                try:
                    low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {quoted(self.table)}").fetchone()
                except sqlite3.OperationalError:  # a table without rowid
                    out.append(Range(path, None, None))
                    continue
            if low is not None:
                out += [Range(path, at, min(high, at + self.rows - 1)) for at in range(low, high + 1, self.rows)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition is None or not hasattr(partition, "path"):
            return
        where, values = list(self.where), list(self.values)
        if partition.low is not None:
            where.append("rowid BETWEEN ? AND ?")
            values += [partition.low, partition.high]
        columns = ", ".join(quoted(f.name) for f in self.schema)
        sql = f"SELECT {columns} FROM {quoted(self.table)}" + (f" WHERE {' AND '.join(where)}" if where else "")
        make = [_MAKE[type(f.dataType)] for f in self.schema]
        with opened(partition.path) as db:
            rows = db.execute(sql, values)
            while chunk := rows.fetchmany(4096):
                yield pa.RecordBatch.from_arrays([pa.array([m(v) for v in col], _ARROW[type(f.dataType)]) for m, col, f in zip(make, zip(*chunk, strict=True), self.schema, strict=True)], names=self.schema.names)


def _number(kind: type):
    def make(v):
        try:
            return None if v is None else kind(v)
        except (TypeError, ValueError):
            return None

    return make


def _text(v):
    return v if v is None or isinstance(v, str) else v.decode("utf-8", "replace") if isinstance(v, bytes) else str(v)


def _bytes(v):
    return v if v is None or isinstance(v, bytes) else str(v).encode()


_MAKE = {LongType: _number(int), DoubleType: _number(float), StringType: _text, BinaryType: _bytes}
_ARROW = {LongType: pa.int64(), DoubleType: pa.float64(), StringType: pa.string(), BinaryType: pa.binary()}
_DECLARED = {ByteType: "INTEGER", ShortType: "INTEGER", IntegerType: "INTEGER", LongType: "INTEGER", FloatType: "REAL", DoubleType: "REAL", StringType: "TEXT", BinaryType: "BLOB"}


@dataclass
class Written(WriterCommitMessage):
    made: str
    name: str


class Writer(DataSourceWriter):
    def __init__(self, path: str, table: str, schema: StructType, overwrite: bool):
        other = [f.name for f in schema if type(f.dataType) not in _DECLARED]
        if other:
            raise ValueError(f"columns of types that SQLite has not: {', '.join(other)}")
        self.path, self.table, self.schema, self.overwrite = local(path), table, schema, overwrite

    def write(self, iterator: Iterator) -> Written:
        os.makedirs(self.path, exist_ok=True)
        name = f"part-{uuid.uuid4().hex}.sqlite"
        made = f"{self.path}/_{name}"
        columns = ", ".join(f"{quoted(f.name)} {_DECLARED[type(f.dataType)]}" for f in self.schema)
        db = sqlite3.connect(made)
        try:
            db.execute(f"CREATE TABLE {quoted(self.table)} ({columns})")
            db.executemany(f"INSERT INTO {quoted(self.table)} VALUES ({', '.join('?' * len(self.schema))})", (tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in iterator))
            db.commit()
        except BaseException:
            os.remove(made)
            raise
        finally:
            db.close()
        return Written(made, name)

    def commit(self, messages: list[Written | None]) -> None:
        old = files(self.path) if self.overwrite and os.path.isdir(self.path) else []
        for m in messages:
            if m is not None:
                os.replace(m.made, f"{self.path}/{m.name}")
        for x in old:
            os.remove(x)

    def abort(self, messages: list[Written | None]) -> None:
        for m in messages:
            if m is not None and os.path.exists(m.made):
                os.remove(m.made)


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def _table(self) -> str:
        return self.options.get("table", "rows")

    def schema(self) -> StructType:
        for path in files(self.options["path"]):
            with opened(path) as db:
                columns = db.execute(f"PRAGMA table_info({quoted(self._table())})").fetchall()
            if columns:
                out = StructType()
                for _, name, declared, *_ in columns:
                    out = out.add(name, type_of(declared))
                return out
        raise ValueError(f"no database with a table {self._table()} in {self.options['path']}")

    def reader(self, schema: StructType) -> Reader:
        return Reader(self.options["path"], self._table(), schema, int(self.options.get("rows_per_task", 100_000)))

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(self.options["path"], self._table(), schema, overwrite)


def read_sqlite(spark: SparkSession, path: str, table: str = "rows", rows_per_task: int = 100_000) -> DataFrame:
    """The table of all databases at the path."""
    spark.dataSource.register(SqliteSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(NAME).option("table", table).option("rows_per_task", rows_per_task).load(path)


def write_sqlite(df: DataFrame, path: str, table: str = "rows", mode: str = "append") -> None:
    """A database for each task of df."""
    df.sparkSession.dataSource.register(SqliteSource)
    df.write.format(NAME).option("table", table).mode(mode).save(path)
