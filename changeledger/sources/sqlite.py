"""SQLite files as a Spark data source (SRC-16, SRC-1): ranges of row ids, pushed filters, and a stream by keyset cursors.

`path` is one file, or a folder whose `*.db` files are shards of one table; either must lie where all executors see it. A
stream's offset is the cursor of the checkpoint tokens: the watermark and the key of the last row, as the tokens hold them.
"""

from __future__ import annotations

import datetime as dt
import os
import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual,
)
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

from changeledger.shipping import ship

#: Rules of SQLite's own type affinity, by what a declared type contains; the first that fits.
KINDS = (("INT", LongType()), ("DATETIME", TimestampType()), ("TIMESTAMP", TimestampType()), ("CHAR", StringType()), ("TEXT", StringType()), ("CLOB", StringType()), ("BLOB", BinaryType()), ("REAL", DoubleType()), ("FLOA", DoubleType()), ("DOUB", DoubleType()))
COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
#: Rows fetched at a time; rows of a partition.
FETCH, SPAN = 10_000, 1_000_000


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def opened(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def files(path: str) -> list[str]:
    """The file, or the shards of a folder, by name."""
    local = path.removeprefix("file:")
    local = "/" + local.lstrip("/")
    return sorted(str(p) for p in Path(local).glob("*.db")) if os.path.isdir(local) else [local]


def stamp(value: dt.datetime) -> str:
    """A time as text that sorts: `YYYY-MM-DD HH:MM:SS.ffffff` in UTC."""
    value = value.astimezone(dt.timezone.utc) if value.tzinfo else value
    return value.strftime("%Y-%m-%d %H:%M:%S.%f")


@dataclass
class Piece(InputPartition):
    path: str
    low: int
    high: int


class Query:
    """The select over a table's columns, its conditions and its pieces."""

    def __init__(self, options: dict, schema: StructType):
        self.files, self.table, self.schema = files(options["path"]), options["table"], schema
        self.span = int(options.get("rowsPerPartition", SPAN))
        self.conditions: list[str] = []
        self.values: list = []

    def add(self, condition: str, *values) -> None:
        self.conditions.append(condition)
        self.values += values

    def statement(self) -> str:
        columns = ", ".join(quoted(f.name) for f in self.schema)
        return f"select {columns} from {quoted(self.table)} where " + " and ".join(["rowid >= ? and rowid < ?", *self.conditions])

    def pieces(self) -> list[Piece]:
        out = []
        for path in self.files:
            with opened(path) as con:
                low, high = con.execute(f"select min(rowid), max(rowid) from {quoted(self.table)}").fetchone()
            out += [Piece(path, a, min(a + self.span, high + 1)) for a in range(low, high + 1, self.span)] if low is not None else []
        return out

    def rows(self, piece: Piece) -> Iterator[tuple]:
        times = [k for k, f in enumerate(self.schema) if isinstance(f.dataType, TimestampType)]
        with opened(piece.path) as con:
            found = con.execute(self.statement(), [piece.low, piece.high, *self.values])
            while page := found.fetchmany(FETCH):
                for row in page:
                    if times:
                        row = list(row)
                        for k in times:
                            row[k] = None if row[k] is None else dt.datetime.fromisoformat(row[k]).replace(tzinfo=dt.timezone.utc)
                    yield tuple(row)


def bound(value):
    return stamp(value) if isinstance(value, dt.datetime) else value


class TableReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.query = Query(options, schema)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Comparisons with values go into the statement; Spark checks what is given back."""
        kinds = {f.name: f.dataType for f in self.query.schema}
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name not in kinds or isinstance(kinds[name], BinaryType):
                yield f
            elif type(f) in COMPARED:
                self.query.add(f"{quoted(name)} {COMPARED[type(f)]} ?", bound(f.value))
            elif isinstance(f, In) and f.value:
                self.query.add(f"{quoted(name)} in ({', '.join('?' * len(f.value))})", *map(bound, f.value))
            elif isinstance(f, (IsNull, IsNotNull)):
                self.query.add(f"{quoted(name)} is {'not ' if isinstance(f, IsNotNull) else ''}null")
            else:
                yield f

    def partitions(self) -> list[Piece]:
        return self.query.pieces() or [Piece(self.query.files[0] if self.query.files else "", 0, 0)]

    def read(self, piece: Piece) -> Iterator[tuple]:
        return self.query.rows(piece) if piece.high > piece.low else iter(())


class TableStream(DataSourceStreamReader):
    """Rows after the last offset by (watermark, *key); rows without watermark never come."""

    def __init__(self, options: dict, schema: StructType):
        self.options, self.schema = options, schema
        self.order = [options["watermark"], *[k for k in options.get("key", "").split(",") if k]]

    def initialOffset(self) -> dict:  # noqa: N802
        return {"watermark": None, "pk": []}

    def latestOffset(self) -> dict:  # noqa: N802
        best, columns = None, ", ".join(map(quoted, self.order))
        down = ", ".join(f"{quoted(c)} desc" for c in self.order)
        for path in files(self.options["path"]):
            with opened(path) as con:
                row = con.execute(f"select {columns} from {quoted(self.options['table'])} where {quoted(self.order[0])} is not null order by {down} limit 1").fetchone()
            best = max(filter(None, (best, row)), default=None)
        return self.initialOffset() if best is None else {"watermark": best[0], "pk": list(best[1:])}

    def cut(self, start: dict, end: dict) -> Query:
        query, columns = Query(self.options, self.schema), ", ".join(map(quoted, self.order))
        marks = ", ".join("?" * len(self.order))
        query.add(f"{quoted(self.order[0])} is not null")
        if start["watermark"] is not None:
            query.add(f"({columns}) > ({marks})", start["watermark"], *start["pk"])
        query.add(f"({columns}) <= ({marks})", end["watermark"], *end["pk"])
        return query

    def partitions(self, start: dict, end: dict) -> list[Cut]:
        if end["watermark"] is None:
            return []
        return [Cut(p.path, p.low, p.high, start, end) for p in self.cut(start, end).pieces()]

    def read(self, piece: Cut) -> Iterator[tuple]:
        return self.cut(piece.start, piece.end).rows(piece)

    def commit(self, end: dict) -> None:
        pass


@dataclass
class Cut(Piece):
    start: dict
    end: dict


class SqliteSource(DataSource):
    """`spark.read.format("sqlite").option("path", ...).option("table", ...)`; a stream also names watermark and key."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> StructType:
        found = files(self.options["path"])
        if not found:
            raise FileNotFoundError(f"no SQLite file at {self.options['path']}")
        with opened(found[0]) as con:
            columns = con.execute(f"pragma table_info({quoted(self.options['table'])})").fetchall()
        if not columns:
            raise ValueError(f"table {self.options['table']} does not exist")
        kind = lambda t: next((k for part, k in KINDS if part in t.upper()), StringType())
        return StructType([StructField(c[1], kind(c[2] or "")) for c in columns])

    def reader(self, schema: StructType) -> DataSourceReader:
        return TableReader(dict(self.options), schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return TableStream(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    """Makes the format `sqlite` known to the session, with filters pushed to it."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SqliteSource)


def read_sqlite(spark: SparkSession, options: dict) -> DataFrame:
    """A table by path and table name; strings of columns that hold other things are SQLite's own text of them."""
    register(spark)
    return spark.read.format("sqlite").options(**{k: str(v) for k, v in options.items()}).load()


def write_shards(df: DataFrame, folder: str, table: str) -> int:
    """Writes each partition as a SQLite file of the folder, whole or not at all, so that a task can run again; how many files."""
    ship(df.sparkSession)
    local = files(folder + "/x")[0].removesuffix("/x")
    text = df.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) if kind.startswith("timestamp") else F.col(c) for c, kind in df.dtypes])
    declared = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "binary": "BLOB"}
    columns = ", ".join(f"{quoted(c)} {declared.get(kind, 'TEXT')}" for c, kind in df.dtypes)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        os.makedirs(local, exist_ok=True)
        path = f"{local}/part-{TaskContext.get().partitionId():05d}.db"
        temp = f"{path}.{TaskContext.get().taskAttemptId()}.tmp"
        with sqlite3.connect(temp) as con:
            con.execute(f"create table {quoted(table)} ({columns})")
            for f in frames:
                rows = f.astype(object).where(f.notna(), None).itertuples(index=False, name=None)
                con.executemany(f"insert into {quoted(table)} values ({', '.join('?' * len(f.columns))})", rows)
        con.close()
        os.replace(temp, path)
        yield pd.DataFrame({"path": [path]})

    return text.mapInPandas(write, "path string").count()
