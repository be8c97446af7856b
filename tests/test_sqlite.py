import datetime as dt
import sqlite3

import pytest
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, IsNotNull, StringContains

from changeledger.model import TableSpec
from changeledger.operators.keyset import watermark_scan
from changeledger.sources import sqlite as Q
from changeledger.sources.specs import read_source
from changeledger.streaming import runs
from tests.conftest import SF

ORDERS = TableSpec("main", "orders", "o_orderdate", ("o_orderkey",))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shards"))
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    assert Q.write_shards(orders.repartition(3), path, "orders") == 3
    return path


def test_pages_equal_those_of_parquet(spark, folder):
    """Every page after a cursor, until none is left: each row once and in the same order."""
    options = {"path": folder, "table": "orders", "rowsPerPartition": 20}
    rows = read_source(spark, "sqlite", options)
    same = spark.read.parquet(f"{SF}/orders.parquet")
    source = Q.SqliteSource(options)
    assert len(source.reader(source.schema()).partitions()) >= same.count() / 20
    assert dict(rows.dtypes) == {"o_orderkey": "bigint", "o_orderdate": "timestamp", "o_orderstatus": "string", "o_totalprice": "double"}
    cursor, seen = None, 0
    while True:
        pages = [[(r.o_orderdate, r.o_orderkey, r.o_totalprice) for r in watermark_scan(df, ORDERS, cursor, 40).collect()] for df in (rows, same)]
        assert pages[0] == pages[1]
        if not pages[0]:
            break
        seen, cursor = seen + len(pages[0]), pages[0][-1][:2]
    assert seen == same.count()


def test_filters_reach_the_statement(folder):
    source = Q.SqliteSource({"path": folder, "table": "orders"})
    reader = source.reader(source.schema())
    since, odd = GreaterThanOrEqual(("o_orderdate",), dt.datetime(1995, 1, 1)), StringContains(("o_orderstatus",), "F")
    assert list(reader.pushFilters([since, odd, EqualTo(("o_orderstatus",), "F"), IsNotNull(("o_orderkey",))])) == [odd]
    assert '"o_orderdate" >= ? and "o_orderstatus" = ? and "o_orderkey" is not null' in reader.query.statement()
    read = [r for p in reader.partitions() for r in reader.read(p)]
    assert read and all(r[1].replace(tzinfo=None) >= dt.datetime(1995, 1, 1) and r[2] == "F" for r in read)


def test_stream_offsets_are_cursors(spark, tmp_path):
    """Rows come once over restarts; equal watermarks go by key; rows without watermark never come."""
    path = f"{tmp_path}/s.db"
    con = sqlite3.connect(path)
    con.execute("create table t (id integer, updated text, note text)")

    def add(*rows):
        con.executemany("insert into t values (?, ?, ?)", rows)
        con.commit()

    def drain():
        Q.register(spark)
        stream = spark.readStream.format("sqlite").options(path=path, table="t", watermark="updated", key="id").load()
        got = []
        runs.run_once(stream, lambda df, _: got.extend((r.id, r.note) for r in df.collect()), f"{tmp_path}/mark")
        return sorted(got)

    add((1, "2026-01-01", "a"), (2, "2026-01-01", "b"), (9, None, "never"))
    assert drain() == [(1, "a"), (2, "b")]
    add((3, "2026-01-01", "c"), (1, "2026-01-02", "d"), (0, "2026-01-01", "behind"))
    assert drain() == [(1, "d"), (3, "c")]
    assert drain() == []


def test_edges(spark, tmp_path):
    con = sqlite3.connect(f"{tmp_path}/e.db")
    con.execute('create table "odd ""name" ("a b" integer, t text, x blob)')
    con.commit()
    options = {"path": f"{tmp_path}/e.db", "table": 'odd "name'}
    assert read_source(spark, "sqlite", options).count() == 0
    con.execute('insert into "odd ""name" values (null, null, ?)', (b"\x00\xff",))
    con.commit()
    assert [tuple(r) for r in read_source(spark, "sqlite", options).collect()] == [(None, None, bytearray(b"\x00\xff"))]
    with pytest.raises(Exception, match="does not exist"):
        read_source(spark, "sqlite", {"path": f"{tmp_path}/e.db", "table": "none"}).count()
