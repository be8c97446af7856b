"""Every registered query with SQL gives DuckDB's rows on the small tables."""

import decimal

import duckdb
import pytest

from changeledger.plans import QUERIES, SQL
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, float):
        return round(v, 9)
    return str(v) if isinstance(v, decimal.Decimal) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = duck.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(plain(r[names.index(c)]) for c in columns)) for r in found.fetchall())
    assert sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect()) == want


def test_entry():
    import __spark_entry__ as entry

    assert set(SQL) <= set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
