import hashlib
import re

import pytest

from changeledger.llm import exact
from changeledger.llm.queries import op13_exact
from tests.conftest import SF


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain(rows, greatest=True):
    groups = {}
    for d, t in rows:
        groups.setdefault(lowered(t), []).append(d)
    out = []
    for d, t in rows:
        group = groups[lowered(t)]
        keep = (max if greatest else min)((x for x in group if x is not None), default=None)
        out.append((d, keep, len(group), d == keep, hashlib.sha256(lowered(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=repr)


EDGES = [(1, None), (2, ""), (None, ""), (3, "Ab É"), (9, "aB É"), (4, "ab é"), (5, "x" * 300_000), (6, "X" * 300_000), (8, "one"), (8, "one"), (8, "two"), (None, "none"), (None, "NONE"), (7, " one")]


@pytest.mark.parametrize("greatest", [True, False])
@pytest.mark.parametrize("parts", [1, 2, 9, 30])
def test_edges(spark, greatest, parts):
    df = spark.createDataFrame(EDGES, "doc_id long, text string").selectExpr("*", "1 as run", "'d' as digest", "2 as best", "3 as n").repartition(parts)
    assert got(exact.find_copies(df, greatest, fan=2)) == got(exact.find_copies(df, greatest)) == plain(EDGES, greatest)
    assert exact.find_copies(df.limit(0)).count() == 0


def test_equal_digests_of_other_texts_stay_apart(spark):
    rows = spark.createDataFrame([(i, 5, bytes([i % 2]), 1, i % 3) for i in range(12)], "doc_id long, digest long, sha binary, size long, run long")
    assert sorted((bytes(r.sha), r.keep_id, r.group_size) for r in exact.tree_merge(rows, fan=2).collect()) == [(b"\x00", 10, 6), (b"\x01", 11, 6)]


def test_keep_one(spark):
    df = spark.createDataFrame(EDGES, "doc_id long, text string").selectExpr("doc_id", "text", "'x' as __id", "1 as sha", "2 as row")
    kept = exact.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(2, ""), (9, "aB É"), (4, "ab é"), (6, "X" * 300_000), (8, "one"), (8, "one"), (8, "two"), (None, "none"), (None, "NONE"), (7, " one")], key=repr)


def test_no_python_on_the_main_path(spark):
    plan = op13_exact(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(op13_exact(spark, SF)) == plain(rows)
