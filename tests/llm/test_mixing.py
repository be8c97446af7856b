import re

import pytest

from changeledger.llm import mixing
from changeledger.llm.queries import op8_mixing
from tests.conftest import SF


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(full.values())
        share = {s: left * w[s] / sum(w[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > cap * sizes[s]]
        if not over:
            return {**full, **share}
        full |= {s: cap * sizes[s] for s in over}


def check(rows, got, near=True, repeats=False):
    sizes, longest = {}, {}
    for _, s, t in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        sizes[s], longest[s] = sizes.get(s, 0) + n, max(n, longest.get(s, 0))
    want, taken = brute_targets(sizes), {}
    assert len(got) == len(rows)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, x in taken.items():
        slack = (10 if repeats else 1) * longest[s]
        assert not near or abs(x - want[s]) <= slack + 1e-6, (s, x, want[s], longest[s])


def test_small(spark):
    rows = [(i, s, "w " * (i * 37 % 90)) for i, s in enumerate(["a", "b", "", None, "é", "Z"] * 60)] + [(900, "hot", "x y " * 200)] * 3
    rows += [(901, "one", "a b c"), (902, "void", None), (903, "void", " \t"), (904, "long", "q " * 60000), (None, "a", "z z z")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "1 as k", "2 as lam", "3 as size")
    first = mixing.mix(df).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    check(rows, first, near=False)  # equal rows move together
    nameless = [(None, "n", "w " * (i * 37 % 90 + i % 3)) for i in range(400)] + [(i, "m", "w " * 5) for i in range(300)]
    check(nameless, mixing.mix(spark.createDataFrame(nameless, "doc_id long, source string, text string")).collect(), repeats=True)
    unique = [r for r in dict.fromkeys(rows)]
    check(unique, mixing.mix(spark.createDataFrame(unique, "doc_id long, source string, text string")).collect())
    again = mixing.mix(df.repartition(7)).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
    assert mixing.mix(df.limit(0)).count() == 0
    assert {r.target for r in mixing.mix(df.where("source = 'void'")).collect()} == {0.0}
    assert mixing.mixed(df).count() == sum(r.taken // r.size for r in first if r.size)


def test_many_sources(spark):
    """Targets of many sources agree with the plain algorithm, full ones among them."""
    rows = [(i, f"s{i % 700}" if i % 11 else None, "w " * (1 + (i * i) % 97 + (3000 if i == 5 else 0))) for i in range(2500)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = brute_targets(sizes)
    assert all(r.target == pytest.approx(want[r.source]) for r in got) and any(r.target == 3 * r.source_size for r in got)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    got = op8_mixing(spark, SF).join(docs.select("doc_id", "source"), "doc_id").collect()
    check(rows, got)
