import numpy as np

from changeledger.llm import ann
from changeledger.llm.queries import op5_ann
from tests.conftest import SF


def brute(rows, queries, k=10):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    out = {}
    for q, v in queries:
        d = np.sqrt(((x - np.array(v)) ** 2).sum(1))
        d[ids == q] = np.inf
        best = np.lexsort((ids, d))[: min(k, int((ids != q).sum()))]
        out[q] = list(zip(ids[best].tolist(), d[best].tolist()))
    return out


def recall(got, want):
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == {q for q, w in want.items() if w}
    hits = total = 0
    for q, w in want.items():
        f = sorted(found.get(q, []))
        assert [x[0] for x in f] == list(range(1, len(f) + 1)) and [(x[2], x[1]) for x in f] == sorted((x[2], x[1]) for x in f)
        hits, total = hits + len({v for v, _ in w} & {x[1] for x in f}), total + len(w)
    return hits / total


def test_small(spark):
    rnd = np.random.default_rng(2)
    rows = [(i, rnd.normal(0, 1, 6).tolist()) for i in range(900)] + [(2000 + i, [1.0] * 6) for i in range(700)]
    bad = [(5000, None), (5001, [0.0] * 6), (5002, [1.0, None, 2.0, 1.0, 1.0, 1.0]), (5003, [float("nan")] * 6), (5004, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (5100, [1.0] * 5), (6000, [0.0] * 6)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").selectExpr("*", "1 as leaf", "2 as v")
    got = ann.search(df, df.where("vec_id % 100 = 0")).collect()
    assert recall(got, brute(rows, [r for r in rows if r[0] % 100 == 0])) >= 0.95
    hot = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == 2100)
    assert [(v, s) for _, v, s in hot] == [(2000 + i, 0.0) for i in range(10)]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0
    other = [(5100, [1.0] * 5), (5101, [2.0] * 5), (5102, [4.0] * 5)]
    mixed = df.union(spark.createDataFrame(other[1:], "vec_id long, embedding array<double>").selectExpr("*", "1", "2"))
    apart = ann.search(mixed, mixed.where("vec_id = 5100")).orderBy("rank").collect()
    assert [(r.rank, r.vec_id, round(r.score**2)) for r in apart] == [(1, 5101, 5), (2, 5102, 45)]
    few = df.where("vec_id in (100, 101, 200, 5001)")
    assert ann.search(few, few.where("vec_id % 100 = 0")).count() == 4


def test_outliers_get_k_rows(spark, monkeypatch):
    """Where the visited leaves hold too few rows besides the query's own, more are visited."""
    monkeypatch.setattr(ann.Tree, "calibrate", lambda self, x, k: setattr(self, "visits", 1))
    rnd = np.random.default_rng(3)
    rows = [(i, (rnd.normal(0, 1e-3, 4) + 1).tolist()) for i in range(1, 1200)] + [(5000 + i, [1e6 + i, 1.0, -1.0, 2.0]) for i in range(3)] + [(9000, [-1e6, 3.0, 1.0, float(i)]) for i in range(45)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in ann.search(df, df.where("vec_id >= 5000 and embedding[3] < 3")).collect():
        found[r.query_id] = found.get(r.query_id, 0) + 1
    assert found == {5000: 10, 5001: 10, 5002: 10, 9000: 30}


def test_tree_has_not_seen_what_calibrates_it(spark, monkeypatch):
    """With a sample smaller than the table, held-out recall holds on all rows, and blocks split both sides."""
    monkeypatch.setattr(ann, "LEAST", 600)
    monkeypatch.setattr(ann, "HELD_OUT", 600)
    monkeypatch.setattr(ann, "QUERIES", 16)
    monkeypatch.setattr(ann, "STEP", 7)
    rnd = np.random.default_rng(8)
    centers = rnd.normal(0, 2, (30, 12))
    rows = [(i, (centers[i % 30] + rnd.normal(0, 1, 12)).tolist()) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert recall(ann.search(df, df.where("vec_id % 100 = 0")).collect(), brute(rows, [r for r in rows if r[0] % 100 == 0])) >= 0.9


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    assert recall(op5_ann(spark, SF).collect(), brute(rows, [r for r in rows if r[0] % 100 == 0])) >= 0.95


def test_large_components(spark):
    """Components near the ends of double precision: all candidates come, in the order of their exact distances."""
    rnd = np.random.default_rng(3)
    x = [rnd.normal(size=4) * 10.0 ** e for e in [160] * 20 + [0] * 15 + [-160] * 5] + [np.array([1.7e308, 0, 0, 0]), np.array([-1.7e308, 0, 0, 0])]
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(df, df, k=50).orderBy("query_id", "rank").collect()
    exact = lambda a, b: float(np.hypot.reduce(np.abs(a - b)))
    with np.errstate(over="ignore"):
        for q in range(len(x)):
            mine = [r for r in got if r.query_id == q]
            want = sorted((exact(x[q], x[v]), v) for v in range(len(x)) if v != q)
            assert sorted(r.vec_id for r in mine) == sorted(v for _, v in want) and [r.rank for r in mine] == list(range(1, len(x)))
            assert np.allclose([r.score for r in mine], [d for d, _ in want], rtol=1e-12, atol=0)
