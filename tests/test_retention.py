import random

import pytest

from changeledger.operators import retention as R


@pytest.mark.parametrize("small", [10, 100_000])
def test_every_row_is_kept_or_removed(spark, small):
    """Ties, nulls, a null group and rows that repeat, split at sampled rows or not."""
    rnd = random.Random(small)
    rows = [(rnd.choice(["a", "a", "b", None]), rnd.choice([1, 2, 2, 3, None]), rnd.choice("xy")) for _ in range(3000)] + [("c", 1, "x")]
    df = spark.createDataFrame(rows, "g string, k long, v string").repartition(6)
    kept, removed = R.keep_newest(df, 400, ["g"], ["k"], small=small)
    kept, removed = [tuple(r) for r in kept.collect()], [tuple(r) for r in removed.collect()]
    assert sorted(kept + removed, key=repr) == sorted(rows, key=repr)
    for g in ("a", "b", "c", None):
        keys = sorted((r[1] or 0 for r in rows if r[0] == g), reverse=True)
        assert sorted((r[1] or 0 for r in kept if r[0] == g), reverse=True) == keys[:400]


def test_n_beyond_what_one_task_sorts(spark):
    """The 150,000th of 400,000 rows, never more than 1,000 of which are sorted together."""
    df = spark.range(400_000).selectExpr("'s' as g", "id * 7919 % 400009 as k")
    kept, removed = R.keep_newest(df, 150_000, ["g"], ["k"], small=1000)
    assert kept.count() == 150_000 and removed.count() == 250_000
    assert kept.agg({"k": "min"}).first()[0] > removed.agg({"k": "max"}).first()[0]


def test_small_cases(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("a", 2), ("a", None)], "g string, k long")
    kept, removed = R.keep_newest(df, 2, ["g"], ["k"])
    assert sorted(r.k for r in kept.collect()) == [1, 2] and removed.count() == 3
    assert R.keep_newest(df.limit(0), 2, ["g"], ["k"])[0].count() == 0
    assert R.keep_newest(df, 5, ["g"], ["k"])[1].count() == 0
