import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from changeledger.operators import prefix
from changeledger.operators.scratch import Scratch, closing


@pytest.fixture(params=[64 << 20, 200], ids=["one partition", "many partitions"])
def size(request, monkeypatch):
    monkeypatch.setattr(prefix, "PER_TASK", request.param)


def frame(spark, seed, n=400):
    """Rows with few distinct keys, whole rows that repeat, nulls, and a map, which cannot be hashed."""
    rnd = random.Random(seed)
    rows = [(rnd.choice([1, 1, 1, 2, 3, None]), rnd.choice("abc"), rnd.choice(["x", "y", None]), rnd.random() < 0.3) for _ in range(n)]
    return spark.createDataFrame(rows, "k long, g string, v string, ok boolean").withColumn("m", F.create_map(F.lit("a"), F.lit("b"))).repartition(5)


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def whole(df, keys, within=()):
    """df numbered by a plain window in the same total order."""
    rest = [c for c in df.columns if c not in (*within, *keys, "m")]
    tie = F.xxhash64(*rest) if rest else F.lit(0)
    return df.withColumn("n", F.row_number().over(Window.partitionBy(*(within or [F.lit(1)])).orderBy(*keys, tie)))


@pytest.mark.parametrize("seed", range(3))
def test_sequence_keeps_every_row(spark, size, seed):
    df = frame(spark, seed)
    assert values(prefix.sequence(df, ["k"]), "k", "g", "v", "ok", "seq") == values(whole(df, ["k"]), "k", "g", "v", "ok", "n")
    assert values(prefix.sequence(df, ["k"], "seq", ["g"]), "k", "g", "v", "ok", "seq") == values(whole(df, ["k"], ["g"]), "k", "g", "v", "ok", "n")


@pytest.mark.parametrize("seed", range(3))
def test_running_values_keep_every_row(spark, size, seed):
    df = frame(spark, seed)
    n = whole(df, ["k"])
    last = lambda c, *by: F.last(c, ignorenulls=True).over(Window.partitionBy(*(by or [F.lit(1)])).orderBy("n"))
    own = lambda g: last(F.when(F.col("g") == g, F.col("v")))
    want = values(n.withColumn("s", F.array(own("a"), own("b"))), "k", "g", "v", "ok", "s")
    assert values(prefix.running_last(df, ["k"], "g", ["a", "b"], F.col("v")), "k", "g", "v", "ok", "__state") == want
    n = whole(df, ["k"], ["g"])
    assert values(prefix.running_within(df, ["k"], ["g"], F.col("v"), "s"), "k", "g", "v", "ok", "s") == values(n.withColumn("s", last("v", "g")), "k", "g", "v", "ok", "s")
    good = F.coalesce(F.max(F.when(F.col("ok"), F.col("n"))).over(Window.partitionBy("g").orderBy("n")), F.lit(0))
    assert values(prefix.since_last(df, ["k"], ["g"], F.col("ok"), "s"), "k", "g", "v", "ok", "s") == values(n.withColumn("s", F.col("n") - good), "k", "g", "v", "ok", "s")


def test_joined_inputs_and_empty_ones(spark):
    df = spark.range(2000).selectExpr("id % 100 as k", "id as v")
    both = df.join(df.withColumnRenamed("v", "w"), "k")
    out = prefix.sequence(both, ["k"])
    assert out.count() == 40_000 and out.agg(F.max("seq"), F.countDistinct("seq")).first()[:] == (40_000, 40_000)
    assert prefix.sequence(df.limit(0), ["k"]).count() == 0
    assert prefix.sequence(df.limit(7).drop("v"), ["k"], "k2").count() == 7


def test_an_input_that_changes_between_reads_loses_nothing(spark):
    df = spark.range(500).select(F.rand().alias("k"), F.col("id"))
    assert sorted(r.id for r in prefix.sequence(df, ["k"]).select("id").collect()) == list(range(500))


def test_partitions_follow_measured_bytes():
    assert prefix.partitions(0) == 1 and prefix.partitions(64 << 20) == 1 and prefix.partitions((64 << 20) + 1) == 2
    assert prefix.partitions(100 << 40) == prefix.MOST


def test_closing_deletes_what_the_body_stored(spark):
    with closing():
        out = prefix.sequence(spark.range(10).toDF("k"), ["k"])
        assert out.count() == 10
        roots = [s.root for s in Scratch.live[-1:]]
    fs = spark._jvm.org.apache.hadoop.fs.Path(roots[0]).getFileSystem(spark._jsc.hadoopConfiguration())
    assert not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(roots[0]))


def test_tasks_hold_a_bounded_number_of_rows(spark, monkeypatch):
    """Windows and joins run in partitions by the counted rows, whatever number of shuffle partitions the session has."""
    monkeypatch.setattr(prefix, "ROWS", 50)
    rows = spark.range(1000).selectExpr("id as at", "id % 3 as source", "id % 10 = 0 as ok")
    out = prefix.since_last(rows, ["at"], ["source"], F.col("ok"), "run")
    assert out.rdd.getNumPartitions() == 20
    last, got = {}, {(r.source, r.at): r.run for r in out.collect()}
    for k in range(1000):
        last[k % 3] = 0 if k % 10 == 0 else last.get(k % 3, 0) + 1
        assert got[(k % 3, k)] == last[k % 3]
