import numpy as np
import pytest
from pyspark.sql import functions as F

from changeledger.functions import tokens as K
from changeledger.operators import versions as V
from changeledger.sources import feeds
from changeledger.streaming import runs


def rows(spark, lo, hi):
    return spark.range(lo, hi).selectExpr("concat('s', id % 3) as source_id", "concat('r', id) as external_ref", "id as n")


def test_filters_lose_no_key():
    h = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 5000, dtype=np.int64)
    bits = V.bloom(h[:2500])
    assert all(V.may_hold(bits, h[k : k + 1]) for k in range(2500))
    assert sum(V.may_hold(bits, h[k : k + 1]) for k in range(2500, 5000)) < 40


def test_a_killed_writer_and_a_retry(spark, tmp_path, monkeypatch):
    table = V.Versions(spark, f"{tmp_path}/t", ["external_ref"])
    with pytest.raises(FileNotFoundError):
        table.read()
    table.commit(rows(spark, 0, 10), "one")
    monkeypatch.setattr(V.Versions, "_publish", lambda self, m: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        table.commit(rows(spark, 10, 20), "two")
    monkeypatch.undo()
    assert table.read().count() == 10  # what was staged is not read
    for _ in range(2):
        table.commit(rows(spark, 10, 20), "two")
    assert sorted(r.n for r in table.read().collect()) == list(range(20))
    assert table.read(1).count() == 10 and table.manifests() == [1, 2, 3]
    assert table.vacuum(1) > 0 and table.read().count() == 20


def test_two_writers(spark, tmp_path, monkeypatch):
    """Another writer publishes between staging and renaming: both commits are in the table."""
    table, other = (V.Versions(spark, f"{tmp_path}/t") for _ in range(2))
    table.commit(rows(spark, 0, 5), "one")
    plain, met = V.Versions._publish, []

    def late(self, manifest):
        if self is table and not met:
            met.append(1)
            other.commit(rows(spark, 5, 10), "other")
        plain(self, manifest)

    monkeypatch.setattr(V.Versions, "_publish", late)
    table.commit(rows(spark, 10, 15), "two")
    assert sorted(r.n for r in table.read().collect()) == list(range(15)) and met == [1]
    with pytest.raises(V.Conflict):
        table.commit(rows(spark, 0, 1), "three", replace=["data/gone/part-0"])


def test_files_read_and_kept_stay_few(spark, tmp_path, monkeypatch):
    """Batches of new keys: what a batch opens does not grow, and files follow the logarithm of batches."""
    sink, opened = f"{tmp_path}/ledger", []
    plain = V.Versions.candidates
    monkeypatch.setattr(V.Versions, "candidates", lambda self, *a: (opened.append(plain(self, *a)), opened[-1])[1])
    each = runs.deliver_batch(sink, fan=4)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for k in range(20):
            each(rows(spark, 20 * k, 20 * k + 20), k)
        table = V.Versions(spark, sink, ["source_id", "external_ref"])
        assert table.read().count() == 400 and len(table.files()) <= 8
        assert max(map(len, opened)) <= 2 and len(opened[-1]) <= 2
        each(rows(spark, 390, 410), 20)  # ten of its keys are known
        assert table.read().count() == 410 and table.read().distinct().count() == 410 and 1 <= len(opened[-1]) <= 4
        each(rows(spark, 390, 410), 20)  # the same batch again
        assert table.read().count() == 410
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_large_merges_are_cut_by_hash(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "TARGET", 4000)
    table = V.Versions(spark, f"{tmp_path}/t", ["external_ref"])
    for k in range(2):
        table.commit(rows(spark, 1000 * k, 1000 * k + 1000), f"c{k}")
    assert table.compact(2) == 1 and len(table.files()) > 3 and table.read().count() == 2000
    assert len(table.candidates(rows(spark, 5, 6))) == 1
    entries = table.manifest()["files"]
    assert {f["level"] for f in entries} == {1}


def test_purge_publishes_a_version(spark, tmp_path):
    table = V.Versions(spark, f"{tmp_path}/log")
    for k in range(3):
        table.commit(spark.range(10 * k, 10 * k + 10).selectExpr("id as event_id"), f"c{k}")
    before = table.files()
    token = spark.range(1).select(K.trigger_token(F.lit(14))).first()[0]
    feeds.publish_purge(table, token)
    assert sorted(r.event_id for r in table.read().collect()) == list(range(15, 30))
    assert before[2] in table.files() and table.read(3).count() == 30  # an untouched file stays; the old version is readable
    assert feeds.publish_purge(table, token) == 4 and feeds.publish_purge(table, "no token") == 4


def test_batches_are_cut_by_rows(spark, tmp_path, monkeypatch):
    """A delivered batch is written by tasks of a bounded number of rows, and merges keep to it."""
    monkeypatch.setattr(V, "ROWS", 100)
    each = runs.deliver_batch(f"{tmp_path}/t", ["external_ref"], fan=2)
    each(rows(spark, 0, 1000), 0)
    table = V.Versions(spark, f"{tmp_path}/t", ["external_ref"])
    assert len(table.files()) == 10 and table.read().count() == 1000
    each(rows(spark, 500, 1500), 1)
    assert {f["level"] for f in table.manifest()["files"]} == {1} and len(table.files()) >= 15
    assert sorted(r.n for r in table.read().collect()) == list(range(1500))
