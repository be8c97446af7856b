import datetime as dt
import struct

from pyspark.sql import functions as F

from changeledger.operators.versions import read_versions
from changeledger.sources import feeds
from changeledger.streaming import health, runs, transactions

SCHEMA = "source_id string, external_ref string, n long"


def land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_run_once_is_idempotent(spark, tmp_path):
    feed, sink, mark = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/mark"
    land(spark, feed, [("s", "a", 1), ("s", "a", 1), ("s", "b", 2)])
    each = runs.deliver_batch(sink)
    runs.run_once(runs.stream_feed(spark, feed, SCHEMA), each, mark)
    land(spark, feed, [("s", "b", 2), ("t", "a", 3)])
    runs.run_once(runs.stream_feed(spark, feed, SCHEMA), each, mark)
    got = lambda: sorted((r.source_id, r.external_ref) for r in read_versions(spark, sink).collect())
    assert got() == [("s", "a"), ("s", "b"), ("t", "a")]
    each(spark.createDataFrame([("s", "b", 2), ("t", "a", 3)], SCHEMA), 1)  # the last batch again, as after a crash
    assert got() == [("s", "a"), ("s", "b"), ("t", "a")]


def test_forever_with_drift_and_snapshots(spark, tmp_path):
    feed = f"{tmp_path}/in"
    land(spark, feed, [("s", "a", 1)])
    seen, drift, shots = [], [], []
    clock = iter(range(0, 1000, 10)).__next__
    each = runs.snapshot_every(15, lambda s, b: shots.append(b), lambda df, b: seen.append(df.count()), f"{tmp_path}/last", clock)
    changed = lambda s: s.createDataFrame([("s", True)], "source_id string, changed boolean")
    query = runs.run_forever(runs.stream_feed(spark, feed, SCHEMA), runs.drift_check(changed, lambda df: drift.append(df.count()), each), f"{tmp_path}/mark", "0 seconds", 1)
    assert not query.isActive and seen == [1] and drift == [1] and shots == [0]
    # A new process knows the time of the last snapshot: at 10 it is too early, at 20 it is due.
    again = runs.snapshot_every(15, lambda s, b: shots.append(b), lambda df, b: None, f"{tmp_path}/last", clock)
    for batch in (1, 2):
        again(spark.range(1), batch)
    assert shots == [0, 2]


def test_two_streams_and_a_reset_checkpoint_share_a_ledger(spark, tmp_path):
    """Batch 0 runs three times with other rows: nothing is lost or doubled."""
    sink = f"{tmp_path}/out"
    for k, (stream, rows) in enumerate([("a", [("s", "r1", 1), ("s", "r2", 1)]), ("b", [("t", "r9", 1), ("s", "r2", 1)]), ("a", [("s", "r1", 1), ("s", "r3", 1)])]):
        land(spark, f"{tmp_path}/in{k}", rows)
        runs.run_once(runs.stream_feed(spark, f"{tmp_path}/in{k}", SCHEMA), runs.deliver_batch(sink, stream=stream), f"{tmp_path}/mark{k}")
    got = sorted((r.source_id, r.external_ref) for r in read_versions(spark, sink).collect())
    assert got == [("s", "r1"), ("s", "r2"), ("s", "r3"), ("t", "r9")]


def test_decoded_stream(spark, tmp_path):
    spark.createDataFrame([("0/1", "7", "table a.b: DELETE: id[bigint]:5")], "lsn string, xid string, data string").write.parquet(f"{tmp_path}/in")
    stream = runs.stream_feed(spark, f"{tmp_path}/in", "lsn string, xid string, data string", feeds.decode_text_feed)
    got = []
    runs.run_once(stream, lambda df, _: got.extend(df.collect()), f"{tmp_path}/mark")
    assert [(r.operation, r.before) for r in got] == [("delete", {"id": "5"})]


def collect(stream, tmp_path, mode="update"):
    rows = []
    query = stream.writeStream.outputMode(mode).foreachBatch(lambda df, _: rows.extend(df.collect())).option("checkpointLocation", f"{tmp_path}/mark").trigger(availableNow=True).start()
    query.awaitTermination()
    return rows


def test_delivery_status(spark, tmp_path):
    spark.createDataFrame([("q", "prepared_registered", "1"), ("q", "finalized_exported", "3"), ("q", "broadcast_included", "2")], "request_id string, status string, updated_at string").write.parquet(f"{tmp_path}/in")
    rows = collect(runs.delivery_status(runs.stream_feed(spark, f"{tmp_path}/in", "request_id string, status string, updated_at string")), tmp_path)
    assert [(r.request_id, r.status) for r in rows] == [("q", "finalized_exported")]


def test_health_machine(spark, tmp_path):
    """Attempts come out of order in three batches; silent sources leave fallback and probation by the clock of another."""
    at = lambda s: dt.datetime(2026, 1, 1, 0, s // 60, s % 60)
    plan = {
        "fall": [(0, True)] + [(s, False) for s in (1, 2, 3)], "back": [(0, True), (1, False), (2, True)], "prob": [(s, False) for s in (1, 2, 3)] + [(35, True)],
        "none": [(5, None)], "again": [(1, False), (2, False), (3, False), (33, False), (80, True)], "clock": [(s, True) for s in (4, 30, 40, 600)],
    }
    rows = [(k, at(s), ok, f"e{s}") for k, xs in plan.items() for s, ok in xs]
    schema = "source_id string, at timestamp, ok boolean, error string"
    for near, far in ((0, 4), (5, 36), (37, 600)):
        part = [r for r in rows if at(near) <= r[1] <= at(far)]
        spark.createDataFrame(part[::-1], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = health.stream_health(runs.stream_feed(spark, f"{tmp_path}/in", schema, files=1), lateness="5 seconds")
    log = {}
    for r in collect(stream, tmp_path):
        log.setdefault(r.source_id, []).append((r.at, r.cause, r.failure_streak, r.fallback_until, r.probation_until, r.state))
    assert [x[1:3] for x in log["fall"]] == [("attempt", 0), ("attempt", 1), ("attempt", 2), ("attempt", 3), ("fallback over", 3), ("probation over", 3)]
    assert log["fall"][3] == (at(3), "attempt", 3, at(33), None, "fallback") and log["fall"][4] == (at(33), "fallback over", 3, None, at(48), "probation")
    assert log["fall"][5] == (at(48), "probation over", 3, None, None, "streaming")
    assert [x[5] for x in log["back"]] == ["streaming", "backoff", "streaming"]
    assert log["prob"][-2:] == [(at(35), "attempt", 0, None, at(48), "probation"), (at(48), "probation over", 0, None, None, "streaming")]
    # A failure at the very end of fallback comes after that end.
    assert [x[:2] for x in log["again"]][3:] == [(at(33), "fallback over"), (at(33), "attempt"), (at(48), "probation over"), (at(63), "fallback over"), (at(78), "probation over"), (at(80), "attempt")]
    assert log["none"] == [(at(5), "attempt", 1, None, None, "backoff")] and len(log["clock"]) == 3  # the last one is within the lateness


def test_health_forgets_silent_sources():
    rules = {"threshold": 3, "fallback": 30, "probation": 15, "base": 1, "most": 10, "history": 2, "forget": 100}
    machine = health.Machine(rules, None)
    rows = [machine.attempt(t, False, f"e{t}") for t in (1, 2, 3)]
    assert [r[3] for r in rows] == [2, 4, 7] and rows[-1][7] == ["e2", "e3"] and machine.ends() == [(33, "fallback")]
    again = health.Machine(rules, machine.kept())
    assert [r[:2] for r in again.until(60)] == [(33, "fallback over"), (48, "probation over")] and again.ends() == []


def test_transactions_wait_together(spark, tmp_path):
    """Interleaved, reused and never committed transactions over three files; entries of the state are shared and few."""
    log = [
        [("begin", "a"), ("row", None), ("row", "b"), ("row", "c"), ("row", None)], [("row", None), ("row", "b"), ("commit", None), ("row", "a"), ("commit", "a"), ("row", "a"), ("row", "")],
        [("commit", "b"), ("row", "b"), ("commit", "b"), ("row", "c"), ("commit", "a"), ("commit", "z")],
    ]
    seq = iter(range(100))
    for part in log:
        rows = [("s", next(seq), kind, xid, "0/9" if kind == "commit" else "0/1", f"v{kind}") for kind, xid in part]
        spark.createDataFrame(rows[::-1], "source_id string, seq long, kind string, xid string, lsn string, note string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    got = collect(transactions.stream_transactions(runs.stream_feed(spark, f"{tmp_path}/in", schema, files=1)), tmp_path, "append")
    found = sorted((r.seq, r.xid, r.event_index, r.total, r.advance, r.note) for r in got)
    a, b = [(1, "a", 1, 3), (4, "a", 2, 3), (5, "a", 3, 3)], [(2, "b", 1, 2), (6, "b", 2, 2)]
    whole = sorted([*a, *b, (8, "a", 1, 1), (10, "a", 1, 1), (13, "b", 1, 1)])
    assert found == [(*r, r[2] == r[3], "vrow") for r in whole]


def test_closed_transactions_never_enter_the_state():
    """A batch of whole transactions costs two calls of the state, however many there are."""
    calls = []

    class Known:
        def exists(self):
            return False

        def __getattr__(self, name):
            return lambda *a: calls.append(name)

    import pandas as pd

    n = 3000
    rows = pd.DataFrame({"kind": ["begin", "row", "commit"] * n, "xid": [x for k in range(n) for x in (str(k), None, None)], "seq": range(3 * n), "lsn": "0/1", "body": "{}"})
    held = transactions.Transactions()
    held.current = held.rows = Known()
    assert sum(map(len, held.handleInputRows(("s",), iter([rows]), None))) == n and calls == ["update"]


def test_relations_of_earlier_batches_decode_tuples(spark, tmp_path):
    """Three batches of two files; a table's message is replaced in the second, another table never has one; a batch runs again."""
    text = lambda v: b"t" + struct.pack(">I", len(v)) + v
    rel = lambda k, name: b"R" + struct.pack(">I", k) + b"app\0" + name + b"\0d" + struct.pack(">h", 1) + b"\1id\0" + struct.pack(">Ii", 20, -1)
    row = lambda k, v: b"I" + struct.pack(">I", k) + b"N" + struct.pack(">h", 1) + text(v)
    log = [[(1, rel(1, b"a"))], [(2, row(1, b"10")), (3, row(2, b"11"))], [(4, row(1, b"12")), (5, rel(1, b"b"))], [(6, row(1, b"13"))], [(7, row(1, b"14"))], [(8, b"C")]]
    for part in log:
        spark.createDataFrame([(seq, "0/1", "7", bytearray(d)) for seq, d in part], "seq long, lsn string, xid string, data binary").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    got, batches = {}, []
    each = transactions.decode_batch(f"{tmp_path}/state", lambda df, k: got.__setitem__(k, sorted((r.seq, r.kind, r.table, (r.after or {}).get("id")) for r in df.collect())))

    def twice(batch, k):
        batches.append(batch.count())
        each(batch, k)
        each(batch, k)

    runs.run_once(runs.stream_feed(spark, f"{tmp_path}/in", schema, files=2), twice, f"{tmp_path}/mark")
    assert batches == [3, 3, 2]
    assert got == {0: [(2, "row", "a", "10"), (3, "row", None, None)], 1: [(4, "row", "a", "12"), (6, "row", "b", "13")], 2: [(7, "row", "b", "14"), (8, "commit", None, None)]}
