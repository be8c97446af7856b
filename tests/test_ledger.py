import json

from pyspark.sql import functions as F

from changeledger.functions import canonical as C
from changeledger.model import CHANGE_EVENT
from changeledger.operators import evidence as E
from changeledger.operators import health as H
from changeledger.operators import ledger as L
from changeledger.operators import retention as R
from tests.test_canonical import EVENT

CFG = L.LedgerConfig("me", 1, 1)
ACTION = "prepared_action struct<contract:string,action:string,data:struct<submitter:string,schema_id:int,policy_id:int,external_ref:string,object_hash:string>>"
RECEIPT = "request_id string, tx_id string, block_num long, trust_state string, finality_flag boolean, finalized_at string"


def run(spark, prior=(), broadcast=("tx", 9, None), receipt=True, cfg=CFG, submitter="me"):
    envelopes = C.envelope(spark.createDataFrame([EVENT], CHANGE_EVENT)).withColumn("seq", F.lit(1))
    ref = envelopes.first().external_ref
    prepared = spark.createDataFrame([("r1", ref, "oh", "v", ("v", "submit", (submitter, 1, 1, ref, "oh")))], f"request_id string, external_ref_hash string, object_hash string, verification_account string, {ACTION}")
    past = spark.createDataFrame([("old", "pg-core", ref, s, "x", "act", "1") for s in prior], "request_id string, source_id string, external_ref string, status string, tx_id string, prepared_action string, updated_at string")
    broadcasts = spark.createDataFrame([(r, *broadcast) for r in ("r1", "old")], "request_id string, tx_id string, block_num long, error string")
    receipts = spark.createDataFrame([("r1", "rx", 10, "finalized", None, None)] if receipt else [], RECEIPT)
    audit = spark.createDataFrame([("r1",)] if receipt else [], "request_id string")
    return L.notarize_singles(envelopes, past, prepared, broadcasts, receipts, audit, cfg).collect()


def test_single_path(spark):
    done = run(spark)[0]
    assert (done.status, done.tx_id, done.block_num, done.ok) == ("finalized_exported", "rx", 10, True)
    included = run(spark, receipt=False)[0]
    assert (included.status, included.ok) == ("broadcast_included", True)
    waiting = run(spark, receipt=False, cfg=L.LedgerConfig("me", 1, 1, True))[0]
    assert (waiting.status, waiting.ok) == ("broadcast_included", False)
    bad = run(spark, submitter="you")[0]
    assert (bad.status, bad.last_error, bad.ok) == ("failed", "submitter", False)
    again = run(spark, broadcast=("tx", 9, "connection reset"), receipt=False)[0]
    assert (again.status, again.last_error) == ("broadcast_included", "connection reset")
    assert run(spark, prior=["finalized_exported"]) == [] and run(spark, prior=["broadcast_included"], receipt=False)[0].request_id == "old"


def test_duplicate_submit(spark):
    twice = ("tx", 0, "duplicate request for submitter me")
    assert run(spark, broadcast=twice, cfg=L.LedgerConfig("me", 1, 1, True))[0].status == "finalized_exported"
    assert run(spark, broadcast=twice)[0].status == "failed"


def test_repeated_answers_count_once(spark):
    rows = spark.createDataFrame([("q",)], "request_id string")
    broadcasts = spark.createDataFrame([("q", "t0", 0, "timed out"), ("q", "t1", 5, None)], "request_id string, tx_id string, block_num long, error string")
    receipts = spark.createDataFrame([("q", "r0", 9, "pending", None, None), ("q", "r1", 7, "finalized", True, None)], RECEIPT)
    audit = spark.createDataFrame([("q",), ("q",)], "request_id string")
    got = L.finalize(rows, broadcasts, receipts, audit).collect()
    assert [(r.tx_id, r.block_num, r.finalized, r.included, r.broadcast_error) for r in got] == [("r1", 7, True, True, None)]


def test_gate_and_dlq(spark, tmp_path):
    events = spark.createDataFrame([EVENT], CHANGE_EVENT)
    ready, gated = L.gate_ready(events, spark.createDataFrame([("pg-core", False)], "source_id string, ready boolean"))
    assert ready.count() == 0
    rows = L.dlq_rows(gated, F.col("reason"))
    row = rows.first()
    assert row.reason == "source is not ready" and '"identity_key":"' in row.payload and '"after":{"amount":"100.00","status":"issued"}' in row.payload
    for run, total in (("cycle-1", 1), ("cycle-1", 1), ("cycle-2", 2)):  # a retried run doubles nothing
        L.write_dlq(rows, f"{tmp_path}/dlq", run)
        assert spark.read.parquet(f"{tmp_path}/dlq").count() == total
    bundles = L.proof_bundles(spark.createDataFrame([("s", "q1"), ("s", "../x")], "source_id string, request_id string"))
    for run in ("one", "one", "two"):
        L.write_bundles(bundles.withColumn("note", F.lit(run)), f"{tmp_path}/proofs", run)
    assert [(r.request_id, r.note) for r in L.read_bundles(spark, f"{tmp_path}/proofs").collect()] == [("q1", "two")]


def test_members_of_failed_batches(spark):
    """Every event of a failed batch reaches the DLQ although a later batch moves the checkpoint past it."""
    versions = [("a", 0, 1), ("a", 0, 2), ("a", 1, 3), ("b", 0, 1)]
    events = spark.createDataFrame([(s, *EVENT[1:8], f"lsn:{n}", *EVENT[9:], n, k) for s, k, n in versions], CHANGE_EVENT + ", seq long, batch_no long")
    results = spark.createDataFrame([("a", 0, "failed", "boom", None, "ra", False, 2, "t2"), ("a", 1, "broadcast_included", None, "q", "rb", True, 3, "t3"), ("b", 0, "broadcast_included", None, "q", "rc", True, 1, "t1")], "source_id string, batch_no long, status string, last_error string, request_id string, external_ref string, ok boolean, seq long, checkpoint_token string")
    deliveries, dead = L.route_failures(results, events)
    assert [(r.request_id, r.source_id) for r in deliveries.collect()] == [("ra", "a")]
    rows = [(r.source_id, r.reason, json.loads(r.payload)["change_version"], len(json.loads(r.payload)["identity_key"])) for r in dead.collect()]
    assert sorted(rows) == [("a", "boom", "lsn:1", 64), ("a", "boom", "lsn:2", 64)]
    assert {r.source_id: r.token for r in L.advance_checkpoints(results).collect()}["a"] == "t3"


def test_retention_and_latest(spark):
    log = spark.createDataFrame([("a", "s", "1", None), ("a", "s", "2", "x"), ("b", "s", "3", None), ("c", "t", "1", None)], "request_id string, source_id string, updated_at string, note string")
    now = {r.request_id: (r.updated_at, r.note) for r in L.upsert_latest(log, ["request_id"], ["updated_at"]).collect()}
    assert now == {"a": ("2", "x"), "b": ("3", None), "c": ("1", None)}
    kept, removed = R.keep_newest(log, 1, ["source_id"], ["updated_at", "request_id"])
    assert sorted(r.request_id for r in kept.collect()) == ["b", "c"] and removed.count() == 2
    assert R.keep_newest(log, 0, ["source_id"], ["updated_at"])[0].count() == 4


def test_evidence(spark, tmp_path):
    for stamp in ("20260101T000000", "20260102T000000", "20260103T000000"):
        E.write_evidence(spark.range(3), str(tmp_path), "report", "s1", stamp)
    manifest = spark.read.schema(E.MANIFEST).parquet(f"{tmp_path}/manifest")
    assert E.latest_artifacts(manifest, "s1").first().path.endswith("20260103T000000") and manifest.where("size > 0").count() == 3
    kept, removed = E.retain(manifest, 2)
    assert removed.first().path.endswith("20260101T000000") and E.drop_removed(manifest, removed).count() == 2
    files = E.list_files(spark, f"{tmp_path}/report").where("path not like '%0102%'")
    assert E.prune_missing(kept, files)[1].first().path.endswith("20260102T000000")


def test_streaks(spark):
    attempts = spark.createDataFrame([("s", i, ok, f"e{i}") for i, ok in enumerate([True, False, False, True, False, False, False])], "source_id string, at long, ok boolean, error string")
    assert [r.streak for r in H.failure_streaks(attempts).orderBy("at").collect()] == [0, 1, 2, 0, 1, 2, 3]
    assert [r.error for r in H.recent_errors(attempts, 2).orderBy("n").collect()] == ["e6", "e5"]
