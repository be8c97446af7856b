import datetime as dt
import hashlib
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from changeledger.functions import canonical as C
from changeledger.functions import decode as D
from changeledger.functions import status as S
from changeledger.functions import tokens as K
from changeledger.model import CHANGE_EVENT, EVENT_COLUMNS, KeySpec, SourceSpec, TableSpec
from changeledger.operators import batching
from changeledger.sources import snapshot as N

EVENT = ("pg-core", "postgresql", "erp-1", "ledger", "public", "tickets", "update", '{"id":4711}', "lsn:10/20", "2025-11-03T10:11:12Z", '{"amount":"100.00","status":"issued"}', '{"amount":"100.00","status":"draft"}', '{"txid":44}', "lsn:10/20", "single")


def dumps(x):
    return json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def one(df, col):
    return df.select(col.alias("v")).first()["v"]


def test_envelope(spark):
    row = C.envelope(spark.createDataFrame([EVENT], CHANGE_EVENT)).first()
    e = dict(zip(EVENT_COLUMNS, EVENT))
    identity = sha(dumps({"source_type": e["source_type"], "source_instance": e["source_instance"], "database_name": "ledger", "schema_or_namespace": "public", "table_or_collection": "tickets", "operation": "update", "primary_key": {"id": 4711}, "change_version": "lsn:10/20"}))
    assert (row.identity_key, row.external_ref) == (identity, sha(identity + ":lsn:10/20"))
    assert row.before_hash == sha(e["before"]) and row.after_hash == sha(e["after"]) and row.metadata_hash == sha('{"txid":44}')
    empty = C.envelope(spark.createDataFrame([EVENT[:10] + (None, None, None, "", "single")], CHANGE_EVENT)).first()
    assert (empty.before_hash, empty.after_hash) == (None, C.EMPTY_HASH) and empty.external_ref == row.external_ref


def test_values(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 11, 3, 10, 11, 12, 345678), dt.date(2026, 1, 2), Decimal("100.00"), b"\x0a\xff", 'é"\\\n', None, [Decimal("1.50"), None], {"b": 1, "a": None}, True)], "ts timestamp, d date, n decimal(18,2), bin binary, s string, z int, xs array<decimal(5,2)>, m map<string,int>, ok boolean")
    got = {c: one(df, C.canonical_json(F.struct(F.col(c)), df.select(F.struct(c).alias("v")).schema["v"].dataType)) for c in df.columns}
    assert got["ts"] == '{"ts":"2025-11-03T10:11:12Z"}' and got["d"] == '{"d":"2026-01-02"}' and got["n"] == '{"n":"100.00"}' and got["bin"] == '{"bin":"0aff"}'
    assert got["s"] == dumps({"s": 'é"\\\n'}) and got["z"] == '{"z":null}' and got["xs"] == '{"xs":["1.50",null]}'
    assert one(df, C.canonical_json(F.col("m"), df.schema["m"].dataType)) == '{"a":null,"b":1}'
    with pytest.raises(TypeError):
        C.canonical_json(F.col("x"), spark.createDataFrame([(1.5,)], "x double").schema["x"].dataType)


def test_batch_ref(spark):
    refs = ["b", "a", "c"]
    assert one(spark.createDataFrame([(refs,)], "r array<string>"), C.batch_ref(F.col("r"))) == sha(dumps({"count": 3, "leaf_external_refs": sorted(refs)}))
    with pytest.raises(Exception, match="must not be empty"):
        one(spark.createDataFrame([([],)], "r array<string>"), C.batch_ref(F.col("r")))


def test_paging_delivers_each_row_once(spark):
    rows = [(i, f"s{i % 3}", dt.datetime(2026, 4, 20, 8, 0, i // 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, status string, updated_at timestamp")
    spec = TableSpec("public", "tickets", "updated_at", ("id",))
    from changeledger.operators.keyset import watermark_scan

    for limit in (1, 7, 25):
        state, seen = None, []
        while page := watermark_scan(df, spec, state, limit).collect():
            seen += [r.id for r in page]
            state = (page[-1].updated_at, page[-1].id)
        assert sorted(seen) == list(range(60)) and len(seen) == 60


def test_snapshot_is_stable(spark):
    a = spark.createDataFrame([(1, "issued", dt.datetime(2026, 4, 20, 8)), (2, "paid", dt.datetime(2026, 4, 20, 8, 5)), (3, "late", None)], "id long, status string, updated_at timestamp")
    b = spark.createDataFrame([(9, dt.datetime(2026, 4, 20, 8, 2, 0, 250))], "id long, updated_at timestamp")
    specs = [TableSpec("p", "tickets", "updated_at", ("id",)), TableSpec("p", "payments", "updated_at", ("id",))]
    run = lambda n: N.snapshot({"p.tickets": a.repartition(n), "p.payments": b}, specs, SourceSpec("x", "sqlite")).orderBy("order_time").collect()
    got = run(1)
    assert [r.change_version for r in got] == ["p.tickets:2026-04-20T08:00:00Z:1", "p.payments:2026-04-20T08:02:00Z:9", "p.tickets:2026-04-20T08:05:00Z:2"]
    assert got[0].checkpoint_token == json.dumps({"p.tickets": {"watermark": "2026-04-20T08:00:00Z", "pk": [1]}}, sort_keys=True)
    assert got[2].checkpoint_token == json.dumps({"p.tickets": {"watermark": "2026-04-20T08:05:00Z", "pk": [2]}, "p.payments": {"watermark": "2026-04-20T08:02:00.000250Z", "pk": [9]}}, sort_keys=True)
    assert got == run(5)
    kept = N.snapshot({"p.tickets": a, "p.payments": b}, specs, SourceSpec("x", "sqlite"), {"p.payments": (dt.datetime(2026, 4, 21), 9)}).orderBy("order_time").first()
    assert json.loads(kept.checkpoint_token)["p.payments"] == {"pk": [9], "watermark": "2026-04-21T00:00:00Z"}


def test_chunks_do_not_depend_on_partitions(spark):
    rows = spark.range(230).selectExpr("id", "concat('r', id) as external_ref", "concat('t', id) as checkpoint_token")
    outs = [sorted(batching.batches(batching.chunk(rows.repartition(n), 100, ["id"])).collect()) for n in (1, 6)]
    assert outs[0] == outs[1] and [r.leaf_count for r in outs[0]] == [100, 100, 30]
    assert sorted(r.batch_no for r in batching.chunk(rows.limit(3), 0, ["id"]).collect()) == [0, 1, 2]


def test_tokens(spark):
    df = spark.createDataFrame([("rows.017", 188, 1, "é")], "f string, p long, i int, bad string")
    token = one(df, K.binlog_token(F.col("f"), F.col("p"), F.col("i")))
    assert token == json.dumps({"mode": "binlog", "log_file": "rows.017", "log_pos": 188, "row_index": 1}, sort_keys=True)
    assert one(df, K.decode_token(F.lit(token), "binlog"))["log_pos"] == 188 and one(df, K.decode_token(F.lit(token), "trigger_cdc")) is None and one(df, K.decode_token(F.lit("{bad"), "logical_cdc")) is None
    for bad in (K.text(F.col("bad")), K.decode_token(F.lit("{bad"), "logical_cdc", strict=True), K.decode_watermarks(F.lit('{"a.b": {"pk": [1], "watermark": "x"}}'), {"a.b": 2})):
        with pytest.raises(Exception):  # noqa: B017
            one(df, bad)
    assert one(df, K.lsn_to_long(F.lit("FF/2F00C10"))) == (0xFF << 32) + 0x2F00C10 and one(df, K.long_to_lsn(F.lit((0xFF << 32) + 0x2F00C10))) == "FF/2F00C10"


def test_decoding(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 11, 3, 12, 0, 0, 5), Decimal("1.50"), b"\x01")], "t timestamp, n decimal(5,2), b binary")
    for c, tag in (("t", "datetime"), ("n", "decimal"), ("b", "bytes")):
        assert one(df, D.restore_value(D.tag_value(F.col(c), tag), tag) == F.col(c))
    with pytest.raises(Exception, match="another type"):
        one(df, D.restore_value(D.tag_value(F.col("n"), "decimal"), "date"))
    with pytest.raises(Exception, match="unknown operation"):
        one(df, S.map_operation(F.lit("truncate")))
    assert one(df, S.event_start_pos(F.lit(220), F.lit(32), F.lit(7))) == 188 and one(df, S.event_start_pos(F.lit(10), F.lit(32), F.lit(7))) == 4
    sql = "insert into \"D\".\"I\"(\"ID\",\"A\"\"B\") values ('1',NULL);"
    assert one(df, D.redo_insert_values(F.lit(sql))) == {"ID": "1", 'A"B': None}
    assert KeySpec(0, "orders:*").regex == "(?s)^orders:.*$" and one(df, F.lit("orders:\n1").rlike(KeySpec(0, "orders:*").regex))
