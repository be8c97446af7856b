import struct

import pytest
from pyspark.sql import functions as F

from changeledger.operators import assemble as A
from changeledger.sources import feeds, specs
from changeledger.sources.binary import decode_binary_feed

INSERT = "table public.tickets: INSERT: id[bigint]:{} status[text]:'{}' updated_at[timestamp with time zone]:'2025-11-03 12:00:01+00'"


def test_text_transaction(spark):
    rows = [(1, "0/2F00C10", "905", "BEGIN"), (2, "0/2F00C10", "905", INSERT.format(1, "draft")), (3, "0/2F00C10", "905", INSERT.format(2, "issued")), (4, "0/16B6A40", "905", "COMMIT")]
    feed = feeds.decode_text_feed(spark.createDataFrame(rows, "seq long, lsn string, xid string, data string"))
    got = A.assemble_transactions(feed).orderBy("seq").collect()
    assert [(r.event_index, r.total, r.commit_lsn, r.advance) for r in got] == [(1, 2, "0/16B6A40", False), (2, 2, "0/16B6A40", True)]
    assert got[0].after == {"id": "1", "status": '"draft"', "updated_at": '"2025-11-03 12:00:01+00"'} and (got[0].schema, got[0].table) == ("public", "tickets")
    first = A.limit_events(A.assemble_transactions(feed), 1).collect()
    assert [(r.event_index, r.advance) for r in first] == [(1, False)]
    assert [r.event_index for r in A.limit_events(A.assemble_transactions(feed), 1, ("905", 1)).collect()] == [2]
    carried = A.carry_xid(feed.withColumn("xid", F.when(F.col("kind") != "row", F.col("xid")))).orderBy("seq").collect()
    assert [r.xid for r in carried] == ["905"] * 4


def tuple_(*values):
    out = struct.pack(">h", len(values))
    for kind, v in values:
        out += kind + (struct.pack(">i", len(v)) + v if kind in (b"t", b"b") else b"")
    return out


def relation(relid, columns, table=b"tickets"):
    out = b"R" + struct.pack(">I", relid) + b"public\0" + table + b"\0f" + struct.pack(">h", len(columns))
    return out + b"".join(struct.pack(">b", k) + n + b"\0" + struct.pack(">Ii", oid, -1) for k, n, oid in columns)


def test_binary_feed(spark):
    two, three = [(1, b"id", 20), (0, b"note", 25)], [(1, b"id", 20), (0, b"amount", 1700), (0, b"raw", 17)]
    msgs = [
        b"B" + struct.pack(">qqi", 1, 2, 7), relation(5, two), b"I" + struct.pack(">I", 5) + b"N" + tuple_((b"t", b"42"), (b"t", "é".encode())),
        b"U" + struct.pack(">I", 5) + b"O" + tuple_((b"t", b"42"), (b"n", b"")) + b"N" + tuple_((b"t", b"42"), (b"u", b"")), relation(5, three, b"bills"),
        b"U" + struct.pack(">I", 5) + b"N" + tuple_((b"t", b"43"), (b"t", b"1.50"), (b"b", b"\x0a\xff")), b"D" + struct.pack(">I", 5) + b"K" + tuple_((b"t", b"43"), (b"n", b""), (b"n", b"")), b"C" + struct.pack(">bqqq", 0, 1, 2, 3),
    ]
    rows = [(i, f"0/{i:X}", "7", bytearray(m)) for i, m in enumerate(msgs)]
    got = decode_binary_feed(spark.createDataFrame(rows, "seq long, lsn string, xid string, data binary")).orderBy("seq").collect()
    assert [r.kind for r in got] == ["begin", "row", "row", "row", "row", "commit"]
    assert (got[1].operation, got[1].table, got[1].before, got[1].after) == ("insert", "tickets", None, {"id": "42", "note": '"é"'})
    assert (got[2].before, got[2].after, got[2].unchanged_columns) == ({"id": "42", "note": "null"}, {"id": "42", "note": "null"}, ["note"])
    assert (got[3].table, got[3].after) == ("bills", {"id": "43", "amount": '"1.50"', "raw": '"0aff"'})
    assert (got[4].operation, got[4].before, got[4].after) == ("delete", {"id": "43", "amount": "null", "raw": "null"}, None)


def test_quoted_identifiers(spark):
    line = 'table "My ""S"""."T.x": UPDATE: old-key: "Id No"[numeric(10,2)]:1.50 new-tuple: "Id No"[numeric(10,2)]:1.50 note[character varying(9)]:\'it\'\'s\' tags[text[]]:\'{a}\' "a:b"["My Type"]:\'x: y[z]:1\''
    feed = spark.createDataFrame([("0/1", "7", line)], "lsn string, xid string, data string")
    r = feeds.decode_text_feed(feed).first()
    assert (r.kind, r.schema, r.table, r.operation) == ("row", 'My "S"', "T.x", "update")
    assert set(r.before) == {"Id No"} and r.after["note"] == '"it\'s"' and r.after["a:b"] == '"x: y[z]:1"' and set(r.after) == {"Id No", "note", "tags", "a:b"}


def test_row_events(spark):
    kind = "array<struct<values:map<string,string>,before_values:map<string,string>,after_values:map<string,string>>>"
    row = lambda i, s: {"id": str(i), "status": s}
    rows = [
        ("rows.017", 188, "write", "app", "tickets", [(row(1, "draft"), None, None), (row(2, "issued"), None, None)]),
        ("rows.017", 240, "update", "app", "tickets", [(None, row(2, "issued"), row(2, "archived"))]), ("rows.017", 300, "delete", "app", "other", [(row(9, "x"), None, None)]),
    ]
    feed = spark.createDataFrame(rows, f"log_file string, log_pos long, type string, schema string, table string, rows {kind}")
    got = feeds.row_events(feed, spark.createDataFrame([("app", "tickets")], "schema string, table string"), ("rows.017", 188, 1)).orderBy("log_pos").collect()
    assert [(r.operation, r.after["id"], r.after["status"]) for r in got] == [("insert", "2", "issued"), ("update", "2", "archived")]


def test_tracking_pages_inside_a_version(spark):
    changes = spark.createDataFrame([(101, "I", 1), (101, "U", 2), (102, "D", 3)], "change_version long, operation string, id long")
    table = spark.createDataFrame([(1, "a"), (2, "b")], "id long, status string")
    page = feeds.change_tracking(changes, table, ["id"], "dbo.tickets", 0, row_limit=2).orderBy("change_version", "id").collect()
    assert page[1].checkpoint_token == '{"mode": "change_tracking", "version": 101}' and page[1].current.status == "b"
    first = feeds.change_tracking(changes, table, ["id"], "dbo.tickets", 0, row_limit=1).first()
    assert first.checkpoint_token == '{"mode": "change_tracking", "pk": [1], "table_key": "dbo.tickets", "version": 101}'
    rest = feeds.change_tracking(changes, table, ["id"], "dbo.tickets", 0, state=(101, 1)).orderBy("change_version").collect()
    assert [(r.id, r.operation, r.current is None) for r in rest] == [(2, "update", False), (3, "delete", True)]
    with pytest.raises(ValueError, match="changes since version 5"):
        feeds.change_tracking(changes, table, ["id"], "k", 5, min_valid=9)


def test_redo_members(spark):
    rows = [("a1", 7, 100, 200, "archived"), ("o1", 7, 100, 200, "online"), ("z1", 0, 5, 0, "online"), ("z2", 0, 6, 0, "online"), ("old", 6, 1, 99, "archived"), ("o2", 8, 200, 0, "online")]
    got = feeds.select_redo_members(spark.createDataFrame(rows, "member string, sequence_no long, first_change_scn long, next_change_scn long, kind string"), 150).collect()
    assert [r.member for r in got] == ["z1", "z2", "a1", "o2"]


def test_specs(spark):
    schema = spark.createDataFrame([], "ID long, Updated_At timestamp, status string").schema
    found = specs.resolve_specs({"main": {"tickets": schema}}, {"main": ["tickets"]}, {"primary_key_columns": ["id"]}, "sqlite")
    assert found[0].watermark == "Updated_At" and found[0].pk == ("ID",) and found[0].commit_column == "Updated_At"
    assert specs.resolve_specs({"main": {"tickets": schema}}, {"main": ["tickets"]}, {}, "sqlite", {"main": ["tickets"]}) == []
    for options, kind, said in (({"primary_key_columns": ["id"]}, "postgresql", "no column updated_at"), ({}, "sqlite", "no primary key"), ({"primary_key_columns": ["x"]}, "sqlite", "no column x")):
        with pytest.raises(ValueError, match=said):
            specs.resolve_specs({"main": {"tickets": schema}}, {"main": ["tickets"]}, options, kind)
    with pytest.raises(ValueError, match="does not exist"):
        specs.resolve_specs({"main": {}}, {"main": ["tickets"]})


def test_readers(spark, tmp_path):
    for kind in (*specs.JDBC, *specs.CONNECTORS):
        name, options = specs.reader_options(kind, {"host": "h", "port": 1, "database": "d", "dbtable": "t"})
        assert name == "jdbc" and options["url"].startswith("jdbc:") or kind in specs.CONNECTORS
    with pytest.raises(ValueError):
        specs.reader_options("mysql", {"host": "h", "port": 1, "database": "d", "partitionColumn": "id"})
    with pytest.raises(ValueError):
        specs.reader_options("nope", {})
    spark.range(3).write.parquet(f"{tmp_path}/x")
    assert specs.read_source(spark, "parquet", {"path": f"{tmp_path}/x"}).count() == 3
    specs.register_source("mine", lambda s, o: s.range(o["n"]))
    assert specs.read_source(spark, "mine", {"n": 5}).count() == 5


def test_redo_literals_are_parsed_once(spark):
    """No parse stands inside a lambda, where it would run again for every key of a row."""
    schema = "scn long, rs_id string, ssn long, operation_code int, seg_owner string, table_name string, sql_redo string, sql_undo string"
    sql = """update "S"."T" set "A" = '1' where "ID" = '{}' and "A" = '0';"""
    redo = spark.createDataFrame([(1, "r", 1, 3, "S", "T", sql.format(7), """update "S"."T" set "A" = '0' where "ID" = '7';""")], schema)
    out = feeds.redo_feed(redo, spark.createDataFrame([("S", "T")], "seg_owner string, table_name string"))
    r = out.first()
    assert (r.before, r.after, r.row_index) == ({"ID": "7", "A": "0"}, {"ID": "7", "A": "1"}, 1)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("regexp_extract_all(") <= 10


def test_rows_of_a_hot_table_are_not_sorted_in_one_task(spark):
    feed = spark.range(1000).selectExpr("'bin.1' as log_file", "id as log_pos", "'write' as type", "'app' as schema", "if(id % 2 = 0, 'events', 'other') as table", "array(struct(map('id', string(id)) as values, map('id', 'b') as before_values, map('id', 'a') as after_values)) as rows")
    out = feeds.row_events(feed, spark.createDataFrame([("app", "events")], "schema string, table string"), ("bin.1", 99, 1), 300)
    assert [r.log_pos for r in out.collect()] == list(range(100, 700, 2))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
