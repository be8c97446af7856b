"""Queries over cursors, snapshots, canonical form and batches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from changeledger.functions import canonical as C
from changeledger.functions import tokens as K
from changeledger.model import KeySpec, SourceSpec, TableSpec
from changeledger.operators import batching, keyset
from changeledger.plans.base import identity, micros, query, seconds
from changeledger.sources import snapshot as N

SOURCE = SourceSpec("pg-core", "postgresql")
ORDERS = TableSpec("sales", "orders", "o_orderdate", ("o_orderkey",))
EVENTS = TableSpec("app", "events", "ts", ("event_id",))
LINES = TableSpec("sales", "lineitem", "l_shipdate", ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
SINCE = dt.datetime(1993, 3, 1)
MID = dt.datetime(2024, 1, 1, 3, 0, 0, 500)

ORDER_REFS = f"""
with b as (select *, row_number() over (order by o_orderdate, o_orderkey) n, {seconds('o_orderdate')} ts from orders where o_orderdate is not null and (o_orderdate > timestamp '1993-03-01' or (o_orderdate = timestamp '1993-03-01' and o_orderkey > 50))),
e as (select *, '{{"sales.orders": {{"pk": [' || o_orderkey || '], "watermark": "' || ts || '"}}}}' as token, sha256({identity("'sales.orders:' || ts || ':' || o_orderkey", "'snapshot'", "'{\"o_orderkey\":' || o_orderkey || '}'", 'sales', 'orders')}) as ik from b),
r as (select *, sha256(ik || ':' || token) as ref, (n - 1) // 100 as batch_no from e)
"""


ORDER = ["order_time", "order_table", "order_pk"]


def order_events(t, *columns: str):
    """Envelopes of the orders after a cursor, in chunks of 100: the columns that the reader wants, as chunks are stored."""
    rows = N.snapshot({ORDERS.key: t.orders}, [ORDERS], SOURCE, {ORDERS.key: (SINCE, 50)})
    return batching.chunk(C.envelope(rows).select(*ORDER, *columns), 100, ORDER)


@query("minimum_slice", ORDER_REFS + """select batch_no, count(*) as leaf_count, sha256('{"count":' || count(*) || ',"leaf_external_refs":["' || string_agg(ref, '","' order by ref) || '"]}') as batch_external_ref,
 min_by(token, n) as first_token, max_by(token, n) as last_token from r group by batch_no""")
def minimum_slice(t):
    return batching.batches(order_events(t, "external_ref", "checkpoint_token"))


@query("envelopes", ORDER_REFS + """select n as seq, ik as identity_key, ref as external_ref, batch_no, cast(null as varchar) as before_hash,
 sha256('{"o_custkey":' || o_custkey || ',"o_orderdate":"' || ts || '","o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '","o_orderstatus":"' || o_orderstatus || '","o_totalprice":"' || cast(o_totalprice as decimal(18,2)) || '"}') as after_hash,
 sha256('{"capture_mode":"watermark-poll","commit_timestamp_column":"o_orderdate","primary_key_columns":["o_orderkey"],"watermark_column":"o_orderdate"}') as metadata_hash from r""")
def envelopes(t):
    hashes = ["identity_key", "external_ref", "before_hash", "after_hash", "metadata_hash"]
    return order_events(t, *hashes).select("seq", "batch_no", *hashes)


@query("ref_by_version", ORDER_REFS + "select n as seq, sha256(ik || ':sales.orders:' || ts || ':' || o_orderkey) as external_ref from r")
def ref_by_version(t):
    rows = N.snapshot({ORDERS.key: t.orders}, [ORDERS], SOURCE, {ORDERS.key: (SINCE, 50)})
    return batching.chunk(C.envelope(rows, "version").select(*ORDER, "external_ref"), 100, ORDER).select("seq", "external_ref")


@query("watermark_scan", f"select event_id, user_id, event_type, {micros('ts')} as ts from events where ts > timestamp '2024-01-01 03:00:00.0005' or (ts = timestamp '2024-01-01 03:00:00.0005' and event_id > 7) order by ts, event_id limit 250")
def watermark_scan(t):
    return keyset.watermark_scan(t.events, EVENTS, (MID, 7), 250).select("event_id", "user_id", "event_type", C.iso_micros(F.col("ts")).alias("ts"))


@query("keyset_composite", "select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem where (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) > (timestamp '1996-06-01', 500, 3, 100, 10)")
def keyset_composite(t):
    return keyset.watermark_scan(t.lineitem, LINES, (dt.datetime(1996, 6, 1), 500, 3, 100, 10)).select(*LINES.pk)


@query("gte_scan", "select o_orderkey, o_custkey from orders where o_orderdate > timestamp '1995-05-05' or (o_orderdate = timestamp '1995-05-05' and o_orderkey > 900) order by o_orderdate, o_orderkey limit 300")
def gte_scan(t):
    return keyset.gte_scan_then_filter(t.orders, ORDERS, (dt.datetime(1995, 5, 5), 900), 300).select("o_orderkey", "o_custkey")


@query("late_rows", "select o_orderkey from orders where not (o_orderdate > timestamp '1995-05-05' or (o_orderdate = timestamp '1995-05-05' and o_orderkey > 900)) and o_orderkey % 3 <> 0")
def late_rows(t):
    return keyset.late_rows(t.orders, t.orders.where("o_orderkey % 3 = 0"), ORDERS, (dt.datetime(1995, 5, 5), 900)).select("o_orderkey")


@query("multi_table_snapshot", f"""
with c as (select 'sales.orders' as k, 0 as i, o_orderdate as tm, o_orderkey as a, '{{"pk": [' || o_orderkey || '], "watermark": "' || {micros('o_orderdate')} || '"}}' as st, {seconds('o_orderdate')} as ct from orders
 union all select 'app.events', 1, ts, event_id, '{{"pk": [' || event_id || '], "watermark": "' || {micros('ts')} || '"}}', {seconds('ts')} from events),
w as (select *, last_value(case when k = 'sales.orders' then st end ignore nulls) over o as s0, last_value(case when k = 'app.events' then st end ignore nulls) over o as s1 from c window o as (order by tm, i, a rows between unbounded preceding and current row))
select k || ':' || ct || ':' || a as change_version, ct as commit_timestamp, '{{' || concat_ws(', ', case when s1 is not null then '"app.events": ' || s1 end, case when s0 is not null then '"sales.orders": ' || s0 end) || '}}' as checkpoint_token from w""")
def multi_table_snapshot(t):
    return N.snapshot({ORDERS.key: t.orders, EVENTS.key: t.events}, [ORDERS, EVENTS], SOURCE).select("change_version", "commit_timestamp", "checkpoint_token")


@query("snapshot_batches", f"""
with ev as (select * from events union all select * from events where event_id % 1000 = 0),
c as (select 'sales.orders' as k, 0 as i, o_orderdate as tm, o_orderkey as a, '{{"pk": [' || o_orderkey || '], "watermark": "' || {micros('o_orderdate')} || '"}}' as st,
  sha256({identity("'sales.orders:' || " + seconds('o_orderdate') + " || ':' || o_orderkey", "'snapshot'", "'{\"o_orderkey\":' || o_orderkey || '}'", 'sales', 'orders')}) as ik from orders
 union all select 'app.events', 1, ts, event_id, '{{"pk": [' || event_id || '], "watermark": "' || {micros('ts')} || '"}}',
  sha256({identity("'app.events:' || " + seconds('ts') + " || ':' || event_id", "'snapshot'", "'{\"event_id\":' || event_id || '}'", 'app', 'events')}) from ev),
w as (select *, row_number() over o as n, last_value(case when i = 0 then st end ignore nulls) over o as s0, last_value(case when i = 1 then st end ignore nulls) over o as s1
 from c window o as (order by tm, i, a rows between unbounded preceding and current row)),
t as (select n, ik, '{{' || concat_ws(', ', case when s1 is not null then '"app.events": ' || s1 end, case when s0 is not null then '"sales.orders": ' || s0 end) || '}}' as token from w),
r as (select n, token, sha256(ik || ':' || token) as ref, (n - 1) // 100 as batch_no from t)
select batch_no, count(*) as leaf_count, sha256('{{"count":' || count(*) || ',"leaf_external_refs":["' || string_agg(ref, '","' order by ref) || '"]}}') as batch_external_ref,
 min_by(token, n) as first_token, max_by(token, n) as last_token from r group by batch_no""")
def snapshot_batches(t):
    """Two tables, one with repeated rows, as one snapshot, through envelopes into batches: the engine's main chain."""
    events = t.events.unionByName(t.events.where("event_id % 1000 = 0"))
    rows = N.snapshot({ORDERS.key: t.orders, EVENTS.key: events}, [ORDERS, EVENTS], SOURCE)
    return batching.batches(batching.chunk(C.envelope(rows).select(*ORDER, "external_ref", "checkpoint_token"), 100, ORDER))


@query("snapshot_images", f"""select '{{"event_id":' || event_id || '}}' as primary_key, '{{"event_id":' || event_id || ',"event_type":"' || event_type || '","props":' || to_json(props) || ',"ts":"' || {seconds('ts')} || '","user_id":' || user_id || ',"value":"' || cast(value as decimal(18,2)) || '"}}' as after from events""")
def snapshot_images(t):
    return N.snapshot({EVENTS.key: t.events}, [EVENTS], SOURCE).select("primary_key", "after")


@query("final_checkpoint", f"select l_linestatus, {micros('max(l_shipdate)')} as watermark, max_by(l_orderkey, (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey)) as l_orderkey from lineitem group by l_linestatus")
def final_checkpoint(t):
    out = N.final_checkpoint(t.lineitem, LINES, ["l_linestatus"])
    return out.select("l_linestatus", C.iso_micros(F.col("l_shipdate")).alias("watermark"), "l_orderkey")


@query("order_events", "select row_number() over (order by o_orderdate, o_orderkey) as seq, o_orderkey from orders")
def ordered(t):
    rows = N.candidates(t.orders, ORDERS, SOURCE, 0).withColumn("o_orderkey", F.get_json_object("primary_key", "$.o_orderkey").cast("long"))
    return N.order_events(rows, "watermark").select("seq", "o_orderkey")


@query("order_events_text", "select row_number() over (order by \"ts\", 's' || (user_id % 3), event_type, '{\"id\":' || event_id || '}') as seq, event_id from events")
def ordered_text(t):
    rows = t.events.select("event_id", F.col("ts").alias("commit_timestamp"), F.concat(F.lit("s"), F.col("user_id") % 3).alias("schema_or_namespace"), F.col("event_type").alias("table_or_collection"),
                           F.concat(F.lit('{"id":'), "event_id", F.lit("}")).alias("primary_key"))
    return N.order_events(rows, "text").select("seq", "event_id")


@query("order_events_tracking", "select row_number() over (order by user_id, event_type, event_id) as seq, event_id from events")
def ordered_tracking(t):
    rows = t.events.select("event_id", F.col("user_id").alias("change_version"), F.col("event_type").alias("table_key"), F.col("event_id").alias("order_pk"))
    return N.order_events(rows, "tracking").select("seq", "event_id")


@query("order_events_redo", "select row_number() over (order by user_id, event_type, event_id % 7, event_id) as seq, event_id from events")
def ordered_redo(t):
    rows = t.events.select("event_id", F.col("user_id").alias("scn"), F.col("event_type").alias("rs_id"), (F.col("event_id") % 7).alias("ssn"), F.col("event_id").alias("row_index"))
    return N.order_events(rows, "redo").select("seq", "event_id")


@query("order_events_kv", "select row_number() over (order by doc_id % 3, lang, cast(doc_id as varchar)) as seq, doc_id from documents")
def ordered_kv(t):
    rows = t.documents.select("doc_id", (F.col("doc_id") % 3).alias("db"), F.col("lang").alias("pattern"), F.col("doc_id").cast("string").alias("key"))
    return N.order_events(rows, "kv").select("seq", "doc_id")


@query("pk_as_text", "select l_orderkey, l_linenumber from lineitem where l_shipdate > timestamp '1997-01-01' or (l_shipdate = timestamp '1997-01-01' and cast(l_orderkey as varchar) > '9')")
def pk_as_text(t):
    spec = TableSpec("sales", "lineitem", "l_shipdate", ("l_orderkey",))
    return keyset.watermark_scan(t.lineitem, spec, (dt.datetime(1997, 1, 1), "9"), pk_as_text=True).select("l_orderkey", "l_linenumber")


KV = "select 0 as db, concat(lang, ':', doc_id) as key, source as ns, text as value, doc_id from {documents}"
KV_DUCK = "(select 0 as db, concat(lang, ':', doc_id) as key, source as ns, text as value, doc_id from documents)"


@query("kv_scan", f"select key, pattern from (select key, 'en:*' as pattern, row_number() over (order by key) n from {KV_DUCK} where key like 'en:%' and key > 'en:3') where n <= 200 union all select key, 'f?:1*' from {KV_DUCK} where regexp_matches(key, '^f.:1')  and 1 = 1 qualify row_number() over (order by key) <= 200")
def kv_scan(t):
    en, fr = KeySpec(0, "en:*"), KeySpec(0, "f?:1*")
    return N.kv_scan(t.sql(KV), [en, fr], {en: "en:3"}, 200).select("key", "pattern")


@query("kv_value_image", """
with l as (select doc_id % 50 as k, doc_id, n_chars, lang from documents)
select cast(k as varchar) as key, case k % 5 when 0 then 'hash' when 1 then 'list' when 2 then 'set' when 3 then 'zset' else 'string' end as type,
 case k % 5 when 0 then '{' || string_agg('"f' || lpad(cast(doc_id as varchar), 9, '0') || '":"' || lang || '"', ',' order by doc_id) || '}' when 1 then '[' || string_agg('"' || lang || '"', ',' order by doc_id) || ']'
 when 2 then '[' || string_agg('"m' || doc_id || '"', ',' order by 'm' || doc_id) || ']' when 3 then '[' || string_agg('{"member":"m' || doc_id || '","score":' || n_chars || '}', ',' order by n_chars, 'm' || doc_id) || ']' else '"v' || min(k) || '"' end as value
from l group by k""")
def kv_value_image(t):
    rows = t.sql("""select 0 as db, cast(doc_id % 50 as string) as key, case doc_id % 5 when 0 then 'hash' when 1 then 'list' when 2 then 'set' when 3 then 'zset' else 'string' end as type,
        concat('f', lpad(cast(doc_id as string), 9, '0')) as field, doc_id as idx, n_chars as score,
        case doc_id % 5 when 0 then lang when 1 then lang when 4 then concat('v', doc_id % 50) else concat('m', doc_id) end as value from {documents}""")
    return N.kv_value_image(rows).select("key", "type", "value")


@query("kv_events", f"""with k as (select key, 'en:*' as pattern, 0 as i from {KV_DUCK} where key like 'en:%' union all select key, 'es:*', 1 from {KV_DUCK} where key like 'es:%'),
w as (select *, last_value(case when i = 0 then key end ignore nulls) over o as a, last_value(case when i = 1 then key end ignore nulls) over o as b from k window o as (order by pattern, key rows between unbounded preceding and current row))
select 'db0:' || key as change_version, '{{"key":"' || key || '"}}' as primary_key, '{{"key":"' || key || '","type":"string","value":"x"}}' as after, '{{' || concat_ws(', ', '"db0:en:*": {{"last_key": "' || a || '"}}', '"db0:es:*": {{"last_key": "' || b || '"}}') || '}}' as checkpoint_token from w""")
def kv_events(t):
    specs = [KeySpec(0, "en:*"), KeySpec(0, "es:*")]
    rows = N.kv_scan(t.sql(KV), specs).select("db", "key", "pattern", F.lit("string").alias("type"), F.lit('"x"').alias("value"))
    return N.kv_events(rows, specs, SourceSpec("kv", "redis"), F.lit("1970-01-01T00:00:00Z")).select("change_version", "primary_key", "after", "checkpoint_token")


@query("inline_events", """with e as (select event_id, user_id, coalesce(cast(case when event_id % 3 = 0 then null else user_id end as varchar), '0') as v from events)
select 'public' as schema_or_namespace, case when event_id % 2 = 0 then 'update' else 'snapshot' end as operation, v as change_version, v as checkpoint_token, '1970-01-01T00:00:00Z' as commit_timestamp, '{}' as after, '{"id":' || event_id || '}' as primary_key from e""")
def inline_events(t):
    items = t.sql("""select case when event_id % 2 = 0 then 'update' end as operation, case when event_id % 3 = 0 then null else user_id end as checkpoint_token, concat('{"id":', event_id, '}') as primary_key from {events}""")
    return N.inline_events(items, SOURCE).select("schema_or_namespace", "operation", "change_version", "checkpoint_token", "commit_timestamp", "after", "primary_key")


@query("canonical_values", f"""select event_id, sha256('{{"a":"' || {seconds('ts')} || '","b":"' || cast(ts as date) || '","c":"' || cast(value as decimal(18,2)) || '","d":"' || lower(hex(cast(event_type as blob))) || '","e":[' || user_id || ',null],"f":{{"x":null,"y":' || to_json(event_type) || '}},"g":true}}') as hash from events""")
def canonical_values(t):
    kinds = F.struct(
        F.lit(True).alias("g"), F.struct(F.col("event_type").alias("y"), F.lit(None).cast("string").alias("x")).alias("f"), F.array(F.col("user_id"), F.lit(None).cast("long")).alias("e"), F.col("event_type").cast("binary").alias("d"),
        F.col("value").alias("c"), F.to_date("ts").alias("b"), F.col("ts").alias("a"),
    )
    rows = t.events.select("event_id", kinds.alias("v"))
    return rows.select("event_id", C.sha256_hex(C.canonical_json(F.col("v"), rows.schema["v"].dataType)).alias("hash"))


@query("canonical_map", "select user_id, '{' || string_agg('\"k' || event_id || '\":\"' || event_type || '\"', ',' order by 'k' || event_id) || '}' as json from events group by user_id")
def canonical_map(t):
    rows = t.events.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("k"), F.col("event_id")), F.col("event_type")))).alias("m"))
    return rows.select("user_id", C.canonical_json(F.col("m"), rows.schema["m"].dataType).alias("json"))


@query("canonical_nested_map", """select event_id, '{"id":' || event_id || ',"list":[{"k10":null,"k9":' || user_id || '}],"tags":{"a":"' || event_type || '","b":{"x":1,"y":' || user_id || '}}}' as after from events""")
def canonical_nested_map(t):
    """Maps in a row image, in an array and in a map: equal values give equal text, whatever the order of their keys."""
    inner = "if(event_id % 2 = 0, map('y', user_id, 'x', 1L), map('x', 1L, 'y', user_id))"
    rows = t.sql(f"""select event_id as id, event_id % 2 = 0 as even, array(if(event_id % 2 = 0, map('k9', user_id, 'k10', null), map('k10', null, 'k9', user_id))) as list,
 if(event_id % 3 = 0, struct({inner} as b, event_type as a), struct({inner} as b, event_type as a)) as tags from {{events}}""")
    return rows.select(F.col("id").alias("event_id"), C.image(rows, ["id", "list", "tags"]).alias("after"))


@query("variant_json", "select event_id, '{\"a\":{\"y\":null,\"z\":' || user_id || '},\"b\":[' || event_id || ',\"q\"]}' as json from events")
def variant_json(t):
    return t.sql("""select event_id, concat('{ "b" : [', event_id, ', "q"], "a": {"z": ', user_id, ', "y": null} }') as j from {events}""").select("event_id", C.variant_json(F.col("j")).alias("json"))


@query("row_hashes", "select event_id, case when user_id % 3 <> 0 then sha256('{\"id\":' || event_id || '}') end as before_hash, case when user_id % 2 = 0 then '44136fa355b3678a1146ad16f7e8649e94fb4fc21fe77e8310c060f61caaff8a' else sha256('{\"id\":' || event_id || '}') end as after_hash from events")
def row_hashes(t):
    rows = t.sql("""select event_id, case when user_id % 3 <> 0 then concat('{"id":', event_id, '}') end as b, case when user_id % 2 <> 0 then concat('{"id":', event_id, '}') end as a from {events}""")
    return rows.select("event_id", C.row_hash(F.col("b")).alias("before_hash"), C.after_hash(F.col("a")).alias("after_hash"))


@query("prepare_payload", """select o_orderkey, '{"submitter":"me","external_ref":"r' || o_orderkey || '","schema":{"id":3,"version":"1.0.0","active":true,"canonicalization_profile":"json-sorted-v1"},"policy":{"id":4,"active":true,"allow_single":true,"allow_batch":false},"payload":{"id":' || o_orderkey || '}}' as payload from orders""")
def prepare_payload(t):
    body = F.struct(F.col("o_orderkey").alias("id"))
    return t.orders.withColumn("external_ref", F.concat(F.lit("r"), F.col("o_orderkey"))).select("o_orderkey", F.to_json(C.prepare_payload("me", 3, 4, payload=body)).alias("payload"))


@query("batch_payload", """select batch_no, leaf_count, items from (select batch_no, count(*) as leaf_count, '[' || string_agg('{"external_leaf_ref":"' || ref || '","payload":{"key":' || o_orderkey || '}}', ',' order by n) || ']' as items from (""" + ORDER_REFS + """select * from r) group by batch_no)""")
def batch_payload(t):
    rows = order_events(t, "primary_key", "external_ref").withColumn("key", F.get_json_object("primary_key", "$.o_orderkey").cast("long"))
    items = F.transform(F.array_sort(F.collect_list(F.struct("seq", C.batch_item(F.struct("key")).alias("item")))), lambda x: x["item"])
    return rows.groupBy("batch_no").agg(F.count("*").alias("leaf_count"), F.to_json(items).alias("items"))


@query("change_versions", f"select event_id, 'event:' || event_id as trigger, 'lsn:0/1A:' || user_id as logical, 'bin.1:' || event_id || ':' || user_id as binlog, 'app.events:' || event_id || ':' || user_id as tracking, event_id || ':0x01:5:' || user_id as redo, 'db2:' || event_type as kv, 'app.events:' || {seconds('ts')} || ':' || event_id as watermark from events")
def change_versions(t):
    e, u = F.col("event_id"), F.col("user_id")
    return t.events.select(
        "event_id", K.change_version("trigger", e).alias("trigger"), K.change_version("logical", F.lit("0/1A"), u).alias("logical"), K.change_version("binlog", F.lit("bin.1"), e, u).alias("binlog"),
        K.change_version("tracking", F.lit("app.events"), e, u).alias("tracking"), K.change_version("redo", e, F.lit("0x01"), F.lit(5), u).alias("redo"), K.change_version("kv", F.lit(2), F.col("event_type")).alias("kv"),
        K.change_version("watermark", F.lit("app.events"), C.iso_seconds(F.col("ts")), e).alias("watermark"),
    )


@query("encode_tokens", """select event_id, '{"event_id": ' || event_id || ', "mode": "trigger_cdc"}' as trigger, '{"advance_lsn": ' || (event_id % 2 = 0) || ', "commit_lsn": "", "event_index": ' || user_id || ', "lsn": "0/A", "mode": "logical_cdc", "xid": "' || event_id || '"}' as logical,
 '{"log_file": "bin.1", "log_pos": ' || event_id || ', "mode": "binlog", "row_index": 1}' as binlog, case when event_id % 2 = 0 then '{"mode": "change_tracking", "pk": [' || user_id || '], "table_key": "a.b", "version": ' || event_id || '}' else '{"mode": "change_tracking", "version": ' || event_id || '}' end as tracking,
 '{"mode": "logminer", "rs_id": "x", "scn": ' || event_id || ', "ssn": 2}' as redo from events""")
def encode_tokens(t):
    e, u, even = F.col("event_id"), F.col("user_id"), F.col("event_id") % 2 == 0
    return t.events.select(
        "event_id", K.trigger_token(e).alias("trigger"), K.logical_token(e.cast("string"), F.lit("0/A"), F.lit(""), u, even).alias("logical"), K.binlog_token(F.lit("bin.1"), e, F.lit(1)).alias("binlog"),
        K.tracking_token(e, even, F.lit("a.b"), K.values([u.cast("string")])).alias("tracking"), K.redo_token(e, F.lit("x"), F.lit(2)).alias("redo"),
    )


@query("decode_tokens", "select event_id, case when event_id % 3 = 0 then event_id end as resumed, case when event_id % 3 = 1 then 'bin.' || event_id end as log_file from events")
def decode_tokens(t):
    rows = t.sql("""select event_id, case event_id % 3 when 0 then concat('{"event_id": ', event_id, ', "mode": "trigger_cdc"}') when 1 then concat('{"log_file": "bin.', event_id, '", "log_pos": 4, "mode": "binlog", "row_index": 0}') else 'not json' end as token from {events}""")
    return rows.select("event_id", K.decode_token(F.col("token"), "trigger_cdc")["event_id"].alias("resumed"), K.decode_token(F.col("token"), "binlog")["log_file"].alias("log_file"))


@query("join_checkpoints", """with cp as (select 'sales.' || case k when 0 then 'a' when 1 then 'b' else 'c' end as key, 100 * (k + 1) as last from (select unnest([0, 1]) as k)),
o as (select o_orderkey, 'sales.' || case o_orderkey % 3 when 0 then 'a' when 1 then 'b' else 'c' end as key from orders) select o_orderkey, o.key, cast(last as varchar) as last from o left join cp using (key) where last is null or o_orderkey > last""")
def join_checkpoints(t):
    """Fleet-wide resume: rows of many tables against one exploded token."""
    rows = t.sql("select o_orderkey, concat('sales.', case o_orderkey % 3 when 0 then 'a' when 1 then 'b' else 'c' end) as key from {orders}")
    token = '{"sales.a": {"pk": [100], "watermark": "2020-01-01T00:00:00Z"}, "sales.b": {"pk": [200], "watermark": "2020-01-01T00:00:00Z"}}'
    return N.join_checkpoints(rows, "key", F.lit(token), ["o_orderkey"]).select("o_orderkey", "key", F.col("cursor.pk")[0].alias("last"))


@query("join_checkpoints_composite", """with l as (select *, 'sales.' || case l_suppkey % 3 when 0 then 'a' when 1 then 'b' else 'c' end as key, 'k' || l_linenumber as part from lineitem)
select l_orderkey, part, key, l_shipdate from l where key = 'sales.c' or (key = 'sales.a' and (l_shipdate, l_orderkey, part) > (timestamp '1995-06-17 00:00:00', 1000, 'k3'))
 or (key = 'sales.b' and (l_shipdate, l_orderkey, part) > (timestamp '1996-01-02 00:00:00', 9, 'k10'))""")
def join_checkpoints_composite(t):
    """Watermark, number and text, part by part: 9 is before 1000 and k10 before k9; one table's cursor is tagged."""
    rows = t.lineitem.withColumns({"key": F.expr("concat('sales.', case l_suppkey % 3 when 0 then 'a' when 1 then 'b' else 'c' end)"), "part": F.concat(F.lit("k"), "l_linenumber")})
    tagged = '{"pk": [{"type": "int", "value": "9"}, {"type": "str", "value": "k10"}], "watermark": {"type": "datetime", "value": "1996-01-02T00:00:00.000000"}}'
    token = '{"sales.a": {"pk": [1000, "k3"], "watermark": "1995-06-17T00:00:00Z"}, "sales.b": ' + tagged + "}"
    return N.join_checkpoints(rows, "key", F.lit(token), ["l_orderkey", "part"], "l_shipdate").select("l_orderkey", "part", "key", "l_shipdate")


@query("lsn_math", """with v as (select event_id, event_id * 7919 // 4096 as hi, case when event_id % 5 = 0 then 0 else (event_id * 104729) % 4294967296 end as lo from events)
select event_id, upper(printf('%x', hi)) || '/' || upper(printf('%x', lo)) as lsn, hi * 4294967296 + lo as value, cast(sign(hi * 4294967296 + lo - 5 * 4294967296) as bigint) as cmp from v""")
def lsn_math(t):
    low = F.when(F.col("event_id") % 5 == 0, 0).otherwise((F.col("event_id") * 104729) % (1 << 32))
    value = F.floor(F.col("event_id") * 7919 / 4096).cast("long") * (1 << 32) + low
    rows = t.events.select("event_id", K.long_to_lsn(value).alias("lsn"))
    return rows.select("event_id", "lsn", K.lsn_to_long(F.col("lsn")).alias("value"), K.lsn_compare(F.col("lsn"), F.lit("5/0")).cast("long").alias("cmp"))


@query("batch_budget", """with s as (select avg(strlen('{"event_id":' || event_id || '}')) as m, count(*) as n from events), k as (select n, greatest(1, cast(ceil(m * 100 / 1024) as bigint)) as kib from s)
select n as events, kib as kib_per_batch, cast(ceil(25 / kib) as bigint) as cycles, cast(ceil(25 / kib) as bigint) as expected_exports from k""")
def batch_budget(t):
    return batching.batch_budget(t.events, F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit("}")), 25, 100)


@query("chunk_by_source", "select user_id, seq, (seq - 1) // 7 as batch_no, event_id from (select user_id, event_id, row_number() over (partition by user_id order by ts, event_id) as seq from events)")
def chunk_by_source(t):
    return batching.chunk(t.events, 7, ["ts", "event_id"], ["user_id"]).select("user_id", "seq", "batch_no", "event_id")
