"""Queries over landed change feeds and transactions."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeledger.functions import decode as D
from changeledger.functions import status as S
from changeledger.operators import assemble as A
from changeledger.plans.base import query, seconds
from changeledger.sources import feeds, specs

TRIGGER = """select event_id + 1 as event_id, 'app' as source_schema, case user_id % 3 when 0 then 'clicks' when 1 then 'signups' else 'untracked' end as source_table,
 case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' else 'UPDATE' end as operation, user_id as pk from {events}"""
TRACKED = [("app", "clicks"), ("app", "signups")]


def values(t, rows, schema):
    return t.spark.createDataFrame(rows, schema)


@query("trigger_log", f"""with p as (select * from ({TRIGGER.format(events='events')}) where event_id > 500 order by event_id limit 4000)
select event_id, source_table, lower(operation) as operation, 'event:' || event_id as change_version, '{{"event_id": ' || event_id || ', "mode": "trigger_cdc"}}' as checkpoint_token from p where source_table <> 'untracked'""")
def trigger_log(t):
    out = feeds.trigger_log(t.sql(TRIGGER), values(t, TRACKED, "source_schema string, source_table string"), 500, 4000)
    return out.select("event_id", "source_table", "operation", "change_version", "checkpoint_token")


@query("purge_processed", f"select event_id, source_table from ({TRIGGER.format(events='events')}) where event_id > 4321")
def purge_processed(t):
    return feeds.purge_processed(t.sql(TRIGGER), '{"event_id": 4321, "mode": "trigger_cdc"}').select("event_id", "source_table")


@query("match_specs", "select event_id, event_type from events where event_type in ('click', 'view')")
def match_specs(t):
    return feeds.match_specs(t.events.select("event_id", "event_type"), values(t, [("click",), ("view",)], "event_type string"), ["event_type"])


TXN_ROWS = "select cast(floor(event_id / 7) as bigint) as x, event_id, 2 * event_id as seq from {events}"
TXN = f"""with r as ({TXN_ROWS}) select cast(x as string) as xid, 'row' as kind, event_id, seq, concat('0/', hex(seq)) as lsn from r
 union all select cast(x as string), 'commit', null, 2 * max(event_id) + 1, concat('0/', hex(2 * max(event_id) + 1)) from r where x % 11 <> 0 group by x"""
TXN_DUCK = """with r as (select event_id // 7 as x, event_id, 2 * event_id as seq from events), w as (select r.*, row_number() over (partition by x order by seq) as i, count(*) over (partition by x) as total, max(event_id) over (partition by x) as last from r),
a as (select *, case when x % 11 <> 0 then '0/' || upper(printf('%x', 2 * last + 1)) else '' end as commit_lsn from w)"""


@query("assemble_transactions", TXN_DUCK + " select cast(x as varchar) as xid, event_id, i as event_index, total, commit_lsn, (commit_lsn <> '' and i = total) as advance from a")
def assemble_transactions(t):
    return A.assemble_transactions(t.sql(TXN)).select("xid", "event_id", "event_index", "total", "commit_lsn", "advance")


@query("limit_events", TXN_DUCK + " select cast(x as varchar) as xid, event_id, i as event_index from a where not (x = 3 and i <= 4) and seq >= 2 * 25 order by seq limit 1000")
def limit_events(t):
    assembled = A.assemble_transactions(t.sql(TXN)).where("seq >= 2 * 25")
    return A.limit_events(assembled, 1000, ("3", 4)).select("xid", "event_id", "event_index")


@query("carry_xid", "select event_id, case when (event_id // 7) % 5 = 0 then null else cast(event_id // 7 as varchar) end as xid from events")
def carry_xid(t):
    """Begin and commit rows around groups of seven; every fifth group has no begin, so its rows have no transaction."""
    feed = t.sql("""with r as (select cast(floor(event_id / 7) as bigint) as x, event_id from {events}) select cast(null as string) as xid, 'row' as kind, event_id, 3 * event_id as seq from r
        union all select cast(x as string), 'begin', null, 3 * min(event_id) - 1 from r where x % 5 <> 0 group by x union all select cast(x as string), 'commit', null, 3 * max(event_id) + 1 from r group by x""")
    return A.carry_xid(feed).where("kind = 'row'").select("event_id", "xid")


TEXT = r"""select concat('0/', hex(o_orderkey)) as lsn, cast(o_orderkey as string) as xid, case o_orderkey % 4
 when 0 then concat('table sales.orders: INSERT: o_orderkey[bigint]:', o_orderkey, ' o_orderstatus[character varying]:''', o_orderstatus, ''' tags[text[]]:''{a,b}'' note[text]:''it''''s old-key: x''')
 when 1 then concat('table sales.orders: UPDATE: old-key: o_orderkey[bigint]:', o_orderkey, ' o_orderstatus[text]:''new-tuple: '' new-tuple: o_orderkey[bigint]:', o_orderkey, ' o_orderstatus[text]:''', o_orderstatus, ''' ok[boolean]:true')
 when 2 then concat('table sales.orders: DELETE: o_orderkey[bigint]:', o_orderkey, ' note[text]:NULL') else concat('BEGIN ', o_orderkey) end as data, o_orderkey from {orders}"""


@query("text_feed", """select o_orderkey, case o_orderkey % 4 when 3 then 'begin' else 'row' end as kind, case o_orderkey % 4 when 0 then 'insert' when 1 then 'update' when 2 then 'delete' end as operation,
 case o_orderkey % 4 when 1 then '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"new-tuple: "}' when 2 then '{"note":null,"o_orderkey":' || o_orderkey || '}' end as before,
 case o_orderkey % 4 when 0 then '{"note":"it''s old-key: x","o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","tags":"{a,b}"}' when 1 then '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","ok":true}' end as after from orders""")
def text_feed(t):
    out = feeds.decode_text_feed(t.sql(TEXT))
    return out.select("o_orderkey", "kind", "operation", raw_json("before"), raw_json("after"))


@query("text_feed_unchanged", """select o_orderkey, '{"bits":"0110","id":' || o_orderkey || ',"note":' || case when o_custkey % 3 = 0 then 'null' when o_custkey % 3 = 1 then '"unchanged-toast-datum"' else 'null' end
 || ',"odd name":' || case when o_custkey % 2 = 0 then 'null' else '"x"' end || '}' as after,
 concat_ws(',', case when o_custkey % 3 = 0 then 'note' end, case when o_custkey % 2 = 0 then 'odd name' end) as unchanged from orders""")
def text_feed_unchanged(t):
    """Values that an update left as they were, beside nulls and texts that only look like them, and bit strings."""
    rows = t.sql("""select o_orderkey, '0/1' as lsn, '7' as xid, concat('table app.notes: UPDATE: id[bigint]:', o_orderkey, ' note[text]:',
        case o_custkey % 3 when 0 then 'unchanged-toast-datum' when 1 then "'unchanged-toast-datum'" else 'null' end, ' "odd name"[text]:', if(o_custkey % 2 = 0, 'unchanged-toast-datum', "'x'"), " bits[bit(4)]:B'0110'") as data from {orders}""")
    out = feeds.decode_text_feed(rows)
    return out.select("o_orderkey", raw_json("after"), F.array_join("unchanged_columns", ",").alias("unchanged"))


def raw_json(column: str):
    """A map of JSON values as one canonical object."""
    pairs = F.transform(F.array_sort(F.map_entries(column)), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"]))
    return F.when(F.col(column).isNotNull(), F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))).alias(column)


ROWS = """with g as (select cast(floor(event_id / 5) as bigint) as g, collect_list(struct(event_id, event_type)) as r from {events} group by 1)
select 'bin.000001' as log_file, 4 + 100 * g as log_pos, case g % 4 when 0 then 'write' when 1 then 'update' when 2 then 'delete' else 'rotate' end as type, 'app' as schema, case when g % 3 = 0 then 'other' else 'events' end as table,
 transform(array_sort(r), x -> struct(if(g % 4 in (0, 2), map('id', cast(x.event_id as string), 'kind', x.event_type), null) as values, if(g % 4 = 1, map('id', cast(x.event_id as string), 'kind', 'old'), null) as before_values,
  if(g % 4 = 1, map('id', cast(x.event_id as string), 'kind', x.event_type), null) as after_values)) as rows from g"""


@query("row_events", """with e as (select event_id, event_type, event_id // 5 as g, event_id % 5 + 1 as i from events), f as (select *, 4 + 100 * g as pos from e where g % 4 <> 3 and g % 3 <> 0 and (4 + 100 * g > 504 or (4 + 100 * g = 504 and i > 2)) order by g, i limit 3000)
select pos as log_pos, i as row_index, case g % 4 when 0 then 'insert' when 1 then 'update' else 'delete' end as operation, case when g % 4 = 1 then 'old' when g % 4 = 2 then event_type end as before_kind, case when g % 4 <> 2 then event_type end as after_kind,
 'bin.000001:' || pos || ':' || i as change_version, '{"log_file": "bin.000001", "log_pos": ' || pos || ', "mode": "binlog", "row_index": ' || i || '}' as checkpoint_token from f""")
def row_events(t):
    out = feeds.row_events(t.sql(ROWS), values(t, [("app", "events")], "schema string, table string"), ("bin.000001", 504, 2), 3000)
    return out.select("log_pos", F.col("row_index").cast("long").alias("row_index"), "operation", F.col("before")["kind"].alias("before_kind"), F.col("after")["kind"].alias("after_kind"), "change_version", "checkpoint_token")


CHANGES = "select l_orderkey as o_orderkey, cast(max(l_partkey % 1000) as bigint) as change_version, case max(l_returnflag) when 'A' then 'I' when 'N' then 'U' else 'D' end as operation from {lineitem} group by l_orderkey"


@query("change_tracking", f"""with c as ({CHANGES.format(lineitem='lineitem')}), m as (select *, max(o_orderkey) over (partition by change_version) as last from c where change_version > 300), p as (select * from m order by change_version, o_orderkey limit 5000)
select p.o_orderkey, change_version, case operation when 'I' then 'insert' when 'U' then 'update' else 'delete' end as operation, case when operation <> 'D' then o_orderstatus end as status,
 case when p.o_orderkey < last then '{{"mode": "change_tracking", "pk": [' || p.o_orderkey || '], "table_key": "sales.orders", "version": ' || change_version || '}}' else '{{"mode": "change_tracking", "version": ' || change_version || '}}' end as checkpoint_token
 from p left join orders using (o_orderkey)""")
def change_tracking(t):
    out = feeds.change_tracking(t.sql(CHANGES), t.orders, ["o_orderkey"], "sales.orders", 300, row_limit=5000)
    return out.select("o_orderkey", "change_version", "operation", F.col("current.o_orderstatus").alias("status"), "checkpoint_token")


@query("change_tracking_resume", f"""with c as ({CHANGES.format(lineitem='lineitem')}) select o_orderkey, change_version from c where (change_version, o_orderkey) > (700, 4000)""")
def change_tracking_resume(t):
    return feeds.change_tracking(t.sql(CHANGES), t.orders, ["o_orderkey"], "sales.orders", 0, state=(700, 4000)).select("o_orderkey", "change_version")


REDO = """select o_custkey as scn, 'rs' as rs_id, o_orderkey as ssn, case o_orderkey % 4 when 0 then 1 when 1 then 3 when 2 then 2 else 5 end as operation_code, 'SALES' as seg_owner, case when o_custkey % 5 = 0 then 'X' else 'ORDERS' end as table_name, o_orderkey,
 case o_orderkey % 4 when 0 then concat('insert into "SALES"."ORDERS"("ID","N,B","AT") values (''', o_orderkey, ''',''it''''s, (ok)'',TO_TIMESTAMP(''17-APR-26 10.11.12.000000 AM''));')
  when 1 then concat('update "SALES"."ORDERS" set "ST" = ''a and b where c'', "Q" = NULL where "ID" = ''', o_orderkey, ''' and "ST" = ''old'' and ROWID = ''AAA'';')
  when 2 then concat('delete from "SALES"."ORDERS" where "ID" = ''', o_orderkey, ''' and "ST" = ''', o_orderstatus, ''' and ROWID = ''AAA'';') else 'commit' end as sql_redo,
 case o_orderkey % 4 when 1 then concat('update "SALES"."ORDERS" set "ST" = ''old'', "Q" = ''7'' where "ID" = ''', o_orderkey, ''' and ROWID = ''AAA'';') end as sql_undo from {orders}"""


@query("redo_sql", """select o_orderkey, case o_orderkey % 4 when 0 then 'insert' when 1 then 'update' else 'delete' end as operation,
 case o_orderkey % 4 when 1 then 'ID=' || o_orderkey || ',Q=7,ST=old' when 2 then 'ID=' || o_orderkey || ',ST=' || o_orderstatus end as before,
 case o_orderkey % 4 when 0 then 'AT=2026-04-17T10:11:12Z,ID=' || o_orderkey || ',N,B=it''s, (ok)' when 1 then 'ID=' || o_orderkey || ',Q=~,ST=a and b where c' end as after,
 o_custkey || ':rs:' || o_orderkey || ':1' as change_version, '{"mode": "logminer", "rs_id": "rs", "scn": ' || o_custkey || ', "ssn": ' || o_orderkey || '}' as checkpoint_token
 from orders where o_orderkey % 4 <> 3 and o_custkey % 5 <> 0 and (o_custkey > 400 or (o_custkey = 400 and o_orderkey >= 10))""")
def redo_sql(t):
    out = feeds.redo_feed(t.sql(REDO), values(t, [("SALES", "ORDERS")], "seg_owner string, table_name string"), (400, "rs", 10))
    flat = lambda c: F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("~")))), ",").alias(c)
    return out.select("o_orderkey", "operation", flat("before"), flat("after"), "change_version", "checkpoint_token")


LOGS = "select concat('m', o_orderkey) as member, o_custkey % 200 as sequence_no, o_orderkey as first_change_scn, case when o_orderkey % 5 = 0 then 0 else o_orderkey + 50 end as next_change_scn, case when o_orderkey % 2 = 0 then 'archived' else 'online' end as kind from {orders}"


@query("redo_members", f"""with l as (select * from ({LOGS.format(orders='orders')}) where next_change_scn = 0 or next_change_scn > 700)
select member, sequence_no from l qualify row_number() over (partition by sequence_no, case when sequence_no = 0 then member else '' end order by case when kind = 'archived' then 0 else 1 end, first_change_scn, member) = 1""")
def redo_members(t):
    return feeds.select_redo_members(t.sql(LOGS), 700).select("member", "sequence_no")


@query("change_docs", """select event_id, case event_type when 'signup' then 'insert' when 'error' then 'delete' else 'update' end as operation, '{"_id":"' || event_id || '"}' as primary_key,
 case when event_type <> 'error' then '{"_id":"' || event_id || '","user":' || user_id || '}' end as after, cast(null as varchar) as before from events where event_type <> 'view' and user_id % 3 <> 0""")
def change_docs(t):
    docs = t.sql("""select event_id, concat('r', event_id) as resume, case event_type when 'signup' then 'insert' when 'error' then 'delete' when 'click' then 'replace' when 'view' then 'drop' else 'update' end as operation_type, 'app' as db, if(user_id % 3 = 0, 'other', 'events') as coll,
        concat('{"_id": "', event_id, '"}') as document_key, concat('{"user": ', user_id, ', "_id": "', event_id, '"}') as full_document, cast(null as string) as update_description from {events}""")
    return feeds.change_docs(docs, values(t, [("app", "events")], "db string, coll string")).select("event_id", "operation", "primary_key", "after", "before")


@query("map_operation", "select event_id, case event_id % 7 when 0 then 'insert' when 1 then 'update' when 2 then 'delete' when 3 then 'insert' when 4 then 'update' when 5 then 'delete' else 'update' end as operation from events")
def map_operation(t):
    code = F.element_at(F.array(*map(F.lit, ["I", "U", "D", "INSERT", "update", "Delete", "replace"])), (F.col("event_id") % 7 + 1).cast("int"))
    return t.events.select("event_id", S.map_operation(code).alias("operation"))


@query("derive_keys", "select event_id, case when event_id % 3 = 0 then 'b' || event_id else 'a' || event_id end as pk from events")
def derive_keys(t):
    image = lambda p, empty: F.when(empty, F.create_map().cast("map<string,string>")).otherwise(F.create_map(F.lit("id"), F.concat(F.lit(p), F.col("event_id"))))
    return t.events.select("event_id", S.derive_primary_key(image("b", F.lit(False)), image("a", F.col("event_id") % 3 == 0), ["id"])[0].alias("pk"))


@query("commit_timestamps", f"select event_id, case when event_id % 4 = 0 then {seconds('to_timestamp(1700000000 + event_id)')} else {seconds('ts')} end as at from events")
def commit_timestamps(t):
    stamp = F.when(F.col("event_id") % 4 == 1, F.col("ts").cast("timestamp"))
    other = F.when(F.col("event_id") % 4 > 1, F.col("ts").cast("timestamp"))
    at = S.derive_commit_timestamp(stamp, other, F.lit(1700000000) + F.col("event_id"))
    return t.events.select("event_id", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"))


@query("event_start", "select event_id, case when event_id = 0 then 4 when event_id % 5 = 0 then event_id when user_id = 0 then event_id * 3 else greatest(4, event_id * 3 - user_id) end as pos from events")
def event_start(t):
    e = F.col("event_id")
    return t.events.select("event_id", S.event_start_pos(F.when(e % 5 != 0, e * 3), F.col("user_id"), e).alias("pos"))


@query("rename_positional", "select event_id, case when event_id % 2 = 0 then 'id,kind' else 'UNKNOWN_COL0,other' end as names from events")
def rename_positional(t):
    m = F.create_map(F.lit("UNKNOWN_COL0"), F.lit("1"), F.when(F.col("event_id") % 2 == 0, "UNKNOWN_COL1").otherwise("other"), F.lit("2"))
    return t.events.select("event_id", F.array_join(F.map_keys(D.rename_positional(m, ["id", "kind"])), ",").alias("names"))


@query("pg_literals", """select event_id, case event_id % 5 when 0 then 'null' when 1 then '"it''s"' when 2 then cast(event_id as varchar) when 3 then 'true' else '"2024-01-01"' end as json from events""")
def pg_literals(t):
    literal = F.element_at(F.array(F.lit("NULL"), F.lit("'it''s'"), F.col("event_id").cast("string"), F.lit("true"), F.lit("2024-01-01")), (F.col("event_id") % 5 + 1).cast("int"))
    return t.events.select("event_id", D.pg_literal_json(literal).alias("json"))


@query("pg_values", """select event_id, case event_id % 5 when 0 then 'null' when 1 then cast(event_id as varchar) when 2 then 'true' when 3 then '"' || event_id || '"' else '"' || lower(hex(cast(event_type as blob))) || '"' end as json from events""")
def pg_values(t):
    e = (F.col("event_id") % 5 + 1).cast("int")
    pick = lambda *xs: F.element_at(F.array(*xs), e)
    payload = pick(F.lit(""), F.col("event_id").cast("string"), F.lit("t"), F.col("event_id").cast("string"), F.col("event_type")).cast("binary")
    return t.events.select("event_id", D.pg_value_json(pick(*map(F.lit, "ntttb")), payload, pick(*map(F.lit, (20, 20, 16, 1700, 17)))).alias("json"))


@query("tag_restore", """with e as (select *, cast(value as decimal(18,2)) as d from events) select event_id, 'decimal' as type, cast(d as varchar) as value,
 case when event_id % 3 = 0 then 'null' else 'datetime' end as time_type, case when event_id % 3 > 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') end as time_value, lower(hex(cast(event_type as blob))) as raw, true as same from e""")
def tag_restore(t):
    tagged = {"decimal": F.col("value"), "datetime": F.when(F.col("event_id") % 3 > 0, F.col("ts").cast("timestamp")), "bytes": F.col("event_type").cast("binary")}
    rows = t.events.select("event_id", *[c.alias(f"{k}_c") for k, c in tagged.items()], *[D.tag_value(c, k).alias(k) for k, c in tagged.items()])
    back = [D.restore_value(F.col(k), k).eqNullSafe(F.col(f"{k}_c")) for k in tagged]
    return rows.select("event_id", "decimal.type", "decimal.value", F.col("datetime.type").alias("time_type"), F.col("datetime.value").alias("time_value"), F.col("bytes.value").alias("raw"), (back[0] & back[1] & back[2]).alias("same"))


FLEET = "select concat('s', c_custkey) as source_id, c_custkey as n, c_custkey % 7 <> 0 as enabled, case when c_custkey % 3 = 0 then 'none' else 'full' end as backfill_mode, case when c_custkey % 11 = 0 then 'logminer' else 'watermark' end as capture_mode from {customer}"


@query("active_sources", "select 's' || c_custkey as source_id from customer where c_custkey % 7 <> 0 and c_custkey % 5 <> 0")
def active_sources(t):
    controls = t.customer.select(F.concat(F.lit("s"), "c_custkey").alias("source_id"), (F.col("c_custkey") % 5 == 0).alias("paused"))
    return specs.active_sources(t.sql(FLEET), controls).select("source_id")


@query("readable_sources", "select 's' || c_custkey as source_id from customer where c_custkey % 4 = 0 or (c_custkey % 3 <> 0 and c_custkey % 11 <> 0)")
def readable_sources(t):
    checkpoints = t.customer.where("c_custkey % 4 = 0").select(F.concat(F.lit("s"), "c_custkey").alias("source_id"), F.lit("{}").alias("token"))
    return specs.readable_sources(t.sql(FLEET), checkpoints).select("source_id")


CATALOG = "select 'n' as ns, concat('t', c_custkey) as tbl, explode(filter(array('id', if(c_custkey % 3 = 0, null, 'updated_at'), if(c_custkey % 5 = 0, null, 'k2')), x -> x is not null)) as column_name from {customer} where c_custkey % 7 <> 0"


@query("check_catalog", """select 't' || c_custkey as tbl, case when c_custkey % 7 = 0 then 'missing table' when c_custkey % 3 = 0 then 'missing column updated_at' when c_custkey % 4 = 0 then 'missing primary key' when c_custkey % 5 = 0 then 'missing column k2' end as problem from customer where c_custkey % 13 <> 0""")
def check_catalog(t):
    include = t.sql("select 'n' as ns, concat('t', c_custkey) as tbl, 'updated_at' as watermark, if(c_custkey % 4 = 0, cast(array() as array<string>), array('id', 'k2')) as pk from {customer}")
    exclude = t.sql("select 'n' as ns, concat('t', c_custkey) as tbl from {customer} where c_custkey % 13 = 0")
    return specs.check_catalog(t.sql(CATALOG), include, exclude).select("tbl", "problem")


@query("key_columns", "select 't' || c_custkey as tbl, 'id' as column_name, cast(1 as bigint) as key_position from customer where c_custkey % 7 <> 0 union all select 't' || c_custkey, 'updated_at', null from customer where c_custkey % 7 <> 0 and c_custkey % 3 <> 0 union all select 't' || c_custkey, 'k2', null from customer where c_custkey % 7 <> 0 and c_custkey % 5 <> 0")
def key_columns(t):
    keys = t.sql("select 'n' as ns, concat('t', c_custkey) as tbl, 'id' as column_name, 1L as key_position from {customer}")
    return specs.join_key_columns(t.sql(CATALOG), keys).select("tbl", "column_name", "key_position")


SPECS = "select concat('s', c_nationkey) as source_id, concat('sales.', c_name) as key, 'updated_at' as watermark, array('id', c_mktsegment) as pk, if(c_custkey % 4 = 0, 'collection', 'table') as kind, c_name as tbl from {customer}"


@query("coverage", "select 's' || c_nationkey as source_id, count(*) as tracked_objects, count(*) filter (where c_custkey % 4 <> 0) as tables, count(*) filter (where c_custkey % 4 = 0) as collections from customer group by 1")
def coverage(t):
    return specs.coverage(t.sql(SPECS))


@query("runtime_signature", """select 's' || c_nationkey as source_id, sha256('[' || string_agg('{"key":"sales.' || c_name || '","pk":["id","' || c_mktsegment || '"],"watermark":"updated_at"}', ',' order by c_name) || ']') as signature from customer group by 1""")
def runtime_signature(t):
    return specs.runtime_signature(t.sql(SPECS))


@query("signature_changed", "select 's' || n_nationkey as source_id, n_nationkey % 3 <> 0 as changed from nation where n_nationkey in (select c_nationkey from customer)")
def signature_changed(t):
    now = specs.runtime_signature(t.sql(SPECS))
    number = F.substring("source_id", 2, 9).cast("int")
    stored = now.where(number % 3 != 1).withColumn("signature", F.when(number % 3 == 0, F.col("signature")).otherwise(F.lit("old")))
    return specs.signature_changed(stored, now)


PUBLISHED = "select concat('s', c_nationkey) as source_id, if(c_custkey % 50 = 1, concat(c_name, 'x'), c_name) as tbl from {customer} where c_custkey % 40 <> 0"


@query("publication_drift", """with t as (select 's' || c_nationkey as source_id, c_name as tbl from customer), p as (select 's' || c_nationkey as source_id, case when c_custkey % 50 = 1 then c_name || 'x' else c_name end as tbl from customer where c_custkey % 40 <> 0),
m as (select t.* from t anti join p using (source_id, tbl)), e as (select p.* from p anti join t using (source_id, tbl))
select s.source_id, coalesce((select string_agg(tbl, ',' order by tbl) from m where m.source_id = s.source_id), '') as missing, coalesce((select string_agg(tbl, ',' order by tbl) from e where e.source_id = s.source_id), '') as extra,
 not exists (select 1 from m where m.source_id = s.source_id) and not exists (select 1 from e where e.source_id = s.source_id) as in_sync from (select distinct source_id from t union select distinct source_id from p) s""")
def publication_drift(t):
    out = specs.publication_drift(t.sql(SPECS), t.sql(PUBLISHED))
    return out.select("source_id", F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"), "in_sync")


@query("table_set_diff", """with t as (select 's' || c_nationkey as source_id, c_name as tbl from customer), p as (select 's' || c_nationkey as source_id, case when c_custkey % 50 = 1 then c_name || 'x' else c_name end as tbl from customer where c_custkey % 40 <> 0)
select *, 'tracked' as side from (select * from t except all select * from p) union all select *, 'published' from (select * from p except all select * from t)""")
def table_set_diff(t):
    return specs.table_set_diff(t.sql(SPECS).select("source_id", "tbl"), t.sql(PUBLISHED))


@query("replica_identity_drift", "select 's' || c_nationkey as source_id, bool_and(c_custkey % 60 <> 7 and c_custkey % 90 <> 8) as in_sync from customer group by 1")
def replica_identity_drift(t):
    held = t.sql("select concat('s', c_nationkey) as source_id, c_name as tbl, if(c_custkey % 60 = 7, 'd', 'f') as identity from {customer} where c_custkey % 90 <> 8")
    return specs.replica_identity_drift(t.sql(SPECS), held)


@query("union_candidates", "select '{\"o_orderkey\":' || o_orderkey || '}' as pk, 'sales.orders' as tbl from orders union all select '{\"event_id\":' || event_id || '}', 'app.events' from events")
def union_candidates(t):
    from changeledger.plans.capture import EVENTS, ORDERS, SOURCE
    from changeledger.sources import snapshot as N

    parts = [N.candidates(t.orders, ORDERS, SOURCE, 0), N.candidates(t.events, EVENTS, SOURCE, 1).drop("state")]
    return N.union_candidates(parts).select(F.col("primary_key").alias("pk"), F.col("table_key").alias("tbl"))


@query("read_source", "select o_orderkey, o_orderstatus from orders")
def read_source(t):
    return specs.read_source(t.spark, "parquet", {"path": f"{t.sf_dir}/orders.parquet"}).select("o_orderkey", "o_orderstatus")
