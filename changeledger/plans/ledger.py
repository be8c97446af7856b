"""Queries over the delivery ledger, retention, health and evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeledger.functions import canonical as C
from changeledger.functions import status as S
from changeledger.operators import batching as B
from changeledger.operators import evidence as E
from changeledger.operators import health as H
from changeledger.operators import ledger as L
from changeledger.operators.retention import keep_newest as keep
from changeledger.plans.base import identity, query

CFG = L.LedgerConfig("me", 3, 4)
FINAL = L.LedgerConfig("me", 3, 4, True)

#: Responses derived from the orders: k is the key; many rules are broken on purpose, and many requests are answered twice.
EXPECTED = "select o_orderkey as k, concat('s', o_custkey % 20) as source_id, concat('ref', o_orderkey) as external_ref, o_orderkey as seq, concat('t', o_orderkey) as checkpoint_token from {orders}"
PREPARED = """select concat('q', o_orderkey) as request_id, concat('ref', o_orderkey, if(o_orderkey % 97 = 5, 'x', '')) as external_ref_hash, concat('h', o_orderkey) as object_hash, concat('r', o_orderkey) as root_hash, 'm' as manifest_hash, cast(o_orderkey % 100 as int) as leaf_count, 'verif' as verification_account,
 named_struct('contract', if(o_orderkey % 89 = 3, 'bad', 'verif'), 'action', if(o_orderkey % 83 = 3, 'other', {action}), 'data', if(o_orderkey % 101 = 1, null, named_struct('submitter', if(o_orderkey % 79 = 2, 'you', 'me'), 'schema_id', if(o_orderkey % 17 = 0, 9, 3), 'policy_id', if(o_orderkey % 23 = 0, 9, 4),
  'external_ref', concat('ref', o_orderkey), 'object_hash', if(o_orderkey % 29 = 0, 'zz', concat('h', o_orderkey)), 'root_hash', if(o_orderkey % 31 = 0, 'zz', concat('r', o_orderkey)), 'manifest_hash', 'm', 'leaf_count', cast(if(o_orderkey % 37 = 0, -5, o_orderkey % 100) as int)))) as prepared_action from {orders} where o_orderkey % 10 <> 0"""
BROADCASTS = """select concat('q', o_orderkey) as request_id, concat('x', o_orderkey) as tx_id, if(o_orderkey % 7 = 0, 0L, o_orderkey) as block_num,
 case when o_orderkey % 7 = 0 then if(o_orderkey % 2 = 0, 'request timed out', 'duplicate request for submitter me') when o_orderkey % 43 = 1 then 'timed out' end as error from {orders}""" + """
 union all select concat('q', o_orderkey), 'early', 0L, 'timed out' from {orders} where o_orderkey % 9 = 0"""
RECEIPTS = "select concat('q', o_orderkey) as request_id, concat('y', o_orderkey) as tx_id, o_orderkey + 1 as block_num, if(o_orderkey % 4 = 0, 'finalized', 'pending') as trust_state, o_orderkey % 5 <> 0 as finality_flag, cast(null as string) as finalized_at from {orders} where o_orderkey % 3 <> 0" + """
 union all select concat('q', o_orderkey), 'early', 0L, 'pending', false, null from {orders} where o_orderkey % 3 <> 0 and o_orderkey % 6 = 1"""
AUDIT = "select concat('q', o_orderkey) as request_id from {orders} where o_orderkey % 2 = 0 or o_orderkey % 7 = 0"
PRIOR = """select concat('p', o_orderkey) as request_id, concat('s', o_custkey % 20) as source_id, concat('ref', o_orderkey) as external_ref, case o_orderkey % 13 when 0 then 'finalized_exported' when 1 then 'broadcast_included' else 'failed' end as status,
 concat('x', o_orderkey) as tx_id, 'act' as prepared_action, cast(o_orderdate as string) as updated_at from {orders} where o_orderkey % 13 < 3"""

RULES = """case when k % 101 = 1 then 'data missing' when k % 89 = 3 then 'contract' when k % 83 = 3 then 'action' when k % 79 = 2 then 'submitter' when k % 17 = 0 then 'schema_id' when k % 23 = 0 then 'policy_id'"""
SINGLE_REASON = f"case when k % 10 = 0 or k % 97 = 5 then 'no response' else {RULES} when k % 29 = 0 then 'object_hash' end end"
BATCH_REASON = f"case when k % 10 = 0 or k % 97 = 5 then 'no response' else {RULES} when k % 31 = 0 then 'root_hash' when k % 37 = 0 then 'leaf_count' end end"
FINALIZED = "(k % 3 <> 0 and (k % 4 = 0 or k % 5 <> 0) and (k % 2 = 0 or k % 7 = 0))"


def prepared(t, batch=False):
    """Responses; every eleventh request was asked before, and its first answer is broken."""
    rows = t.sql(PREPARED.replace("{action}", "'submitroot'" if batch else "'submit'"))
    early = rows.where("cast(substring(request_id, 2) as bigint) % 11 = 0").withColumns({"request_id": F.concat(F.lit("a"), "request_id"), "verification_account": F.lit("none")})
    return rows.unionByName(early)


def responses(t):
    return t.sql(BROADCASTS), t.sql(RECEIPTS), t.sql(AUDIT)


@query("validate_prepared", f"select k, {SINGLE_REASON} as reason from (select o_orderkey as k from orders)")
def validate_prepared(t):
    return L.validate_prepared(t.sql(EXPECTED), prepared(t), CFG).select("k", "reason")


@query("validate_batches", f"select k, {BATCH_REASON} as reason from (select o_orderkey as k from orders)")
def validate_batches(t):
    return L.validate_prepared(t.sql(EXPECTED), prepared(t, True), CFG, True).select("k", "reason")


def singles_sql(final: bool) -> str:
    dup = "(k % 7 = 0 and k % 2 = 1 and fin)" if final else "false"
    good = "status = 'finalized_exported'" + ("" if final else " or status = 'broadcast_included'")
    return f"""with b as (select o_orderkey as k, o_orderkey % 13 = 1 as prior from orders where o_orderkey % 13 <> 0),
r as (select *, case when prior then null else {SINGLE_REASON} end as reason, not prior and k % 10 <> 0 and k % 97 <> 5 as asked from b),
f as (select *, asked and {FINALIZED} as fin, asked and k % 7 <> 0 as inc from r),
e as (select *, case when reason is not null then reason when asked and k % 7 = 0 and not {dup} then case when k % 2 = 0 then 'request timed out' else 'duplicate request for submitter me' end when asked and k % 7 <> 0 and k % 43 = 1 then 'timed out' end as last_error from f),
s as (select *, case when last_error is not null and not (last_error like '%timed out%' and inc) then 'failed' when fin then 'finalized_exported' when inc then 'broadcast_included' else 'prepared_registered' end as status from e)
select k, case when prior then 'p' || k when asked then 'q' || k when status = 'failed' then 'ref' || k end as request_id, status, last_error, ({good}) as ok from s"""


@query("notarize_singles", singles_sql(False))
def notarize_singles(t):
    return L.notarize_singles(t.sql(EXPECTED), t.sql(PRIOR), prepared(t), *responses(t), CFG).select("k", "request_id", "status", "last_error", "ok")


@query("notarize_singles_final", singles_sql(True))
def notarize_singles_final(t):
    return L.notarize_singles(t.sql(EXPECTED), t.sql(PRIOR), prepared(t), *responses(t), FINAL).select("k", "request_id", "status", "last_error", "ok")


@query("notarize_batches", f"""with b as (select o_orderkey as k from orders where o_orderkey % 13 not in (0, 1)), r as (select *, {BATCH_REASON} as reason, k % 10 <> 0 and k % 97 <> 5 as asked from b), f as (select *, asked and {FINALIZED} as fin, asked and k % 7 <> 0 as inc from r),
e as (select *, case when reason is not null then reason when asked and k % 7 = 0 then case when k % 2 = 0 then 'request timed out' else 'duplicate request for submitter me' end when asked and k % 43 = 1 then 'timed out' end as last_error from f)
select k, case when last_error is not null and not (last_error like '%timed out%' and inc) then 'failed' when fin then 'finalized_exported' when inc then 'broadcast_included' else 'prepared_registered' end as status, last_error from e""")
def notarize_batches(t):
    rows = t.sql("select o_orderkey as k, concat('s', o_custkey % 20) as source_id, o_orderkey as batch_no, o_orderkey % 100 as leaf_count, concat('ref', o_orderkey) as batch_external_ref, 'tok' as last_token from {orders} where o_orderkey % 13 not in (0, 1)")
    return L.notarize_batches(rows, t.sql(PRIOR), prepared(t, True), *responses(t), CFG).select("k", "status", "last_error")


@query("reuse_deliveries", "select o_orderkey as k, case when o_orderkey % 13 = 1 then 'p' || o_orderkey end as prior_request_id from orders where o_orderkey % 13 <> 0")
def reuse_deliveries(t):
    return L.reuse_deliveries(t.sql(EXPECTED), t.sql(PRIOR))[0].select("k", "prior_request_id")


@query("finalize", f"select k, case when k % 3 <> 0 then 'y' || k else 'x' || k end as tx_id, case when k % 3 <> 0 then k + 1 when k % 7 = 0 then 0 else k end as block_num, {FINALIZED} as finalized from (select o_orderkey as k from orders)")
def finalize(t):
    rows = t.sql("select o_orderkey as k, concat('q', o_orderkey) as request_id from {orders}")
    return L.finalize(rows, *responses(t)).select("k", "tx_id", "block_num", "finalized")


@query("recover_duplicates", f"select 'q' || k as request_id, {FINALIZED} as recovered from (select o_orderkey as k from orders where o_orderkey % 7 = 0 and o_orderkey % 2 = 1)")
def recover_duplicates(t):
    return L.recover_duplicates(*responses(t))


DELIVERIES = """select concat('d', o_orderkey) as request_id, concat('s', o_custkey % 20) as source_id, concat('ref', o_orderkey % 4000) as external_ref, case when o_orderkey % 5 = 0 then 'failed' when step = 1 then 'prepared_registered' when step = 2 then 'broadcast_included' else 'finalized_exported' end as status,
 if(o_orderkey % 6 = 0, null, 'act') as prepared_action, concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T', step) as updated_at from (select *, explode(sequence(1, cast(o_orderkey % 3 + 1 as int))) as step from {orders})"""
DELIVERIES_DUCK = """(select 'd' || o_orderkey as request_id, 's' || (o_custkey % 20) as source_id, 'ref' || (o_orderkey % 4000) as external_ref, case when o_orderkey % 5 = 0 then 'failed' when step = 1 then 'prepared_registered' when step = 2 then 'broadcast_included' else 'finalized_exported' end as status,
 case when o_orderkey % 6 = 0 then null else 'act' end as prepared_action, strftime(o_orderdate, '%Y-%m-%d') || 'T' || step as updated_at from (select *, unnest(range(1, o_orderkey % 3 + 2)) as step from orders))"""
LATEST = f"(select * from {DELIVERIES_DUCK} qualify row_number() over (partition by request_id order by updated_at desc) = 1)"


def latest(t):
    return L.upsert_latest(t.sql(DELIVERIES), ["request_id"], ["updated_at"])


@query("upsert_latest", f"select request_id, source_id, status, updated_at from {LATEST}")
def upsert_latest(t):
    return latest(t).select("request_id", "source_id", "status", "updated_at")


@query("best_delivery", f"""select source_id, external_ref, request_id, status from {LATEST} where status <> 'failed' and prepared_action is not null
 qualify row_number() over (partition by source_id, external_ref order by case status when 'finalized_exported' then 3 when 'broadcast_included' then 2 else 1 end desc, updated_at desc, request_id desc) = 1""")
def best_delivery(t):
    return L.best_delivery(latest(t)).select("source_id", "external_ref", "request_id", "status")


@query("pending_finality", f"select source_id, count(*) filter (where status in ('prepared_registered', 'broadcast_included')) as pending from {LATEST} group by 1")
def pending_finality(t):
    return L.pending_finality(latest(t))


@query("reconcile_queue", f"select request_id, source_id from {LATEST} where status in ('prepared_registered', 'broadcast_included') order by cast(substr(source_id, 2) as int), updated_at, request_id limit 2500")
def reconcile_queue(t):
    sources = t.spark.range(20).selectExpr("concat('s', id) as source_id", "id as source_idx")
    return L.reconcile_queue(latest(t), sources, 2500).select("request_id", "source_id")


WHOLE = "(prepared_action is not null and k % 7 <> 0)"


def pending(t):
    """Latest deliveries with the event that they store, which every seventh has lost; a seventh has no prepared action."""
    k = F.substring("request_id", 2, 20).cast("long")
    stored = F.concat(
        F.lit('{"after":{"id":'), k, F.lit(',"tags":["a",null]},"before":null,"change_version":"v'), k, F.lit('","checkpoint_token":"{\\"a\\": '), k, F.lit('}","commit_timestamp":"2024-01-01T00:00:00Z","database_name":"main",'),
        F.lit('"identity_key":"old","metadata":{"m":1},"mode":"single","operation":"update","primary_key":{"id":'), k,
        F.lit('},"schema_or_namespace":"app","source_id":"s","source_instance":"main","source_type":"postgresql","table_or_collection":"orders"}'),
    )
    return latest(t).withColumns({"trace_id": F.concat(F.lit("t"), k), "event_payload": F.when(k % 7 != 0, stored)})


@query("reconcile", f"""with q as (select *, cast(substr(request_id, 2) as bigint) as k from {LATEST} where status in ('prepared_registered', 'broadcast_included'))
select request_id, {WHOLE} as checked, {WHOLE} and {FINALIZED} as reconciled, case when {WHOLE} and {FINALIZED} then 'finalized_exported' else status end as status,
 case when {WHOLE} and not {FINALIZED} then 'not final' end as last_error from q""")
def reconcile(t):
    sources = t.spark.range(20).selectExpr("concat('s', id) as source_id", "id as source_idx")
    rename = lambda df: df.withColumn("request_id", F.concat(F.lit("d"), F.substring("request_id", 2, 20)))
    return L.reconcile(pending(t), sources, *map(rename, responses(t))).select("request_id", "checked", "reconciled", "status", "last_error")


@query("stored_events", f"""with q as (select *, cast(substr(request_id, 2) as bigint) as k from {LATEST} where cast(substr(request_id, 2) as bigint) % 7 <> 0),
i as (select *, sha256({identity("'v' || k", "'update'", "'{" + '"id":' + "' || k || '}'", 'app', 'orders')}) as ik from q)
select request_id, 't' || k as trace_id, ik as identity_key, sha256(ik || ':{{"a": ' || k || '}}') as external_ref, sha256('{{"id":' || k || ',"tags":["a",null]}}') as after_hash,
 cast(null as varchar) as before_hash, sha256('{{"m":1}}') as metadata_hash from i""")
def stored_events(t):
    return L.stored_events(pending(t)).select("request_id", "trace_id", "identity_key", "external_ref", "after_hash", "before_hash", "metadata_hash")


RESULTS = "select *, k % 6 <> 0 as ok, if(k % 6 = 0, 'failed', 'broadcast_included') as status, if(k % 12 = 0, null, concat('q', k)) as request_id, if(k % 6 = 0, 'boom', null) as last_error, k % 4 + 1 as members from (" + EXPECTED + ")"


@query("advance_checkpoints", "select 's' || (o_custkey % 20) as source_id, 't' || max(o_orderkey) as token from orders where o_orderkey % 6 <> 0 group by 1")
def advance_checkpoints(t):
    return L.advance_checkpoints(t.sql(RESULTS))


@query("route_failures", "select case when o_orderkey % 12 = 0 then 'ref' || o_orderkey else 'q' || o_orderkey end as request_id, 's' || (o_custkey % 20) as source_id, 'ref' || o_orderkey as external_ref, 'failed' as status, 'boom' as last_error from orders where o_orderkey % 6 = 0")
def route_failures(t):
    return L.route_failures(t.sql(RESULTS))[0]


MEMBER = """'{"after":{"k":' || k || '},"change_version":"order:' || k || '","checkpoint_token":"t' || k || '","database_name":"main","identity_key":"' || sha256('{"change_version":"order:' || k || '","database_name":"main","operation":"insert","primary_key":{"k":' || k || '},"schema_or_namespace":"app","source_instance":"main","source_type":"mysql","table_or_collection":"orders"}') || '","operation":"insert","primary_key":{"k":' || k || '},"schema_or_namespace":"app","source_id":"' || source_id || '","source_instance":"main","source_type":"mysql","table_or_collection":"orders"}'"""


@query("route_batch_failures", f"""with e as (select o_orderkey as k, 's' || (o_custkey % 20) as source_id, (row_number() over (partition by o_custkey % 20 order by o_orderkey) - 1) // 10 as batch_no from orders),
b as (select source_id, batch_no, max(k) as top from e group by 1, 2) select source_id, 'boom ' || top as reason, sha256({MEMBER}) as payload_hash from e join b using (source_id, batch_no) where top % 3 = 0""")
def route_batch_failures(t):
    rows = t.sql("""select o_orderkey as k, concat('s', o_custkey % 20) as source_id, concat('{"k":', o_orderkey, '}') as after, concat('order:', o_orderkey) as change_version, 'insert' as operation, concat('{"k":', o_orderkey, '}') as primary_key, 'main' as database_name, 'main' as source_instance, 'mysql' as source_type, 'app' as schema_or_namespace, 'orders' as table_or_collection,
 concat('t', o_orderkey) as checkpoint_token, concat('ref', o_orderkey) as external_ref from {orders}""")
    events = B.chunk(rows, 10, ["k"], ["source_id"])
    top = F.substring("last_token", 2, 20).cast("long")
    results = B.batches(events, ["source_id", "batch_no"]).withColumns({"external_ref": F.col("batch_external_ref"), "request_id": F.lit(None).cast("string"), "status": F.when(top % 3 == 0, "failed").otherwise("broadcast_included"), "last_error": F.when(top % 3 == 0, F.concat(F.lit("boom "), top))})
    return L.route_failures(results, events)[1].select("source_id", "reason", C.sha256_hex(F.col("payload")).alias("payload_hash"))


@query("run_summary", "select 's' || (o_custkey % 20) as source_id, cast(sum(case when o_orderkey % 6 <> 0 then o_orderkey % 4 + 1 else 0 end) as bigint) as processed, cast(sum(case when o_orderkey % 6 = 0 then o_orderkey % 4 + 1 else 0 end) as bigint) as failed from orders group by 1")
def run_summary(t):
    return H.run_summary(t.sql(RESULTS))


@query("gate_ready", "select o_orderkey as k, o_custkey % 20 % 3 <> 0 and o_custkey % 20 <> 19 as ready from orders")
def gate_ready(t):
    ready, gated = L.gate_ready(t.sql(EXPECTED), t.spark.range(19).selectExpr("concat('s', id) as source_id", "id % 3 <> 0 as ready"))
    return ready.select("k", F.lit(True).alias("ready")).unionByName(gated.select("k", F.lit(False).alias("ready")))


@query("dlq", """select 's' || user_id as source_id, 'bad' as reason, sha256('{"after":{"id":' || event_id || '},"change_version":"event:' || event_id || '","identity_key":"' || sha256('{"change_version":"event:' || event_id || '","database_name":"main","operation":"insert","primary_key":{"id":' || event_id || '},"schema_or_namespace":"app","source_instance":"main","source_type":"mysql","table_or_collection":"events"}') || '","operation":"insert","primary_key":{"id":' || event_id || '},"source_id":"s' || user_id || '"}') as payload_hash from events""")
def dlq(t):
    rows = t.sql("""select concat('s', user_id) as source_id, concat('{"id":', event_id, '}') as after, concat('event:', event_id) as change_version, 'insert' as operation, concat('{"id":', event_id, '}') as primary_key, 'main' as database_name, 'main' as source_instance, 'mysql' as source_type, 'app' as schema_or_namespace, 'events' as table_or_collection from {events}""")
    keyed = rows.withColumn("identity_key", C.identity_key()).drop("database_name", "source_instance", "source_type", "schema_or_namespace", "table_or_collection")
    return L.dlq_rows(keyed, F.lit("bad")).select("source_id", "reason", C.sha256_hex(F.col("payload")).alias("payload_hash"))


@query("proof_bundles", "select 's' || (o_custkey % 20) || '/' || case when o_orderkey % 50 = 0 then '../x' else 'q' || o_orderkey end || '.json' as path, o_orderkey % 50 <> 0 as safe, 'single' as mode from orders")
def proof_bundles(t):
    rows = t.sql("select concat('s', o_custkey % 20) as source_id, if(o_orderkey % 50 = 0, '../x', concat('q', o_orderkey)) as request_id from {orders}")
    return L.proof_bundles(rows).select("path", "safe", "mode")


@query("batch_bundles", "select 's/q' || (o_orderkey // 100) || '.json' as path, 'batch' as mode, string_agg('ref' || o_orderkey, ',' order by o_orderkey) as members from orders group by o_orderkey // 100")
def batch_bundles(t):
    members = t.sql("select cast(floor(o_orderkey / 100) as bigint) as batch_no, o_orderkey as seq, concat('ref', o_orderkey) as external_ref from {orders}")
    requests = members.select("batch_no").distinct().withColumns({"source_id": F.lit("s"), "request_id": F.concat(F.lit("q"), "batch_no")})
    return L.proof_bundles(requests, members).select("path", "mode", F.array_join("members", ",").alias("members"))


@query("keep_newest", f"select request_id, source_id, row_number() over (partition by source_id order by updated_at desc, request_id desc) <= 25 as kept from {LATEST}")
def keep_newest(t):
    kept, removed = keep(latest(t), 25, ["source_id"], ["updated_at", "request_id"])
    return kept.select("request_id", "source_id", F.lit(True).alias("kept")).unionByName(removed.select("request_id", "source_id", F.lit(False).alias("kept")))


@query("keep_newest_ties", """with e as (select case when user_id % 7 <> 3 then event_type end as kind, case when event_id % 11 <> 0 then event_id // 50 end as v from events union all
  select 'click', 3 from events where event_id % 100 = 0),
r as (select *, row_number() over (partition by kind order by v desc nulls last) as place from e)
select kind, place <= 1500 as kept, count(*) as n, min(v) as first_at, max(v) as last_at, count(*) - count(v) as nulls from r group by 1, 2""")
def keep_newest_ties(t):
    """Order values that repeat or are null, a null group and repeated rows; cells are split down to 200 rows."""
    rows = t.sql("""select if(user_id % 7 <> 3, event_type, null) as kind, if(event_id % 11 <> 0, cast(floor(event_id / 50) as bigint), null) as at, event_id from {events}
        union all select 'click', 3L, 0L from {events} where event_id % 100 = 0""")
    told = [df.withColumn("kept", F.lit(mark)) for df, mark in zip(keep(rows, 1500, ["kind"], ["at"], small=200), (True, False))]
    counted = [F.count("*").alias("n"), F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.count_if(F.col("at").isNull()).alias("nulls")]
    return told[0].unionByName(told[1]).groupBy("kind", "kept").agg(*counted)


@query("list_ledger", f"select request_id, status from {LATEST} where source_id = 's7'")
def list_ledger(t):
    return L.list_ledger(latest(t), "updated_at", "s7").select("request_id", "status")


ERRORS = "case event_id % 8 when 0 then 'read TIMEOUT' when 1 then 'copy_both failed' when 2 then 'publication missing' when 3 then 'slot x is active' when 4 then 'broken pipe' when 5 then 'HTTP request failed: 503' when 6 then 'did not finalize in time' else 'duplicate request for submitter' end"


@query("classify_errors", f"""with e as (select event_id, {ERRORS} as x from events) select event_id, case event_id % 8 when 0 then 'timeout' when 1 then 'protocol_error' when 2 then 'publication_error' when 3 then 'slot_conflict' when 4 then 'connection_lost' else 'runtime_error' end as kind,
 event_id % 8 in (5, 6) as retryable, event_id % 8 = 5 as poll_retryable, event_id % 8 = 7 as duplicate from e""")
def classify_errors(t):
    x = F.expr(ERRORS)
    return t.events.select("event_id", S.classify_stream_error(x).alias("kind"), S.is_retryable(x).alias("retryable"), S.is_retryable(x, True).alias("poll_retryable"), S.is_duplicate_submit(x).alias("duplicate"))


@query("should_mark_failed", "select event_id, not (event_id % 2 = 0 and (event_id % 3 = 0 or event_id % 5 = 0)) as failed from events")
def should_mark_failed(t):
    e = F.col("event_id")
    text = F.when(e % 2 == 0, "RPC call failed: x").otherwise("bad action")
    return t.events.select("event_id", S.should_mark_failed(text, F.when(e % 3 == 0, e + 1), F.when(e % 5 == 0, "broadcast_included").otherwise("prepared_registered"), F.lit("x1")).alias("failed"))


@query("receipt_finality", """select event_id, event_type = 'click' or user_id % 4 = 0 or event_id % 9 = 0 as final from events""")
def receipt_finality(t):
    """Trust states in any letter case; an empty time of finality is none."""
    state = F.when(F.col("event_type") == "click", F.when(F.col("event_id") % 2 == 0, "FINALIZED").otherwise("Finalized_Verified")).when(F.col("event_id") % 2 == 0, "PENDING").otherwise("")
    flag = F.when(F.col("user_id") % 4 == 0, True).when(F.col("user_id") % 4 == 1, False)
    time = F.when(F.col("event_id") % 9 == 0, "2024").when(F.col("event_id") % 9 == 1, "")
    return t.events.select("event_id", S.receipt_is_finalized(state, flag, time).alias("final"))


@query("backoff", "select event_id, cast(case when user_id % 9 = 0 then 0 else least(10, 0.5 * pow(2, user_id % 9 - 1)) end as double) as delay, case when event_id % 4 < 2 then '' when event_id % 4 = 2 then '0.1' else '0.1,0.2' end as retries from events")
def backoff(t):
    n = (F.col("event_id") % 4).cast("int")
    return t.events.select("event_id", S.backoff_delay((F.col("user_id") % 9).cast("int")).alias("delay"), F.array_join(F.transform(S.retry_delays(n), lambda d: d.cast("decimal(3,1)").cast("string")), ",").alias("retries"))


@query("severity", "select user_id, case max(case event_id % 97 when 1 then 3 when 2 then 2 when 3 then 2 when 4 then 1 else 0 end) when 3 then 'error' when 2 then 'critical' when 1 then 'degraded' else 'healthy' end as severity from events group by 1")
def severity(t):
    s = F.expr("case event_id % 97 when 1 then 'error' when 2 then 'critical' when 3 then 'critical' when 4 then 'degraded' else 'healthy' end")
    return t.events.withColumn("s", s).groupBy("user_id").agg(S.max_severity(F.col("s")).alias("severity"))


@query("validate_images", "select event_id, concat_ws(',', case when event_type = 'view' then 'unknown operation' end, case when user_id % 10 = 0 then 'missing primary key' end, case when event_id % 7 = 0 then 'unsafe id' end) as reasons from events")
def validate_images(t):
    op = F.when(F.col("event_type") == "view", "view").otherwise("insert")
    pk = F.array(F.when(F.col("user_id") % 10 != 0, F.col("user_id").cast("string")))
    rid = F.when(F.col("event_id") % 7 == 0, "a/b").otherwise("ok")
    return t.events.select("event_id", F.array_join(S.validate_images(op, pk, rid), ",").alias("reasons"))


STATUS_SQL = f"""with s as (select 's' || n as source_id, n from (select unnest(range(0, 22)) as n)), d as (select source_id, count(*) as c from {LATEST} group by 1), p as (select source_id, count(*) as c from {LATEST} where status = 'finalized_exported' group by 1), q as (select source_id, count(*) as c from {LATEST} where status = 'failed' group by 1),
st as (select s.source_id, n, n % 4 = 0 as paused, n % 3 = 0 as has_signature, case when n % 2 = 0 then 'tok' || n end as token, coalesce(d.c, 0) as delivery_count, coalesce(p.c, 0) as proof_count, coalesce(q.c, 0) as dlq_count from s left join d using (source_id) left join p using (source_id) left join q using (source_id))"""


def status_rows(t):
    rows = latest(t)
    ids = t.spark.range(22)
    name = F.concat(F.lit("s"), F.col("id")).alias("source_id")
    controls, signatures, checkpoints = ids.where("id % 4 in (0, 1)").select(name, (F.col("id") % 4 == 0).alias("paused")), ids.where("id % 3 = 0").select(name), ids.where("id % 2 = 0").select(name, F.concat(F.lit("tok"), "id").alias("token"))
    return H.source_status(ids.select(name), controls, signatures, checkpoints, rows, rows.where("status = 'finalized_exported'"), rows.where("status = 'failed'"))


@query("source_status", STATUS_SQL + " select source_id, paused, has_signature, token, delivery_count, proof_count, dlq_count from st")
def source_status(t):
    return status_rows(t)


INSPECTED = """select concat('s', id) as source_id, if(id % 11 = 3, false, true) as slot_exists, if(id % 5 = 4, false, null) as publication_in_sync, true as replica_identity_in_sync, id % 7 = 1 as fallback_active, if(id % 14 = 1, 'timeout', null) as fallback_reason, id % 13 = 2 as probation_active, cast(null as string) as probation_reason,
 id % 6 = 5 as backoff_active, cast(id % 9 as int) as failure_streak, 'timeout' as last_error_kind, id * 30000000L as retained_bytes, id * 5000000L as flush_bytes from range(22)"""
WARN_DUCK = """concat_ws('|', case when n % 11 = 3 then 'slot missing' end, case when n % 5 = 4 then 'publication out of sync' end, case when n % 7 = 1 then 'fallback after ' || case when n % 14 = 1 then 'timeout' else 'runtime_error' end end, case when n % 13 = 2 then 'probation after fallback_recovery' end,
 case when n % 6 = 5 then 'backoff after timeout' when n % 9 > 0 then (n % 9) || ' failures, last timeout' end, case when n * 30000000 > 268435456 then 'retained log above threshold' end, case when n * 5000000 > 67108864 then 'flush lag above threshold' end)"""
SEVERITY_DUCK = f"case when {WARN_DUCK} = '' then 'healthy' when n % 11 = 3 then 'critical' when n % 7 = 1 or n % 13 = 2 then 'degraded' when n % 6 = 5 and n % 9 >= 3 then 'critical' else 'degraded' end"


@query("fleet_metrics", STATUS_SQL + f""", h as (select *, {SEVERITY_DUCK} as severity from st) select source_id, count(*) as source_count, count(*) filter (where severity = 'healthy') as ok_count, count(*) filter (where paused) as paused_count, cast(sum(delivery_count) as bigint) as delivery_count, cast(sum(proof_count) as bigint) as proof_count,
 cast(sum(dlq_count) as bigint) as dlq_count, count(*) filter (where severity = 'degraded') as degraded_count, count(*) filter (where severity = 'critical') as critical_count, count(*) filter (where severity = 'error') as error_count from h group by rollup(source_id)""")
def fleet_metrics(t):
    return H.fleet_metrics(status_rows(t), H.source_health(t.spark.sql(INSPECTED)))


@query("source_report", STATUS_SQL + f", c as (select 's' || c_nationkey as source_id, count(*) as tracked from customer group by 1) select source_id, {SEVERITY_DUCK} as severity, {WARN_DUCK} as warnings, delivery_count, tracked, case when n < 15 then n * 30000000 end as retained_bytes from st left join c using (source_id)")
def source_report(t):
    from changeledger.plans.feeds import SPECS
    from changeledger.sources import specs

    inspected = H.source_health(t.spark.sql(INSPECTED))
    slots = t.spark.sql(INSPECTED).where("cast(substring(source_id, 2) as int) < 15")
    out = H.source_report(status_rows(t), inspected, specs.coverage(t.sql(SPECS)), slots)
    return out.select("source_id", "severity", F.array_join("warnings", "|").alias("warnings"), "counts.delivery_count", F.col("coverage.tracked_objects").alias("tracked"), "slot.retained_bytes")


HEALTH = """select concat('s', event_id) as source_id, event_id as id, user_id % 11 <> 3 as slot_exists, user_id % 5 <> 4 as publication_in_sync, true as replica_identity_in_sync, user_id % 7 = 1 as fallback_active, cast(null as string) as fallback_reason, user_id % 13 = 2 as probation_active, cast(null as string) as probation_reason,
 user_id % 6 = 5 as backoff_active, cast(user_id % 9 as int) as failure_streak, event_type as last_error_kind, event_id * 30000L as retained_bytes, event_id * 9000L as flush_bytes from {events}"""


@query("source_health", """with w as (select event_id, user_id as n, concat_ws('|', case when user_id % 11 = 3 then 'slot missing' end, case when user_id % 5 = 4 then 'publication out of sync' end, case when user_id % 7 = 1 then 'fallback after runtime_error' end, case when user_id % 13 = 2 then 'probation after fallback_recovery' end,
 case when user_id % 6 = 5 then 'backoff after ' || event_type when user_id % 9 > 0 then (user_id % 9) || ' failures, last ' || event_type end, case when event_id * 30000 > 268435456 then 'retained log above threshold' end, case when event_id * 9000 > 67108864 then 'flush lag above threshold' end) as warnings from events)
select event_id as id, warnings, case when warnings = '' then 'healthy' when n % 11 = 3 then 'critical' when n % 7 = 1 or n % 13 = 2 then 'degraded' when n % 6 = 5 and n % 9 >= 3 then 'critical' else 'degraded' end as severity from w""")
def source_health(t):
    return H.source_health(t.sql(HEALTH)).select("id", F.array_join("warnings", "|").alias("warnings"), "severity")


@query("overall_severity", "select 'critical' as severity, cast(sum(case when event_id % 3 = 0 then 2 else 0 end) as bigint) as warning_count, cast(sum(case when event_id % 5 = 0 then 1 else 0 end) as bigint) as error_count from events")
def overall_severity(t):
    found = t.sql("select case when event_id % 3 = 0 then 'degraded' when event_id % 5 = 0 then 'critical' else 'healthy' end as severity, if(event_id % 3 = 0, array('a', 'b'), cast(array() as array<string>)) as warnings, if(event_id % 5 = 0, array('e'), cast(array() as array<string>)) as errors from {events}")
    return H.overall_severity(found)


@query("slot_lag", "select event_id, event_id * 65536 - event_id * 256 as retained_bytes, event_id * 65536 - event_id * 60000 as flush_bytes, event_id * 5536 > 0 as pending, event_id * 65280 > 268435456 as retained_warning, event_id * 5536 > 67108864 as flush_warning from events")
def slot_lag(t):
    from changeledger.functions.tokens import long_to_lsn

    e = F.col("event_id")
    rows = t.events.select("event_id", long_to_lsn(e * 65536).alias("current_lsn"), long_to_lsn(e * 256).alias("restart_lsn"), long_to_lsn(e * 60000).alias("confirmed_lsn"))
    return H.slot_lag(rows).drop("current_lsn", "restart_lsn", "confirmed_lsn")


ATTEMPTS = "select concat('s', user_id % 10) as source_id, event_id as at, event_type <> 'error' as ok, concat('e', event_id) as error from {events}"


@query("failure_streaks", """with a as (select 's' || (user_id % 10) as source_id, event_id as "at", event_type <> 'error' as ok from events), g as (select *, sum(ok::int) over (partition by source_id order by "at") as i from a)
select source_id, "at", cast(sum((not ok)::int) over (partition by source_id, i order by "at") as bigint) as streak from g""")
def failure_streaks(t):
    return H.failure_streaks(t.sql(ATTEMPTS)).select("source_id", "at", "streak")


@query("streaks_of_equal_times", """with a as (select 's' || (user_id % 10) as source_id, event_id // 40 as "at", event_type <> 'error' as ok, 'e' || (event_id % 4) as error from events),
n as (select *, row_number() over (partition by source_id order by "at", ok, error) as n from a), g as (select *, sum(ok::int) over (partition by source_id order by n) as i from n)
select source_id, "at", ok, error, cast(sum((not ok)::int) over (partition by source_id, i order by n) as bigint) as streak from g""")
def streaks_of_equal_times(t):
    sql = "select concat('s', user_id % 10) as source_id, cast(floor(event_id / 40) as bigint) as at, event_type <> 'error' as ok, concat('e', event_id % 4) as error from {events}"
    return H.failure_streaks(t.sql(sql)).select("source_id", "at", "ok", "error", "streak")


@query("recent_errors", "select source_id, n, \"at\", error from (select 's' || (user_id % 10) as source_id, event_id as \"at\", 'e' || event_id as error, row_number() over (partition by user_id % 10 order by event_id desc) as n from events where event_type = 'error') where n <= 5")
def recent_errors(t):
    return H.recent_errors(t.sql(ATTEMPTS))


MANIFEST = "select 'report' as kind, concat('s', o_custkey % 20) as source_id, concat('/e/', o_orderkey) as path, cast(o_orderdate as timestamp) as created_at from {orders}"


@query("prune_missing", "select '/e/' || o_orderkey as path, o_orderkey % 4 <> 0 as kept from orders")
def prune_missing(t):
    files = t.sql("select concat('/e/', o_orderkey) as path from {orders} where o_orderkey % 4 <> 0")
    kept, removed = E.prune_missing(t.sql(MANIFEST), files)
    return kept.select("path", F.lit(True).alias("kept")).unionByName(removed.select("path", F.lit(False).alias("kept")))


@query("drop_removed", "select '/e/' || o_orderkey as path from orders where o_orderkey % 4 <> 0")
def drop_removed(t):
    return E.drop_removed(t.sql(MANIFEST), t.sql("select concat('/e/', o_orderkey) as path from {orders} where o_orderkey % 4 = 0")).select("path")


@query("retain_evidence", "select path from (select '/e/' || o_orderkey as path, row_number() over (partition by o_custkey % 20 order by o_orderdate desc, '/e/' || o_orderkey desc) as n from orders) where n <= 10")
def retain_evidence(t):
    return E.retain(t.sql(MANIFEST), 10)[0].select("path")


@query("latest_artifacts", "select '/e/' || o_orderkey as path from orders where o_custkey % 20 = 3 order by o_orderdate desc, path desc limit 5")
def latest_artifacts(t):
    return E.latest_artifacts(t.sql(MANIFEST), "s3", "report", 5).select("path")
