"""Queries over binary feeds and streams: fixed tables are replayed as streams, and the tables they leave are compared."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from changeledger.operators import keyset
from changeledger.operators import ledger as L
from changeledger.operators.scratch import place as place_of
from changeledger.operators.scratch import scratch_path
from changeledger.operators.versions import read_versions
from changeledger.plans.base import SQL, query
from changeledger.plans.capture import ORDERS
from changeledger.plans.ledger import DELIVERIES, LATEST
from changeledger.sources import specs
from changeledger.sources.binary import decode_binary_feed
from changeledger.sources.sqlite import write_shards
from changeledger.streaming import health, runs, transactions

#: Messages of three tables of two columns; the first table is renamed at sequence number 7005.
MESSAGES = """
with o as (select *, concat('74', lpad(hex(length(cast(o_orderkey as string))), 8, '0'), hex(cast(o_orderkey as string))) as id,
  concat('74', lpad(hex(length(o_orderstatus)), 8, '0'), hex(o_orderstatus)) as st, lpad(hex(100 + o_orderkey % 3), 8, '0') as rel from {orders}),
m as (select 10 * o_orderkey + 1 as seq, case o_custkey % 3 when 0 then concat('49', rel, '4E0002', id, st)
  when 1 then concat('55', rel, '4F0002', id, st, '4E0002', id, if(o_custkey % 2 = 0, '75', '6E')) else concat('44', rel, '4B0002', id, '6E') end as h from o
 union all select seq, concat('52', lpad(hex(relid), 8, '0'), hex('app'), '00', hex(name), '0064000201', hex('id'), '00', lpad(hex(20), 8, '0'), 'FFFFFFFF00',
  hex('status'), '00', lpad(hex(25), 8, '0'), 'FFFFFFFF') from values (-3L, 100, 'r0'), (-2L, 101, 'r1'), (-1L, 102, 'r2'), (7005L, 100, 'r0b') as v(seq, relid, name))
select seq, '0/1' as lsn, '7' as xid, unhex(h) as data from m"""


@query("binary_feed", """select 10 * o_orderkey + 1 as seq, case o_custkey % 3 when 0 then 'insert' when 1 then 'update' else 'delete' end as operation,
 'r' || (o_orderkey % 3) || case when o_orderkey % 3 = 0 and 10 * o_orderkey + 1 > 7005 then 'b' else '' end as tbl,
 case when o_custkey % 3 > 0 then cast(o_orderkey as varchar) end as before_id, case o_custkey % 3 when 1 then '"' || o_orderstatus || '"' when 2 then 'null' end as before_status,
 case when o_custkey % 3 < 2 then cast(o_orderkey as varchar) end as after_id, case o_custkey % 3 when 0 then '"' || o_orderstatus || '"' when 1 then 'null' end as after_status,
 case when o_custkey % 6 = 4 then 'status' else '' end as unchanged from orders""")
def binary_feed(t):
    return images(decode_binary_feed(t.sql(MESSAGES)))


def images(decoded):
    rows = decoded.where("kind = 'row'")
    cell = lambda side, name: F.col(side)[name].alias(f"{side}_{name}")
    cells = [cell(side, name) for side in ("before", "after") for name in ("id", "status")]
    unchanged = F.coalesce(F.array_join("unchanged_columns", ","), F.lit(""))
    return rows.select("seq", "operation", F.col("table").alias("tbl"), *cells, unchanged.alias("unchanged"))


#: Rows of a landed file of a log; the most that a micro-batch of one file gives to one task.
ROWS_A_FILE = 1_000_000


def land(rows, path: str, place, parts: int, *left_out: str) -> None:
    """Lands rows as one file for each number from 0 to parts - 1 that `place` gives, in one pass; later numbers have later times."""
    rows.withColumn("__place", place.cast("int")).repartitionById(parts, F.col("__place")).drop("__place", *left_out).write.parquet(path)
    fs, folder = place_of(rows.sparkSession, path)
    files = [s for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
    first = max((s.getModificationTime() for s in files), default=0) - 10 * parts
    for s in files:
        fs.setTimes(s.getPath(), first + 10 * int(s.getPath().getName().split("-")[1]), -1)


def in_order(rows, path: str, parts: int, key: str, most: int | None = ROWS_A_FILE) -> int:
    """Lands rows as files by ranges of key, one after another, as a log grows: `parts` files, more where they would hold
    more than `most` rows; returns their number."""
    low, high, n = rows.agg(F.min(key), F.max(key), F.count("*")).first()
    if not n:
        rows.write.parquet(path)
        return parts
    parts = max(parts, -(-n // most) if most else 0)
    land(rows, path, F.floor((F.col(key) - low) * parts / (high - low + 1)), parts)
    return parts


def landed(t, sql: str) -> tuple[str, str, int]:
    """(folder, schema, files of a quarter) of a feed landed as files for a stream."""
    rows, path = t.sql(sql), scratch_path(t.spark)
    quarter = max(1, -(-rows.count() // (4 * ROWS_A_FILE)))
    rows.repartition(4 * quarter).write.mode("overwrite").parquet(f"{path}/feed")
    return path, rows.schema, quarter


@query("stream_deliveries", "select 's' || (o_custkey % 20) as source_id, 'ref' || (o_orderkey // 2) as external_ref, min(o_orderkey // 2) as k from orders group by 1, 2")
def stream_deliveries(t):
    """A feed with repeats, delivered in several batches; the checkpoint is reset and a second stream runs as well."""
    path, schema, quarter = landed(t, "select concat('s', o_custkey % 20) as source_id, concat('ref', cast(floor(o_orderkey / 2) as bigint)) as external_ref, cast(floor(o_orderkey / 2) as bigint) as k from {orders}")
    for stream, mark in (("a", "one"), ("a", "two"), ("b", "three")):
        feed = runs.stream_feed(t.spark, f"{path}/feed", schema, files=3 * quarter)
        runs.run_once(feed, runs.deliver_batch(f"{path}/ledger", stream=stream), f"{path}/{mark}")
    return read_versions(t.spark, f"{path}/ledger").select("source_id", "external_ref", "k")


@query("stream_delivery_status", f"select request_id, status, updated_at from {LATEST}")
def stream_delivery_status(t):
    path, schema, quarter = landed(t, DELIVERIES)
    latest = runs.delivery_status(runs.stream_feed(t.spark, f"{path}/feed", schema, files=2 * quarter))
    keep = lambda rows, batch: rows.write.mode("append").parquet(f"{path}/updates")
    runs.run_once(latest, keep, f"{path}/mark", "update")
    return L.upsert_latest(t.spark.read.parquet(f"{path}/updates"), ["request_id"], ["updated_at"])


ATTEMPTS = """select concat('s', user_id % 10) as source_id, timestamp_seconds(86400 + event_id) as at, not (cast(floor(event_id / 60) as int) % 2 = 1 and event_type <> 'click') as ok,
 concat('e', 86400 + event_id) as error, event_id from {events}"""


@query("stream_health", """with a as (select 's' || (user_id % 10) as s, 86400 + event_id as n, not ((event_id // 60) % 2 = 1 and event_type <> 'click') as ok from events),
g as (select *, count(*) filter (where ok) over w as i, lag(ok) over w as prev, coalesce(max(case when ok then n end) over (partition by s order by n rows between unbounded preceding and 1 preceding), -1) as good
 from a window w as (partition by s order by n)),
k as (select *, count(*) filter (where not ok) over (partition by s, i order by n) as streak, count(*) filter (where ok and not prev and good >= 0) over (partition by s order by n) as reconnects,
 array_to_string(list_slice(list('e' || n) filter (where not ok) over (partition by s order by n), -5, -1), ',') as errors from g),
b as (select *, case when not ok then 1000 * n + cast(least(10000, 500 * pow(2, streak - 1)) as bigint) end as backoff from k),
bad as (select s, n as f, lead(n) over (partition by s order by n) as later from b where not ok and streak >= 3),
o as (select s, f + 30 as e from bad where later is null or later >= f + 30),
x as (select s, n as t, 'attempt' as cause, n as upto from b union all select s, e, 'fallback over', e - 1 from o union all select s, e + 15, 'probation over', e + 14 from o),
y as (select x.*, (select max(n) from b where b.s = x.s and n <= upto) as last, (select max(f) from bad where bad.s = x.s and f <= upto) as f,
 (select max(e) from o where o.s = x.s and e <= t) as e from x),
z as (select y.*, case when f + 30 > t then 1000 * (f + 30) end as fallback, case when e + 15 > t then 1000 * (e + 15) end as probation from y)
select z.s as source_id, 1000 * z.t as at_ms, cause, b.streak as failure_streak, backoff as backoff_ms, fallback as fallback_ms, probation as probation_ms, b.reconnects, coalesce(b.errors, '') as errors,
 case when fallback is not null then 'fallback' when probation is not null then 'probation' when backoff > 1000 * t then 'backoff' else 'streaming' end as state from z join b on b.s = z.s and b.n = z.last""")
def stream_health(t):
    """Attempts land out of order in files that the stream reads one by one; a last row of another source moves the
    watermark past them all, so that silent sources leave fallback and probation."""
    rows, path = t.sql(ATTEMPTS), scratch_path(t.spark)
    most, n = rows.agg(F.max("event_id"), F.count("*")).first()
    parts = max(4, -(-n // ROWS_A_FILE))
    place = F.floor((F.col("event_id") + F.xxhash64("event_id") % 10) * parts / (most + 1)) + 1
    land(rows, f"{path}/feed", place, parts + 2, "event_id")
    end = rows.limit(1).select(F.lit("clock").alias("source_id"), F.timestamp_seconds(F.lit(most + 96_400)).alias("at"), F.lit(True).alias("ok"), F.lit("").alias("error"))
    end.coalesce(1).write.mode("append").parquet(f"{path}/feed")
    feed = runs.stream_feed(t.spark, f"{path}/feed", rows.drop("event_id").schema, files=1)
    log = health.stream_health(feed, lateness="30 seconds")
    runs.run_once(log, lambda found, _: found.write.mode("append").parquet(f"{path}/health"), f"{path}/mark", "update")
    millis = lambda c: F.unix_millis(c)
    long = lambda c: F.col(c).cast("long").alias(c)
    return t.spark.read.parquet(f"{path}/health").where("source_id != 'clock'").select(
        "source_id", millis("at").alias("at_ms"), "cause", long("failure_streak"), millis("backoff_until").alias("backoff_ms"), millis("fallback_until").alias("fallback_ms"), millis("probation_until").alias("probation_ms"),
        long("reconnects"), F.array_join("errors", ",").alias("errors"), "state",
    )


#: Transactions of seven rows, of which every fifth is not committed; their rows carry no transaction id.
LOG = """with e as (select event_id, event_id div 7 as x, concat('s', event_id div 7 % 3) as source_id, event_type from {events})
select source_id, 10 * event_id + 5 as seq, 'row' as kind, cast(null as string) as xid, concat('0/', hex(event_id)) as lsn, event_type, map('id', cast(event_id as string)) as after from e
union all select source_id, 10 * min(event_id), 'begin', cast(x as string), '0/0', null, null from e group by x, source_id
union all select source_id, 10 * max(event_id) + 9, 'commit', cast(x as string), concat('0/C', x), null, null from e where x % 5 <> 0 group by x, source_id"""


@query("stream_transactions", """with e as (select event_id, event_id // 7 as x, event_type from events where (event_id // 7) % 5 <> 0)
select 's' || (x % 3) as source_id, cast(x as varchar) as xid, 10 * event_id + 5 as seq, row_number() over (partition by x order by event_id) as event_index, count(*) over (partition by x) as total,
 '0/C' || x as commit_lsn, event_id = max(event_id) over (partition by x) as advance, event_type, cast(event_id as varchar) as id from e""")
def stream_transactions(t):
    """Files of a log end inside transactions, which are whole all the same."""
    rows, path = t.sql(LOG), scratch_path(t.spark)
    in_order(rows, f"{path}/feed", 5, "seq")
    made = transactions.stream_transactions(runs.stream_feed(t.spark, f"{path}/feed", rows.schema, files=1))
    runs.run_once(made, lambda found, _: found.write.mode("append").parquet(f"{path}/out"), f"{path}/mark")
    return t.spark.read.parquet(f"{path}/out").select("source_id", "xid", "seq", "event_index", "total", "commit_lsn", "advance", "event_type", F.col("after")["id"].alias("id"))


@query("stream_binary_feed", SQL["binary_feed"])
def stream_binary_feed(t):
    """Relation messages of earlier files, one of which is replaced later, decode the tuples of later ones."""
    rows, path = t.sql(MESSAGES), scratch_path(t.spark)
    files = -(-in_order(rows, f"{path}/feed", 5, "seq") // 5)
    feed = runs.stream_feed(t.spark, f"{path}/feed", rows.schema, files=files)
    runs.run_once(feed, transactions.decode_batch(f"{path}/relations", lambda found, _: found.write.mode("append").parquet(f"{path}/out")), f"{path}/mark")
    return images(t.spark.read.parquet(f"{path}/out"))


@query("sqlite_source", "select o_orderkey, o_custkey, o_orderdate from orders where o_orderdate > timestamp '1995-05-05' or (o_orderdate = timestamp '1995-05-05' and o_orderkey > 900)")
def sqlite_source(t):
    """Orders handed over as SQLite files, read by ranges of row ids after a cursor, which the files' own filters see."""
    path = scratch_path(t.spark)
    write_shards(t.orders.select("o_orderkey", "o_custkey", "o_orderdate").repartition(4), path, "orders")
    rows = specs.read_source(t.spark, "sqlite", {"path": path, "table": "orders"})
    return keyset.watermark_scan(rows, ORDERS, (dt.datetime(1995, 5, 5), 900)).select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))


PLACE = "least(3, cast(floor((event_id - lo) * 4 / (hi - lo + 1)) as int))"
EVENT_FILES = f"""with m as (select min(event_id) as lo, max(event_id) as hi from events), e as (select *, {PLACE} as part from events, m)"""


def event_files(t) -> tuple[str, object]:
    """The events as four files by ranges of ids, landed one after another."""
    rows, path = t.events.select("event_id", "user_id", "event_type"), scratch_path(t.spark)
    in_order(rows, f"{path}/feed", 4, "event_id", None)  # a file is a batch, and batches are four
    return path, rows.schema


@query("stream_forever", "select 's' || (user_id % 10) as source_id, 'e' || event_id as external_ref from events")
def stream_forever(t):
    """A polling stream that stops after as many loops as there are files."""
    path, schema = event_files(t)
    feed = runs.stream_feed(t.spark, f"{path}/feed", schema, files=1)
    named = feed.select(F.concat(F.lit("s"), F.col("user_id") % 10).alias("source_id"), F.concat(F.lit("e"), "event_id").alias("external_ref"))
    runs.run_forever(named, runs.deliver_batch(f"{path}/ledger"), f"{path}/mark", "0 seconds", 4)
    return read_versions(t.spark, f"{path}/ledger").select("source_id", "external_ref")


@query("stream_drift", EVENT_FILES + """, k as (select part, event_type, min(part) over (partition by event_type) as first from e)
select b.part as batch_id, event_type as source_id from (select distinct part from k) b join (select distinct event_type, first from k) f on b.part > f.first""")
def stream_drift(t):
    """Before each batch, sources whose signature differs from the stored one; here a source changes once it has delivered."""
    path, schema = event_files(t)
    kinds = t.events.select(F.col("event_type").alias("source_id"), F.lit("new").alias("signature")).distinct()
    seen = []

    def current(spark):
        there = read_versions(spark, f"{path}/ledger").select("source_id").distinct() if seen else spark.createDataFrame([], "source_id string")
        stored = kinds.join(there, "source_id", "left_anti").unionByName(there.withColumn("signature", F.lit("old")))
        return specs.signature_changed(stored, kinds)

    def changed(found):
        found.select("source_id", F.lit(len(seen)).cast("long").alias("batch_id")).write.mode("append").parquet(f"{path}/drift")

    deliver = runs.deliver_batch(f"{path}/ledger")

    def each(batch, batch_id):
        deliver(batch.select(F.col("event_type").alias("source_id"), F.col("event_id").cast("string").alias("external_ref")), batch_id)
        seen.append(batch_id)

    runs.run_once(runs.stream_feed(t.spark, f"{path}/feed", schema, files=1), runs.drift_check(current, changed, each), f"{path}/mark")
    return t.spark.read.parquet(f"{path}/drift")


@query("stream_snapshots", EVENT_FILES + " select b as batch_id, (select count(*) from e where part <= b) as delivered from (select unnest([0, 2]) as b)")
def stream_snapshots(t):
    """A snapshot of the ledger's size after a batch, where the last one is 15 seconds old by a clock of ten seconds a batch."""
    path, schema = event_files(t)
    deliver = runs.deliver_batch(f"{path}/ledger", ["external_ref"])

    def take(spark, batch_id):
        count = read_versions(spark, f"{path}/ledger").agg(F.count("*").alias("delivered"))
        count.select(F.lit(batch_id).cast("long").alias("batch_id"), "delivered").write.mode("append").parquet(f"{path}/shots")

    each = runs.snapshot_every(15, take, lambda batch, k: deliver(batch.select(F.col("event_id").cast("string").alias("external_ref")), k), f"{path}/last", iter(range(0, 1000, 10)).__next__)
    runs.run_once(runs.stream_feed(t.spark, f"{path}/feed", schema, files=1), each, f"{path}/mark")
    return t.spark.read.parquet(f"{path}/shots")
