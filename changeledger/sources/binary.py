"""Binary replication messages (SRC-9, JN-10): B, C, R, I, U and D messages landed as (seq, lsn, xid, data).

Headers and tuples are read with SQL functions over the hex text; only relation messages, a handful per table, are
parsed by an Arrow function. Each tuple message finds the latest relation message of its table before it.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeledger.functions.decode import pg_value_json
from changeledger.operators.prefix import running_within
from changeledger.shipping import ship

#: Relation messages that are broadcast with the range of numbers that each holds for; more of them are carried by ordered passes.
FEW = 256
#: Tuples that a task decodes; their decoding costs far more than their move, and a feed's files may be few.
ROWS_A_TASK = 50_000
RELATION = "seq long, relid long, schema string, table string, columns array<struct<name:string,oid:long,key:boolean>>"


def parse_relation(data: bytes) -> dict:
    """schema, table and columns of one R message."""
    at = 5

    def text() -> str:
        nonlocal at
        end = data.index(b"\0", at)
        out, at = data[at:end].decode("utf-8"), end + 1
        return out

    schema, table = text(), text()
    n = struct.unpack_from(">h", data, at + 1)[0]
    at += 3
    columns = []
    for _ in range(n):
        key = bool(data[at] & 1)
        at += 1
        name = text()
        oid = struct.unpack_from(">I", data, at)[0]
        at += 8
        columns.append({"name": name, "oid": oid, "key": key})
    return {"relid": struct.unpack_from(">I", data, 1)[0], "schema": schema, "table": table, "columns": columns}


def relations(feed: DataFrame) -> DataFrame:
    ship(feed.sparkSession)

    def run(batches):
        types = pa.schema([("seq", pa.int64()), ("relid", pa.int64()), ("schema", pa.string()), ("table", pa.string()), ("columns", pa.list_(pa.struct([("name", pa.string()), ("oid", pa.int64()), ("key", pa.bool_())])))])
        for b in batches:
            yield pa.RecordBatch.from_pylist([{"seq": s, **parse_relation(bytes(d))} for s, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist())], types)

    return feed.where(F.hex(F.substring("data", 1, 1)) == "52").select("seq", "data").mapInArrow(run, RELATION)


def _int(hexed: Column, at: Column, size: int) -> Column:
    return F.conv(F.substring(hexed, at, F.lit(2 * size)), 16, 10).cast("long")


def _tuple(hexed: Column, at: Column) -> Column:
    """(end, items): the tuple at character `at` of the hex text; items are (kind, hex payload)."""
    n = _int(hexed, at, 2).cast("int")
    empty = F.struct((at + 4).cast("long").alias("end"), F.array().cast("array<struct<kind:string,hex:string>>").alias("items"))

    def step(acc: Column, _: Column) -> Column:
        p = acc["end"].cast("int")
        kind = F.decode(F.unhex(F.substring(hexed, p, F.lit(2))), "UTF-8")
        bare = kind.isin("n", "u")
        size = F.when(bare, F.lit(0).cast("long")).otherwise(_int(hexed, p + 2, 4))
        item = F.struct(kind.alias("kind"), F.when(~bare, F.substring(hexed, p + 10, (2 * size).cast("int"))).alias("hex"))
        return F.struct(F.when(bare, acc["end"] + 2).otherwise(acc["end"] + 10 + 2 * size).alias("end"), F.concat(acc["items"], F.array(item)).alias("items"))

    return F.aggregate(F.sequence(F.lit(1), n), empty, step)


def asof_relation(tuples: DataFrame, rels: DataFrame) -> DataFrame:
    """tuples (seq, relid, ...) with the latest relation (schema, table, columns) of their relid before them."""
    found = rels.limit(FEW + 1).collect()
    if len(found) <= FEW:
        spans = rels.sparkSession.createDataFrame(found, RELATION).withColumn("__from", F.coalesce("seq", F.lit(-(1 << 63)))).drop("seq")
        spans = spans.withColumn("__to", F.lead("__from").over(Window.partitionBy("relid").orderBy("__from"))).withColumnRenamed("relid", "__relid")
        holds = (F.col("relid") == F.col("__relid")) & (F.col("seq") > F.col("__from")) & (F.col("__to").isNull() | (F.col("seq") <= F.col("__to")))
        tasks = max(1, -(-tuples.count() // ROWS_A_TASK))
        return tuples.repartition(tasks, "seq").join(F.broadcast(spans), holds, "left").drop("__relid", "__from", "__to")
    rel = F.struct("schema", "table", "columns")
    both = tuples.withColumn("__rel", F.lit(None).cast("struct<schema:string,table:string,columns:array<struct<name:string,oid:bigint,key:boolean>>>")).unionByName(rels.select("seq", "relid", rel.alias("__rel")), allowMissingColumns=True)
    # A feed has a few hot tables: their rows are spread over partitions, and the last relation is carried on.
    known = running_within(both, ["seq"], ["relid"], F.col("__rel"), "__at")
    return known.where("__rel is null").select(*tuples.columns, "__at.*")


def decode_binary_feed(feed: DataFrame, asof: Callable[[DataFrame, DataFrame], DataFrame] = asof_relation) -> DataFrame:
    """(seq, lsn, xid, kind, relid, schema, table, operation, before, after, unchanged_columns) of feed.

    Images are maps from column to JSON value. An unchanged large value is null in the image and named in
    unchanged_columns. Begin and commit rows have null images; rows of unknown relations have a null table. asof finds
    the relation message before each tuple.
    """
    hexed = F.hex("data")
    kind = F.decode(F.substring("data", 1, 1), "UTF-8")
    rows = feed.select("seq", "lsn", "xid", kind.alias("k"), hexed.alias("h"))
    marks = rows.where("k in ('B', 'C')").select("seq", "lsn", "xid", F.when(F.col("k") == "B", "begin").otherwise("commit").alias("kind"))
    data = rows.where("k in ('I', 'U', 'D')").withColumn("relid", _int(F.col("h"), F.lit(3), 4))
    known = asof(data, relations(feed))
    known = known.withColumns({"part": F.decode(F.unhex(F.substring("h", 11, 2)), "UTF-8"), "one": _tuple(F.col("h"), F.lit(13))})
    known = known.withColumn("two", F.when((F.col("k") == "U") & F.col("part").isin("K", "O"), _tuple(F.col("h"), (F.col("one.end") + 2).cast("int"))))
    pair = lambda items: F.zip_with("columns", items, lambda c, i: F.struct(c["name"].alias("name"), c["oid"].alias("oid"), i["kind"].alias("kind"), i["hex"].alias("hex")))

    def image(items: Column) -> Column:
        cells = pair(items)
        values = F.transform(cells, lambda c: pg_value_json(c["kind"], F.unhex(c["hex"]), c["oid"]))
        return F.when(items.isNotNull() & F.col("columns").isNotNull(), F.map_from_arrays(F.transform(cells, lambda c: c["name"]), values))

    op = F.when(F.col("k") == "I", "insert").when(F.col("k") == "U", "update").otherwise("delete")
    new = F.when(F.col("two").isNotNull(), F.col("two.items")).when(F.col("k") != "D", F.col("one.items"))
    old = F.when((F.col("k") == "D") | F.col("two").isNotNull(), F.col("one.items"))
    unchanged = F.transform(F.filter(pair(new), lambda c: c["kind"] == "u"), lambda c: c["name"])
    out = known.select("seq", "lsn", "xid", F.lit("row").alias("kind"), "relid", "schema", "table", op.alias("operation"), image(old).alias("before"), image(new).alias("after"), unchanged.alias("unchanged_columns"))
    return out.unionByName(marks, allowMissingColumns=True)
