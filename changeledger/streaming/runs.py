"""Streams of change events (ST-1 to ST-8)."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeledger.operators.ledger import upsert_latest
from changeledger.operators.versions import FAN, Versions


def stream_feed(spark: SparkSession, path: str, schema, decode: Callable[[DataFrame], DataFrame] | None = None, form: str = "parquet", files: int = 100) -> DataFrame:
    """A landed feed as a stream, decoded by one of the stateless feed functions."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(form).load(path)
    return decode(rows) if decode else rows


def deliver_batch(sink: str, key: Sequence[str] = ("source_id", "external_ref"), stream: str = "main", fan: int = FAN) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that appends only events the ledger, a versioned table at `sink`, does not hold.

    Only files whose filters may hold a key of the batch are opened, and a batch adds one small file; fan of them are
    merged. A commit's tag is stream, run (the id that a query keeps with its checkpoint) and batch: a batch that runs
    again after a crash compares with what all others wrote and replaces its own rows; another stream, or the same one after its
    checkpoint was reset, never replaces them. Of a key's rows in one batch the greatest stays, so a replay stores the
    same values. The streams of one ledger run one after another. Batches that were merged by then are not replaced:
    their rows are known, and nothing is doubled.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        tag = f"{stream}/{query}/{batch_id}"
        table = Versions(spark, sink, key)
        fresh = upsert_latest(batch, list(key), []).persist()
        try:
            now = table.manifest()
            paths = table.candidates(fresh, now, tag)
            rows = fresh.join(table.load(paths, now["schema"]).select(*key), list(key), "left_anti") if paths else fresh
            if not rows.isEmpty() or any(f["tag"] == tag for f in now["files"]):
                table.commit(rows, tag, count=fresh.count())
                table.compact(fan)
        finally:
            fresh.unpersist()

    return run


def run_once(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Drains what is there and stops."""
    query = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_forever(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, interval: str = "5 seconds", max_loops: int | None = None) -> StreamingQuery:
    """Polls at an interval; with max_loops it stops after that many batches."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()
    while max_loops is not None and query.isActive and (query.lastProgress is None or query.lastProgress["batchId"] + 1 < max_loops):
        time.sleep(0.1)
    if max_loops is not None:
        query.stop()
    return query


def drift_check(current: Callable[[SparkSession], DataFrame], on_change: Callable[[DataFrame], None], each: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Before each batch, sources whose signature changed go to on_change."""

    def run(batch: DataFrame, batch_id: int) -> None:
        on_change(current(batch.sparkSession).where("changed"))
        each(batch, batch_id)

    return run


def snapshot_every(
    seconds: float, take: Callable[[SparkSession, int], None], each: Callable[[DataFrame, int], None], mark: str, clock: Callable[[], float] = time.time
) -> Callable[[DataFrame, int], None]:
    """After a batch, a snapshot if the last one is at least `seconds` old; its time is kept at `mark` over restarts."""

    def run(batch: DataFrame, batch_id: int) -> None:
        each(batch, batch_id)
        spark, now = batch.sparkSession, clock()
        jpath = spark._jvm.org.apache.hadoop.fs.Path(mark)
        known = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)
        last = spark.read.schema("at double").parquet(mark).agg(F.max("at")).first()[0] if known else None
        if last is None or now - last >= seconds:
            take(spark, batch_id)
            spark.createDataFrame([(float(now),)], "at double").coalesce(1).write.mode("append").parquet(mark)

    return run


def delivery_status(stream: DataFrame) -> DataFrame:
    """Latest status per request, for update mode."""
    return upsert_latest(stream.select("request_id", "status", "updated_at"), ["request_id"], ["updated_at"])

