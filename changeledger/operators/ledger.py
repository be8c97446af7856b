"""The delivery ledger as joins over landed response tables (JN-5 to JN-7, WIN-8, LG-1 to LG-7, SNK-1 to SNK-4)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from changeledger.functions import canonical as C
from changeledger.functions import status as S
from changeledger.model import CHANGE_EVENT, EVENT_COLUMNS
from changeledger.operators.versions import Versions

#: Statuses that a later run can resume, best last.
STATUSES = ("prepared_registered", "broadcast_included", "finalized_exported")
#: Actions of single and batch requests.
ACTIONS = {False: "submit", True: "submitroot"}


@dataclass(frozen=True)
class LedgerConfig:
    submitter: str
    schema_id: int
    policy_id: int
    wait_for_finality: bool = False


def _ordered(kind: DataType) -> bool:
    """Whether values of a type can be compared."""
    if isinstance(kind, ArrayType):
        return _ordered(kind.elementType)
    if isinstance(kind, StructType):
        return all(_ordered(f.dataType) for f in kind)
    return not isinstance(kind, (MapType, VariantType))


def upsert_latest(log: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Latest row per key of an append-only log: whole rows win, as one maximum that combines before the shuffle.

    Of rows with equal order the one with the greatest remaining columns wins, maps and variants aside.
    """
    rest = [c for c in log.columns if c not in key]
    ties = [f.name for f in log.schema if f.name in rest and f.name not in order and _ordered(f.dataType)]
    best = log.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order, *ties)).alias("__r"))
    return best.select(*key, *[F.col(f"__r.{c}") for c in rest]).select(*log.columns)


def status_rank(status: Column) -> Column:
    out = None
    for rank, name in enumerate(STATUSES, 1):
        out = F.when(status == name, rank) if out is None else out.when(status == name, rank)
    return out.otherwise(0)


def best_delivery(deliveries: DataFrame) -> DataFrame:
    """The delivery to resume per (source_id, external_ref): best status, then latest update, then greatest request."""
    usable = deliveries.where(F.col("status").isin(*STATUSES) & F.col("prepared_action").isNotNull())
    return upsert_latest(usable.withColumn("__rank", status_rank(F.col("status"))), ["source_id", "external_ref"], ["__rank", "updated_at", "request_id"]).drop("__rank")


def reuse_deliveries(envelopes: DataFrame, deliveries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(todo, done): envelopes still to deliver with their prior_* columns, and those already finalized."""
    prior = best_delivery(deliveries)
    prior = prior.select("source_id", "external_ref", *[F.col(c).alias(f"prior_{c}") for c in ("request_id", "status", "tx_id", "prepared_action")])
    joined = envelopes.join(prior, ["source_id", "external_ref"], "left")
    finished = F.col("prior_status").eqNullSafe("finalized_exported")
    return joined.where(~finished), joined.where(finished)


def mismatch(cfg: LedgerConfig, batch: bool = False) -> Column:
    """Reason of the first rule that a prepared response breaks, null for a good one.

    Columns: external_ref (expected), verification_account, external_ref_hash, object_hash or root_hash, manifest_hash
    and leaf_count of the response, and prepared_action (contract, action, data).
    """
    data, text = "prepared_action.data.", lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rules = [
        (F.col("prepared_action.data").isNull(), "data missing"),
        (text("prepared_action.contract") != text("verification_account"), "contract"),
        (text("prepared_action.action") != ACTIONS[batch], "action"),
        (text("external_ref_hash") != text("external_ref"), "external_ref_hash"),
        (text(data + "submitter") != cfg.submitter, "submitter"),
        (F.coalesce(F.col(data + "schema_id"), F.lit(0)) != cfg.schema_id, "schema_id"),
        (F.coalesce(F.col(data + "policy_id"), F.lit(0)) != cfg.policy_id, "policy_id"),
        (text(data + "external_ref") != text("external_ref"), "external_ref"),
    ]
    if batch:
        rules += [((text("root_hash") == "") | (text("manifest_hash") == "") | F.col("leaf_count").isNull(), "batch hashes missing")]
        rules += [(text(data + c) != text(c), c) for c in ("root_hash", "manifest_hash")]
        rules += [(F.coalesce(F.col(data + "leaf_count"), F.lit(-1)) != F.col("leaf_count"), "leaf_count")]
    else:
        rules += [(text("object_hash") == "", "object_hash missing"), (text(data + "object_hash") != text("object_hash"), "object_hash")]
    return F.coalesce(*[F.when(cond, F.lit(name)) for cond, name in rules])


def validate_prepared(expected: DataFrame, prepared: DataFrame, cfg: LedgerConfig, batch: bool = False) -> DataFrame:
    """expected rows with their response and `reason`: the first broken rule, or `no response`.

    Of several responses to one reference the one with the greatest request id counts.
    """
    one = upsert_latest(prepared, ["external_ref_hash"], ["request_id"])
    joined = expected.join(one.withColumn("__ref", F.col("external_ref_hash")), F.col("external_ref") == F.col("__ref"), "left")
    return joined.withColumn("reason", F.when(F.col("__ref").isNull(), "no response").otherwise(mismatch(cfg, batch))).drop("__ref")


def finalize(deliveries: DataFrame, broadcasts: DataFrame, receipts: DataFrame, audit: DataFrame) -> DataFrame:
    """deliveries (request_id, ...) with tx_id, block_num, finalized: receipt and audit chain present and final.

    Transaction and block come from the receipt, else from the broadcast. Repeated answers to one request count once: a
    final receipt before others, an included broadcast before others, then one without error, then the latest block.
    """
    final = S.receipt_is_finalized(F.col("trust_state"), F.col("finality_flag"), F.col("finalized_at"))
    rank = {"__in": F.coalesce(F.col("block_num") > 0, F.lit(False)), "__clean": F.col("error").isNull()}
    broadcasts = upsert_latest(broadcasts.withColumns(rank), ["request_id"], ["__in", "__clean", "block_num", "tx_id"])
    receipts = upsert_latest(receipts.withColumn("__f", F.coalesce(final, F.lit(False))), ["request_id"], ["__f", "block_num", "tx_id"])
    b = broadcasts.select("request_id", F.col("tx_id").alias("__bt"), F.col("block_num").alias("__bb"), F.col("error").alias("broadcast_error"))
    r = receipts.select("request_id", F.col("tx_id").alias("__rt"), F.col("block_num").alias("__rb"), S.receipt_is_finalized(F.col("trust_state"), F.col("finality_flag"), F.col("finalized_at")).alias("__final"))
    a = audit.select("request_id", F.lit(True).alias("__audit")).distinct()
    out = deliveries.join(b, "request_id", "left").join(r, "request_id", "left").join(a, "request_id", "left")
    return out.withColumns({
        "tx_id": F.coalesce("__rt", "__bt"), "block_num": F.coalesce("__rb", "__bb"), "included": F.coalesce(F.col("__bb") > 0, F.lit(False)), "finalized": F.coalesce(F.col("__final") & F.col("__audit"), F.lit(False)),
    }).drop("__bt", "__bb", "__rt", "__rb", "__final", "__audit")


def resolve_status(cfg: LedgerConfig) -> tuple[Column, Column]:
    """(status, last_error) of a request from reason, broadcast_error, included and finalized.

    A duplicate submit is no failure where finality is awaited and the receipt is final.
    """
    duplicate = S.is_duplicate_submit(F.col("broadcast_error")) & F.col("finalized") & F.lit(cfg.wait_for_finality)
    error = F.when(F.col("reason").isNotNull(), F.col("reason")).when(F.col("broadcast_error").isNotNull() & ~duplicate, F.col("broadcast_error"))
    status = F.when(error.isNotNull() & S.should_mark_failed(error, F.when(F.col("included"), F.col("block_num")), F.lit(None).cast("string"), F.lit(None).cast("string")), "failed")
    status = status.when(F.col("finalized"), "finalized_exported").when(F.col("included"), "broadcast_included").otherwise("prepared_registered")
    return status, error


def notarize_singles(envelopes: DataFrame, prior: DataFrame, prepared: DataFrame, broadcasts: DataFrame, receipts: DataFrame, audit: DataFrame, cfg: LedgerConfig) -> DataFrame:
    """Single path: envelopes not yet finalized with request_id, status, tx_id, block_num, last_error and ok.

    ok tells whether the checkpoint may pass the event: inclusion is enough unless finality is awaited.
    """
    todo, _ = reuse_deliveries(envelopes, prior)
    checked = validate_prepared(todo, prepared, cfg).withColumn("request_id", F.coalesce("prior_request_id", "request_id"))
    checked = checked.withColumn("reason", F.when(F.col("prior_request_id").isNull(), F.col("reason")))
    out = finalize(checked, broadcasts, receipts, audit)
    status, error = resolve_status(cfg)
    out = out.withColumns({"status": status, "last_error": error})
    good = F.col("status").isin("finalized_exported", *([] if cfg.wait_for_finality else ["broadcast_included"]))
    return out.withColumn("ok", good).withColumn("request_id", F.when((F.col("status") == "failed") & F.col("request_id").isNull(), F.col("external_ref")).otherwise(F.col("request_id")))


def notarize_batches(batches: DataFrame, prior: DataFrame, prepared: DataFrame, broadcasts: DataFrame, receipts: DataFrame, audit: DataFrame, cfg: LedgerConfig) -> DataFrame:
    """Batch path over rows (source_id, batch_no, leaf_count, batch_external_ref, last_token): as single, one row per batch."""
    rows = batches.withColumnRenamed("batch_external_ref", "external_ref").withColumnRenamed("leaf_count", "members")
    todo, _ = reuse_deliveries(rows, prior)
    checked = validate_prepared(todo, prepared, cfg, batch=True).withColumn("request_id", F.coalesce("prior_request_id", "request_id"))
    checked = checked.withColumn("reason", F.when(F.col("prior_request_id").isNull(), F.col("reason")))
    status, error = resolve_status(cfg)
    out = finalize(checked, broadcasts, receipts, audit).withColumns({"status": status, "last_error": error})
    return out.withColumn("ok", F.col("status").isin("finalized_exported", *([] if cfg.wait_for_finality else ["broadcast_included"])))


def recover_duplicates(broadcasts: DataFrame, receipts: DataFrame, audit: DataFrame, wait_for_finality: bool = True) -> DataFrame:
    """(request_id, recovered) of duplicate submits: finalized from the receipt, where finality is awaited."""
    hit = broadcasts.where(S.is_duplicate_submit(F.col("error"))).select("request_id")
    done = finalize(hit, broadcasts, receipts, audit)
    return done.select("request_id", (F.col("finalized") & F.lit(wait_for_finality)).alias("recovered"))


def pending_finality(deliveries: DataFrame) -> DataFrame:
    """Pending deliveries per source."""
    return deliveries.groupBy("source_id").agg(F.count_if(F.col("status").isin(*STATUSES[:2])).alias("pending"))


def reconcile_queue(deliveries: DataFrame, sources: DataFrame, limit: int = 0) -> DataFrame:
    """Pending deliveries, sources in their configured order (source_idx), oldest first; the limit is global."""
    queue = deliveries.where(F.col("status").isin(*STATUSES[:2])).join(sources.select("source_id", "source_idx"), "source_id")
    queue = queue.orderBy("source_idx", "updated_at", "request_id")
    return queue.limit(limit) if limit > 0 else queue


def stored_events(deliveries: DataFrame) -> DataFrame:
    """(request_id, trace_id, event columns, envelope columns): events and envelopes rebuilt from stored payloads; the stored trace id stays."""
    event = F.from_json("event_payload", CHANGE_EVENT).alias("e")
    rows = deliveries.where("event_payload is not null").select("request_id", "trace_id", event)
    rows = rows.select("request_id", F.col("trace_id").alias("__trace"), *[F.col(f"e.{c}") for c in EVENT_COLUMNS])
    return C.envelope(rows).withColumn("trace_id", F.col("__trace")).drop("__trace")


def reconcile(deliveries: DataFrame, sources: DataFrame, broadcasts: DataFrame, receipts: DataFrame, audit: DataFrame, limit: int = 0) -> DataFrame:
    """The queue with its new status: finalized where receipt and audit chain are final, else unchanged with last_error.

    Only rows that store their prepared action and event payload can be finalized; the others stay as they are, with
    checked false. Transaction and block of a queued row stay where no answer has others. stored_events() rebuilds the
    events and envelopes for export.
    """
    queue = reconcile_queue(deliveries, sources, limit)
    old = {c: f"__{c}" for c in ("tx_id", "block_num", "last_error") if c in queue.columns}
    out = finalize(queue.withColumnsRenamed(old), broadcasts, receipts, audit)
    whole = F.col("prepared_action").isNotNull() & F.col("event_payload").isNotNull()
    final = whole & F.col("finalized")
    before = lambda c: F.col(old[c]) if c in old else F.lit(None)
    kept = {c: F.when(whole, F.coalesce(c, before(c))).otherwise(before(c)) for c in ("tx_id", "block_num")}
    error = F.when(whole & ~F.col("finalized"), F.lit("not final")).when(~whole, before("last_error"))
    status = F.when(final, "finalized_exported").otherwise(F.col("status"))
    return out.withColumns({"checked": whole, "reconciled": final, "last_error": error, "status": status, **kept}).drop(*old.values())


def advance_checkpoints(results: DataFrame) -> DataFrame:
    """(source_id, token): token of the last good event per source; it passes over earlier failures, which are in the DLQ."""
    return results.where("ok").groupBy("source_id").agg(F.max_by("checkpoint_token", "seq").alias("token"))


def route_failures(results: DataFrame, events: DataFrame | None = None, by: list[str] = ("source_id", "batch_no"), created_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(deliveries, dlq) of failed results; a failed result without a request has its reference as request id.

    events are the chunked events of the same run: every member of a failed batch becomes a DLQ row with the batch's
    error. Without them each result is an event itself, and the failed ones are returned for dlq_rows.
    """
    failed = results.where("status = 'failed'")
    deliveries = failed.select(F.coalesce("request_id", "external_ref").alias("request_id"), "source_id", "external_ref", "status", "last_error")
    if events is None:
        return deliveries, failed
    lost = failed.select(*by, F.col("last_error").alias("__error"))
    return deliveries, dlq_rows(events.join(lost, list(by)), F.col("__error"), created_at)


def gate_ready(events: DataFrame, readiness: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ready, gated): events of sources that are ready, and the others, which go to the DLQ with a reason."""
    joined = events.join(readiness.select("source_id", "ready"), "source_id", "left")
    ok = F.coalesce("ready", F.lit(False))
    return joined.where(ok).drop("ready"), joined.where(~ok).drop("ready").withColumn("reason", F.lit("source is not ready"))


def dlq_rows(failed: DataFrame, reason: Column, created_at: Column | None = None) -> DataFrame:
    """(source_id, reason, payload, created_at): payload is the event's JSON with its identity key."""
    fields = sorted([*[c for c in failed.columns if c in ("after", "before", "change_version", "checkpoint_token", "commit_timestamp", "database_name", "metadata", "mode", "operation", "primary_key", "schema_or_namespace", "source_id", "source_instance", "source_type", "table_or_collection")], "identity_key"])
    raw = ("after", "before", "metadata", "primary_key")
    rows = failed if "identity_key" in failed.columns else failed.withColumn("identity_key", C.identity_key())
    parts = [F.concat(F.lit(f'"{c}":'), F.coalesce(F.col(c) if c in raw else C.quote(F.col(c)), F.lit("null"))) for c in fields]
    return rows.select("source_id", reason.alias("reason"), F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("payload"), (F.current_timestamp() if created_at is None else created_at).alias("created_at"))


def proof_bundles(finalized: DataFrame, members: DataFrame | None = None, by: list[str] = ("batch_no",)) -> DataFrame:
    """Rows to export: source_id, request_id, mode, path, safe and the payload columns; batches carry members in event order."""
    path = F.concat(F.col("source_id"), F.lit("/"), F.col("request_id"), F.lit(".json"))
    safe = S.safe_name(F.col("source_id")) & S.safe_name(F.col("request_id"))
    out = finalized
    if members is not None:
        packed = members.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("seq", "external_ref"))).alias("__m"))
        out = out.join(packed.select(*by, F.transform("__m", lambda m: m["external_ref"]).alias("members")), list(by), "left")
    return out.withColumns({"mode": F.lit("single" if members is None else "batch"), "path": path, "safe": safe})


def write_bundles(bundles: DataFrame, directory: str, run: str) -> int:
    """Commits the safe bundles of one run as JSON lines to the versioned table at `directory`; returns the version.

    Files follow bytes, not requests. The same run again replaces its own rows; a request that a later run exports again
    is what read_bundles() gives.
    """
    table = Versions(bundles.sparkSession, directory, form="json")
    rows = bundles.where("safe").drop("safe").withColumn("exported", F.lit(table.manifest()["version"] + 1))
    return table.commit(rows, run)


def read_bundles(spark: SparkSession, directory: str) -> DataFrame:
    """The last export of every request."""
    return upsert_latest(Versions(spark, directory, form="json").read(), ["source_id", "request_id"], ["exported"]).drop("exported")


def write_dlq(rows: DataFrame, directory: str, run: str) -> None:
    """Dead letters of one run (a batch, a cycle); the same run again replaces its own rows and doubles none."""
    replace = rows.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    replace.partitionBy("run").parquet(directory)


def list_ledger(log: DataFrame, order: str, source_id: str | None = None, descending: bool = True) -> DataFrame:
    """Ledger rows in their listing order, of one source if given."""
    rows = log if source_id is None else log.where(F.col("source_id") == source_id)
    return rows.orderBy(F.col(order).desc() if descending else F.col(order))
