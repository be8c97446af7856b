"""Status, metrics and health of sources (AG-1 to AG-3, AG-7, AG-8, AG-12, AG-13, WIN-9)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeledger.functions import status as S
from changeledger.functions import tokens as K
from changeledger.operators.prefix import since_last

#: Bytes of retained and unflushed log from which a slot is reported.
RETAINED_WARN, FLUSH_WARN = 268_435_456, 67_108_864


def source_status(sources: DataFrame, controls: DataFrame, signatures: DataFrame, checkpoints: DataFrame, deliveries: DataFrame, proofs: DataFrame, dlq: DataFrame) -> DataFrame:
    """One row per source: paused, has_signature, token, delivery_count, proof_count, dlq_count."""
    count = lambda df, name: df.groupBy("source_id").agg(F.count("*").alias(name))
    parts = [
        controls.select("source_id", "paused"), signatures.select("source_id", F.lit(True).alias("has_signature")), checkpoints.select("source_id", "token"),
        count(deliveries, "delivery_count"), count(proofs, "proof_count"), count(dlq, "dlq_count"),
    ]
    out = reduce(lambda a, b: a.join(b, "source_id", "left"), parts, sources.select("source_id"))
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("delivery_count", "proof_count", "dlq_count")}
    return out.withColumns({"paused": F.coalesce("paused", F.lit(False)), "has_signature": F.coalesce("has_signature", F.lit(False)), **zero})


def fleet_metrics(status: DataFrame, health: DataFrame) -> DataFrame:
    """A metric row per source and one of totals (source_id null)."""
    rows = status.join(health.select("source_id", "severity"), "source_id", "left").withColumn("severity", F.coalesce("severity", F.lit("healthy")))
    tally = lambda s: F.count_if(F.col("severity") == s)
    return rows.rollup("source_id").agg(
        F.count("*").alias("source_count"), tally("healthy").alias("ok_count"), F.count_if("paused").alias("paused_count"), F.sum("delivery_count").alias("delivery_count"), F.sum("proof_count").alias("proof_count"),
        F.sum("dlq_count").alias("dlq_count"), tally("degraded").alias("degraded_count"), tally("critical").alias("critical_count"), tally("error").alias("error_count"),
    )


def overall_severity(findings: DataFrame) -> DataFrame:
    """Worst severity and numbers of warnings and errors over config, service and source findings."""
    return findings.agg(S.max_severity(F.col("severity")).alias("severity"), F.sum(F.size("warnings")).cast("long").alias("warning_count"), F.sum(F.size("errors")).cast("long").alias("error_count"))


def slot_lag(slots: DataFrame, retained_warn: int = RETAINED_WARN, flush_warn: int = FLUSH_WARN) -> DataFrame:
    """slots (current_lsn, restart_lsn, confirmed_lsn) with retained_bytes, flush_bytes, pending and both warnings."""
    now = K.lsn_to_long(F.col("current_lsn"))
    out = slots.withColumns({"retained_bytes": now - K.lsn_to_long(F.col("restart_lsn")), "flush_bytes": now - K.lsn_to_long(F.col("confirmed_lsn"))})
    return out.withColumns({"pending": F.col("flush_bytes") > 0, "retained_warning": F.col("retained_bytes") > retained_warn, "flush_warning": F.col("flush_bytes") > flush_warn})


def run_summary(results: DataFrame) -> DataFrame:
    """(source_id, processed, failed) in events: a failed batch counts all of its members."""
    return results.groupBy("source_id").agg(F.sum(F.when(F.col("ok"), F.col("members")).otherwise(0)).cast("long").alias("processed"), F.sum(F.when(~F.col("ok"), F.col("members")).otherwise(0)).cast("long").alias("failed"))


def warnings(retained_warn: int = RETAINED_WARN, flush_warn: int = FLUSH_WARN) -> Column:
    """Names of what is wrong with a source's inspected state, in the order of report."""
    is_false = lambda c: F.col(c).eqNullSafe(False)
    is_true = lambda c: F.col(c).eqNullSafe(True)
    streak = F.coalesce("failure_streak", F.lit(0))
    found = [
        F.when(is_false("slot_exists"), "slot missing"), F.when(is_false("publication_in_sync"), "publication out of sync"), F.when(is_false("replica_identity_in_sync"), "replica identity out of sync"),
        F.when(is_true("fallback_active"), F.concat(F.lit("fallback after "), F.coalesce("fallback_reason", F.lit("runtime_error")))), F.when(is_true("probation_active"), F.concat(F.lit("probation after "), F.coalesce("probation_reason", F.lit("fallback_recovery")))),
        F.when(is_true("backoff_active"), F.concat(F.lit("backoff after "), F.coalesce("last_error_kind", F.lit("runtime_error")))).when(streak > 0, F.concat(streak.cast("string"), F.lit(" failures, last "), F.coalesce("last_error_kind", F.lit("runtime_error")))),
        F.when(F.col("retained_bytes") > retained_warn, "retained log above threshold"), F.when(F.col("flush_bytes") > flush_warn, "flush lag above threshold"),
    ]
    return F.filter(F.array(*found), lambda w: w.isNotNull())


def source_health(inspected: DataFrame, retained_warn: int = RETAINED_WARN, flush_warn: int = FLUSH_WARN) -> DataFrame:
    """inspected with warnings and severity; a missing slot is critical, backoff from three failures on too."""
    out = inspected.withColumn("warnings", warnings(retained_warn, flush_warn))
    worst = (
        F.when(F.size("warnings") == 0, "healthy").when(F.col("slot_exists").eqNullSafe(False), "critical").when(F.col("fallback_active").eqNullSafe(True) | F.col("probation_active").eqNullSafe(True), "degraded")
        .when(F.col("backoff_active").eqNullSafe(True) & (F.coalesce("failure_streak", F.lit(0)) >= 3), "critical").otherwise("degraded")
    )
    return out.withColumn("severity", worst)


def source_report(status: DataFrame, health: DataFrame, coverage: DataFrame, slots: DataFrame) -> DataFrame:
    """One nested row per source: severity, counts, coverage, slot and warnings; a failed inspection is severity error."""
    out = status.join(health.select("source_id", "severity", "warnings"), "source_id", "left").join(coverage, "source_id", "left").join(slots.select("source_id", "retained_bytes", "flush_bytes"), "source_id", "left")
    return out.select(
        "source_id", F.coalesce("severity", F.lit("error")).alias("severity"), F.struct("delivery_count", "proof_count", "dlq_count").alias("counts"), F.struct("tracked_objects", "tables", "collections").alias("coverage"),
        F.struct("retained_bytes", "flush_bytes").alias("slot"), "paused", F.coalesce("warnings", F.array(F.lit("not inspected"))).alias("warnings"),
    )


def failure_streaks(attempts: DataFrame) -> DataFrame:
    """attempts (source_id, at, ok, perhaps error) with streak: failures in a row up to and with this attempt, since the
    last success.

    Attempts of one time go by ok, failures first, and then by error. A source with very many attempts is spread over
    partitions.
    """
    order = [c for c in ("at", "ok", "error") if c in attempts.columns]
    return since_last(attempts, order, ["source_id"], F.coalesce("ok", F.lit(False)), "streak")


def recent_errors(attempts: DataFrame, k: int = 5) -> DataFrame:
    """(source_id, n, at, error): the last k errors of each source, n = 1 the latest."""
    order = Window.partitionBy("source_id").orderBy(F.col("at").desc())
    return attempts.where(~F.col("ok")).withColumn("n", F.row_number().over(order).cast("long")).where(F.col("n") <= k).select("source_id", "n", "at", "error")
