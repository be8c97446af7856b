"""Rules over statuses and error texts (FN-16 to FN-18, FN-22 to FN-27)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Markers of errors that a later attempt may clear.
RETRYABLE = (
    "http request failed: 502",
    "http request failed: 503",
    "http request failed: 504",
    "rpc call failed:",
    "timed out",
    "did not finalize in time",
    "temporarily unavailable",
    "connection reset",
    "connection aborted",
    "connection refused",
)
#: Messages of a second submit.
DUPLICATE = ("duplicate request for submitter", "duplicate batch request for submitter")
OPERATIONS = ("insert", "update", "delete", "snapshot")
SEVERITIES = ("healthy", "degraded", "critical", "error")
#: Stream error kinds; the first whose groups all match wins, a group by any of its words.
STREAM_ERRORS = (
    ("timeout", (("timeout",),)),
    ("protocol_error", (("copy_both", "replication frame"),)),
    ("publication_error", (("publication", "replica identity"),)),
    ("slot_conflict", (("slot",), ("active", "in use"))),
    ("connection_lost", (("connection", "closed", "broken pipe", "eof"),)),
)


def _any(text: Column, markers) -> Column:
    out = F.lit(False)
    for m in markers:
        out = out | text.contains(m)
    return F.coalesce(out, F.lit(False))


def map_operation(code: Column) -> Column:
    """insert, update or delete from I/U/D, full words or replace; anything else is an error."""
    c = F.upper(F.trim(code.cast("string")))
    known = F.when(c.isin("I", "INSERT"), "insert").when(c.isin("U", "UPDATE", "REPLACE"), "update").when(c.isin("D", "DELETE"), "delete")
    return F.coalesce(known, F.raise_error(F.concat(F.lit("unknown operation "), F.coalesce(c, F.lit("null")))).cast("string"))


def derive_primary_key(before: Column, after: Column, columns: list[str]) -> Column:
    """Key values as text from the after image, else the before image (maps); an empty image counts as missing."""
    source = F.when(F.size(after) > 0, after).otherwise(before)
    return F.array(*[source[c] for c in columns])


def derive_commit_timestamp(after: Column, before: Column, epoch: Column | None = None) -> Column:
    """First known commit time; an epoch of 0 or less counts as missing; else now."""
    first = F.coalesce(after, before)
    if epoch is not None:
        first = F.coalesce(first, F.when(epoch > 0, F.timestamp_seconds(epoch)))
    return F.coalesce(first, F.current_timestamp())


def event_start_pos(packet_pos: Column, size: Column, stream_pos: Column) -> Column:
    """Start of a row event: its end less its size, 4 at least. Without a size it is the end, without an end the position
    of the stream, and 4 if that is unknown too. Zero and null are unknown."""
    four = F.lit(4).cast("long")
    started = F.when((packet_pos > 0) & (size > 0), F.greatest(four, packet_pos - size))
    return started.when(packet_pos > 0, packet_pos).when(stream_pos > 0, stream_pos).otherwise(four)


def classify_stream_error(text: Column) -> Column:
    low, out = F.lower(text), None
    for kind, groups in STREAM_ERRORS:
        hit = F.lit(True)
        for words in groups:
            hit = hit & _any(low, words)
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("runtime_error")


def is_retryable(text: Column, polling: bool = False) -> Column:
    """While polling, a request that did not finalize in time is not retried."""
    return _any(F.lower(text), [m for m in RETRYABLE if not (polling and m.startswith("did not finalize"))])


def is_duplicate_submit(text: Column) -> Column:
    return _any(text, DUPLICATE)


def should_mark_failed(text: Column, block_num: Column, prior_status: Column, prior_tx: Column) -> Column:
    """False only for a retryable error of work that a block already holds."""
    included = F.coalesce(block_num > 0, F.lit(False)) | F.coalesce((prior_status == "broadcast_included") & (prior_tx != ""), F.lit(False))
    return ~(is_retryable(text) & included)


def receipt_is_finalized(trust_state: Column, finality_flag: Column, finalized_at: Column) -> Column:
    """Whether a receipt is final by its trust state, in any letter case, its flag, or a time of finality that is not empty."""
    trusted = F.lower(trust_state).isin("finalized", "finalized_verified")
    return F.coalesce(trusted, F.lit(False)) | F.coalesce(finality_flag, F.lit(False)) | F.coalesce(finalized_at.cast("string") != "", F.lit(False))


def backoff_delay(streak: Column, base: float = 0.5, most: float = 10.0) -> Column:
    """Seconds to wait after `streak` failures in a row."""
    return F.when(streak > 0, F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), F.least(streak - 1, F.lit(60))))).otherwise(F.lit(0.0))


def retry_delays(attempts: Column, base: float = 0.1) -> Column:
    """Delays between attempts, one fewer than attempts."""
    return F.when(attempts > 1, F.transform(F.sequence(F.lit(0), attempts - 2), lambda i: F.lit(base) * F.pow(F.lit(2.0), i))).otherwise(F.array().cast("array<double>"))


def severity_rank(severity: Column) -> Column:
    out = None
    for rank, name in enumerate(SEVERITIES):
        out = F.when(severity == name, rank) if out is None else out.when(severity == name, rank)
    return out.otherwise(len(SEVERITIES) - 1)


def max_severity(severity: Column) -> Column:
    """Aggregate: the worst severity; healthy where there is none."""
    return F.coalesce(F.max_by(severity, severity_rank(severity)), F.lit("healthy"))


def safe_name(name: Column) -> Column:
    """A plain path component: not blank, and no dots alone, blanks around them aside."""
    return F.coalesce(name.rlike(r"^[^/\\\x00]+$") & ~F.regexp_replace(name, r"^\s+|\s+$", "").isin("", ".", ".."), F.lit(False))


def validate_images(operation: Column, pk: Column, request_id: Column, numbers: list[Column] = ()) -> Column:
    """Reasons why an event cannot be delivered; empty for a good one."""
    checks = [
        F.when(~F.coalesce(operation.isin(*OPERATIONS), F.lit(False)), "unknown operation"),
        F.when(pk.isNull() | F.exists(pk, lambda v: v.isNull()), "missing primary key"),
        F.when(~safe_name(request_id), "unsafe id"),
    ] + [F.when(F.isnan(n), "not a number") for n in numbers]
    return F.filter(F.array(*checks), lambda r: r.isNotNull())
