"""The health of streaming sources as ordered state with timers (ST-4).

Attempts wait in state until the watermark has passed them, so they apply in time order whatever batches bring them. Timers
in event time end fallback and probation although a source stays silent, and forget a source that is silent for long.
The rows given are the same for any division into batches: one for each attempt and one for each end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from changeledger.shipping import ship

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Times are microseconds inside the processor.
MADE = "source_id string, at long, cause string, failure_streak int, backoff_until long, fallback_until long, probation_until long, reconnects int, errors array<string>, state string"
KEPT = "streak int, backoff long, fallback long, probation long, reconnects int, connected boolean, errors array<string>, last long"
WAITING = "at long, ok boolean, error string"
SECOND = 1_000_000


def with_timers(spark: SparkSession) -> None:
    """Chooses the state store that timers and lists of state need, for streams that start from now on."""
    spark.conf.set(STORE, ROCKS)


class Machine:
    """One source's state: attempts and ends of fallback and probation, applied in time order, give rows."""

    def __init__(self, rules: dict, kept: tuple | None):
        self.rules = rules
        kept = kept or (0, None, None, None, 0, False, [], None)
        self.streak, self.backoff, self.fallback, self.probation, self.reconnects, self.connected, errors, self.last = kept
        self.errors = list(errors)

    def kept(self) -> tuple:
        return (self.streak, self.backoff, self.fallback, self.probation, self.reconnects, self.connected, self.errors, self.last)

    def row(self, at: int, cause: str) -> tuple:
        active = self.backoff is not None and self.backoff > at
        state = "fallback" if self.fallback is not None else "probation" if self.probation is not None else "backoff" if active else "streaming"
        return (at, cause, self.streak, self.backoff, self.fallback, self.probation, self.reconnects, list(self.errors), state)

    def ends(self) -> list[tuple[int, str]]:
        return sorted((t, name) for t, name in ((self.fallback, "fallback"), (self.probation, "probation")) if t is not None)

    def until(self, now: int) -> Iterator[tuple]:
        """Ends up to a time; the end of fallback begins probation."""
        while self.ends() and self.ends()[0][0] <= now:
            at, name = self.ends()[0]
            setattr(self, name, None)
            if name == "fallback":
                self.probation = at + self.rules["probation"]
            yield self.row(at, f"{name} over")

    def attempt(self, at: int, ok: bool, error: str | None) -> tuple:
        rules, self.last = self.rules, at
        if ok:
            self.reconnects += int(self.connected and self.streak > 0)
            self.streak, self.backoff, self.connected = 0, None, True
        else:
            self.streak += 1
            self.errors = [*self.errors, error][-rules["history"] :]
            self.backoff = at + min(rules["most"], rules["base"] * 2 ** min(self.streak - 1, 60))
            if self.streak >= rules["threshold"]:
                self.fallback = at + rules["fallback"]
        return self.row(at, "attempt")


class Health(StatefulProcessor):
    """Orders a source's attempts by the watermark and runs its Machine."""

    def __init__(self, rules: dict):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", KEPT)
        self.waiting = handle.getListState("waiting", WAITING)

    def settle(self, key: tuple, new: list[tuple], watermark_ms: int) -> pd.DataFrame:
        """Applies what the watermark has passed, keeps the rest, and sets the next timer."""
        now = watermark_ms * 1000
        held = [tuple(r) for r in self.waiting.get()] + new
        held.sort(key=lambda r: (r[0], bool(r[1]), r[2] or ""))
        due = [r for r in held if r[0] <= now]
        machine = Machine(self.rules, tuple(self.state.get()) if self.state.exists() else None)
        rows = []
        for at, ok, error in due:
            rows += [*machine.until(at), machine.attempt(at, bool(ok), error)]
        rows += machine.until(now)
        left = held[len(due) :]
        if left:
            self.waiting.put(left)
        else:
            self.waiting.clear()
        gone = None if machine.last is None or left or machine.ends() else machine.last + self.rules["forget"]
        if gone is not None and gone <= now:
            self.state.clear()
        else:
            self.state.update(machine.kept())
            times = [*[t for t, _ in machine.ends()], *([left[0][0]] if left else []), *([gone] if gone is not None else [])]
            if times:
                self.handle.registerTimer(-(-min(times) // 1000))
        names = [c.split()[0] for c in MADE.split(", ")][1:]
        out = pd.DataFrame(rows, columns=names, dtype=object)
        out.insert(0, "source_id", key[0])
        for c in ("backoff_until", "fallback_until", "probation_until"):
            out[c] = out[c].astype("Int64")
        return out.astype({"at": "int64", "failure_streak": "int32", "reconnects": "int32"})

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802
        new = [(int(at), bool(ok), error) for f in rows for at, ok, error in zip(f["us"], f["ok"], f["error"])]
        yield self.settle(key, new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802
        yield self.settle(key, [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def stream_health(
    attempts: DataFrame, threshold: int = 3, fallback_s: float = 30, probation_s: float = 15, base_s: float = 0.5, most_s: float = 10, history: int = 5,
    lateness: str = "10 seconds", forget_s: float = 86_400,
) -> DataFrame:
    """State machine per source over a stream of attempts (source_id, at, ok, error), in event time.

    A failure lengthens the streak and the backoff; from `threshold` failures on the source falls back for a while, and
    then is on probation. A success clears streak and backoff only; the first connect is no reconnect. Attempts of one time
    go by ok, failures first, then by error. Attempts more than `lateness` behind the newest one of all sources are
    dropped; those within it wait until it has passed. A source without attempts for forget_s, fallback and
    probation over, starts anew. Needs the state store of with_timers(), which this call chooses for the session.
    """
    ship(attempts.sparkSession)
    with_timers(attempts.sparkSession)
    us = lambda s: int(s * SECOND)
    rules = {"threshold": threshold, "fallback": us(fallback_s), "probation": us(probation_s), "base": us(base_s), "most": us(most_s), "history": max(1, history), "forget": us(forget_s)}
    rows = attempts.select("source_id", "at", F.unix_micros("at").alias("us"), F.coalesce("ok", F.lit(False)).alias("ok"), "error").withWatermark("at", lateness)
    made = rows.groupBy("source_id").transformWithStateInPandas(Health(rules), MADE, "Update", "EventTime")
    times = {c: F.timestamp_micros(c) for c in ("at", "backoff_until", "fallback_until", "probation_until")}
    return made.withColumns(times)
