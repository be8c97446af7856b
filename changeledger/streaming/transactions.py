"""Transactions and relation messages that span micro-batches (WIN-1, WIN-2, JN-10, SRC-9 on streams).

A feed is landed in the order of its log: rows of a later micro-batch have greater `seq`. Inside a batch rows come in any
order, and those of one key are held by one task, so a feed lands in files of bounded size. What is open at a batch's end
waits in the state store.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from changeledger.operators.scratch import place
from changeledger.shipping import ship
from changeledger.sources.binary import RELATION, asof_relation, decode_binary_feed, relations
from changeledger.streaming.health import with_timers

WAITING = pa.schema([("own", pa.string()), ("seq", pa.int64()), ("lsn", pa.string()), ("body", pa.string())])
MADE = "source_id string, xid string, seq long, lsn string, event_index long, total long, commit_lsn string, advance boolean, body string"
#: Rows in an entry of the state, and rows given at a time.
PART, OUT = 10_000, 100_000
#: JSON of packed columns keeps microseconds.
EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def ordered(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """A key's rows of one micro-batch by seq."""
    return pd.concat(list(rows)).sort_values("seq", kind="stable")


def filled(values: np.ndarray) -> np.ndarray:
    """Texts with missing and empty ones as None."""
    return np.array([None if v is None or v != v or v == "" else v for v in values], dtype=object)


def groups(batch: pd.DataFrame, given: str | None) -> tuple[pd.DataFrame, str | None]:
    """A source's ordered rows with `own`, their transaction, and `turn`, how many commits of it came before; and the open begin.

    A row or commit without xid takes that of the begin before it, unless a commit has come since.
    """
    xid, kind = filled(batch["xid"].to_numpy(object)), batch["kind"].to_numpy(object)
    begin, commit = kind == "begin", kind == "commit"
    marks = np.maximum.accumulate(np.where(begin | commit, np.arange(1, len(kind) + 1), 0))
    after = np.concatenate(([given], np.where(begin, xid, None)))  # what a mark leaves open, by its place plus one
    open_before = after[np.concatenate(([0], marks[:-1]))]
    own = np.where(pd.isna(xid), open_before, xid)
    out = batch.assign(own=np.where(pd.isna(own), "", own), commit=commit)[~begin]
    out["turn"] = out.groupby("own", sort=False)["commit"].cumsum() - out["commit"]
    return out, after[marks[-1]]


def packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows[["own", "seq", "lsn", "body"]], WAITING, preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, WAITING) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def unpacked(blob: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(blob).read_all().to_pandas()


def hashes(names: pd.Series) -> np.ndarray:
    return pd.util.hash_array(np.asarray(names, dtype=object))


class Transactions(StatefulProcessor):
    """Holds a source's open transactions and gives a transaction's rows when its commit comes.

    What begins and ends in one micro-batch never enters the state. Rows of open transactions wait together in entries of
    PART rows, and `current` lists hash and entry of each of them, so a batch asks for the entries that it needs alone.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getValueState("current", "xid string, next long, h binary, part binary")
        self.rows = handle.getMapState("rows", "part long", "packed binary")

    def load(self, part: int) -> pd.DataFrame:
        return unpacked(bytes(self.rows.getValue((part,))[0]))

    def release(self, source: str, ends: pd.Series, new: pd.Series, parts: np.ndarray, counts: pd.Series) -> Iterator[pd.DataFrame]:
        """Waiting rows of transactions whose commits (`ends`: lsn by name) have come; what else waits beside them stays."""
        totals, first = counts.add(new.reindex(counts.index, fill_value=0)), pd.Series(0, counts.index)
        for part in parts:
            rows = self.load(int(part))
            mine = rows["own"].isin(counts.index)
            out = rows[mine]
            place = out.groupby("own", sort=False).cumcount() + 1 + out["own"].map(first)
            yield made(out.assign(source_id=source, xid=out["own"], event_index=place, total=out["own"].map(totals), commit_lsn=out["own"].map(ends)))
            first = first.add(out.groupby("own").size(), fill_value=0).astype("int64")
            self.store(int(part), rows[~mine])

    def store(self, part: int, rows: pd.DataFrame) -> None:
        if len(rows):
            self.rows.updateValue((part,), (packed(rows),))
            h = np.unique(hashes(rows["own"]))
            self.index.append((h, np.full(len(h), part)))
        else:
            self.rows.removeKey((part,))

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802
        given, following, h, part = self.current.get() if self.current.exists() else (None, 0, b"", b"")
        h, part = np.frombuffer(bytes(h), np.uint64), np.frombuffer(bytes(part), np.int64)
        batch, given = groups(ordered(rows), given)
        data, ends = batch[~batch["commit"]], batch[batch["commit"]]
        ends = ends.set_index(["own", "turn"])["lsn"].fillna("")
        turns = pd.MultiIndex.from_frame(data[["own", "turn"]])
        closed = np.asarray(turns.isin(ends.index))
        done, left = data[closed], data[~closed]
        done = done.assign(source_id=key[0], xid=done["own"], commit_lsn=ends.reindex(turns[closed]).to_numpy(object))
        by = done.groupby(["own", "turn"], sort=False)["seq"]
        done = done.assign(event_index=by.cumcount() + 1, total=by.transform("size"))
        first = ends[ends.index.get_level_values(1) == 0].droplevel(1)  # earlier rows belong to a name's first commit
        parts = np.unique(part[np.isin(h, hashes(first.index))])
        counts = pd.Series(0, first.index[:0])
        for p in parts:  # counted before they are given, entry by entry, as one transaction may fill many
            own = self.load(int(p))["own"]
            counts = counts.add(own[own.isin(first.index)].value_counts(), fill_value=0).astype("int64")
        self.index = [(h[~np.isin(part, parts)], part[~np.isin(part, parts)])]
        if len(parts):
            early = done["turn"] == 0
            before = done["own"].map(counts).fillna(0).astype("int64").where(early, 0)
            done = done.assign(event_index=done["event_index"] + before, total=done["total"] + before)
            yield from self.release(key[0], first, done[early].groupby("own").size(), parts, counts)
        for at in range(0, len(done), OUT):
            yield made(done.iloc[at : at + OUT])
        for at in range(0, len(left), PART):
            self.store(following, left.iloc[at : at + PART])
            following += 1
        h, part = (np.concatenate([x[k] for x in self.index]) for k in (0, 1))
        self.current.update((given, following, h.astype(np.uint64).tobytes(), part.astype(np.int64).tobytes()))

    def close(self) -> None:
        pass


def made(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of a committed transaction in the columns of MADE."""
    rows = rows.assign(advance=(rows["commit_lsn"] != "") & (rows["event_index"] == rows["total"]))
    return rows[[c.split()[0] for c in MADE.split(", ")]].astype({"seq": "int64", "event_index": "int64", "total": "int64"})


def stream_transactions(feed: DataFrame) -> DataFrame:
    """Data rows of a feed (source_id, seq, kind, xid, lsn, any others) with event_index, total, commit_lsn and advance.

    The stream twin of carry_xid and assemble_transactions: rows without xid take that of the open begin; a
    transaction's rows come when its commit comes, wherever batches cut it, and wait in the state store until then.
    """
    ship(feed.sparkSession)
    with_timers(feed.sparkSession)
    known = ("source_id", "seq", "kind", "xid", "lsn")
    others = [f for f in feed.schema if f.name not in known]
    body = F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in others]), EXACT) if others else F.lit("{}")
    rows = feed.select("source_id", F.col("seq").cast("long").alias("seq"), "kind", F.col("xid").cast("string").alias("xid"), F.col("lsn").cast("string").alias("lsn"), body.alias("body"))
    made = rows.groupBy("source_id").transformWithStateInPandas(Transactions(), MADE, "Append", "None")
    if not others:
        return made.drop("body")
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return made.withColumn("__o", F.from_json("body", kind, EXACT)).select(*[c for c in made.columns if c != "body"], "__o.*")


def decode_batch(state: str, each: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function of a stream (seq, lsn, xid, data): each gets decode_binary_feed() of every batch.

    Only relation messages are carried: a batch leaves the latest of every table, of its own or an earlier batch, in a folder
    of its number under `state`, and starts from that of the batch before, so one that runs again finds the same. Tuples
    never meet in one task, so a batch may have files of any number.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = lambda k: f"{state}/{k}"
        rels = relations(batch)
        if batch_id:
            rels = rels.unionByName(spark.read.schema(RELATION).parquet(folder(batch_id - 1)))
        rest = F.struct("schema", "table", "columns")
        latest = rels.groupBy("relid").agg(F.max("seq").alias("seq"), F.max_by(rest, F.coalesce("seq", F.lit(-(1 << 63)))).alias("r"))
        latest.select("seq", "relid", "r.*").coalesce(1).write.mode("overwrite").parquet(folder(batch_id))
        each(decode_binary_feed(batch, lambda tuples, _: asof_relation(tuples, rels)), batch_id)
        if batch_id > 1:  # the batch before may have to run again
            fs, old = place(spark, folder(batch_id - 2))
            fs.delete(old, True)

    return run
