"""Packing of token pieces into sequences by large-item matching and best fit."""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeledger.llm.common import Scratch
from changeledger.llm.tokens import END_ID, encoder
from changeledger.shipping import ship

#: A group of pieces that one task packs: about so many sequences, and never much more than so many pieces.
GROUP_SEQUENCES, GROUP_PIECES = 8192, 200_000
PIECES = "rid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece.

    Pieces above a third of the capacity fit at most twice into a bin: each, the longest first, is matched with the
    longest remaining one that still fits. The others fill the smallest gap that holds them, the longest first. Of
    equal lengths the earlier piece comes first.
    """
    n = len(lengths)
    bins, offsets = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    waiting = [deque() for _ in range(capacity + 1)]  # unmatched large pieces by length, in order
    gaps: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by free room
    large_mask = gap_mask = 0
    order = np.argsort(-lengths, kind="stable").tolist()
    large = [i for i in order if 3 * lengths[i] > capacity]
    for i in large:
        waiting[lengths[i]].append(i)
        large_mask |= 1 << int(lengths[i])
    count = 0

    def drop(i: int) -> None:
        nonlocal large_mask
        if not waiting[lengths[i]]:
            large_mask &= ~(1 << int(lengths[i]))

    for i in large:
        if bins[i] >= 0:
            continue
        waiting[lengths[i]].popleft()  # i itself
        drop(i)
        bins[i], used = count, int(lengths[i])
        fits = large_mask & ((1 << (capacity - used + 1)) - 1)
        if fits:
            mate = waiting[fits.bit_length() - 1].pop()
            drop(mate)
            bins[mate], offsets[mate] = count, used
            used += int(lengths[mate])
        gaps[capacity - used].append(count)
        gap_mask |= 1 << (capacity - used)
        count += 1
    for i in order[len(large) :]:
        need = int(lengths[i])
        fits = gap_mask >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            b = gaps[room].pop()
            if not gaps[room]:
                gap_mask &= ~(1 << room)
        else:
            b, room, count = count, capacity, count + 1
        bins[i], offsets[i] = b, capacity - room
        gaps[room - need].append(b)
        gap_mask |= 1 << (room - need)
    return bins, offsets


def pieces(docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None) -> DataFrame:
    """Token pieces of whole texts: only documents above the capacity are cut; the first piece takes the rest.

    A null text has the end id alone; repeated rows and null ids are kept, told apart by rid.
    """
    ship(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        tokens, rid = encoder(tokenizer), TaskContext.get().partitionId() << 40
        names = ["rid", "doc_id", "piece", "start", "length", "ids_crc32"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        made = lambda out: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
        for b in batches:
            out = []
            for d, ids in zip(b.column(0).to_pylist(), tokens.each(b.column(1))):
                ids = np.append(ids.astype("<u4"), np.uint32(END_ID))
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for k, (a, z) in enumerate(zip(cuts[:-1], cuts[1:])):
                    out.append((rid, d, k, a, z - a, zlib.crc32(ids[a:z].data)))
                    rid += 1
                if len(out) >= 1024:
                    yield made(out)
                    out = []
            if out:
                yield made(out)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


def pack_documents(docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece of docs (doc_id, text).

    Pieces are dealt by a hash of their row number into groups that one task packs; their number follows the tokens,
    so a hot id or many equal rows never gather in one group. An empty table gives no rows.
    """
    cut = Scratch(docs.sparkSession).save(pieces(docs, capacity, tokenizer), "pieces")
    size = cut.agg(F.sum("length").alias("ids"), F.count("*").alias("n")).first()
    groups = max(1, -(-(size["ids"] or 0) // (capacity * GROUP_SEQUENCES)), -(-size["n"] // GROUP_PIECES))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rid", ignore_index=True)
        bins, offsets = pack(frame["length"].to_numpy(), capacity)
        frame["sequence_id"], frame["offset"] = (frame["g"].to_numpy(np.int64) << 32) + bins, offsets
        return frame[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    dealt = cut.withColumn("g", F.expr(f"pmod(xxhash64(rid), {groups}L)"))
    return dealt.groupBy("g").applyInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
