"""Token-id shards in a Re-Pair grammar, with random access.

A shard is one row of a Parquet table: about `shard_ids` ids of consecutive documents, ascending by doc_id. Frequent
pairs of neighbouring symbols are replaced by nonterminals, round after round; no pair spans two documents. The row
holds the rules (two symbols each), the number of ids that each rule expands to, the remaining symbols, and for each
document its first symbol and its number of ids. One document, or one range of ids, is decoded by expanding only the
symbols that cover it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeledger.llm.common import Scratch
from changeledger.llm.tokens import END_ID, encoder
from changeledger.shipping import ship

SHARD_IDS = 1 << 20
#: Stored bytes of the input in one part (a few shards), and the most parts that a table has.
PART_BYTES, MOST_PARTS = 16 << 20, 100_000
SCHEMA = "part int, shard int, start long, n_ids long, base int, doc_ids binary, id_null binary, lengths binary, first binary, rules binary, spans binary, symbols binary"


def _ranks(kind: np.ndarray, pair: np.ndarray, bits: int) -> np.ndarray:
    """The place in `kind` of each pair, -1 for others: hash tables of fixed size; what loses a slot goes to the next table."""
    out, todo, slots, odd = np.full(len(pair), -1, np.int32), np.arange(len(kind)), 18, 0x9E3779B97F4A7C15 >> (64 - bits) | 1
    while len(todo):
        turn, shift = kind.dtype.type(odd), kind.dtype.type(bits - slots)
        slot = (kind[todo] * turn) >> shift
        _, first = np.unique(slot, return_index=True)
        table = np.full(1 << slots, -1, np.int32)
        table[slot[first]] = todo[first]
        own = table[(pair * turn) >> shift]
        np.maximum(out, np.where(kind[own] == pair, own, -1), out=out)
        todo, odd = np.delete(todo, first), (odd * 0xD1342543DE82EF95 + 2) % (1 << bits) | 1
    return out


def compress(ids: np.ndarray, last: np.ndarray, base: int, rounds: int | None = None, top: int = 7000, least: int = 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, last flags, rules): replaces up to `top` pairs a round that occur `least` times or more, until none does.

    A round counts only places whose pair is new or was left over by the round before: any other pair has been counted
    as too rare, and its count never grows.
    """
    seq, rules = ids.astype(np.uint16 if base <= 1 << 16 else np.uint32), []
    near = np.ones(len(seq), bool)
    while len(seq) > 1 and rounds != 0:
        rounds = rounds and rounds - 1
        at = np.flatnonzero(near[:-1] & ~last[:-1])
        word, bits = (np.uint32, 32) if seq.dtype == np.uint16 else (np.uint64, 64)
        half = word(bits // 2)
        if len(at) > len(seq) // 2:
            pair = (seq[:-1].astype(word) << half | seq[1:])[near[:-1] & ~last[:-1]]
        else:
            pair = seq[at].astype(word) << half | seq[at + 1]
        run = np.sort(pair)
        edge = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1]))) if len(run) else at
        count, kind = np.diff(np.concatenate((edge, [len(run)]))), run[edge]
        good = count >= least
        count, kind = count[good], kind[good]
        if not len(kind):
            break
        kind = kind[np.lexsort((kind, -count))]
        rank = _ranks(kind, pair, bits)
        chosen, left, kind = np.flatnonzero((rank >= 0) & (rank < top)), at[rank >= top], kind[:top]
        hit = at[chosen]
        # Of overlapping pairs every other one is taken, from the left.
        place = np.arange(len(hit))
        start = np.maximum.accumulate(np.where(np.concatenate(([True], hit[1:] != hit[:-1] + 1)), place, 0))
        mine = (place - start) % 2 == 0
        take, symbol = hit[mine], base + len(rules) + rank[chosen[mine]]
        if base + len(rules) + len(kind) > 1 << 16:
            seq = seq.astype(np.uint32)
        stay, fresh, near, last = np.ones(len(seq), bool), np.zeros(len(seq), bool), np.zeros(len(seq), bool), last.copy()
        seq[take], last[take], stay[take + 1], fresh[take], near[left] = symbol, last[take + 1], False, True, True
        seq, last, fresh, near = seq[stay], last[stay], fresh[stay], near[stay]
        near |= fresh
        near[:-1] |= fresh[1:]
        rules.extend(zip((kind >> half).tolist(), (kind & word((1 << bits // 2) - 1)).tolist()))
    return seq, last, np.array(rules, np.int64).reshape(-1, 2)


def expansions(rules: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of all rules, expanded together, one level at a time."""
    flat, sizes = rules.reshape(-1), np.full(len(rules), 2, np.int64)
    while (inner := flat >= base).any():
        owner = np.repeat(np.arange(len(rules)), sizes)
        sizes = sizes + np.bincount(owner[inner], minlength=len(rules))
        width = 1 + inner.astype(np.int64)
        new = np.repeat(flat, width)
        at = (np.cumsum(width) - width)[inner]
        new[at], new[at + 1] = rules[flat[inner] - base, 0], rules[flat[inner] - base, 1]
        flat = new
    return flat, np.concatenate(([0], np.cumsum(sizes)))


class Shard:
    """Decodes a row of the table."""

    def __init__(self, row: dict):
        wide = np.uint16 if row["symbols"][:1] == b"\x02" else np.uint32
        self.n_ids, base = row["n_ids"], row["base"]
        self.symbols = np.frombuffer(row["symbols"], wide, offset=4)
        self.rules = np.frombuffer(row["rules"], "<u4").astype(np.int64).reshape(-1, 2)
        self.first = np.frombuffer(row["first"], "<u4").astype(np.int64)
        self.lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
        self.doc_ids, self.null = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["id_null"], np.uint8)
        ids, offsets = expansions(self.rules, base)
        # One table for all symbols: an id stands for itself, a nonterminal for its expansion.
        self.table = np.concatenate((np.arange(base), ids)).astype(np.uint32)
        self.begin = np.concatenate((np.arange(base), base + offsets[:-1])).astype(np.int32)
        self.sizes = np.concatenate((np.ones(base, np.int32), np.frombuffer(row["spans"], "<u4").astype(np.int32)))[self.symbols]

    def _expand(self, lo: int, hi: int) -> np.ndarray:
        size = self.sizes[lo:hi]
        ends = np.cumsum(size, dtype=np.int32)
        if not len(ends):
            return np.zeros(0, np.uint32)
        return self.table[np.repeat(self.begin[self.symbols[lo:hi]] - ends + size, size) + np.arange(ends[-1], dtype=np.int32)]

    def document(self, k: int) -> np.ndarray:
        return self._expand(int(self.first[k]), int(self.first[k + 1]))

    def ids_between(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo to hi (exclusive) of the shard, by the expansion lengths."""
        ends = np.cumsum(self.sizes)
        a, b = int(np.searchsorted(ends, lo, "right")), int(np.searchsorted(ends, hi, "left")) + 1
        begin = int(ends[a] - self.sizes[a]) if a < len(ends) else 0
        return self._expand(a, b)[lo - begin : hi - begin]

    def all(self) -> np.ndarray:
        return self._expand(0, len(self.symbols))


def _shard_row(part: int, shard: int, start: int, docs: list, base: int) -> dict:
    ids = np.concatenate([x for _, x in docs])
    lengths = np.array([len(x) for _, x in docs], np.int64)
    last = np.zeros(len(ids), bool)
    last[np.cumsum(lengths) - 1] = True
    symbols, ended, rules = compress(ids, last, base)
    _, offsets = expansions(rules, base)
    narrow = base + len(rules) <= 1 << 16
    first = np.concatenate(([0], np.flatnonzero(ended) + 1))
    return {
        "part": part, "shard": shard, "start": start, "n_ids": len(ids), "base": base,
        "doc_ids": np.array([d or 0 for d, _ in docs], "<i8").tobytes(), "id_null": np.array([d is None for d, _ in docs], np.uint8).tobytes(),
        "lengths": lengths.astype("<u4").tobytes(), "first": first.astype("<u4").tobytes(), "rules": rules.astype("<u4").tobytes(),
        "spans": np.diff(offsets).astype("<u4").tobytes(), "symbols": bytes([2 if narrow else 4, 0, 0, 0]) + symbols.astype("<u2" if narrow else "<u4").tobytes(),
    }


TYPES = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), ("base", pa.int32())] + [(c, pa.binary()) for c in ("doc_ids", "id_null", "lengths", "first", "rules", "spans", "symbols")])


def _parts(docs: DataFrame) -> int:
    """Parts for the measured length of the texts, whatever docs is made of."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")).cast("long"))).first()[0] or 0
    return max(1, min(MOST_PARTS, -(-size // PART_BYTES)))


def encode(docs: DataFrame, path: str, tokenizer: str | None = None, shard_ids: int = SHARD_IDS) -> None:
    """Writes the ids of docs (doc_id, text), each followed by END_ID, as shards in ascending doc_id order.

    Null texts are empty, null ids come first, and rows that share an id stand side by side in the order of a hash of
    their text. Part p holds a range of ids below that of part p + 1; within it shards and documents ascend. A shard
    is closed by size alone, so one document may fill a shard of its own.
    """
    ship(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        part, tokens = TaskContext.get().partitionId(), encoder(tokenizer)
        base, shard, start, docs, held = max(tokens.tokenizer.get_vocab_size(), END_ID + 1), 0, 0, [], 0
        for b in batches:
            for d, ids in zip(b.column(0).to_pylist(), tokens.each(b.column(1))):
                docs.append((d, np.append(ids, tokens.dtype(END_ID))))
                held += len(ids) + 1
                if held >= shard_ids:
                    yield pa.RecordBatch.from_pylist([_shard_row(part, shard, start, docs, base)], TYPES)
                    shard, start, docs, held = shard + 1, start + held, [], 0
        if docs:
            yield pa.RecordBatch.from_pylist([_shard_row(part, shard, start, docs, base)], TYPES)

    n = _parts(docs)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("h"))
    ordered = keyed.repartitionByRange(n, "doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    ordered.mapInArrow(run, SCHEMA).write.parquet(path)


def shards(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a written table with `before`, the ids of all earlier parts."""
    ship(spark)
    rows = spark.read.schema(SCHEMA).parquet(path)
    # One row for each part, as many as the writer had partitions.
    bases = rows.groupBy("part").agg(F.sum("n_ids").alias("n")).selectExpr("part", "sum(n) over (order by part) - n as before")
    return rows.join(F.broadcast(bases), "part")


def _opened(batches):
    """(shard, start of its first document, ends of its documents) of each row, one at a time."""
    for b in batches:
        for k in range(b.num_rows):
            row = b.slice(k, 1).to_pylist()[0]
            shard = Shard(row)
            yield shard, row["before"] + row["start"], np.cumsum(shard.lengths)


def decode(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of a written table; start counts the ids of all documents before it."""

    def run(batches):
        for shard, begin, ends in _opened(batches):
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(shard.all().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids, pa.int64(), mask=shard.null.astype(bool)), pa.array(begin + ends - shard.lengths, pa.int64()), ids], ["doc_id", "start", "ids"])

    return shards(spark, path).mapInArrow(run, "doc_id long, start long, ids array<int>")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of a written table; its ids are decoded and stay in the tasks."""

    def run(batches):
        for shard, begin, ends in _opened(batches):
            data = memoryview(shard.all().astype("<u4").tobytes())
            cuts = [0, *(4 * ends).tolist()]
            crc = [zlib.crc32(data[a:z]) for a, z in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids, pa.int64(), mask=shard.null.astype(bool)), pa.array(begin + ends - shard.lengths, pa.int64()), pa.array(shard.lengths, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards(spark, path).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame) -> DataFrame:
    """Writes docs under the shared folder, reads the files back and returns their digests.

    The files stay until the driver ends, because the result reads them.
    """
    path = Scratch(docs.sparkSession).path("token-shards")
    encode(docs, path)
    return digests(docs.sparkSession, path)
