"""Removal of repeated word spans through a compacted De Bruijn graph.

A window of `window` words is an edge between two nodes, its first and its last (window - 1) words; an edge's key is the
pair of its nodes' hashes (128 bits). Every window holds a minimizer, the least k-mer inside it; equal windows hold equal
minimizers, so only windows with a minimizer that occurs twice can repeat, and only those edges are looked at. Edges meet in
one partially aggregated group-by, which gives each repeated edge its first source (row and place); only repeated edges
stay in the graph. Joins on the node keys give every edge the in- and out-degree of the node that it leaves. Edges with
consecutive source coordinates are compacted into one path as long as the nodes between them do not branch. A document's
occurrences of a path that advance in step are a span; its words are compared, by SHA-256, with the words at its source
coordinates, and the spans that hold are removed.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeledger.llm.common import Scratch

KMER = 8
#: Odd multipliers of the two rolling hashes: of nodes and of minimizers.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
FACTS = "rid long, dk long, n long, sha string, s1 long, s2 long, ah array<long>, ap array<int>, z binary"
EDGES = "rid long, dk long, f array<long>, t array<long>, p array<int>, own array<struct<start:int,n:int,src_start:int>>"


def _roll(h: np.ndarray, k: int, multiplier: int) -> np.ndarray:
    out, m = np.zeros(max(0, len(h) - k + 1), np.uint64), np.uint64(multiplier)
    for j in range(k if len(out) else 0):
        out = out * m + h[j : j + len(out)]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.array(list(map(xxhash.xxh64_intdigest, words)), dtype=np.uint64)


def _minimizers(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window: the k-mer hash (its low bits zero) and the place of its leftmost least k-mer."""
    width = window - KMER + 1
    bits = np.uint64((1 << width.bit_length()) - 1)
    low = _roll(h, KMER, MULTIPLIERS[1]) & ~bits
    have = 1
    while have < width:  # the low bits count how far right of the window's start the least one is
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:] + np.uint64(step))
        have += step
    return low & ~bits, np.arange(len(low)) + (low & bits).astype(np.int64)


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").split()


def _record(columns: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, schema.types)], schema=schema)


def _facts(window: int):
    """(rid, dk, text) rows to FACTS: words, their digests, minimizers and the packed text."""
    wide, narrow = pa.list_(pa.int64()), pa.list_(pa.int32())
    kinds = [pa.int64()] * 3 + [pa.string()] + [pa.int64()] * 2 + [wide, narrow, pa.binary()]
    schema = pa.schema(list(zip(("rid", "dk", "n", "sha", "s1", "s2", "ah", "ap", "z"), kinds)))

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for b in batches:
            rows: list[list] = [[] for _ in schema]
            for rid, dk, text in zip(*(c.to_pylist() for c in b.columns)):
                words = _words(text)
                joined = b" ".join(words)
                s1, s2 = np.frombuffer(xxhash.xxh3_128_digest(joined), "<i8").tolist()
                low, at = np.zeros(0, np.int64), np.zeros(0, np.int32)
                if len(words) >= window:
                    low, at = _minimizers(_hashes(words), window)
                    new = np.concatenate(([True], at[1:] != at[:-1]))
                    low, at = low[new].view(np.int64), at[new].astype(np.int32)
                sha = hashlib.sha256(joined).hexdigest()
                for out, v in zip(rows, (rid, dk, len(words), sha, s1, s2, low, at, squeeze.compress(joined))):
                    out.append(v)
            yield _record(rows, schema)

    return run


def _own(words: list[bytes], places: np.ndarray, source: np.ndarray, window: int) -> list[dict]:
    """Runs of windows that repeat earlier ones of their own text, place and source in step; words are compared."""
    if not len(places):
        return []
    cut = np.flatnonzero((np.diff(places) != 1) | (np.diff(source) != 1)) + 1
    first = np.concatenate(([0], cut))
    out = []
    for start, src, n in zip(places[first].tolist(), source[first].tolist(), np.diff(np.append(first, len(places))).tolist()):
        size = n + window - 1
        if words[start : start + size] == words[src : src + size]:
            out.append({"start": start, "n": n, "src_start": src})
    return out


def _edges(window: int):
    """(rid, dk, z, hits) rows to EDGES: the windows whose minimizer occurs again, each at its first place in the text."""
    span = pa.struct([("start", pa.int32()), ("n", pa.int32()), ("src_start", pa.int32())])
    kinds = [pa.int64()] * 2 + [pa.list_(pa.int64())] * 2 + [pa.list_(pa.int32()), pa.list_(span)]
    schema = pa.schema(list(zip(("rid", "dk", "f", "t", "p", "own"), kinds)))

    def run(batches):
        expand = zstandard.ZstdDecompressor()
        for b in batches:
            out: list[list] = [[] for _ in schema]
            for rid, dk, z, hits in zip(*(c.to_pylist() for c in b.columns)):
                words = _words(expand.decompress(z))
                h = _hashes(words)
                _, at = _minimizers(h, window)
                places = np.flatnonzero(np.isin(at, np.array(hits, np.int64)))
                node = _roll(h, window - 1, MULTIPLIERS[0])
                f, t = node[places], node[places + 1]
                _, first, kind = np.unique(np.rec.fromarrays([f, t]), return_index=True, return_inverse=True)
                source = places[first[kind]]  # of equal windows in this text the first
                new = source == places
                own = _own(words, places[~new], source[~new], window)
                row = (rid, dk, f[new].view(np.int64), t[new].view(np.int64), places[new].astype(np.int32), own)
                for column, v in zip(out, row):
                    column.append(v)
            yield _record(out, schema)

    return run


def _span_digest(words: list[bytes], start: int, n: int, window: int) -> bytes:
    return hashlib.sha256(b" ".join(words[start : start + n + window - 1])).digest()


def _sources(window: int):
    """(src, z, wanted) rows to (src, src_start, n, digest): the words at the source coordinates of spans."""
    schema = pa.schema([("src", pa.int64()), ("src_start", pa.int32()), ("n", pa.int32()), ("digest", pa.binary())])

    def run(batches):
        expand = zstandard.ZstdDecompressor()
        for b in batches:
            out: list[list] = [[] for _ in schema]
            for src, z, wanted in zip(*(c.to_pylist() for c in b.columns)):
                words = _words(expand.decompress(z))
                for x in wanted:
                    start, n = x["src_start"], x["n"]
                    for column, v in zip(out, (src, start, n, _span_digest(words, start, n, window))):
                        column.append(v)
            yield _record(out, schema)

    return run


def _cut(window: int):
    """(rid, z, spans) rows to (rid, n_removed, cut_sha, kept) without the words of the spans that hold."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    schema = pa.schema(list(zip(("rid", "n_removed", "cut_sha", "kept"), kinds)))

    def run(batches):
        expand = zstandard.ZstdDecompressor()
        for b in batches:
            out: list[list] = [[] for _ in schema]
            for rid, z, spans in zip(*(c.to_pylist() for c in b.columns)):
                words = _words(expand.decompress(z))
                edge = np.zeros(len(words) + 1, np.int32)
                for x in spans:
                    start, n = x["start"], x["n"]
                    if x["digest"] is None or x["digest"] == _span_digest(words, start, n, window):
                        edge[start] += 1
                        edge[start + n + window - 1] -= 1
                keep = np.cumsum(edge[:-1]) == 0
                kept = b" ".join(compress(words, keep.tolist()))
                row = (rid, len(words) - int(keep.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace"))
                for column, v in zip(out, row):
                    column.append(v)
            yield _record(out, schema)

    return run


def compact(first: DataFrame) -> DataFrame:
    """Repeated edges (f, t, src, src_p, src_dk) with `head`, the source place of the first edge of their path.

    A path follows consecutive source coordinates and ends where the node between two edges has more than one repeated
    edge in or out. The window over a source holds that text's repeated edges, and so is bounded by its words.
    """
    leaving = first.groupBy(F.col("f").alias("node")).agg(F.count("*").alias("outs"))
    entering = first.groupBy(F.col("t").alias("node")).agg(F.count("*").alias("ins"))
    through = leaving.join(entering, "node").where("outs = 1 and ins = 1").select("node")
    known = first.join(through, first.f == through.node, "left").withColumn("plain", F.col("node").isNotNull()).drop("node")
    along = Window.partitionBy("src").orderBy("src_p")  # the edges of one source text
    goes_on = F.col("plain") & F.coalesce(F.lag("src_p").over(along) == F.col("src_p") - 1, F.lit(False))
    starts = known.withColumn("start", F.when(~goes_on, F.col("src_p"))).drop("plain")
    return starts.withColumn("head", F.last("start", ignorenulls=True).over(along)).drop("start")


def repeated_spans(docs: DataFrame, window: int = 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, rows, spans) of docs.

    texts (rid, z): the packed words of every row. rows (rid, dk, n, sha, whole, key): facts of every row; whole tells that
    its word sequence occurs under a smaller id, so that all of its windows start earlier; key is the row whose spans
    stand for it (rows with equal id and words share them). spans (rid, start, n, src, src_start, digest): a path of n
    windows, hence n + window - 1 words from word `start`; src is the row of its first occurrence, null in the same
    text, and digest the SHA-256 of the words there, null where they are compared already.
    """
    if window < KMER + 2:
        raise ValueError(f"a window has at least {KMER + 2} words")
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("dk"), F.col("text").cast("string").cast("binary")
    )
    facts = scratch.save(texts.mapInArrow(_facts(window), FACTS), "facts")
    # Only word sequences that occur more than once have a lead; written first, so that a hot one can be split.
    # Null ids come after all others and are never a lead.
    rep = F.coalesce(F.min_by("rid", "dk"), F.min("rid"))
    lead = facts.groupBy("s1", "s2").agg(F.min("dk").alias("lead"), rep.alias("rep"), F.count("*").alias("c")).where("c > 1").drop("c")
    lead = scratch.save(lead, "lead")
    later = F.coalesce((F.col("dk") > F.col("lead")) | (F.col("dk").isNull() & F.col("lead").isNotNull()), F.lit(False))
    joined = facts.drop("z").join(lead, ["s1", "s2"], "left").withColumn("whole", later & (F.col("n") >= window))
    wide = joined.select("rid", "dk", "n", "sha", "whole", F.coalesce("rep", "rid").alias("key"), "ah", "ap")
    wide = scratch.save(wide, "wide")
    rows = scratch.save(wide.drop("ah", "ap"), "rows")
    scratch.free(lead)
    one = wide.where(f"rid = key and n >= {window}")
    occ = one.select("rid", F.explode(F.arrays_zip("ah", "ap")).alias("x")).select("rid", F.col("x.ah").alias("a"), F.col("x.ap").alias("p"))
    # The repeated keys are written before the join: a join of two plain exchanges can split a hot key's rows.
    again = scratch.save(occ.groupBy("a").agg(F.count("*").alias("c")).where("c > 1").select("a"), "again")
    hits = scratch.save(occ.join(again, "a").groupBy("rid").agg(F.collect_list("p").alias("hits")), "hits")
    scratch.free(again, wide)
    packed = facts.select("rid", "dk", "z")
    edges = scratch.save(packed.join(hits, "rid").select("rid", "dk", "z", "hits").mapInArrow(_edges(window), EDGES), "edges")
    scratch.free(hits)
    flat = edges.select("rid", "dk", F.explode(F.arrays_zip("f", "t", "p")).alias("x")).select("rid", "dk", "x.f", "x.t", "x.p")
    # The smallest (id, row, place) is the source; a null id is none.
    source = F.min(F.when(F.col("dk").isNotNull(), F.struct("dk", "rid", "p"))).alias("s")
    seen = flat.groupBy("f", "t").agg(source, F.max("dk").alias("most"), F.bool_or(F.col("dk").isNull()).alias("nameless"))
    first = seen.where("s.dk < most or (s.dk is not null and nameless)")
    first = scratch.save(first.select("f", "t", F.col("s.dk").alias("src_dk"), F.col("s.rid").alias("src"), F.col("s.p").alias("src_p")), "first")
    paths = scratch.save(compact(first), "paths")
    scratch.free(first)
    gone = flat.join(paths, ["f", "t"]).where("dk > src_dk or dk is null").withColumn("lane", F.col("src_p") - F.col("p"))
    path = ["rid", "src", "head", "lane"]
    lane = Window.partitionBy(*path).orderBy("p")
    runs = (
        gone.withColumn("island", F.col("p") - F.row_number().over(lane)).groupBy(*path, "island")
        .agg(F.min("p").alias("start"), F.count("*").cast("int").alias("n"), F.min("src_p").alias("src_start"))
        .select("rid", "start", "n", "src", "src_start")
    )
    runs = scratch.save(runs, "runs")
    wanted = runs.select("src", "src_start", "n").distinct().groupBy("src").agg(F.collect_list(F.struct("src_start", "n")).alias("wanted"))
    at_source = wanted.join(facts.select(F.col("rid").alias("src"), "z"), "src").select("src", "z", "wanted")
    digests = scratch.save(at_source.mapInArrow(_sources(window), "src long, src_start int, n int, digest binary"), "digests")
    checked = runs.join(digests, ["src", "src_start", "n"]).select("rid", "start", "n", "src", "src_start", "digest")
    none = F.lit(None)
    own = edges.select("rid", F.explode("own").alias("x")).select(
        "rid", "x.start", "x.n", none.cast("long").alias("src"), "x.src_start", none.cast("binary").alias("digest")
    )
    spans = scratch.save(checked.unionByName(own), "spans")
    scratch.free(edges, paths, runs, digests)
    return facts.select("rid", "z"), rows, spans


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) per row; kept is null where no word was removed.

    Null or empty texts have no words and keep the empty text; texts under `window` words lose nothing. A null doc_id
    orders after all others. Rows that share an id (or have none) are judged apart and never against each other; equal
    rows get equal answers. Texts are read whole, however long: one task holds one text with the spans that others take
    from it, each start and length once. Other columns are ignored; an empty table gives no rows.
    """
    texts, rows, spans = repeated_spans(docs, window)
    per_row = spans.groupBy("rid").agg(F.collect_list(F.struct("start", "n", "digest")).alias("spans"))
    cut = texts.join(per_row, "rid").select("rid", "z", "spans")
    cut = cut.mapInArrow(_cut(window), "rid long, n_removed long, cut_sha string, kept string").withColumnRenamed("rid", "key")
    empty = hashlib.sha256(b"").hexdigest()
    whole = F.col("whole")
    removed = F.when(whole, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long")
    sha = F.when(whole, F.lit(empty)).otherwise(F.coalesce("cut_sha", "sha"))
    kept = F.when(whole, F.lit("")).otherwise(F.col("kept"))
    return rows.join(cut, "key", "left").select(
        F.col("dk").alias("doc_id"), F.col("n").alias("n_words"), removed.alias("n_removed"), sha.alias("kept_sha256"), kept.alias("kept")
    )
