"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on a sample that grows with the vectors up to a bound; every vector is then put into the leaf that it
descends to. A query visits leaves in the order of a priority queue over the distances to node centres; how many it
visits is calibrated on other sampled vectors, which the tree has not seen, until the wanted recall is reached. Queries and
vectors meet by leaf, both sides in blocks of bounded size, so a hot leaf is many tasks and no task holds all of its rows.
A side is sent once for each block of the other side that it meets: once, up to a block of queries in a leaf.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeledger.llm.common import Scratch

#: Sampled vectors that fit the tree: one in SHARE, at least and at most so many (some 100 MB at 64 dimensions).
SHARE, LEAST, MOST = 50, 20_000, 200_000
#: Further sampled vectors that calibrate the visits; children of a node; sample vectors in a leaf.
HELD_OUT, BRANCH, LEAF, SEED = 10_000, 8, 40, 5
#: Components whose squares could overflow in sums, and whose inverses' squares could vanish.
LARGE = 2.0**500
#: Recall among the held-out vectors from which no more leaves are visited.
RECALL = 0.97
#: Rows of a leaf in one block at most, queries of a leaf in one block, and queries compared with a block at a time.
BLOCK, QUERIES, STEP = 8192, 16_384, 512


class Tree:
    def __init__(self, x: np.ndarray, branch: int = BRANCH, leaf: int = LEAF):
        rnd = np.random.default_rng(SEED)
        # A power of two that brings the sample's components to where their squares are safe.
        top = np.abs(x).max(initial=0)
        self.scale = 2.0 ** (int(np.frexp(top)[1]) - 1) if top > LARGE else 1.0
        x = x / self.scale
        self.centers, self.children = [x.mean(0) if len(x) else np.zeros(x.shape[1])], [None]
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if len(rows) <= leaf:
                continue
            own = _kmeans(x[rows], branch, rnd)
            kinds = np.unique(own)
            if len(kinds) < 2:  # all alike
                continue
            self.children[node] = np.arange(len(self.centers), len(self.centers) + len(kinds))
            for k, child in zip(kinds, self.children[node]):
                self.centers.append(x[rows[own == k]].mean(0))
                self.children.append(None)
                todo.append((int(child), rows[own == k]))
        self.centers = np.array(self.centers)
        self.visits = 1

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row descends to."""
        x = x / self.scale
        at = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows) or self.children[node] is None:
                at[rows] = node
                continue
            c = self.centers[self.children[node]]
            own = ((c * c).sum(1) - 2 * x[rows] @ c.T).argmin(1)
            todo += [(int(child), rows[own == k]) for k, child in enumerate(self.children[node])]
        return at

    def search(self, q: np.ndarray, visits: int, sizes: dict[int, int] | None = None, least: int = 0) -> list[int]:
        """The first `visits` leaves of one query, best bin first, and more until they hold `least` rows by `sizes`."""
        q = q / self.scale
        heap, out, held = [(0.0, 0)], [], 0
        while heap and (len(out) < visits or held < least):
            _, node = heapq.heappop(heap)
            kids = self.children[node]
            if kids is None:
                out.append(node)
                held += sizes.get(node, 0) if sizes else 0
                continue
            far = ((self.centers[kids] - q) ** 2).sum(1)
            for d, k in zip(far.tolist(), kids.tolist()):
                heapq.heappush(heap, (d, k))
        return out

    def calibrate(self, x: np.ndarray, k: int, recall: float = RECALL, queries: int = 400) -> None:
        """Fewest visits that find `recall` of the k neighbours of rows of x among its other rows.

        x are vectors that did not fit the tree. They lie less dense than all vectors, so that their neighbours are
        farther off and the visits rather too many.
        """
        rows = np.random.default_rng(SEED).permutation(len(x))[:queries]
        total = sum(c is None for c in self.children)
        if len(x) <= k or total < 2:
            self.visits = total
            return
        leaf, rank = self.leaves(x), []
        for i in rows:
            d = _far(x, x[i])
            d[i] = np.inf
            near = np.argpartition(d, k)[:k]
            order = {n: j for j, n in enumerate(self.search(x[i], total))}
            rank.append([order[n] for n in leaf[near]])
        self.visits = min(total, int(np.quantile(np.array(rank), recall, method="higher")) + 2)


def _kmeans(x: np.ndarray, k: int, rnd: np.random.Generator, steps: int = 8) -> np.ndarray:
    c = x[rnd.choice(len(x), min(k, len(x)), replace=False)].copy()
    own = np.zeros(len(x), np.int64)
    for _ in range(steps):
        own = ((c * c).sum(1) - 2 * x @ c.T).argmin(1)
        for j in range(len(c)):
            if (own == j).any():
                c[j] = x[own == j].mean(0)
    return own


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) with vectors as doubles: none null, zero, or holding null or non-finite components."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(finite & F.exists("v", lambda x: x != 0))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def fit(rows: DataFrame, k: int, n: int) -> Tree:
    """The tree of n rows. Vectors are sampled by a hash of id and vector; of few, a third calibrates and does not fit it."""
    wanted = min(MOST, max(LEAST, n // SHARE), 2 * n // 3)
    place = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)) / F.lit(float(1 << 30)) * n
    picked = rows.withColumn("place", place).where(F.col("place") < wanted + HELD_OUT).dropDuplicates(["vec_id", "v"]).orderBy("place", "vec_id")
    found = picked.select("v", (F.col("place") < wanted).alias("fits")).toArrow()
    x, fits = _matrix(found.column("v")), found.column("fits").to_numpy()
    tree = Tree(x[fits])
    tree.calibrate(x[~fits], k)
    return tree


def search(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries its k nearest rows of vectors with another vec_id.

    Both have vec_id and embedding; other columns are ignored. score is the Euclidean distance in double precision;
    ties go to the smaller vec_id. Null ids and the vectors that valid() drops take no part; a query is compared with the
    vectors of its own length, each length having its own tree. Repeated query rows count once; repeated candidate rows
    are candidates each. An empty table gives no rows.
    """
    rows, asked = valid(vectors), valid(queries)
    lengths = rows.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n")).orderBy("length").collect()
    if not lengths:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    of = lambda df, n: df.where(F.size("v") == n)
    return reduce(DataFrame.unionByName, [_search(of(rows, r.length), of(asked, r.length), k, r.n) for r in lengths])


def _search(rows: DataFrame, asked: DataFrame, k: int, n: int) -> DataFrame:
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession)
    tree = fit(rows, k, n)
    block = max(1024, min(BLOCK, n // 64))
    shared = spark.sparkContext.broadcast(tree)  # bounded by the sample

    def place(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(shared.value.leaves(_matrix(b.column(1))), pa.int64())], ["vec_id", "v", "leaf"])

    members = scratch.save(rows.mapInArrow(place, "vec_id long, v array<double>, leaf long"), "members")
    # One row per leaf, and the sample bounds the leaves.
    sizes = {r.leaf: r.n for r in members.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    cells = _cells(sizes, block)
    homes = spark.createDataFrame([(leaf, cell, parts) for leaf, (cell, parts) in cells.items()], "leaf long, cell long, parts int")

    def probe(batches):
        for b in batches:
            out: list[tuple] = []
            for i, (x, own) in enumerate(zip(_matrix(b.column(1)), b.column(2).to_pylist())):
                by: dict[int, list[int]] = {}
                for leaf in shared.value.search(x, shared.value.visits, sizes, k + own):
                    if leaf in cells:
                        by.setdefault(cells[leaf][0], []).append(leaf)
                out += [(i, cell, cells[leaves[0]][1], leaves) for cell, leaves in by.items()]
            at, cell, parts, leaves = zip(*out) if out else ((), (), (), ())
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(cell, pa.int64()), pa.array(parts, pa.int32()), pa.array(leaves, pa.list_(pa.int64()))], ["query_id", "q", "cell", "parts", "leaves"])

    # A query's own rows are no candidates.
    mine = members.groupBy(F.col("vec_id").alias("__id")).agg(F.count("*").alias("own"))
    asked = asked.dropDuplicates(["vec_id", "v"])
    asked = asked.join(mine, asked.vec_id == mine["__id"], "left").select("vec_id", "v", F.coalesce("own", F.lit(0)).alias("own"))
    # A query is a small row but a long walk through the tree, so tasks are not joined by their bytes.
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(1, n // 64))
    asked = asked.repartition(tasks, "vec_id")
    probes = scratch.save(asked.mapInArrow(probe, "query_id long, q array<double>, cell long, parts int, leaves array<long>"), "probes")
    asks = probes.groupBy("cell").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("asks"))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    placed = members.join(F.broadcast(homes), "leaf").join(asks, "cell").withColumn("r", F.pmod(F.xxhash64("vec_id", "v"), "parts").cast("int"))
    left = placed.withColumn("a", spread("asks")).select("cell", "r", "a", "leaf", "vec_id", "v")
    turned = probes.join(asks, "cell").withColumn("a", F.pmod(F.xxhash64("query_id"), "asks").cast("int"))
    right = turned.withColumn("r", spread("parts")).select("cell", "r", "a", "query_id", "q", "leaves")

    def meet(m: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if len(m) and len(p):
            ids, x, q, own = m["vec_id"].to_numpy(), np.stack(m["v"].to_numpy()), np.stack(p["q"].to_numpy()), p["query_id"].to_numpy()
            leaf, wanted = m["leaf"].to_numpy(), p["leaves"].to_numpy()
            at = np.repeat(np.arange(len(p)), [len(w) for w in wanted])
            visit = np.concatenate(wanted)
            parts = []
            for value in np.unique(leaf):
                rows, asking = leaf == value, at[visit == value]
                for some in np.split(asking, range(STEP, len(asking), STEP)) if len(asking) else []:
                    parts.append(_near(ids[rows], x[rows], q[some], own[some], some, k))
            if parts:
                who, vec, far = (np.concatenate(c) for c in zip(*parts))
                order = np.lexsort((vec, far, who))
                who, vec, far = who[order], vec[order], far[order]
                first = np.searchsorted(who, who, "left")
                keep = np.arange(len(who)) - first < k
                found = [who[keep], vec[keep], far[keep]]
        hashes = np.array([xxhash.xxh64_intdigest(v.tobytes()) >> 1 for v in p["q"]], np.int64) if len(p) else np.zeros(0, np.int64)
        return pd.DataFrame({"query_id": p["query_id"].to_numpy()[found[0]], "qh": hashes[found[0]], "vec_id": found[1], "score": found[2]})

    met = left.groupBy("cell", "r", "a").cogroup(right.groupBy("cell", "r", "a")).applyInPandas(meet, "query_id long, qh long, vec_id long, score double")
    order = Window.partitionBy("query_id", "qh").orderBy("score", "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _cells(sizes: dict[int, int], block: int) -> dict[int, tuple[int, int]]:
    """leaf -> (cell, parts): small leaves share a cell of some `block` rows, a large one has its own, in parts."""
    out, cell, held = {}, 0, 0
    for leaf, n in sorted(sizes.items()):
        if held and held + n > block:
            cell, held = cell + 1, 0
        out[leaf] = (cell, max(1, -(-n // block)))
        held += n
    return out


def _near(ids: np.ndarray, x: np.ndarray, q: np.ndarray, own: np.ndarray, who: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, vec_id, distance) of each query's k nearest rows of one leaf, ties of the last included.

    A matrix product finds them up to its rounding error; the distances returned are computed exactly. Where components are so
    large or small that sums of squares could overflow or vanish, _far computes all distances; one beyond double precision is infinite
    and still ranks.
    """
    mine = ids[None, :] == own[:, None]
    if not 1 / LARGE <= max(np.abs(x).max(initial=0), np.abs(q).max(initial=0)) <= LARGE:
        d, slack = np.stack([_far(x, one) for one in q]), 0.0
    else:
        square, length = (x * x).sum(1), (q * q).sum(1)
        d, slack = length[:, None] + square[None, :] - 2 * q @ x.T, 1e-12 * (length + square.max())[:, None]
    # Own rows come last, after any candidates at infinity.
    d[mine] = np.nan
    last = np.partition(d, min(k, d.shape[1]) - 1, axis=1)[:, min(k, d.shape[1]) - 1 :][:, :1]
    i, j = np.nonzero(((d <= last + slack) | np.isnan(last)) & ~mine)
    far = np.concatenate([_far(x[j[a : a + 65536]], q[i[a : a + 65536]]) for a in range(0, len(i), 65536)] or [np.zeros(0)])
    return who[i], ids[j], far


def _far(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows; differences that are large or tiny are divided by a power of two, which changes no rounding."""
    with np.errstate(over="ignore", invalid="ignore"):
        step = np.abs(x - q)
        top = step.max(1, initial=0)
        odd = (top > LARGE) & np.isfinite(top) | (top < 1 / LARGE) & (top > 0)
        if not odd.any():
            return np.sqrt((step * step).sum(1))
        scale = np.where(odd, 2.0 ** (np.frexp(top)[1] - 1.0), 1.0)
        return np.sqrt(((step / scale[:, None]) ** 2).sum(1)) * scale
