"""Shared plumbing of the training-data operators: tables, scratch tables and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeledger.operators import scratch
from changeledger.operators.scratch import closing, scratch_dir  # noqa: F401  for the operators and their tests
from changeledger.shipping import ship

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """name, or name with more underscores where df has such a column."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name


class Scratch(scratch.Scratch):
    """Scratch tables of operators whose Python stages need the package on every worker."""

    def __init__(self, spark: SparkSession):
        super().__init__(spark)
        ship(spark)


def _star(scratch: Scratch, edges: DataFrame, large: bool) -> DataFrame:
    """One star step: every node links its (larger / not larger) neighbours to the least node around it."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return scratch.save(out.where("a != b").distinct(), "star")


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b): rows (node, component), component the least node.

    Alternates large-star and small-star steps until the edges stay the same. Only counts reach the driver; each
    step's edges are a written table. Nodes without an edge to another node do not appear.
    """
    cols = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    now = scratch.save(cols.distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x"), F.expr("sum(pmod(xxhash64(b, a), 1000003))").alias("y")).first()
        if mark == before or mark["n"] == 0:
            break
        before = mark
        one = _star(scratch, now, True)
        two = _star(scratch, one, False)
        scratch.free(now, one)
        now = two
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
