"""Exact duplicates by a tree-merge of sorted digest runs; DataFrame functions only.

Every stored partition of digests is a run. A round merges FAN neighbouring runs into one: the partitions exchange them by
(run, digest), every task combines what it sends before the shuffle, and each merge, a sort aggregation in digest order, keeps
one row per text with its surviving identifier and its number of rows. A merged run is as many slots wide as it has
source partitions, so no task holds a whole one, and a text that a third of all rows share is one row per task from
the first round on. After log_FAN(partitions) rounds one run is left.

Runs are ordered by a 64-bit digest; rows merge only where SHA-256 and length of the normalised text agree as well, which
is verified at every level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeledger.llm.common import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs that one round merges into one.
FAN = 8
SAME = ("digest", "sha", "size")


def normalised(text: Column) -> Column:
    """text with A-Z alone lower-cased; null is empty."""
    return F.coalesce(F.translate(text.cast("string"), UPPER, LOWER), F.lit(""))


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, sha, size, run) of every row: a 64-bit digest, the SHA-256 and the bytes of its normalised text."""
    text = docs.select("doc_id", normalised(F.col("text")).alias("t"))
    return text.select(
        "doc_id", F.xxhash64("t").alias("digest"), F.unhex(F.sha2("t", 256)).alias("sha"), F.octet_length("t").cast("long").alias("size"),
        F.spark_partition_id().cast("long").alias("run"),
    )


def merged(runs: DataFrame, greatest: bool, fan: int = FAN) -> DataFrame:
    """One round: runs (run, digest, sha, size, best, n), fan neighbours becoming one; best is a struct of one field."""
    pick = F.max if greatest else F.min
    joined = runs.withColumn("run", F.floor(F.col("run") / fan).cast("long"))
    return joined.groupBy("run", *SAME).agg(pick("best").alias("best"), F.sum("n").alias("n"))


def tree_merge(rows: DataFrame, greatest: bool = True, fan: int = FAN) -> DataFrame:
    """(digest, sha, size, best, n), a row per text, from rows of digests(): identifiers merge in rounds of fan runs each."""
    first = F.max if greatest else F.min
    # A struct with the null flag first: a row with an id always beats one without.
    flag = F.col("doc_id").isNotNull() if greatest else F.col("doc_id").isNull()
    runs = rows.groupBy("run", *SAME).agg(first(F.struct(flag.alias("flag"), F.col("doc_id").alias("id"))).alias("best"), F.count("*").alias("n"))
    last = rows.agg(F.max("run")).first()[0] or 0
    while last:
        runs, last = merged(runs, greatest, fan), last // fan
    return runs.select(*SAME, F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"))


def find_copies(docs: DataFrame, greatest: bool = True, fan: int = FAN) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of docs (doc_id, text; other columns are ignored).

    Texts are equal if they are identical after lower-casing A-Z alone; null counts as empty. keep_id is the greatest
    (or least) doc_id of the equal texts, null only where none has one; group_size counts rows, repeated ones too. Rows
    that share both text and id are one document, and all of them are kept; a row without id is kept only where its whole
    group has none. Texts of any length are read whole; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.save(digests(docs), "digests")
    groups = tree_merge(rows, greatest, fan)
    # Both sides come by plain exchanges, so that adaptive execution can split the rows of a hot text.
    out = rows.drop("run").join(groups, list(SAME))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def keep_one(docs: DataFrame, greatest: bool = True) -> DataFrame:
    """The rows of docs that find_copies keeps, with all their columns, whatever these are called.

    A row is looked up by its id and its text's SHA-256, so rows of one id and several texts are told apart.
    """
    kept = find_copies(docs, greatest).where("kept").select(F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__sha")).distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.unhex(F.sha2(normalised(docs["text"]), 256)).alias("sha"))
    same = rows["row"]["doc_id"].eqNullSafe(kept["__id"]) & (rows["sha"] == kept["__sha"])
    return rows.join(kept, same, "left_semi").select("row.*")
