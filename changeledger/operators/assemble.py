"""Transactions from decoded rows (WIN-1 to WIN-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeledger.operators.prefix import running_last, sequence


def carry_xid(feed: DataFrame, order: list[str] = ("seq",)) -> DataFrame:
    """Data rows take the xid of the open begin; after a commit there is none. feed has kind and xid.

    The carry is a distributed prefix scan, so one long feed needs no single partition.
    """
    mark = F.when(F.col("kind") == "begin", F.struct(F.col("xid").alias("x"))).when(F.col("kind") == "commit", F.struct(F.lit(None).cast("string").alias("x")))
    run = running_last(feed.withColumn("__all", F.lit("a")), list(order), "__all", ["a"], mark)
    return run.withColumn("xid", F.when(F.col("kind") == "row", F.coalesce(F.col("xid"), F.col("__state")[0]["x"])).otherwise(F.col("xid"))).drop("__all", "__state")


def assemble_transactions(feed: DataFrame, order: list[str] = ("seq",), within: list[str] = ()) -> DataFrame:
    """Data rows (kind row) with event_index (from 1), total, commit_lsn (empty if unseen) and advance.

    advance holds for the last event of a transaction whose commit is in the feed.
    """
    rows = feed.where("kind = 'row'")
    commits = feed.where("kind = 'commit'").groupBy(*within, "xid").agg(F.max("lsn").alias("__commit"))
    totals = rows.groupBy(*within, "xid").agg(F.count("*").alias("total")).join(commits, [*within, "xid"], "left")
    # Numbered by a prefix pass, so that one huge transaction is many tasks; the joins can split it as well.
    out = sequence(rows, list(order), "event_index", [*within, "xid"]).join(totals, [*within, "xid"])
    out = out.withColumn("commit_lsn", F.coalesce("__commit", F.lit("")))
    return out.withColumn("advance", (F.col("commit_lsn") != "") & (F.col("event_index") == F.col("total"))).drop("__commit")


def limit_events(assembled: DataFrame, n: int = 0, resume: tuple[str, int] | None = None, order: list[str] = ("seq",)) -> DataFrame:
    """The first n events after the resume point (xid, event_index); later rows of that transaction are never lost."""
    out = assembled
    if resume is not None:
        out = out.where(~((F.col("xid") == resume[0]) & (F.col("event_index") <= resume[1])))
    return out.orderBy(*order).limit(n) if n > 0 else out
