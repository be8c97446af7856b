"""Evidence snapshots and their manifest (SNK-5, JN-11, SRT-2, SET-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeledger.operators.retention import keep_newest

MANIFEST = "kind string, source_id string, path string, created_at timestamp, size long, severity string, contract_version string"


def write_evidence(df: DataFrame, root: str, kind: str, source_id: str, stamp: str, severity: str = "healthy", version: str = "1") -> DataFrame:
    """Writes a snapshot as JSON under kind/source/stamp and returns its manifest row; a retry replaces both."""
    path = f"{root}/{kind}/{source_id}/{stamp}"
    df.write.mode("overwrite").json(path)
    size = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("size"))
    row = size.select(F.lit(kind).alias("kind"), F.lit(source_id).alias("source_id"), F.lit(path).alias("path"), F.to_timestamp(F.lit(stamp), "yyyyMMdd'T'HHmmss").alias("created_at"), F.col("size").cast("long").alias("size"), F.lit(severity).alias("severity"), F.lit(version).alias("contract_version"))
    entry = row.withColumn("entry", F.lit(f"{kind}-{source_id}-{stamp}")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    entry.partitionBy("entry").parquet(f"{root}/manifest")
    return row


def list_files(spark, root: str) -> DataFrame:
    """(path): folders of snapshots that exist, from a listing without contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(root).select("path")
    return files.select(F.regexp_extract(F.regexp_replace("path", r"^\w+:/+", "/"), r"^(.*)/[^/]+$", 1).alias("path")).distinct()


def prune_missing(manifest: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, removed) manifest entries by whether their path exists."""
    return manifest.join(files.select("path").distinct(), "path", "left_semi"), manifest.join(files.select("path"), "path", "left_anti")


def drop_removed(manifest: DataFrame, removed: DataFrame) -> DataFrame:
    return manifest.join(removed.select("path"), "path", "left_anti")


def retain(manifest: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    return keep_newest(manifest, n, ["source_id", "kind"], ["created_at", "path"])


def latest_artifacts(manifest: DataFrame, source_id: str | None = None, kind: str | None = None, n: int = 1) -> DataFrame:
    """The newest n (1 at least) entries of a source and kind."""
    rows = manifest if source_id is None else manifest.where(F.col("source_id") == source_id)
    rows = rows if kind is None else rows.where(F.col("kind") == kind)
    return rows.orderBy(F.col("created_at").desc(), F.col("path").desc()).limit(max(1, n))
