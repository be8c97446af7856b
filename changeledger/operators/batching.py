"""Fixed-size batches (WIN-5, AG-5, AG-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeledger.functions import canonical as C
from changeledger.operators.prefix import sequence


def chunk(df: DataFrame, size: int, keys: list[str], within: list[str] = ()) -> DataFrame:
    """df with seq and batch_no: consecutive chunks of max(1, size) rows in the order of keys, apart for each source."""
    return sequence(df, keys, "seq", within).withColumn("batch_no", F.floor((F.col("seq") - 1) / max(1, size)).cast("long"))


def batches(chunked: DataFrame, by: list[str] = ("batch_no",)) -> DataFrame:
    """One row per batch: leaf_count, batch_external_ref, first and last token. A batch holds batch_size rows at most."""
    return chunked.groupBy(*by).agg(
        F.count("*").alias("leaf_count"), C.batch_ref(F.collect_list("external_ref")).alias("batch_external_ref"),
        F.min_by("checkpoint_token", "seq").alias("first_token"), F.max_by("checkpoint_token", "seq").alias("last_token"),
    )


def batch_budget(df: DataFrame, json: Column, target_kib: int, batch_size: int, batch: bool = True) -> DataFrame:
    """KiB per batch from the measured mean event size, cycles for the target, expected exports."""
    mean = F.avg(F.octet_length(json))
    per = F.greatest(F.lit(1).cast("long"), F.ceil(mean * batch_size / 1024))
    cycles = F.greatest(F.lit(1).cast("long"), F.ceil(F.lit(target_kib) / F.col("kib_per_batch")))
    return df.agg(F.count("*").alias("events"), per.alias("kib_per_batch")).withColumn("cycles", cycles).withColumn("expected_exports", F.col("cycles") if batch else F.col("cycles") * batch_size)
