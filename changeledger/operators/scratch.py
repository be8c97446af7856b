"""Intermediate tables in the shared checkpoint folder, which lost executors do not take with them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's own switch that deletes a finished write's shuffle files, which no later step reads.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the session names; a new local one only where none is set and the master is local."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="changeledger-"))
    return sc._jsc.sc().getCheckpointDir().get()


def place(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's own classes for a path."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def scratch_path(spark: SparkSession) -> str:
    """A new folder under scratch_dir, deleted when the driver ends."""
    fs, path = place(spark, f"{scratch_dir(spark)}/cl-{uuid.uuid4().hex}")
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return path.toString()


class Scratch:
    """Tables written under the shared folder, so that a lost executor costs a reread and no recomputation.

    free() deletes a table that no later step reads, close() all of them; what a result still reads goes when the
    driver ends, or at the end of closing().
    """

    live: list[Scratch] = []

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{scratch_dir(spark)}/cl-{uuid.uuid4().hex}"
        self.saved = 0
        Scratch.live.append(self)

    def path(self, name: str) -> str:
        """A new path for a table of this scratch."""
        if not self.saved:
            fs, root = place(self.spark, self.root)
            fs.mkdirs(root)
            fs.deleteOnExit(root)
        self.saved += 1
        return f"{self.root}/{name}-{self.saved}"

    def save(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        path, schema = self.path(name), df.schema
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", compression).parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.schema(schema).parquet(path)
        out.scratch_path = path
        return out

    def bytes(self, df: DataFrame) -> int:
        """Measured size of a saved table's files."""
        fs, path = place(self.spark, df.scratch_path)
        return fs.getContentSummary(path).getLength()

    def free(self, *frames: DataFrame) -> None:
        for df in frames:
            fs, path = place(self.spark, df.scratch_path)
            fs.delete(path, True)

    def close(self) -> None:
        fs, root = place(self.spark, self.root)
        fs.delete(root, True)
        if self in Scratch.live:
            Scratch.live.remove(self)


@contextmanager
def closing() -> Iterator[None]:
    """Deletes the scratch tables that the body made, at its end: for a caller that has stored their result."""
    known = list(Scratch.live)
    yield
    for scratch in [s for s in Scratch.live if s not in known]:
        scratch.close()
