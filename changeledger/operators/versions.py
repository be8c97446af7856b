"""Versioned tables: staged files, and a manifest that is renamed into place (SNK-1, SNK-2, SNK-6, ST-3).

A table is a folder with `data`, `index` and `_versions`. A commit stages its files under a name of its own and then
renames a manifest, which lists all files of the version, to the next number; a rename onto a number that exists fails, so
of two writers one starts again. Readers take the files of the last manifest: what a killed writer staged is never read. A commit
has a tag, and a commit with a tag that the table holds replaces that one's files, so a retry doubles nothing.

With key columns, every file has Bloom filters of its keys, one for each of BUCKETS ranges of their hash, and a reader of
some keys opens only files that may hold them. Commits are small files; FAN commits of one level are merged into files
of the next one, cut by the keys' hash at TARGET bytes, so that files follow bytes, and their number the logarithm of
commits.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeledger.operators.scratch import place
from changeledger.shipping import ship

#: Bytes of a file, commits of a level that are merged, ranges of hashes, bits and probes for each key of a filter.
TARGET, FAN, BUCKETS, BITS, PROBES = 128 << 20, 8, 64, 12, 7
#: Rows of a file at most, by the counts that writers give: one task writes a file, and sorts it if there are others.
ROWS = 1_000_000
INDEX = "path string, bucket int, bits binary"


class Conflict(RuntimeError):
    """Another writer committed first."""


def probes(h: np.ndarray, size: int) -> np.ndarray:
    """Bit places of hashes in a filter of `size` bits, a row for each hash."""
    u = h.astype(np.uint64)
    step = (u * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return ((u[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)[None, :]) >> np.uint64(11)) % np.uint64(size)


def bloom(h: np.ndarray) -> bytes:
    size = max(64, -(-len(h) * BITS // 8) * 8)
    bits = np.zeros(size, bool)
    bits[probes(h, size).ravel()] = True
    return np.packbits(bits).tobytes()


def may_hold(bits: bytes, h: np.ndarray) -> bool:
    """Whether a filter may hold any of the hashes."""
    there = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
    return bool(there[probes(h, len(there))].all(1).any())


def _bucket(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - (BUCKETS.bit_length() - 1)).cast("int")


class Versions:
    """A versioned table at `root`; key names the columns of its index, if it has one."""

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str] = (), form: str = "parquet"):
        self.spark, self.root, self.key, self.form = spark, root.rstrip("/"), list(key), form

    def _fs(self, path: str):
        return place(self.spark, path)

    def manifests(self) -> list[int]:
        """Numbers of the versions, oldest first."""
        fs, path = self._fs(f"{self.root}/_versions")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version, the last one if none is given; an empty one before the first commit."""
        known = self.manifests()
        if not known:
            return {"version": 0, "schema": None, "files": []}
        fs, path = self._fs(f"{self.root}/_versions/v{known[-1] if version is None else version:012d}.json")
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        """Writes a manifest beside and renames it to its number; Conflict if that exists."""
        fs, temp = self._fs(f"{self.root}/_versions/.{uuid.uuid4().hex}")
        out = fs.create(temp, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        jvm, sc = self.spark._jvm, self.spark.sparkContext
        _, there = self._fs(f"{self.root}/_versions/v{manifest['version']:012d}.json")
        options = sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(temp.toUri(), self.spark._jsc.hadoopConfiguration()).rename(temp, there, options)
        except Exception as e:
            fs.delete(temp, False)
            if fs.exists(there):
                raise Conflict(f"version {manifest['version']} of {self.root} exists") from e
            raise

    def files(self, manifest: dict | None = None) -> list[str]:
        return [f["path"] for f in (manifest or self.manifest())["files"]]

    def load(self, paths: list[str], schema: str | dict) -> DataFrame:
        kind = StructType.fromJson(schema) if isinstance(schema, dict) else schema
        if not paths:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).format(self.form).load([f"{self.root}/{p}" for p in paths])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the last one if none is given."""
        manifest = self.manifest(version)
        if manifest["schema"] is None:
            raise FileNotFoundError(f"no version of {self.root}")
        return self.load(self.files(manifest), manifest["schema"])

    def stage(self, rows: DataFrame, tag: str, level: int = 0, size: int = 0, count: int = 0) -> list[dict]:
        """Writes rows as files of about TARGET bytes and ROWS rows, given their expected size and the most that they can
        count, and indexes them; entries for a manifest."""
        name, n = uuid.uuid4().hex, max(1, -(-size // TARGET), -(-count // ROWS))
        keyed = rows.withColumn("__h", F.xxhash64(*self.key)) if self.key else rows
        # An exchange even to one file: the tasks that make the rows stay many, and none holds the memory of all of them.
        spread = keyed.repartitionByRange(n, "__h").sortWithinPartitions("__h").drop("__h") if self.key and n > 1 else rows.repartition(n)
        spread.write.format(self.form).save(f"{self.root}/data/{name}")
        fs, path = self._fs(f"{self.root}/data/{name}")
        found = [(s.getPath().getName(), s.getLen()) for s in fs.listStatus(path) if s.getPath().getName().startswith("part-")]
        entries = [{"path": f"data/{name}/{p}", "bytes": b, "tag": tag, "level": level, "index": name, "rows": -(-count // len(found))} for p, b in found]
        if self.key and entries:
            self._index([e["path"] for e in entries], rows.schema, name)
        return entries

    def _index(self, paths: list[str], schema: StructType, name: str) -> None:
        """Bloom filters of files: each file's hashes, TARGET bytes of rows at most, meet by range of hash."""
        ship(self.spark)
        h = F.xxhash64(*self.key)
        at = F.regexp_extract("_metadata.file_path", r"(data/[^/]+/[^/]+)$", 1)
        hashes = self.load(paths, schema.jsonValue()).select(at.alias("path"), h.alias("h"), _bucket(h).alias("bucket")).distinct()

        def filters(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"path": [key[0]], "bucket": [key[1]], "bits": [bloom(rows["h"].to_numpy())]})

        hashes.groupBy("path", "bucket").applyInPandas(filters, INDEX).repartition(1).write.parquet(f"{self.root}/index/{name}")

    def candidates(self, keys: DataFrame, manifest: dict | None = None, without: str | None = None) -> list[str]:
        """Files, but for those of the tag `without`, that may hold a row with one of the keys; no file that holds one is missing."""
        entries = [f for f in (manifest or self.manifest())["files"] if f["tag"] != without]
        if not entries:
            return []
        ship(self.spark)
        folders = sorted({f["index"] for f in entries})
        index = self.spark.read.schema(INDEX).parquet(*[f"{self.root}/index/{n}" for n in folders])
        h = F.xxhash64(*self.key)
        asked = keys.select(h.alias("h"), _bucket(h).alias("bucket")).distinct()

        def hit(key: tuple, wanted: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            hashes = wanted["h"].to_numpy()
            return pd.DataFrame({"path": [p for p, b in zip(filters["path"], filters["bits"]) if len(hashes) and may_hold(b, hashes)]}, dtype=object)

        found = asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(hit, "path string").distinct()
        live = {f["path"] for f in entries}
        return [p for (p,) in found.collect() if p in live]  # one for each file of the table at most

    def commit(self, rows: DataFrame, tag: str, replace: Sequence[str] = (), level: int = 0, size: int = 0, count: int = 0) -> int:
        """Adds rows under a tag, in place of that tag's files and of the files named in `replace`; returns the version.

        A conflict stages nothing again: the new files go into the next version, unless files to replace are gone.
        """
        entries = self.stage(rows, tag, level, size, count)
        while True:
            now = self.manifest()
            if not set(replace) <= set(self.files(now)):
                raise Conflict(f"files to replace in {self.root} are gone")
            kept = [f for f in now["files"] if f["tag"] != tag and f["path"] not in set(replace)]
            try:
                self._publish({"version": now["version"] + 1, "schema": rows.schema.jsonValue(), "files": kept + entries})
                return now["version"] + 1
            except Conflict:
                continue

    def compact(self, fan: int = FAN) -> int:
        """Merges the commits of each level that has `fan` or more of them into one of the next level; how often it did."""
        done = 0
        while True:
            now = self.manifest()
            tags: dict[int, dict[str, list[dict]]] = {}
            for f in now["files"]:
                tags.setdefault(f["level"], {}).setdefault(f["tag"], []).append(f)
            full = [level for level, by in sorted(tags.items()) if len(by) >= fan]
            if not full:
                return done
            old = [f for fs in tags[full[0]].values() for f in fs]
            rows = self.load([f["path"] for f in old], now["schema"])
            self.commit(rows, f"merge-{uuid.uuid4().hex}", [f["path"] for f in old], full[0] + 1, sum(f["bytes"] for f in old), sum(f["rows"] for f in old))
            done += 1

    def rewrite(self, keep: Column, tag: str) -> int:
        """A new version with only the rows for which keep holds; files without other rows are left as they are."""
        now = self.manifest()
        if not now["files"]:
            return now["version"]
        rows, at = self.load(self.files(now), now["schema"]), F.regexp_extract("_metadata.file_path", r"(data/[^/]+/[^/]+)$", 1)
        lost = [p for (p,) in rows.where(~F.coalesce(keep, F.lit(False))).select(at).distinct().collect()]  # one for each file
        if not lost:
            return now["version"]
        old = [f for f in now["files"] if f["path"] in set(lost)]
        return self.commit(self.load(lost, now["schema"]).where(keep), tag, lost, 0, sum(f["bytes"] for f in old), sum(f["rows"] for f in old))

    def vacuum(self, versions: int = 2) -> int:
        """Deletes manifests before the last `versions` and folders that no manifest left names; how many folders went.

        Only for a table without writers: what a writer has staged and not yet committed goes too.
        """
        for n in self.manifests()[:-versions]:
            fs, path = self._fs(f"{self.root}/_versions/v{n:012d}.json")
            fs.delete(path, False)
        named = {f["index"] for n in self.manifests() for f in self.manifest(n)["files"]}
        gone = 0
        for part in ("data", "index"):
            fs, path = self._fs(f"{self.root}/{part}")
            for s in fs.listStatus(path) if fs.exists(path) else ():
                if s.getPath().getName() not in named:
                    fs.delete(s.getPath(), True)
                    gone += 1
        return gone


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    """The last version of the table at root."""
    return Versions(spark, root).read()

