"""Resolving tracked objects and choosing sources (SRC-16 to SRC-19, JN-3, AG-6, AG-10, JN-8, JN-9)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeledger.functions import canonical as C
from changeledger.model import TableSpec
from changeledger.sources.sqlite import read_sqlite

#: The JDBC engines and their drivers; the other sources name a Spark connector.
JDBC = {
    "postgresql": ("postgresql", "org.postgresql.Driver"), "mysql": ("mysql", "com.mysql.cj.jdbc.Driver"), "mariadb": ("mariadb", "org.mariadb.jdbc.Driver"),
    "sqlserver": ("sqlserver", "com.microsoft.sqlserver.jdbc.SQLServerDriver"), "oracle": ("oracle:thin", "oracle.jdbc.OracleDriver"), "db2": ("db2", "com.ibm.db2.jcc.DB2Driver"), "sqlite": ("sqlite", "org.sqlite.JDBC"),
}
CONNECTORS = {"mongodb": "mongodb", "redis": "org.apache.spark.sql.redis", "cassandra": "org.apache.spark.sql.cassandra", "scylladb": "org.apache.spark.sql.cassandra", "elasticsearch": "org.elasticsearch.spark.sql"}
#: Column names compared without case by these sources.
CASELESS = ("sqlite", "db2", "cassandra", "scylladb", "oracle")
_READERS: dict[str, Callable] = {}


def register_source(name: str, reader: Callable[[SparkSession, dict], DataFrame]) -> None:
    _READERS[name] = reader


def reader_options(kind: str, options: dict) -> tuple[str, dict]:
    """(format, options) of a source. JDBC reads split on partitionColumn, lowerBound, upperBound, numPartitions if given."""
    if kind == "parquet":
        return "parquet", dict(options)
    if kind in JDBC:
        scheme, driver = JDBC[kind]
        given = {k: str(v) for k, v in options.items() if k not in ("host", "port", "database")}
        url = f"jdbc:{scheme}:{options['database']}" if kind == "sqlite" else f"jdbc:{scheme}:@//{options['host']}:{options['port']}/{options['database']}" if kind == "oracle" else f"jdbc:{scheme}://{options['host']}:{options['port']}" + (f";databaseName={options['database']}" if kind == "sqlserver" else f"/{options['database']}")
        split = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"}
        if set(given) & split and not split <= set(given):
            raise ValueError("a split JDBC read names partitionColumn, lowerBound, upperBound and numPartitions")
        return "jdbc", {"driver": driver, "fetchsize": "10000", **given, "url": given.get("url", url)}
    if kind in CONNECTORS:
        return CONNECTORS[kind], {k: str(v) for k, v in options.items()}
    raise ValueError(f"unknown source {kind}")


def read_source(spark: SparkSession, kind: str, options: dict) -> DataFrame:
    """A source by its kind: a registered reader, SQLite files by path and table, else Spark's connector for it."""
    if kind in _READERS:
        return _READERS[kind](spark, options)
    if kind == "sqlite" and "table" in options:
        return read_sqlite(spark, options)
    name, rest = reader_options(kind, options)
    path = rest.pop("path", None) if name == "parquet" else None
    return spark.read.format(name).options(**rest).load(*([path] if path else []))


def resolve_specs(schemas: dict[str, dict[str, StructType]], include: dict[str, list[str]], options: dict | None = None, kind: str = "postgresql", exclude: dict[str, list[str]] | None = None) -> list[TableSpec]:
    """Specs of the included, not excluded tables; errors name what is missing.

    options: watermark_column (updated_at), commit_timestamp_column (= watermark), primary_key_columns (a list, or a
    list by table), selected_columns.
    """
    options, out = options or {}, []
    for ns, tables in include.items():
        for table in tables:
            if table in (exclude or {}).get(ns, []):
                continue
            if table not in schemas.get(ns, {}):
                raise ValueError(f"table {ns}.{table} does not exist")
            names = schemas[ns][table].names

            def find(column: str) -> str:
                hits = [n for n in names if n == column or kind in CASELESS and n.lower() == column.lower()]
                if not hits:
                    raise ValueError(f"{ns}.{table} has no column {column}")  # noqa: B023
                return hits[0]

            watermark = find(options.get("watermark_column", "updated_at"))
            pk = options.get("primary_key_columns", [])
            pk = pk.get(table, []) if isinstance(pk, dict) else pk
            if not pk:
                raise ValueError(f"{ns}.{table} has no primary key")
            commit = options.get("commit_timestamp_column")
            out.append(TableSpec(ns, table, watermark, tuple(map(find, pk)), tuple(map(find, options.get("selected_columns", names))), find(commit) if commit else None))
    return out


def check_catalog(columns: DataFrame, include: DataFrame, exclude: DataFrame | None = None) -> DataFrame:
    """Fleet form: include (ns, tbl, watermark, pk) against a columns catalog (ns, tbl, column_name): (ns, tbl, problem).

    problem is null for a table that can be tracked.
    """
    wanted = include if exclude is None else include.join(exclude, ["ns", "tbl"], "left_anti")
    held = columns.groupBy("ns", "tbl").agg(F.collect_set("column_name").alias("names"))
    missing = F.filter("pk", lambda c: ~F.array_contains("names", c))
    problem = F.when(F.col("names").isNull(), "missing table").when(~F.array_contains("names", F.col("watermark")), F.concat(F.lit("missing column "), F.col("watermark"))).when(F.size("pk") == 0, "missing primary key").when(F.size(missing) > 0, F.concat(F.lit("missing column "), missing[0]))
    return wanted.join(held, ["ns", "tbl"], "left").select("ns", "tbl", problem.alias("problem"))


def join_key_columns(columns: DataFrame, constraints: DataFrame) -> DataFrame:
    """Catalog columns with key_position, null for columns outside the primary key."""
    return columns.join(constraints, ["ns", "tbl", "column_name"], "left")


def active_sources(sources: DataFrame, controls: DataFrame) -> DataFrame:
    return sources.where("enabled").join(controls.where("paused").select("source_id"), "source_id", "left_anti")


def readable_sources(sources: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Sources that emit something: with a checkpoint, or with a backfill; redo sources start at a baseline and wait."""
    joined = sources.join(checkpoints.select("source_id", "token"), "source_id", "left")
    return joined.where(F.col("token").isNotNull() | ((F.col("backfill_mode") != "none") & (F.col("capture_mode") != "logminer")))


def coverage(specs: DataFrame) -> DataFrame:
    """Tracked objects, tables and collections per source."""
    return specs.groupBy("source_id").agg(F.count("*").alias("tracked_objects"), F.count_if(F.col("kind") == "table").alias("tables"), F.count_if(F.col("kind") == "collection").alias("collections"))


def runtime_signature(specs: DataFrame) -> DataFrame:
    """(source_id, signature): hash of each source's specs (key, watermark, pk) in key order."""
    one = F.concat(F.lit('{"key":'), C.quote(F.col("key")), F.lit(',"pk":["'), F.array_join("pk", '","'), F.lit('"],"watermark":'), C.quote(F.col("watermark")), F.lit("}"))
    rows = F.array_sort(F.collect_list(F.struct(F.col("key").alias("k"), one.alias("j"))))
    return specs.groupBy("source_id").agg(C.sha256_hex(F.concat(F.lit("["), F.array_join(F.transform(rows, lambda r: r["j"]), ","), F.lit("]"))).alias("signature"))


def signature_changed(stored: DataFrame, current: DataFrame) -> DataFrame:
    old = stored.select("source_id", F.col("signature").alias("stored"))
    return current.join(old, "source_id", "left").select("source_id", (~F.col("signature").eqNullSafe(F.col("stored"))).alias("changed"))


def publication_drift(tracked: DataFrame, published: DataFrame) -> DataFrame:
    """(source_id, missing, extra, in_sync) of tracked and published tables (source_id, tbl)."""
    both = tracked.select("source_id", "tbl", F.lit(1).alias("t")).join(published.select("source_id", "tbl", F.lit(1).alias("p")), ["source_id", "tbl"], "full")
    listed = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.col("tbl"))))
    return both.groupBy("source_id").agg(listed(F.col("p").isNull()).alias("missing"), listed(F.col("t").isNull()).alias("extra")).withColumn("in_sync", (F.size("missing") == 0) & (F.size("extra") == 0))


def table_set_diff(tracked: DataFrame, published: DataFrame) -> DataFrame:
    """Rows of one side only, duplicates counted."""
    return tracked.exceptAll(published).withColumn("side", F.lit("tracked")).unionByName(published.exceptAll(tracked).withColumn("side", F.lit("published")))


def replica_identity_drift(specs: DataFrame, identities: DataFrame, expected: str = "f") -> DataFrame:
    """(source_id, in_sync): whether every tracked table has the expected identity."""
    joined = specs.join(identities, ["source_id", "tbl"], "left")
    return joined.groupBy("source_id").agg(F.bool_and(F.coalesce(F.col("identity") == expected, F.lit(False))).alias("in_sync"))
