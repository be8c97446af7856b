"""Loading of the driver tables and shared pieces of the comparison SQL."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query (spark, sf_dir) -> DataFrame and its SQL; queries run with the UTC session time zone."""

    def add(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return add


class Tables:
    """The driver tables by name; money columns are decimals, because floats are never hashed."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        money = {c: df[c].cast("decimal(18,2)") for c, kind in df.dtypes if kind == "double"}
        return df.withColumns(money) if money else df

    def sql(self, text: str) -> DataFrame:
        """A feed derived by SQL from tables named in braces."""
        for name in ("orders", "lineitem", "events", "documents", "customer", "nation", "pages"):
            if "{" + name + "}" in text:
                getattr(self, name).createOrReplaceTempView(f"changeledger_{name}")
                text = text.replace("{" + name + "}", f"changeledger_{name}")
        return self.spark.sql(text)


#: DuckDB text of a timestamp with microseconds where they are not zero.
def micros(col: str) -> str:
    return f"(strftime({col}, '%Y-%m-%dT%H:%M:%S') || case when strftime({col}, '%f') = '000000' then 'Z' else '.' || strftime({col}, '%f') || 'Z' end)"


def seconds(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%dT%H:%M:%SZ')"


def identity(version: str, operation: str, pk: str, schema: str, table: str, database: str = "main", instance: str = "main", kind: str = "postgresql") -> str:
    """DuckDB text of the identity JSON; arguments are SQL expressions (version, operation, pk) or plain names."""
    return f"""'{{"change_version":"' || {version} || '","database_name":"{database}","operation":"' || {operation} || '","primary_key":' || {pk} || ',"schema_or_namespace":"{schema}","source_instance":"{instance}","source_type":"{kind}","table_or_collection":"{table}"}}'"""
