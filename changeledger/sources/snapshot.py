"""Snapshot events of tracked tables and key/value stores (SRC-4 to SRC-6, SRC-15, WIN-4, AG-4, SRT-1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeledger.functions import canonical as C
from changeledger.functions import decode as D
from changeledger.functions import tokens as K
from changeledger.model import EVENT_COLUMNS, KeySpec, SourceSpec, TableSpec
from changeledger.operators.keyset import keyset_after, watermark_scan
from changeledger.operators.prefix import running_last, sequence


def cursor_value(df: DataFrame, column: str) -> Column:
    """A key value as it stands in a token: numbers bare, times and all else as strings."""
    kind = dict(df.dtypes)[column]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.col(column).cast("string")
    return C.quote(C.iso_micros(F.col(column)) if kind.startswith("timestamp") else F.col(column).cast("string"))


def state_json(df: DataFrame, spec: TableSpec) -> Column:
    """{"pk": [...], "watermark": "..."}"""
    pk = K.values([cursor_value(df, c) for c in spec.pk])
    return F.concat(F.lit('{"pk": '), pk, F.lit(', "watermark": '), C.quote(C.iso_micros(F.col(spec.watermark))), F.lit("}"))


def candidates(df: DataFrame, spec: TableSpec, source: SourceSpec, index: int) -> DataFrame:
    """Snapshot events of one table, still without a token, with their order columns."""
    commit = C.iso_seconds(F.col(spec.commit_column))
    columns = list(spec.columns) or df.columns
    marker = C.pk_marker([F.col(c) for c in spec.pk])
    pk_list = '","'.join(spec.pk)
    metadata = f'{{"capture_mode":"watermark-poll","commit_timestamp_column":"{spec.commit_column}","primary_key_columns":["{pk_list}"],"watermark_column":"{spec.watermark}"}}'
    made = {
        "source_id": F.lit(source.id), "source_type": F.lit(source.type), "source_instance": F.lit(source.instance), "database_name": F.lit(source.database),
        "schema_or_namespace": F.lit(spec.schema), "table_or_collection": F.lit(spec.table), "operation": F.lit("snapshot"), "primary_key": C.image(df, list(spec.pk)),
        "change_version": F.concat_ws(":", F.lit(spec.key), commit, marker), "commit_timestamp": commit, "after": C.image(df, columns), "before": F.lit(None).cast("string"),
        "metadata": F.lit(metadata), "mode": F.lit("single"), "table_key": F.lit(spec.key), "order_time": F.col(spec.watermark).cast("timestamp"), "order_table": F.lit(index), "order_pk": sortable(df, spec.pk),
        "state": state_json(df, spec),
    }
    return df.select(*[c.alias(n) for n, c in made.items()])


def sortable(df: DataFrame, columns) -> Column:
    """One text per key whose byte order is the typed order: integers shifted and zero-padded, the rest as they are."""
    kinds = dict(df.dtypes)
    whole = lambda c: F.lpad((F.col(c).cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")).cast("string"), 20, "0")
    one = lambda c: whole(c) if kinds[c] in ("tinyint", "smallint", "int", "bigint") else C.iso_micros(F.col(c)) if kinds[c].startswith("timestamp") else F.col(c).cast("string")
    return F.concat_ws("\x00", *[one(c) for c in columns])


def snapshot(frames: dict[str, DataFrame], specs: list[TableSpec], source: SourceSpec, state: dict[str, tuple] | None = None, row_limit: int = 0) -> DataFrame:
    """CHANGE_EVENT rows of all tracked tables after their cursors, with the running checkpoint of every table so far.

    Order: watermark, then the tables as listed, then the typed key. A table without rows yet keeps its given cursor
    in the token; one without cursor or rows is absent.
    """
    state, parts, given = state or {}, [], {}
    for i, spec in enumerate(specs):
        page = watermark_scan(frames[spec.key], spec, state.get(spec.key), row_limit)
        parts.append(candidates(page, spec, source, i))
        if spec.key in state:
            given[spec.key] = _given(state[spec.key])
    rows = union_candidates(parts)
    keys = [s.key for s in specs]
    if len(specs) == 1:  # the last cursor of the only table is each row's own
        run = rows.withColumn("__state", F.array("state"))
    else:
        run = running_last(rows, ORDERS["watermark"], "table_key", keys, F.col("state"))
    shown = [F.concat(F.lit(f'"{k}": '), F.coalesce(F.col("__state")[keys.index(k)], F.lit(given.get(k)).cast("string"))) for k in sorted(keys)]
    token = F.concat(F.lit("{"), F.concat_ws(", ", *shown), F.lit("}"))
    return run.withColumn("checkpoint_token", token).select(*EVENT_COLUMNS, "order_time", "order_table", "order_pk")


def union_candidates(parts: list[DataFrame]) -> DataFrame:
    """Candidates of several tables as one table, by column name; columns that a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _typed(element: Column, kind: str) -> Column:
    """An element of a cursor as a value of the column that it is compared with: a JSON scalar's text, or that of a tagged
    value, whose tag must fit the column's type."""
    tagged = F.from_json(element, "type string, value string")
    good = F.lit(",".join(D.FITTING.get(kind.split("(")[0], ("str", "null"))))
    fits = F.find_in_set(tagged["type"], good) > 0
    value = F.when(tagged["type"].isNull() | tagged["value"].isNull(), element).when(fits, tagged["value"])
    value = value.otherwise(F.raise_error(F.concat(F.lit(f"a cursor of {kind} holds "), tagged["type"])).cast("string"))
    return value.cast(kind)


def join_checkpoints(rows: DataFrame, key: str, token: Column, pk: list[str], watermark: str | None = None) -> DataFrame:
    """Fleet-wide resume: rows of many tables (named in `key`) at or behind their table's cursor go; tables without one stay.

    Rows compare as (watermark, *pk), or as pk alone without a watermark column, with the same parts of their table's
    entry of the token, part by part and each by its column's type; rows with a null part, which no cursor passes, go where
    there is a cursor. A key list of another length is an error. `cursor` is the entry, as text. The exploded token has a
    row per table, and Spark picks the join by its size.
    """
    spark = rows.sparkSession
    entries = spark.range(1).select(F.explode(K.decode_watermarks(token)).alias("__key", "cursor"))
    length = F.when(F.size("cursor.pk") == len(pk), F.col("cursor")).otherwise(F.raise_error(F.lit("checkpoint key has a wrong number of values")).cast("struct<watermark:string,pk:array<string>>"))
    entries = entries.withColumn("cursor", length)
    kinds = dict(rows.dtypes)
    joined = rows.join(entries, rows[key] == entries["__key"], "left").drop("__key")
    parts = ([(watermark, F.col("cursor.watermark"))] if watermark else []) + [(c, F.get("cursor.pk", F.lit(i))) for i, c in enumerate(pk)]
    after = keyset_after([F.col(c) for c, _ in parts], [_typed(x, kinds[c]) for c, x in parts])
    return joined.where(F.col("cursor").isNull() | after)


def _given(cursor: tuple) -> str:
    import json

    mark = cursor[0]
    text = mark if isinstance(mark, str) else mark.strftime("%Y-%m-%dT%H:%M:%S") + (f".{mark.microsecond:06d}" if mark.microsecond else "") + "Z"
    return json.dumps({"pk": list(cursor[1:]), "watermark": text}, sort_keys=True)


def final_checkpoint(df: DataFrame, spec: TableSpec, by: list[str] = ()) -> DataFrame:
    """Last (watermark, pk) of a batch: partial maxima, then one row."""
    last = F.max(F.struct(spec.watermark, *spec.pk)).alias("__last")
    return df.groupBy(*by).agg(last).select(*by, *[F.col(f"__last.{c}") for c in (spec.watermark, *spec.pk)])


def kv_scan(kv: DataFrame, specs: list[KeySpec], state: dict[KeySpec, str] | None = None, row_limit: int = 0) -> DataFrame:
    """Rows (db, key, ...) that match a pattern and follow its last key, the first row_limit per pattern by key."""
    state, parts = state or {}, []
    for spec in specs:
        page = kv.where((F.col("db") == spec.db) & F.col("key").rlike(spec.regex))
        if spec in state:
            page = page.where(F.col("key") > state[spec])
        page = page.withColumn("pattern", F.lit(spec.pattern))
        parts.append(page.orderBy("key").limit(row_limit) if row_limit > 0 else page)
    return reduce(DataFrame.unionByName, parts)


def kv_value_image(rows: DataFrame) -> DataFrame:
    """(db, key, type, value): JSON values from long rows (db, key, type, field, idx, score, value).

    string: its text; hash: object by field; list: array by idx; set: sorted array; zset: array of {member, score} by
    score and member; anything else: its text.
    """
    items = F.collect_list(F.struct("field", "idx", "score", "value"))
    out = rows.groupBy("db", "key", "type").agg(items.alias("i"))
    pick = lambda order, form: F.transform(F.array_sort(F.transform("i", order)), form)
    array = lambda xs: F.concat(F.lit("["), F.array_join(xs, ","), F.lit("]"))
    quoted = C.quote
    hashed = F.concat(F.lit("{"), F.array_join(pick(lambda x: F.struct(x["field"], x["value"]), lambda x: F.concat(quoted(x["field"]), F.lit(":"), quoted(x["value"]))), ","), F.lit("}"))
    listed = array(pick(lambda x: F.struct(x["idx"], x["value"]), lambda x: quoted(x["value"])))
    as_set = array(pick(lambda x: F.struct(x["value"], x["idx"]), lambda x: quoted(x["value"])))
    scored = array(pick(lambda x: F.struct(x["score"], x["value"]), lambda x: F.concat(F.lit('{"member":'), quoted(x["value"]), F.lit(',"score":'), x["score"].cast("string"), F.lit("}"))))
    one = quoted(F.col("i")[0]["value"])
    kind = F.col("type")
    return out.select("db", "key", "type", F.when(kind == "hash", hashed).when(kind == "list", listed).when(kind == "set", as_set).when(kind == "zset", scored).otherwise(one).alias("value"))


def kv_events(rows: DataFrame, specs: list[KeySpec], source: SourceSpec, at: Column | None = None) -> DataFrame:
    """CHANGE_EVENT rows of scanned keys (db, key, pattern, type, value as JSON) in (db, pattern, key) order; a token
    holds the last key of every pattern so far."""
    name = F.concat(F.lit("db"), F.col("db").cast("string"))
    keys = [f"db{s.db}:{s.pattern}" for s in specs]
    rows = running_last(rows.withColumn("__spec", F.concat(name, F.lit(":"), F.col("pattern"))), ["db", "pattern", "key"], "__spec", keys, F.col("key"))
    shown = [F.when(F.col("__state")[keys.index(k)].isNotNull(), F.concat(C.quote(F.lit(k)), F.lit(': {"last_key": '), C.quote(F.col("__state")[keys.index(k)]), F.lit("}"))) for k in sorted(keys)]
    now = C.iso_seconds(F.current_timestamp()) if at is None else at
    return rows.select(
        F.lit(source.id).alias("source_id"), F.lit(source.type).alias("source_type"), F.lit(source.instance).alias("source_instance"), name.alias("database_name"), name.alias("schema_or_namespace"),
        F.col("pattern").alias("table_or_collection"), F.lit("snapshot").alias("operation"), F.concat(F.lit('{"key":'), C.quote(F.col("key")), F.lit("}")).alias("primary_key"),
        K.change_version("kv", F.col("db"), F.col("key")).alias("change_version"), now.alias("commit_timestamp"),
        F.concat(F.lit('{"key":'), C.quote(F.col("key")), F.lit(',"type":'), C.quote(F.col("type")), F.lit(',"value":'), F.col("value"), F.lit("}")).alias("after"), F.lit(None).cast("string").alias("before"),
        F.concat(F.lit('{"capture_mode":"scan","database_number":'), F.col("db").cast("string"), F.lit(',"key_pattern":'), C.quote(F.col("pattern")), F.lit(',"key_type":'), C.quote(F.col("type")), F.lit("}")).alias("metadata"),
        F.concat(F.lit("{"), F.concat_ws(", ", *shown), F.lit("}")).alias("checkpoint_token"), F.lit("single").alias("mode"),
    )


#: Namespace of an inline event without one.
NAMESPACES = {"postgresql": "public", "mysql": "main", "mariadb": "main", "sqlserver": "dbo", "oracle": "main", "db2": "main", "sqlite": "main", "redis": "db0", "mongodb": "default", "cassandra": "default", "scylladb": "default", "elasticsearch": "default"}


def inline_events(items: DataFrame, source: SourceSpec) -> DataFrame:
    """CHANGE_EVENT rows from partial events (any of its columns), with the defaults of a dry run."""
    have = lambda c: F.col(c).cast("string") if c in items.columns else F.lit(None).cast("string")
    fill = lambda c, *d: F.coalesce(have(c), *d).alias(c)
    made = [
        F.lit(source.id).alias("source_id"), F.lit(source.type).alias("source_type"), F.lit(source.instance).alias("source_instance"), F.lit(source.database).alias("database_name"),
        fill("schema_or_namespace", F.lit(NAMESPACES.get(source.type, "default"))), fill("table_or_collection", F.lit("")), fill("operation", F.lit("snapshot")), fill("primary_key", F.lit("{}")),
        fill("change_version", have("checkpoint_token"), F.lit("0")), fill("commit_timestamp", F.lit("1970-01-01T00:00:00Z")), fill("after", F.lit("{}")), have("before").alias("before"), fill("metadata", F.lit("{}")),
        fill("checkpoint_token", have("change_version"), F.lit("0")), F.lit("single").alias("mode"),
    ]
    return items.select(*made)


#: Order columns of events by kind of feed.
ORDERS = {
    "watermark": ["order_time", "order_table", "order_pk"], "text": ["commit_timestamp", "schema_or_namespace", "table_or_collection", "primary_key"],
    "tracking": ["change_version", "table_key", "order_pk"], "redo": ["scn", "rs_id", "ssn", "row_index"], "kv": ["db", "pattern", "key"],
}


def order_events(events: DataFrame, mode: str) -> DataFrame:
    """events with seq, their place in the global order of a feed (unique), found without one big partition."""
    return sequence(events, ORDERS[mode])
