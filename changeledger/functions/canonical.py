"""Canonical JSON and the hashes built on it (FN-1 to FN-9). The session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: sha256 of "{}", the after hash of an event without an after image.
EMPTY_HASH = "44136fa355b3678a1146ad16f7e8649e94fb4fc21fe77e8310c060f61caaff8a"


def iso_seconds(ts: Column) -> Column:
    """UTC timestamp text with the fraction dropped."""
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_micros(ts: Column) -> Column:
    """As iso_seconds, with six digits where the fraction is not zero: cursors keep full precision."""
    ts = ts.cast("timestamp")
    fraction = F.date_format(ts, "SSSSSS")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.when(fraction == "000000", F.lit("Z")).otherwise(F.concat(F.lit("."), fraction, F.lit("Z"))))


def normalize(col: Column, dtype: T.DataType) -> Column:
    """The canonical form of a value; structs come out with their fields in code-point order.

    Floats are refused: their text differs between engines, so callers cast them to a declared decimal.
    """
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        raise TypeError("cast floating-point columns to a decimal before hashing")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_seconds(col)
    if isinstance(dtype, (T.DateType, T.DecimalType)):
        return col.cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.lower(F.hex(col))
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: normalize(x, dtype.elementType))
    if isinstance(dtype, T.StructType):
        fields = [normalize(col[f.name], f.dataType).alias(f.name) for f in sorted(dtype.fields, key=lambda f: f.name)]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.MapType):
        return F.transform_values(col, lambda _, v: normalize(v, dtype.valueType))
    return col


def canonical_json(col: Column, dtype: T.DataType) -> Column:
    """Sorted keys, no spaces, nulls kept, text not escaped beyond JSON's needs; a null struct stays null."""
    value = normalize(col, dtype)
    return _json(value, dtype) if _has_map(dtype) else F.to_json(value, {"ignoreNullFields": "false"})


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.MapType) or isinstance(dtype, T.ArrayType) and _has_map(dtype.elementType)


def _json(v: Column, dtype: T.DataType) -> Column:
    """JSON of a normalized value with the keys of maps in order at every depth; null where the value is."""
    if not _has_map(dtype):
        if isinstance(dtype, (T.StructType, T.ArrayType)):
            return F.to_json(v, {"ignoreNullFields": "false"})
        return v.cast("string") if isinstance(dtype, (T.IntegralType, T.BooleanType)) else quote(v)
    inner = lambda x, kind: F.coalesce(_json(x, kind), F.lit("null"))
    if isinstance(dtype, T.StructType):
        fields = sorted(dtype.fields, key=lambda f: f.name)
        parts = [F.concat(quote(F.lit(f.name)), F.lit(":"), inner(v[f.name], f.dataType)) for f in fields]
        return F.when(v.isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")))
    if isinstance(dtype, T.ArrayType):
        return F.concat(F.lit("["), F.array_join(F.transform(v, lambda x: inner(x, dtype.elementType)), ","), F.lit("]"))
    named = F.transform_keys(v, lambda k, _: k.cast("string"))
    pair = lambda k: F.concat(quote(k), F.lit(":"), inner(F.try_element_at(named, k), dtype.valueType))
    return F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.map_keys(named)), pair), ","), F.lit("}"))


def variant_json(text: Column) -> Column:
    """Canonical JSON of a JSON document given as text, whatever its shape."""
    return F.to_json(F.parse_json(text))


def quote(text: Column) -> Column:
    """A JSON string literal."""
    packed = F.to_json(F.struct(text.alias("v")))
    return F.when(text.isNotNull(), F.substring(packed, F.lit(6), F.length(packed) - 6))


def image(df, columns: list[str]) -> Column:
    """Canonical JSON of a row image made of the given columns of df."""
    chosen = T.StructType([f for f in df.schema.fields if f.name in columns])
    return canonical_json(F.struct(*[F.col(c.name) for c in chosen.fields]), chosen)


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def row_hash(json: Column) -> Column:
    return F.when(json.isNotNull(), sha256_hex(json))


def after_hash(json: Column) -> Column:
    """A missing after image counts as an empty one."""
    return F.when(json.isNull(), F.lit(EMPTY_HASH)).otherwise(sha256_hex(json))


IDENTITY = ("change_version", "database_name", "operation", "primary_key", "schema_or_namespace", "source_instance", "source_type", "table_or_collection")


def identity_json(json_columns: tuple[str, ...] = ("primary_key",)) -> Column:
    """Canonical JSON of the eight identity fields, null where one is missing; json_columns already hold JSON."""
    value = lambda c: F.coalesce(F.col(c) if c in json_columns else quote(F.col(c)), F.lit("null"))
    parts = [F.concat(F.lit(f'"{c}":'), value(c)) for c in IDENTITY]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def identity_key() -> Column:
    return sha256_hex(identity_json())


def external_ref(identity: Column, ref_basis: str = "token") -> Column:
    """Reference of an event: over its checkpoint token, or its change version where that is empty.

    ref_basis="version" always takes the version, which no interleaving with other tables changes.
    """
    version = F.col("change_version")
    basis = version if ref_basis == "version" else F.coalesce(F.when(F.col("checkpoint_token") != "", F.col("checkpoint_token")), version)
    return sha256_hex(F.concat_ws(":", identity, basis))


def envelope(events, ref_basis: str = "token"):
    """events (CHANGE_EVENT with JSON text images) with before_hash, after_hash, metadata_hash, identity_key, external_ref."""
    out = events.withColumn("identity_key", identity_key())
    return out.withColumns({
        "before_hash": row_hash(F.col("before")), "after_hash": after_hash(F.col("after")),
        "metadata_hash": sha256_hex(F.coalesce("metadata", F.lit("{}"))), "external_ref": external_ref(F.col("identity_key"), ref_basis),
    })


def document_payload(trace_id: Column | None = None) -> Column:
    """Nested payload of an envelope; trace ids are random, so callers that hash the payload pass their own."""
    names = ["source_type", "source_instance", "database_name", "schema_or_namespace", "table_or_collection", "operation", "primary_key", "change_version", "commit_timestamp", "before_hash", "after_hash", "metadata_hash"]
    return F.struct(*names, (F.uuid() if trace_id is None else trace_id).alias("trace_id"))


def prepare_payload(submitter: str, schema_id: int, policy_id: int, batch: bool = False, payload: Column | None = None, external_ref: Column | None = None) -> Column:
    schema = F.struct(F.lit(schema_id).alias("id"), F.lit("1.0.0").alias("version"), F.lit(True).alias("active"), F.lit("json-sorted-v1").alias("canonicalization_profile"))
    policy = F.struct(F.lit(policy_id).alias("id"), F.lit(True).alias("active"), F.lit(not batch).alias("allow_single"), F.lit(batch).alias("allow_batch"))
    body = (F.col("items") if batch else document_payload()) if payload is None else payload
    return F.struct(F.lit(submitter).alias("submitter"), (F.col("external_ref") if external_ref is None else external_ref).alias("external_ref"), schema.alias("schema"), policy.alias("policy"), body.alias("items" if batch else "payload"))


def batch_item(payload: Column) -> Column:
    return F.struct(F.col("external_ref").alias("external_leaf_ref"), payload.alias("payload"))


def batch_ref(refs: Column) -> Column:
    """Reference of a batch from the array of its members' references; an empty batch is an error."""
    body = F.concat(F.lit('{"count":'), F.size(refs).cast("string"), F.lit(',"leaf_external_refs":["'), F.array_join(F.array_sort(refs), '","'), F.lit('"]}'))
    return sha256_hex(F.when(F.size(refs) > 0, body).otherwise(F.raise_error(F.lit("batch envelopes must not be empty")).cast("string")))


def pk_marker(columns: list[Column], sep: str = ":") -> Column:
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
