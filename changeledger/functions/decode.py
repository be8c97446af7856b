"""Decoding of feed literals (FN-14, FN-15, FN-19, FN-21)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: An identifier as the output plugin writes it: bare, or quoted with doubled quotes inside.
IDENTIFIER = r"""(?:"(?:[^"]|"")*"|[^\s".:\[\]]+)"""
#: One column of a decoded text row, name[type]:literal. A type may have spaces, a modifier, quoted parts and a trailing [].
TEXT_COLUMN = rf"""({IDENTIFIER})\[((?:"(?:[^"]|"")*"|[^"\[\]]|\[\])+)\]:('(?:[^']|'')*'|[^\s']\S*)"""
#: A redo value: a call with quoted arguments, a quoted literal or a bare word.
REDO_VALUE = r"((?:TO_\w+\((?:'(?:''|[^'])*'|[^()'])*\))|'(?:''|[^'])*'|[^,\s()]+)"
#: Type numbers by the form of their values.
OIDS = {"int": (20, 21, 23, 26), "float": (700, 701), "bool": (16,), "text_number": (1700,), "json": (114, 3802)}


#: Fixed value: what the output plugin writes for a large value that an update leaves as it was.
UNCHANGED = "unchanged-toast-datum"


def pg_literal(literal: Column) -> Column:
    """Text of a literal: NULL and an unchanged value are null, quotes go, doubled quotes become one, bits are their digits;
    other text stays."""
    quoted = F.regexp_extract(literal, r"(?s)^'(.*)'$", 1)
    bits = literal.rlike(r"^B'[01]*'$")
    text = F.when(literal.startswith("'"), F.replace(quoted, F.lit("''"), F.lit("'"))).when(bits, F.regexp_extract(literal, "'(.*)'", 1)).otherwise(literal)
    return F.when((F.upper(literal) != "NULL") & (literal != UNCHANGED), text)


def pg_literal_json(literal: Column) -> Column:
    """The literal as JSON: null, number and boolean literals bare, all else as a string."""
    bare = literal.rlike(r"^-?(0|[1-9]\d*)$") | literal.isin("true", "false")
    return F.when((F.upper(literal) == "NULL") | (literal == UNCHANGED), F.lit("null")).when(bare, literal).otherwise(_string(pg_literal(literal)))


def _string(text: Column) -> Column:
    packed = F.to_json(F.array(text))
    return F.substring(packed, F.lit(2), F.length(packed) - 2)


def pg_value_json(kind: Column, payload: Column, oid: Column) -> Column:
    """A binary tuple value as JSON: kind n or u is null, b hex text, t typed by its OID."""
    text = F.decode(payload, "UTF-8")
    bare = oid.isin(*OIDS["int"], *OIDS["float"])
    typed = F.when(bare, text).when(oid.isin(*OIDS["bool"]), F.when(text.isin("t", "true"), "true").otherwise("false")).when(oid.isin(*OIDS["json"]), F.to_json(F.parse_json(text))).otherwise(_string(text))
    return F.when(kind.isin("n", "u"), F.lit("null")).when(kind == "b", _string(F.lower(F.hex(payload)))).otherwise(typed)


def identifier(name: Column) -> Column:
    """A name without its quotes."""
    inner = F.substring(name, F.lit(2), F.length(name) - 2)
    return F.when(name.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(name)


def text_image(section: Column) -> Column:
    """Map column -> JSON value of one section of a decoded text line."""
    names, values = F.regexp_extract_all(section, F.lit(TEXT_COLUMN), F.lit(1)), F.regexp_extract_all(section, F.lit(TEXT_COLUMN), F.lit(3))
    image_ = F.map_from_arrays(F.transform(names, identifier), F.transform(values, pg_literal_json))
    return F.when(section.isNotNull() & (F.size(names) > 0), image_)


def text_unchanged(section: Column) -> Column:
    """Names of the columns of a section whose value an update left as it was."""
    names, values = F.regexp_extract_all(section, F.lit(TEXT_COLUMN), F.lit(1)), F.regexp_extract_all(section, F.lit(TEXT_COLUMN), F.lit(3))
    marked = F.filter(F.arrays_zip(names.alias("name"), values.alias("value")), lambda x: x["value"] == UNCHANGED)
    return F.transform(marked, lambda x: identifier(x["name"]))


def redo_value(value: Column) -> Column:
    """Text of a redo literal; time literals become UTC text, NULL null."""
    inner = F.regexp_extract(value, r"^TO_\w+\('((?:''|[^'])*)'", 1)
    stamp = F.coalesce(F.try_to_timestamp(inner, F.lit("dd-MMM-yy hh.mm.ss.SSSSSS a")), F.try_to_timestamp(inner, F.lit("dd-MMM-yy hh.mm.ss a")))
    when = F.coalesce(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'"), inner)
    return F.when(value.startswith("TO_"), when).otherwise(pg_literal(value))


def _pairs(text: Column) -> Column:
    """Map of `"name" = value` pairs; unquoted names such as ROWID are left out."""
    pair = r'"((?:""|[^"])*)"\s*(?:=|is)\s*' + REDO_VALUE
    names, values = F.regexp_extract_all(text, F.lit(pair), F.lit(1)), F.regexp_extract_all(text, F.lit(pair), F.lit(2))
    return F.map_from_arrays(F.transform(names, _single), F.transform(values, redo_value))


def _single(name: Column) -> Column:
    return F.replace(name, F.lit('""'), F.lit('"'))


#: Text without unbalanced quotes, so that words inside literals never end a clause.
_BALANCED = r"((?:'(?:''|[^'])*'|[^'])*?)"


def redo_insert_values(sql: Column) -> Column:
    head = r'(?is)^insert\s+into\s+"[^"]+"\."[^"]+"\s*\(((?:"(?:""|[^"])*"|[^)"])*)\)\s*values\s*\((.*)\)\s*;?\s*$'
    names = F.regexp_extract_all(F.regexp_extract(sql, head, 1), F.lit(r'"((?:""|[^"])*)"'), F.lit(1))
    values = F.regexp_extract_all(F.regexp_extract(sql, head, 2), F.lit(REDO_VALUE), F.lit(1))
    return F.when(F.size(names) == F.size(values), F.map_from_arrays(F.transform(names, _single), F.transform(values, redo_value)))


def redo_set_values(sql: Column) -> Column:
    return _pairs(F.regexp_extract(sql, r"(?is)^update\b.*?\sset\s+" + _BALANCED + r"(?:\s+where\s.*)?;?\s*$", 1))


def redo_where_values(sql: Column) -> Column:
    return _pairs(F.regexp_extract(sql, r"(?is)^(?:update|delete)\b" + _BALANCED + r"\swhere\s+(.*?);?\s*$", 2))


TAGS = ("datetime", "date", "time", "decimal", "decimal128", "objectid", "timestamp", "bytes", "binary", "null", "str", "int", "float", "bool")


#: Tags whose values can be compared with a column of a type.
FITTING = {
    "bigint": ("int", "null"), "int": ("int", "null"), "smallint": ("int", "null"), "tinyint": ("int", "null"), "double": ("float", "int", "null"), "float": ("float", "int", "null"), "boolean": ("bool", "null"),
    "decimal": ("decimal", "decimal128", "int", "null"), "timestamp": ("datetime", "timestamp", "null"), "timestamp_ntz": ("datetime", "timestamp", "null"), "date": ("date", "null"), "string": ("str", "objectid", "time", "null"),
}


def tag_value(col: Column, tag: str) -> Column:
    """(type, value): a checkpoint scalar as text that keeps its type."""
    if tag not in TAGS:
        raise ValueError(f"unknown tag {tag}")
    text = F.lower(F.hex(col)) if tag in ("bytes", "binary") else F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") if tag in ("datetime", "timestamp") else col.cast("string")
    return F.struct(F.when(col.isNull(), "null").otherwise(tag).alias("type"), text.alias("value"))


def restore_value(tagged: Column, tag: str) -> Column:
    """The scalar again; a value of another tag is an error."""
    kind = {"datetime": "timestamp", "timestamp": "timestamp", "date": "date", "decimal": "decimal(38,18)", "decimal128": "decimal(38,18)", "int": "bigint", "float": "double", "bool": "boolean"}.get(tag, "string")
    value = F.unhex(tagged["value"]) if tag in ("bytes", "binary") else tagged["value"].cast(kind)
    kind = "binary" if tag in ("bytes", "binary") else kind
    return F.when(tagged["type"] == tag, value).when(tagged["type"] == "null", F.lit(None).cast(kind)).otherwise(F.raise_error(F.lit("another type was stored")).cast(kind))


def rename_positional(values: Column, columns: list[str]) -> Column:
    """Map with keys by position where every key is UNKNOWN_COLn; others stay."""
    place = lambda k: F.regexp_extract(k, r"(\d+)$", 1).cast("int")
    all_unknown = F.forall(F.map_keys(values), lambda k: k.rlike(r"^UNKNOWN_COL\d+$"))
    names = F.array(*[F.lit(c) for c in columns])
    return F.when(all_unknown, F.transform_keys(values, lambda k, _: F.coalesce(F.get(names, place(k)), k))).otherwise(values)
