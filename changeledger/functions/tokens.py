"""Change versions and checkpoint tokens (FN-10 to FN-13). Tokens are JSON with sorted keys and spaces after , and :."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from changeledger.functions.canonical import quote


def change_version(mode: str, *parts: Column) -> Column:
    """watermark: key, commit, pk; trigger: id; logical: lsn, i; binlog: file, pos, i; tracking: key, version, pk;
    redo: scn, rs_id, ssn, i; kv: db number, key; doc: resume text. A missing part is empty and keeps its place."""
    text = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    head = {"trigger": "event", "logical": "lsn"}.get(mode)
    if mode == "kv":
        return F.concat(F.lit("db"), text[0], F.lit(":"), text[1])
    return F.concat_ws(":", *([F.lit(head)] if head else []), *text)


def token(fields: dict[str, Column]) -> Column:
    """One flat object; text columns are given through text()."""
    parts = [F.concat(F.lit(f'"{k}": '), fields[k]) for k in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def text(col: Column) -> Column:
    """A JSON string; tokens are ASCII, so other characters are an error."""
    return quote(F.when(col.rlike(r"^[\x00-\x7F]*$"), col).otherwise(F.raise_error(F.lit("tokens hold ASCII only")).cast("string")))


def number(col: Column) -> Column:
    return col.cast("string")


def flag(col: Column) -> Column:
    return F.when(col, F.lit("true")).otherwise(F.lit("false"))


def values(columns: list[Column]) -> Column:
    """A JSON list of already encoded values."""
    return F.concat(F.lit("["), F.concat_ws(", ", *columns), F.lit("]"))


def trigger_token(event_id: Column) -> Column:
    return token({"mode": F.lit('"trigger_cdc"'), "event_id": number(event_id)})


def logical_token(xid: Column, lsn: Column, commit_lsn: Column, index: Column, advance: Column) -> Column:
    return token({"mode": F.lit('"logical_cdc"'), "xid": text(xid), "lsn": text(lsn), "commit_lsn": text(commit_lsn), "event_index": number(index), "advance_lsn": flag(advance)})


def binlog_token(log_file: Column, log_pos: Column, row_index: Column) -> Column:
    return token({"mode": F.lit('"binlog"'), "log_file": text(log_file), "log_pos": number(log_pos), "row_index": number(row_index)})


def tracking_token(version: Column, inside: Column, table_key: Column, pk: Column) -> Column:
    """The table key and the (encoded) key list only where `inside` holds."""
    whole = {"mode": F.lit('"change_tracking"'), "version": number(version)}
    return F.when(inside, token(whole | {"table_key": text(table_key), "pk": pk})).otherwise(token(whole))


def redo_token(scn: Column, rs_id: Column, ssn: Column) -> Column:
    return token({"mode": F.lit('"logminer"'), "scn": number(scn), "rs_id": text(rs_id), "ssn": number(ssn)})


DECODED = {
    "trigger_cdc": "mode string, event_id long",
    "logical_cdc": "mode string, xid string, lsn string, commit_lsn string, event_index int, advance_lsn boolean",
    "binlog": "mode string, log_file string, log_pos long, row_index int",
    "change_tracking": "mode string, version long, table_key string, pk array<string>",
    "logminer": "mode string, scn long, rs_id string, ssn long",
}


def decode_token(col: Column, mode: str, strict: bool = False) -> Column:
    """The token's fields; null for another mode or, unless strict, for text that is no JSON object."""
    got = F.from_json(col, DECODED[mode], {"mode": "PERMISSIVE"})
    if strict:
        got = F.when(col.isNull() | F.try_parse_json(col).isNotNull(), got).otherwise(F.raise_error(F.lit("bad checkpoint token")).cast(got_type(mode)))
    return F.when(got["mode"] == mode, got)


def got_type(mode: str) -> str:
    return "struct<" + ", ".join(f.replace(" ", ":", 1) for f in DECODED[mode].split(", ")) + ">"


def decode_watermarks(col: Column, pk_arity: dict[str, int] | None = None) -> Column:
    """Map table key -> (watermark, pk); a key list of the wrong length is an error."""
    got = F.from_json(col, "map<string, struct<watermark:string, pk:array<string>>>", {"mode": "FAILFAST"})
    if not pk_arity:
        return got
    sizes = F.create_map(*[F.lit(x) for kv in pk_arity.items() for x in kv])
    wrong = F.exists(F.map_entries(got), lambda e: F.coalesce(F.size(e["value"]["pk"]) != sizes[e["key"]], F.lit(False)))
    return F.when(col.isNull() | ~wrong, got).otherwise(F.raise_error(F.lit("checkpoint key has a wrong number of values")).cast("map<string, struct<watermark:string, pk:array<string>>>"))


def lsn_to_long(lsn: Column) -> Column:
    """HI/LO in hex, 64 bits."""
    half = lambda i: F.conv(F.split_part(lsn, F.lit("/"), F.lit(i)), 16, 10).cast("long")
    return F.shiftleft(half(1), 32).bitwiseOR(half(2))


def long_to_lsn(value: Column) -> Column:
    low = value.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.concat(F.hex(F.shiftrightunsigned(value, 32)), F.lit("/"), F.hex(low))


def lsn_compare(a: Column, b: Column) -> Column:
    """-1, 0 or 1."""
    return F.signum(F.when(lsn_to_long(a) > lsn_to_long(b), 1).when(lsn_to_long(a) < lsn_to_long(b), -1).otherwise(0)).cast("int")
