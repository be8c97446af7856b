"""Decoding of landed change feeds into rows with images (SRC-7, 8, 10 to 14, JN-1, JN-2, WIN-6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeledger.functions import canonical as C
from changeledger.functions import decode as D
from changeledger.functions import status as S
from changeledger.functions import tokens as K
from changeledger.operators.keyset import keyset_after
from changeledger.operators.versions import Versions


def match_specs(feed: DataFrame, specs: DataFrame, on: list[str]) -> DataFrame:
    """feed rows of tracked tables.

    specs is a list of tables, which every task can hold; a join that sorts would bring all rows of a hot table to one task.
    """
    return feed.join(F.broadcast(specs), on, "inner")


def trigger_log(log: DataFrame, specs: DataFrame, after_event_id: int, limit: int = 0) -> DataFrame:
    """Rows of a trigger log (event_id, source_schema, source_table, operation, ...) after an id.

    The limit comes before rows of other tables are dropped, so the cursor moves past them too.
    """
    page = log.where(F.col("event_id") > after_event_id)
    page = page.orderBy("event_id").limit(limit) if limit > 0 else page
    out = match_specs(page, specs, ["source_schema", "source_table"])
    return out.withColumns({"operation": S.map_operation(F.col("operation")), "change_version": K.change_version("trigger", F.col("event_id")), "checkpoint_token": K.trigger_token(F.col("event_id"))})


def purge_processed(log: DataFrame, token: Column | str) -> DataFrame:
    """What stays of a trigger log after the checkpoint `token`: rows above its event id; all rows without one."""
    token = F.lit(token) if isinstance(token, str) else token
    done = K.decode_token(token, "trigger_cdc")["event_id"]
    return log.where(F.col("event_id") > F.coalesce(done, F.lit(-(1 << 63))))


def publish_purge(log: Versions, token: str) -> int:
    """Publishes a version of a trigger log without the rows that the checkpoint has passed; only files with such rows are
    written anew, and readers of the version before still find its files."""
    done = K.decode_token(F.lit(token), "trigger_cdc")["event_id"]
    return log.rewrite(F.col("event_id") > F.coalesce(done, F.lit(-(1 << 63))), f"purge-{token}")


#: Sections of a decoded line, told apart outside quotes.
_OLD = r"(?s)old-(?:key|tuple):\s*((?:[^']|'(?:''|[^'])*')*?)\s*new-tuple:\s*(.*)$"


def decode_text_feed(feed: DataFrame) -> DataFrame:
    """feed (lsn, xid, data, ...) with kind (begin, commit, row, other), schema, table, operation, before, after and
    unchanged_columns.

    Images are maps from column to JSON value. An insert has an after image, a delete a before image from its old key
    or its only tuple, an update both where the line holds both. A large value that an update left as it was is null in
    the image and named in unchanged_columns.
    """
    data = F.col("data")
    head = rf"(?s)^table ({D.IDENTIFIER})\.({D.IDENTIFIER}): (INSERT|UPDATE|DELETE): ?(.*)$"
    kind = F.when(data.startswith("BEGIN"), "begin").when(data.startswith("COMMIT"), "commit").when(data.rlike(head), "row").otherwise("other")
    out = feed.withColumn("kind", kind).withColumn("__op", F.regexp_extract(data, head, 3)).withColumn("__body", F.regexp_extract(data, head, 4))
    old, new = F.regexp_extract("__body", _OLD, 1), F.regexp_extract("__body", _OLD, 2)
    split = F.col("__body").rlike(_OLD)
    is_row = F.col("kind") == "row"
    before = F.when(F.col("__op") == "DELETE", F.col("__body")).when(split & (F.col("__op") == "UPDATE"), old)
    after = F.when(F.col("__op") == "INSERT", F.col("__body")).when(F.col("__op") == "UPDATE", F.when(split, new).otherwise(F.col("__body")))
    named = lambda i: F.when(is_row, D.identifier(F.regexp_extract(data, head, i)))
    return out.withColumns({"schema": named(1), "table": named(2), "operation": F.when(is_row, F.lower("__op")), "before": D.text_image(before), "after": D.text_image(after), "unchanged_columns": D.text_unchanged(after)}).drop("__op", "__body")


def row_events(feed: DataFrame, specs: DataFrame | None = None, state: tuple | None = None, row_limit: int = 0) -> DataFrame:
    """One change per row of Write, Update and Delete events (log_file, log_pos, type, schema, table, rows).

    rows is an array of (values, before_values, after_values). row_index counts from 1; state is (file, pos, index)
    of the last delivered row; the limit cuts in (file, pos, index) order.
    """
    out = feed.select("*", F.posexplode("rows").alias("__i", "__r")).withColumn("row_index", F.col("__i") + 1).drop("__i", "rows")
    if specs is not None:
        out = match_specs(out, specs, ["schema", "table"])
    operation = F.when(F.col("type") == "write", "insert").when(F.col("type") == "update", "update").when(F.col("type") == "delete", "delete")
    out = out.withColumns({"operation": operation, "before": F.when(F.col("type") == "delete", F.col("__r.values")).otherwise(F.col("__r.before_values")), "after": F.when(F.col("type") == "write", F.col("__r.values")).otherwise(F.col("__r.after_values"))})
    out = out.where(F.col("operation").isNotNull()).drop("__r")
    place = ["log_file", "log_pos", "row_index"]
    if state is not None:
        out = out.where(keyset_after([F.col(c) for c in place], list(state)))
    out = out.withColumn("change_version", K.change_version("binlog", *[F.col(c) for c in place])).withColumn("checkpoint_token", K.binlog_token(*[F.col(c) for c in place]))
    return out.orderBy(*place).limit(row_limit) if row_limit > 0 else out


def join_current(changes: DataFrame, table: DataFrame, pk: list[str]) -> DataFrame:
    """Net changes with their current rows; deleted rows have none."""
    return changes.join(table, pk, "left")


def change_tracking(changes: DataFrame, table: DataFrame, pk: list[str], table_key: str, since: int, min_valid: int = 0, state: tuple | None = None, row_limit: int = 0) -> DataFrame:
    """Changes (change_version, operation, *pk) after version `since` with their current rows as `current`.

    Order is (version, table, key). A token names table and key only if another change of that version follows, which
    is decided before the limit, so a page that ends inside a version resumes there. state is (version, *pk).
    """
    if since < min_valid:
        raise ValueError(f"changes since version {since} are gone; the source keeps them from {min_valid}")
    cols = ["change_version", *pk]
    rows = changes.where(F.col("change_version") > since) if state is None else changes.where(keyset_after([F.col(c) for c in cols], list(state)))
    # Only the last row of a version is followed by another one: its key is the greatest of its version.
    lasts = rows.groupBy("change_version").agg(F.max(F.struct(*pk)).alias("__last"))
    rows = rows.join(lasts, "change_version").withColumn("inside", F.struct(*pk) < F.col("__last")).drop("__last")
    rows = rows.orderBy(*cols).limit(row_limit) if row_limit > 0 else rows
    current = table.select(*pk, F.struct(*[F.col(c) for c in table.columns]).alias("current"))
    out = join_current(rows, current, pk).withColumn("operation", S.map_operation(F.col("operation")))
    out = out.withColumn("current", F.when(F.col("operation") != "delete", F.col("current")))
    key = K.values([F.col(c).cast("string") if dict(changes.dtypes)[c] in ("tinyint", "smallint", "int", "bigint") else C.quote(F.col(c).cast("string")) for c in pk])
    return out.withColumns({
        "change_version_text": K.change_version("tracking", F.lit(table_key), F.col("change_version"), C.pk_marker([F.col(c) for c in pk])),
        "checkpoint_token": K.tracking_token(F.col("change_version"), F.col("inside"), F.lit(table_key), key),
    })


def redo_feed(redo: DataFrame, specs: DataFrame, state: tuple | None = None) -> DataFrame:
    """Committed redo rows (scn, rs_id, ssn, operation_code, seg_owner, table_name, sql_redo, sql_undo) of tracked tables.

    Codes 1, 2, 3 are insert, delete, update. The resume (scn, rs_id, ssn) is inclusive. row_index counts within
    (scn, rs_id, ssn), so it does not depend on the page.
    """
    out = match_specs(redo.where(F.col("operation_code").isin(1, 2, 3)), specs, ["seg_owner", "table_name"])
    if state is not None:
        place = [F.col(c) for c in ("scn", "rs_id", "ssn")]
        same = (place[0] == state[0]) & (place[1] == state[1]) & (place[2] == state[2])
        out = out.where((place[0] >= state[0]) & (keyset_after(place, list(state)) | same))
    op = F.when(F.col("operation_code") == 1, "insert").when(F.col("operation_code") == 2, "delete").otherwise("update")
    # Each literal is parsed once, in a projection of its own: inside a lambda it would be parsed again for every key.
    redo_sql, update = F.col("sql_redo"), F.col("operation") == "update"
    out = out.withColumn("operation", op)
    parsed = {
        "__where": F.when(F.col("operation") != "insert", D.redo_where_values(redo_sql)), "__set": F.when(update, D.redo_set_values(redo_sql)),
        "__undo": F.when(update, D.redo_set_values(F.col("sql_undo"))), "__new": F.when(F.col("operation") == "insert", D.redo_insert_values(redo_sql)),
    }
    over = lambda c: F.map_concat(F.map_filter("__where", lambda k, _: ~F.array_contains(F.map_keys(c), k)), F.col(c))
    before = F.when(update, over("__undo")).when(F.col("operation") == "delete", F.col("__where"))
    after = F.when(update, over("__set")).otherwise(F.col("__new"))
    index = F.row_number().over(Window.partitionBy("scn", "rs_id", "ssn").orderBy("sql_redo"))
    out = out.withColumn("row_index", index).withColumns(parsed).withColumns({"before": before, "after": after}).drop(*parsed)
    return out.withColumns({"change_version": K.change_version("redo", *[F.col(c) for c in ("scn", "rs_id", "ssn", "row_index")]), "checkpoint_token": K.redo_token(F.col("scn"), F.col("rs_id"), F.col("ssn"))})


def select_redo_members(logs: DataFrame, start_scn: int) -> DataFrame:
    """Redo logs (member, sequence_no, first_change_scn, next_change_scn, kind) to read from start_scn on.

    One per sequence, archived before online; sequence 0 is never merged; each member once.
    """
    live = logs.where((F.col("next_change_scn") == 0) | (F.col("next_change_scn") > start_scn)).dropDuplicates(["member"])
    group = F.when(F.col("sequence_no") == 0, F.col("member")).otherwise(F.lit(""))
    order = Window.partitionBy("sequence_no", group).orderBy(F.when(F.col("kind") == "archived", 0).otherwise(1), "first_change_scn", "member")
    return live.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n").orderBy("first_change_scn", "member")


def change_docs(docs: DataFrame, specs: DataFrame) -> DataFrame:
    """Change-stream documents (resume, operation_type, db, coll, document_key, full_document, update_description): JSON texts.

    Keeps insert, update, replace (as update) and delete; the before image is always null.
    """
    kept = docs.where(F.col("operation_type").isin("insert", "update", "replace", "delete"))
    out = match_specs(kept, specs, ["db", "coll"])
    return out.withColumns({
        "operation": S.map_operation(F.col("operation_type")), "primary_key": C.variant_json(F.col("document_key")), "before": F.lit(None).cast("string"),
        "after": F.when(F.col("operation_type") != "delete", C.variant_json(F.col("full_document"))),
        "metadata": F.concat(F.lit('{"capture_mode":"change-stream","update_description":'), F.coalesce(C.variant_json(F.col("update_description")), F.lit("null")), F.lit("}")),
        "checkpoint_token": F.concat(F.lit("{"), C.quote(F.concat_ws(".", "db", "coll")), F.lit(': {"resume_token": '), C.quote(F.col("resume")), F.lit("}}")),
    })
