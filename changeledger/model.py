"""Shapes that flow through the engine, and the specs of tracked objects and sources."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from fnmatch import translate

CHANGE_EVENT = (
    "source_id string, source_type string, source_instance string, database_name string, schema_or_namespace string, table_or_collection string, "
    "operation string, primary_key string, change_version string, commit_timestamp string, after string, before string, metadata string, checkpoint_token string, mode string"
)
#: Columns of CHANGE_EVENT in order. Keys, images and metadata are canonical JSON text, so that one table holds any mix of rows.
EVENT_COLUMNS = [f.split()[0] for f in CHANGE_EVENT.split(", ")]


@dataclass(frozen=True)
class TableSpec:
    """A tracked table, collection or index, bound to a DataFrame's columns."""

    schema: str
    table: str
    watermark: str
    pk: tuple[str, ...]
    columns: tuple[str, ...] = ()
    commit: str | None = None

    @property
    def key(self) -> str:
        return f"{self.schema}.{self.table}"

    @property
    def commit_column(self) -> str:
        return self.commit or self.watermark


@dataclass(frozen=True)
class KeySpec:
    """Keys of one numbered database that match a glob pattern."""

    db: int
    pattern: str

    @property
    def regex(self) -> str:
        """The pattern as a Java regular expression; only *, ? and [..] are special."""
        body = translate(self.pattern)
        found = re.fullmatch(r"\(\?s:(.*)\)\\[Zz]", body, re.S)
        return f"(?s)^{found[1]}$"


@dataclass(frozen=True)
class SourceSpec:
    id: str
    type: str
    instance: str = "main"
    database: str = "main"
    backfill_mode: str = "full"
    batch_size: int = 100
    options: dict = field(default_factory=dict)
