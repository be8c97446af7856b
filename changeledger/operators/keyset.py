"""Keyset cursors (SRC-1 to SRC-3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeledger.model import TableSpec


def keyset_after(columns: list[Column], values: list) -> Column:
    """Strictly after the values in lexicographic order; the first conjunct lets the scan skip row groups."""
    values = [v if isinstance(v, Column) else F.lit(v) for v in values]
    after = columns[-1] > values[-1]
    for c, v in zip(reversed(columns[:-1]), reversed(values[:-1])):
        after = (c > v) | ((c == v) & after)
    return (columns[0] >= values[0]) & after


def watermark_scan(df: DataFrame, spec: TableSpec, state: tuple | None = None, row_limit: int = 0, pk_as_text: bool = False) -> DataFrame:
    """Rows with a watermark after the cursor (watermark, *pk), the first row_limit in that order; 0 is all.

    The filter comes before the limit, so a page never loses rows behind the cursor. pk_as_text compares keys as text.
    """
    key = [F.col(c).cast("string") if pk_as_text else F.col(c) for c in spec.pk]
    out = df.where(F.col(spec.watermark).isNotNull())
    if state is not None:
        if len(state) != 1 + len(spec.pk):
            raise ValueError("the cursor needs the watermark and every key value")
        out = out.where(keyset_after([F.col(spec.watermark), *key], list(state)))
    return out.orderBy(spec.watermark, *key).limit(row_limit) if row_limit > 0 else out


def gte_scan_then_filter(df: DataFrame, spec: TableSpec, state: tuple, row_limit: int = 0) -> DataFrame:
    """For sources that can only filter `>=`: that filter is pushed, rows up to the cursor are dropped before any limit."""
    fetched = df.where(F.col(spec.watermark) >= F.lit(state[0]))
    return watermark_scan(fetched, spec, state, row_limit)


def late_rows(df: DataFrame, delivered: DataFrame, spec: TableSpec, state: tuple) -> DataFrame:
    """Rows at or behind the cursor that were never delivered (own addition)."""
    behind = df.where(F.col(spec.watermark).isNotNull()).where(~keyset_after([F.col(spec.watermark), *map(F.col, spec.pk)], list(state)))
    return behind.join(delivered.select(*spec.pk), list(spec.pk), "left_anti")
