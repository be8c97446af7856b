"""Retention by distributed selection (WIN-7): the newest n rows of each group, without a task that holds a group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeledger.operators.prefix import hash_of
from changeledger.operators.scratch import Scratch

#: Rows of a group from which its n-th newest is sought by splitting; sampled rows that split it, about.
SMALL, PIVOTS = 100_000, 64


def _same(left: DataFrame, right: DataFrame, by: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"__{c}"]) for c in by])


def _by(df: DataFrame, by: list[str], *more: Column | str) -> DataFrame:
    """df's groups under names of their own, for a join by _same."""
    return df.select(*[F.col(c).alias(f"__{c}") for c in by], *more)


def _open(rows: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """The rows (by, at) among which a group's n-th newest still may be, with the group's want, size, low and high."""
    right = _by(state, by, "want", "size", "low", "high")
    near = (F.col("low").isNull() | (F.col("at") >= F.col("low"))) & (F.col("high").isNull() | (F.col("at") < F.col("high")))
    return rows.join(right, _same(rows, right, by)).where(near).select(*by, "at", "want", "size", "low", "high")


def _split(rows: DataFrame, state: DataFrame, by: list[str], turn: int) -> DataFrame:
    """state (by, want, size, low, high) of large groups, narrowed to one cell of a histogram on sampled rows."""
    near = _open(rows, state, by)
    share = F.ceil(F.col("size") / (2 * PIVOTS)).cast("long")
    picked = near.where(F.pmod(F.xxhash64("at", F.lit(turn)), share) == 0).groupBy(*by).agg(F.sort_array(F.collect_list("at"), asc=False).alias("pivots"))
    right = _by(picked, by, "pivots")
    cells = near.join(right, _same(near, right, by), "left").withColumn("cell", F.size(F.filter(F.coalesce("pivots", F.array()), lambda p: p > F.col("at"))))
    first = lambda c: F.first(c).alias(c)
    counts = cells.groupBy(*by, "cell").agg(F.count("*").alias("n"), *map(first, ("want", "low", "high")))
    newer = F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hit = counts.withColumn("newer", newer).where((F.col("newer") < F.col("want")) & (F.col("want") <= F.col("newer") + F.col("n")))
    found = hit.join(right, _same(hit, right, by), "left")
    pivot = lambda i: F.when(i >= 0, F.get("pivots", i))
    return found.select(
        *by, (F.col("want") - F.col("newer")).cast("long").alias("want"), F.col("n").alias("size"),
        F.coalesce(pivot(F.col("cell")), "low").alias("low"), F.coalesce(pivot(F.col("cell") - 1), "high").alias("high"),
    )


def nth_newest(rows: DataFrame, n: int, by: list[str], scratch: Scratch, small: int = SMALL) -> DataFrame:
    """(by, last): the n-th greatest `at` (unique) of every group with more than n rows.

    A group of more than `small` rows is split again and again at sampled rows, of which its counted cells tell the one to
    go on with; only what is left of it, `small` rows at most, is sorted.
    """
    kind = dict(rows.dtypes)["at"]
    unknown = F.lit(None).cast(kind)
    sizes = rows.groupBy(*by).agg(F.count("*").alias("size")).where(F.col("size") > n)
    state = scratch.save(sizes.select(*by, F.lit(n).cast("long").alias("want"), "size", unknown.alias("low"), unknown.alias("high")), "cells")
    turn = 0
    while not state.where(F.col("size") > small).isEmpty():
        turn += 1
        step = _split(rows, state.where(F.col("size") > small), by, turn)
        state = scratch.save(state.where(F.col("size") <= small).unionByName(step), "cells")
    near = _open(rows, state, by)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("at").desc()))
    return near.withColumn("place", place).where("place = want").select(*by, F.col("at").alias("last"))


def keep_newest(log: DataFrame, n: int, by: list[str], order: list[str], small: int = SMALL) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): the newest n rows of each group, and all others; n <= 0 keeps all.

    Newest is greatest by the order columns, nulls last; ties go by a hash of the other columns, then by the place where
    the row is stored, so each row is in exactly one of the two, repeated rows and null groups too.
    """
    if n <= 0:
        return log, log.limit(0)
    scratch = Scratch(log.sparkSession)
    rows = scratch.save(log.withColumns({"__row": F.monotonically_increasing_id(), "__tie": hash_of(log, order)}), "log")
    at = F.struct(*order, "__tie", "__row")
    last = scratch.save(nth_newest(rows.select(*by, at.alias("at")), n, by, scratch, small), "last")
    right = _by(last, by, "last")
    told = rows.join(right, _same(rows, right, by), "left").withColumn("__keep", F.col("last").isNull() | (at >= F.col("last")))
    return told.where("__keep").select(*log.columns), told.where("not __keep").select(*log.columns)
