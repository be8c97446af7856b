"""Global sequences and running states without one big partition, on any order, unique or not.

The rows are stored once, each with a row number and a hash of what is not in the order. Their order columns alone are then
range-partitioned, with hash and row number as last order columns, so that ties have one order and a key that repeats
may spread over partitions; they are stored with their place. A pass within partitions and one over a row per partition (and
group) agree on those places. The value found comes back to the rows by their row number: every row of the input is in
the result once, whatever its order columns hold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from changeledger.operators.scratch import Scratch

#: Measured bytes and counted rows for each partition, whatever number of shuffle partitions the session has; the most partitions.
PER_TASK, ROWS, MOST = 64 << 20, 1_000_000, 100_000
#: Places number rows within partitions in their low bits.
LOW = 33


def partitions(size: int, rows: int = 0) -> int:
    return max(1, min(MOST, max(-(-size // PER_TASK), -(-rows // ROWS))))


def _hashable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_hashable(f.dataType) for f in kind)
    return not isinstance(kind, (MapType, VariantType))


def hash_of(df: DataFrame, known: Sequence[str]) -> Column:
    """A hash of df's columns beside the known ones; maps and variants, which have none, are left out."""
    rest = [F.col(f"`{f.name}`") for f in df.schema if f.name not in known and _hashable(f.dataType)]
    return F.xxhash64(*rest) if rest else F.lit(0).cast("long")


class Placed:
    """df's rows stored with `__row`, and their order columns and value stored with their place in the whole order."""

    def __init__(self, df: DataFrame, keys: Sequence[str], within: Sequence[str] = (), **values: Column):
        self.columns, scratch = df.columns, Scratch(df.sparkSession)
        order = [*within, *[k for k in keys if k not in within]]
        made = {"__row": F.monotonically_increasing_id(), "__tie": hash_of(df, order), **values}
        self.rows = scratch.save(df.withColumns(made), "rows")
        narrow = self.rows.select(*order, "__tie", "__row", *values)
        whole = [*order, "__tie", "__row"]
        self.parts = partitions(scratch.bytes(self.rows), self.rows.count())
        spread = narrow.repartitionByRange(self.parts, *whole).sortWithinPartitions(*whole)
        place = F.monotonically_increasing_id()
        kept = spread.select(*within, *values, "__row", place.alias("__place"))
        self.order = scratch.save(kept, "order").withColumn("__b", F.shiftright("__place", LOW))

    def by(self, *within: str) -> DataFrame:
        """The order with the rows of a partition and group together."""
        return self.order.repartition(self.parts, "__b", *within)

    def result(self, found: DataFrame, value: str, name: str) -> DataFrame:
        """df's columns and the value found for each row as `name`."""
        values = found.select("__row", F.col(value).alias("__found")).repartition(self.parts, "__row")
        return self.rows.repartition(self.parts, "__row").join(values, "__row").select(*[f"`{c}`" for c in self.columns if c != name], F.col("__found").alias(name))


def _with(rows: DataFrame, ends: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """rows with the value that ends, a row for each key, hold for their key; null keys are equal."""
    names = {k: f"__k{i}" for i, k in enumerate(keys)}
    right = ends.select(*[F.col(k).alias(n) for k, n in names.items()], value)
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(right[n]) for k, n in names.items()])
    return rows.join(right, same).drop(*names.values())


def _before(*groups: str):
    return Window.partitionBy(*groups).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)


def sequence(df: DataFrame, keys: Sequence[str], name: str = "seq", within: Sequence[str] = ()) -> DataFrame:
    """df with `name` = 1, 2, ... in the order of keys, apart for each combination of `within`."""
    placed = Placed(df, keys, within)
    rows = placed.by(*within) if within else placed.order
    if within:
        number = F.row_number().over(Window.partitionBy("__b", *within).orderBy("__place"))
    else:
        number = F.col("__place").bitwiseAND(F.lit((1 << LOW) - 1)) + 1
    # A row for each partition and group at most; groups hold a range of partitions each.
    totals = rows.groupBy("__b", *within).agg(F.count("*").alias("__n"))
    offsets = totals.withColumn("__off", F.coalesce(F.sum("__n").over(_before(*within)), F.lit(0)))
    numbered = _with(rows.withColumn("__rn", number), offsets, ["__b", *within], "__off")
    return placed.result(numbered.withColumn("__seq", (F.col("__rn") + F.col("__off")).cast("long")), "__seq", name)


def running_last(df: DataFrame, keys: Sequence[str], group: str, groups: Sequence[str], value: Column) -> DataFrame:
    """df with __state: for each of `groups` (in that order) the last value of its rows so far, null before the first."""
    placed = Placed(df, keys, __g=F.col(group), __v=value)
    rows = placed.by()
    local = Window.partitionBy("__b").orderBy("__place")
    own = lambda g: F.when(F.col("__g") == g, F.col("__v"))
    lasts = F.array(*[F.last(own(g), ignorenulls=True).over(local) for g in groups])
    at = lambda g: F.when((F.col("__g") == g) & F.col("__v").isNotNull(), F.col("__place"))
    ends = rows.groupBy("__b").agg(*[F.max_by(own(g), at(g)).alias(f"g{i}") for i, g in enumerate(groups)])
    carried = ends.select("__b", F.array(*[F.last(f"g{i}", ignorenulls=True).over(_before()) for i in range(len(groups))]).alias("__carried"))
    joined = rows.withColumn("__local", lasts).join(carried, "__b")
    state = F.zip_with("__local", "__carried", lambda a, b: F.coalesce(a, b))
    return placed.result(joined.withColumn("__all", state), "__all", "__state")


def running_within(df: DataFrame, keys: Sequence[str], within: Sequence[str], value: Column, name: str) -> DataFrame:
    """df with `name`: the last non-null value so far in the order of keys, apart for each combination of `within`.

    A hot group is spread over partitions like any other rows; only its last value per partition is carried on.
    """
    placed = Placed(df, keys, within, __v=value)
    rows = placed.by(*within)
    local = F.last("__v", ignorenulls=True).over(Window.partitionBy("__b", *within).orderBy("__place"))
    ends = rows.groupBy("__b", *within).agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.col("__place"))).alias("__end"))
    carried = ends.withColumn("__carried", F.last("__end", ignorenulls=True).over(_before(*within)))
    joined = _with(rows.withColumn("__local", local), carried, ["__b", *within], "__carried")
    return placed.result(joined.withColumn("__last", F.coalesce("__local", "__carried")), "__last", name)


def since_last(df: DataFrame, keys: Sequence[str], within: Sequence[str], mark: Column, name: str) -> DataFrame:
    """df with `name`: the number of rows so far since the last one where mark holds (0 there), apart for each `within`.

    One pass: numbers and last marks are carried together.
    """
    placed = Placed(df, keys, within, __m=mark)
    local = Window.partitionBy("__b", *within).orderBy("__place")
    counted = placed.by(*within).withColumn("__rn", F.row_number().over(local))
    counted = counted.withColumn("__good", F.max(F.when(F.col("__m"), F.col("__rn"))).over(local))
    ends = counted.groupBy("__b", *within).agg(F.count("*").alias("__n"), F.max("__good").alias("__end"))
    ends = ends.withColumn("__off", F.coalesce(F.sum("__n").over(_before(*within)), F.lit(0)))
    ends = ends.withColumn("__last", F.coalesce(F.max(F.col("__end") + F.col("__off")).over(_before(*within)), F.lit(0)))
    joined = _with(counted, ends.withColumn("__c", F.struct("__off", "__last")), ["__b", *within], "__c")
    run = F.col("__rn") + F.col("__c.__off") - F.coalesce(F.col("__good") + F.col("__c.__off"), F.col("__c.__last"))
    return placed.result(joined.withColumn("__run", run), "__run", name)
