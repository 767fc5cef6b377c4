"""Window frames without syntax in Spark, sessions and gap filling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspan.operators.shared import fresh


def groups_frame(df: DataFrame, keys: Sequence[str], order: str, before: int, after: int, value: Column, name: str) -> DataFrame:
    """GROUPS BETWEEN before PRECEDING AND after FOLLOWING: a range over the dense rank of peers."""
    (peer,) = fresh("peer", beside=(df,), names=(name,))
    ranked = df.withColumn(peer, F.dense_rank().over(Window.partitionBy(*keys).orderBy(order)))
    w = Window.partitionBy(*keys).orderBy(peer).rangeBetween(-before, after)
    return ranked.withColumn(name, value.over(w)).drop(peer)


#: How the value of the rows before and that of the rows after make one: aggregates that can be put together.
MERGES = {
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
    "count": (F.count, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
}


def _around(df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str, aggregate: str, own: Column | None) -> DataFrame:
    """`name`: the aggregate of the partition's rows whose `order` differs from the row's own; of `own`, too, if it is given."""
    ahead = Window.partitionBy(*keys).orderBy(F.asc(order)).rangeBetween(Window.unboundedPreceding, -1)
    # a frame of all following rows is made anew for each row, one of the preceding rows in the other direction grows
    behind = Window.partitionBy(*keys).orderBy(F.desc(order)).rangeBetween(Window.unboundedPreceding, -1)
    fold, merge = MERGES[aggregate]
    out = merge(fold(value).over(ahead), fold(value).over(behind))
    return df.withColumn(name, out if own is None else merge(out, own))


def exclude(df: DataFrame, keys: Sequence[str], value: Column, name: str, aggregate: str = "sum", order: str | None = None, without: str = "current row") -> DataFrame:
    """An aggregate over the whole partition EXCLUDE CURRENT ROW, GROUP (the row and its peers by `order`) or TIES (its peers).

    aggregate: sum, count, min, max or avg. The rows before and the rows after those left out are aggregated apart and
    merged, so nothing is subtracted: doubles keep small values beside large ones, and an infinite value that is left out
    leaves nothing behind. Null if no value is left (count: 0). Null keys are a key, and null values don't count.
    """
    if without not in ("current row", "group", "ties") or aggregate not in (*MERGES, "avg"):
        raise ValueError((aggregate, without))
    place, total, n = fresh("place", "total", "n", beside=(df,), names=(name,))
    w = Window.partitionBy(*keys).orderBy(order if order else F.lit(0))
    placed = df.withColumn(place, (F.row_number() if without == "current row" else F.dense_rank()).over(w))
    single = {"sum": value, "count": F.when(value.isNotNull(), 1).otherwise(0), "min": value, "max": value}
    own = lambda kind: single[kind] if without == "ties" else None
    if aggregate == "avg":
        both = _around(_around(placed, keys, place, value, total, "sum", own("sum")), keys, place, value, n, "count", own("count"))
        return both.withColumn(name, F.try_divide(total, n)).drop(place, total, n)
    return _around(placed, keys, place, value, name, aggregate, own(aggregate)).drop(place)


def exclude_current_row(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Sum over the partition EXCLUDE CURRENT ROW; null if no other row has a value."""
    return exclude(df, keys, F.col(value), name)


def exclude_peers(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str, ties_only: bool = False) -> DataFrame:
    """Sum over the partition EXCLUDE GROUP (without the row and its peers) or, with ties_only, EXCLUDE TIES (without its peers); null if no value is left."""
    return exclude(df, keys, F.col(value), name, "sum", order, "ties" if ties_only else "group")


def sessionize(df: DataFrame, key: str, time: str, gap_s: int, name: str = "session") -> DataFrame:
    """Numbers each key's sessions from 1: one ends with a pause over gap_s seconds."""
    w = Window.partitionBy(key).orderBy(time)
    pause = F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.lag(time).over(w).cast("timestamp"))
    (new,) = fresh("new", beside=(df,), names=(name,))
    marked = df.withColumn(new, F.when(pause.isNull() | (pause > gap_s * 1_000_000), 1).otherwise(0))
    return marked.withColumn(name, F.sum(new).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))).drop(new)


def gap_fill(df: DataFrame, keys: Sequence[str], bucket: str, step: str, values: Sequence[str]) -> DataFrame:
    """A row for each bucket between a key's first and last; missing values carry the last one forward (LOCF).

    A null key is a key like others. A row with a null bucket has no place in the order and is left out. Rows of one
    bucket are all kept; they come in the order of their values, nulls first.
    """
    first, last = fresh("first", "last", beside=(df,))
    spans = df.groupBy(*keys).agg(F.min(bucket).alias(first), F.max(bucket).alias(last))
    grid = spans.select(*keys, F.explode(F.sequence(first, last, F.expr(f"INTERVAL {step}"))).alias(bucket))
    w = Window.partitionBy(*keys).orderBy(bucket, *values).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = dict(zip((*keys, bucket), fresh(*(f"own_{c}" for c in (*keys, bucket)), beside=(df,)), strict=True))
    own = df.select(*(F.col(c).alias(n) for c, n in named.items()), *values)
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(n)) for c, n in named.items()))
    full = grid.join(own, same, "left")
    return full.select(*keys, bucket, *(F.last(v, ignorenulls=True).over(w).alias(v) for v in values))
