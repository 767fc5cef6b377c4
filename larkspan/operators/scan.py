"""Window functions over a whole table, without a partition, as a distributed prefix scan.

Spark puts a window without PARTITION BY into one task. Here rows are dealt out by ranges of the order, each range is a
window of its own, and one row of totals for each range gives what the earlier ranges add to it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspan.operators.shared import fresh, written

#: Rows of a range, and most ranges: so many rows of totals come to the driver.
RANGE_ROWS, RANGES = 1_000_000, 10_000
#: A column, or a column and whether it ascends.
Order = Sequence[str | tuple[str, bool]]


def sorting(order: Order) -> list[Column]:
    return [F.asc(o) if isinstance(o, str) else F.asc(o[0]) if o[1] else F.desc(o[0]) for o in order]


def whole_scan(df: DataFrame, order: Order, number: str = "row_number", sums: Mapping[str, Column] | None = None, fills: Mapping[str, Column] | None = None, lags: Mapping[str, tuple[Column, int]] | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """`df` with columns over the order of all its rows: `number` (from 1), running sums, last values so far that aren't null (fills), and values of an earlier row (lags) or, with a negative distance, of a later one.

    Rows that tie in `order` follow the hash of all their columns, so that an order value of any number of rows is split;
    rows that are equal in all columns stay in one range. Nulls come as Spark sorts them. A sum is null until it meets a
    value. Sums of doubles depend on the ranges in their last digits; decimals don't. An empty table stays empty.
    """
    sums, fills, lags = dict(sums or {}), dict(fills or {}), dict(lags or {})
    spark, names = df.sparkSession, [*sums, *fills, *lags]
    part, tie, place, end, before, key, found = fresh("part", "tie", "place", "end", "before", "key", "found", beside=(df,), names=(number, *names))
    values = dict(zip(names, fresh(*(f"value_{i}" for i in range(len(names))), beside=(df,), names=(number, *names)), strict=True))
    given = [*sums.values(), *fills.values(), *(c for c, _ in lags.values())]
    rows = df.select("*", *(c.alias(values[n]) for n, c in zip(names, given, strict=True)), F.xxhash64(*df.columns).alias(tie))
    total = rows.count()
    # a range is a task and a file: with less than RANGE_ROWS rows, more of them than keep the cores busy only cost time
    ranges = min(RANGES, total // range_rows + 1, max(4 * spark.sparkContext.defaultParallelism, total // RANGE_ROWS + 1))
    by = [*sorting(order), F.col(tie)]
    dealt = written(rows.repartitionByRange(ranges, *by).withColumn(part, F.spark_partition_id()), "ranges")
    own = Window.partitionBy(part).orderBy(*by)
    ahead = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn(place, F.row_number().over(own).cast("bigint")).withColumn(end, F.count(F.lit(1)).over(Window.partitionBy(part)))
    for n in sums:
        placed = placed.withColumn(n, F.sum(values[n]).over(ahead))
    for n in fills:
        placed = placed.withColumn(n, F.last(values[n], ignorenulls=True).over(ahead))
    for n, (_, distance) in lags.items():
        placed = placed.withColumn(n, (F.lag(values[n], distance) if distance >= 0 else F.lead(values[n], -distance)).over(own))
    placed = written(placed, "placed")
    # what the ranges before add: one row a range
    totals = sorted(placed.where(F.col(place) == F.col(end)).select(part, end, *sums, *fills).collect(), key=lambda r: r[part])
    carried, at, held = [], 0, dict.fromkeys([*sums, *fills])
    for r in totals:
        carried.append((r[part], at, *held.values()))
        at += r[end]
        for n in sums:
            held[n] = r[n] if held[n] is None else held[n] if r[n] is None else held[n] + r[n]
        for n in fills:
            held[n] = held[n] if r[n] is None else r[n]
    earlier = dict(zip(held, fresh(*(f"earlier_{i}" for i in range(len(held))), beside=(placed,), names=(number,)), strict=True))
    kinds = ", ".join([f"`{part}` int, `{before}` bigint", *(f"`{e}` {placed.schema[n].dataType.simpleString()}" for n, e in earlier.items())])
    offsets = F.broadcast(spark.createDataFrame(carried, kinds))  # RANGES rows at most
    full = placed.join(offsets, part).withColumn(number, F.col(place) + F.col(before))
    for n, e in earlier.items():
        added = F.coalesce(F.col(n) + F.col(e), n, e) if n in sums else F.coalesce(n, e)
        full = full.withColumn(n, added.cast(placed.schema[n].dataType))
    # rows so near to their range's edge that the other row lies beyond find it as near to the edge of another range
    back, on = max([0, *(d for _, d in lags.values())]), max([0, *(-d for _, d in lags.values())])
    if back or on:
        near = (F.col(place) <= max(back, on)) | (F.col(place) > F.col(end) - max(back, on))
        edges, inner = written(full.where(near), "edges"), full.where(~near)
        for n, (_, distance) in lags.items():
            beyond = F.col(place) <= distance if distance >= 0 else F.col(place) > F.col(end) + distance
            others = edges.select((F.col(number) + distance).alias(key), F.col(values[n]).alias(found))
            rows = edges.where(beyond).join(others, F.col(number) == F.col(key), "left").withColumn(n, F.col(found)).drop(key, found)
            edges = written(edges.where(~beyond).unionByName(rows), "edges")
        full = inner.unionByName(edges)
    return full.select(*df.columns, number, *names)


def whole_rank(df: DataFrame, order: Order, number: str = "row_number", rank: str = "rank", dense: str = "dense_rank", range_rows: int = RANGE_ROWS) -> DataFrame:
    """`df` with row_number, rank and dense_rank over all its rows: rows whose order columns are equal (nulls, too) share a rank."""
    key, last, first = fresh("peers", "last", "first", beside=(df,), names=(number, rank, dense))
    keyed = df.withColumn(key, F.struct(*(o if isinstance(o, str) else o[0] for o in order)))
    seen = whole_scan(keyed, order, number, lags={last: (F.col(key), 1)}, range_rows=range_rows)
    seen = seen.withColumn(first, (F.col(number) == 1) | ~F.col(key).eqNullSafe(F.col(last))).drop(key, last)
    out = whole_scan(seen, [number], last, sums={dense: F.col(first).cast("bigint")}, fills={rank: F.when(F.col(first), F.col(number))}, range_rows=range_rows)
    return out.select(*df.columns, number, rank, dense)
