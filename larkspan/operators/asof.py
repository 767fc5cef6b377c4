"""As-of joins: each left row with the last right row of its key at or before its time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = 86_400
#: Rows of a key, of both sides, from which on its rows are dealt out by time.
HOT = 1_000_000


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], time: str, right_time: str | None = None, tie: Sequence[str] = (), values: Sequence[str] = (), strict: bool = False, tolerance: str | None = None, bucket_s: int | None = None) -> DataFrame:
    """`left` with the columns `values` of the last right row of the same key whose time isn't later (strict: is earlier).

    One shuffle by key and a window over both sides' union, so no row pairs are made. Of right rows of one time the
    largest by `tie` counts. Rows without a match, with a null key or a null time get nulls. tolerance: an interval
    such as "5 minutes", beyond which a match is too old.

    bucket_s splits each key's rows by time, for keys too large for one task: buckets of so many seconds are dealt out by
    themselves, and each gets the last right row of the earlier ones, which an aggregate of one row for each key and
    bucket finds. 0 and other types than timestamps and dates have none. Unless it is given, the rows of each key are
    counted first, and there are buckets of a day if one has more than HOT of them; the result is the same.
    """
    right_time = right_time or time
    keyed = reduce(Column.__and__, (F.col(c).isNotNull() for c in on))
    # a null key or time matches nothing: such rows would only share a task
    plain, left, right = left.where(~keyed | F.col(time).isNull()), left.where(keyed & F.col(time).isNotNull()), right.where(keyed)
    if bucket_s is None and isinstance(left.schema[time].dataType, T.TimestampType | T.TimestampNTZType | T.DateType):
        sizes = left.select(*on).unionByName(right.select(*on)).groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
        bucket_s = DAY if (sizes.agg(F.max("__n")).first()[0] or 0) > HOT else 0
    packed = F.struct(F.col(right_time).alias("__t"), *(F.col(c).alias(f"__tie{i}") for i, c in enumerate(tie)), *(F.col(c).alias(f"__v{i}") for i, c in enumerate(values)))
    a = left.select(*(F.col(c).alias(f"__k{i}") for i, c in enumerate(on)), F.col(time).alias("__time"), F.lit(0 if strict else 1).alias("__side"), F.struct(*left.columns).alias("__left"))
    b = right.where(F.col(right_time).isNotNull()).select(*(F.col(c).alias(f"__k{i}") for i, c in enumerate(on)), F.col(right_time).alias("__time"), F.lit(1 if strict else 0).alias("__side"), packed.alias("__right"))
    keys = [f"__k{i}" for i in range(len(on))]
    if bucket_s:
        bucket = F.floor(F.unix_seconds(F.col("__time").cast("timestamp")) / bucket_s)
        a, b = a.withColumn("__b", bucket), b.withColumn("__b", bucket)
        lasts = b.groupBy(*keys, "__b").agg(F.max(F.struct("__right", "__side")).alias("__last"))
        grid = a.select(*keys, "__b").distinct().unionByName(lasts.select(*keys, "__b", "__last"), allowMissingColumns=True).groupBy(*keys, "__b").agg(F.first("__last", ignorenulls=True).alias("__last"))
        earlier = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        carried = grid.withColumn("__last", F.last("__last", ignorenulls=True).over(earlier)).where(F.col("__last").isNotNull())
        b = b.unionByName(carried.select(*keys, F.col("__last.__right.__t").alias("__time"), F.col("__last.__side").alias("__side"), F.col("__last.__right").alias("__right"), "__b"))
        keys.append("__b")
    both = a.unionByName(b, allowMissingColumns=True)
    order = [F.col("__time"), F.col("__side"), *(F.col(f"__right.__tie{i}") for i in range(len(tie)))]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = both.withColumn("__hit", F.last("__right", ignorenulls=True).over(w)).where(F.col("__left").isNotNull())
    ok = F.col("__hit.__t") >= F.col("__time") - F.expr(f"INTERVAL {tolerance}") if tolerance else F.lit(True)
    out = hit.select("__left.*", *(F.when(ok, F.col(f"__hit.__v{i}")).alias(c) for i, c in enumerate(values)))
    return out.union(plain.select("*", *(F.lit(None).cast(right.schema[c].dataType).alias(c) for c in values)))
