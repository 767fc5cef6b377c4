"""Range joins by bins: an equi-join on the bin and an exact filter, instead of a nested loop over all pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.operators.overlap import PARTS
from larkspan.operators.shared import fresh


#: Pairs of a point and a range that a task compares for one bin: bins with more are cut into pieces.
PAIRS = 5_000_000


def _pieces(points: DataFrame, spans: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of an equi-join on `keys`, and the keys with two numbers more, by which each point still meets each range of its bin once.

    A bin of more than PAIRS pairs is a grid of pieces: a point lies in one row and is copied to all columns, a range lies
    in one column and is copied to all rows, with as many of each as make the copies few.
    """
    n, m, high, wide, row, column = fresh("points", "ranges", "high", "wide", "row", "column", beside=(points, spans))
    hot = points.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)).join(spans.groupBy(*keys).agg(F.count(F.lit(1)).alias(m)), keys).where(F.col(n).cast("double") * F.col(m) > PAIRS)
    cells = F.ceil(F.col(n).cast("double") * F.col(m) / PAIRS)
    hot = hot.withColumn(high, F.greatest(F.lit(1), F.least(cells, F.ceil(F.sqrt(cells * F.col(n) / F.col(m))))).cast("int"))
    hot = hot.withColumn(wide, F.ceil(cells / F.col(high)).cast("int")).drop(n, m)
    # a row for PAIRS pairs at least
    one = lambda c: F.coalesce(F.col(c), F.lit(1))
    home = lambda df, c: F.pmod(F.xxhash64(*df.columns), one(c)).cast("int")
    copies = lambda c: F.explode(F.sequence(F.lit(0), one(c) - 1))
    a = points.join(F.broadcast(hot), keys, "left").withColumn(row, home(points, high)).withColumn(column, copies(wide)).drop(high, wide)
    b = spans.join(F.broadcast(hot), keys, "left").withColumn(column, home(spans, wide)).withColumn(row, copies(high)).drop(high, wide)
    return a, b, [*keys, row, column]


def point_in_range_join(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: float) -> DataFrame:
    """Inner join on low <= point < high. Bins come in levels, each with bins twice as wide as the level before.

    A range is copied to the bins that it touches on the first level whose bins are as wide as the range: two at most,
    however wide it is. A point is copied to its bin on each level that ranges have, of which there can be few. A range
    with an infinite bound has no bins: it is copied to PARTS parts, and each point is in one of them. Bins of many points
    and ranges are cut into pieces, so that no bin is one long task. Null bounds and points meet nothing; NaN is larger than all, as in Spark's comparisons.
    """
    level, bin_, part = fresh("level", "bin", "part", beside=(points, ranges))
    endless = lambda c: F.isnan(c) | (F.abs(F.col(c).cast("double")) == float("inf"))
    known = ranges.where(F.col(low) < F.col(high)).withColumn(part, endless(low) | endless(high) | (F.col(high).cast("double") - F.col(low).cast("double") == float("inf")))
    spans = known.where(~F.col(part)).drop(part).withColumn(level, F.greatest(F.lit(0), F.ceil(F.log2((F.col(high).cast("double") - F.col(low)) / width))).cast("int"))
    wide = lambda c: F.col(c) / (width * F.pow(F.lit(2.0), F.col(level)))
    levels = sorted(r[0] for r in spans.select(level).distinct().collect())  # about 60 for whole numbers, 2,100 for any doubles
    r = spans.withColumn(bin_, F.explode(F.sequence(F.floor(wide(low)), F.floor(wide(high)))))
    p = points.where(~endless(point)).withColumn(level, F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn(bin_, F.floor(wide(point)))
    hit = (F.col(point) >= F.col(low)) & (F.col(point) < F.col(high))
    columns = [*points.columns, *ranges.columns]
    copies = known.where(part).withColumn(part, F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    dealt = points.withColumn(part, F.pmod(F.xxhash64(*points.columns), F.lit(PARTS)).cast("int"))
    p, r, keys = _pieces(p, r, [level, bin_])
    return p.join(r, keys).where(hit).select(*columns).union(dealt.join(copies, part).where(hit).select(*columns))


def interval_join(left: DataFrame, right: DataFrame, on: str, left_time: str, right_time: str, before_s: int, after_s: int) -> DataFrame:
    """Inner join of rows of one key whose right time is at most before_s earlier and after_s later, in whole seconds.

    Time is cut into bins as long as the span of both bounds; a left row meets its own and the neighbouring bins.
    """
    span = max(1, before_s + after_s) * 1_000_000
    x, y, bin_ = fresh("left_micros", "right_micros", "bin", beside=(left, right))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    first, last = F.col(x) - before_s * 1_000_000, F.col(x) + after_s * 1_000_000
    a = left.withColumn(x, micros(left_time)).withColumn(bin_, F.explode(F.sequence(F.floor(first / span), F.floor(last / span))))
    b = right.withColumn(y, micros(right_time)).withColumn(bin_, F.floor(F.col(y) / span))
    return a.join(b, [on, bin_]).where(F.col(y).between(first, last)).drop(x, y, bin_)
