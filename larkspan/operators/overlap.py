"""Overlap join of two tables of intervals: an equi-join on bins of several levels instead of a nested loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspan.operators.shared import fresh

#: The level of intervals without end, and the parts into which the rows that meet these are dealt.
ENDLESS, PARTS = 9999, 64


def overlap_join(left: DataFrame, right: DataFrame, left_low: str, left_high: str, right_low: str, right_high: str, width: float, closed: bool = True, parts: int = PARTS) -> DataFrame:
    """Inner join of rows whose intervals share a point: a.low <= b.high and b.low <= a.high (closed), or both < (not closed, an interval's end isn't its own).

    Bins come in levels, each twice as wide as the level before, `width` on the first. An interval's own level is the first
    whose bins are as wide as it is, so that it touches two of them at most. A row goes to the bins of its own level and
    of each wider one that the other table has; a pair meets on the wider level of both, and is emitted in the one bin
    that holds the larger of both lower bounds. Intervals with an infinite bound have a level of their own, without bins:
    such rows are copied to `parts` parts, of which each row of the other table is in one.

    A closed interval of no length is a point; if not closed, it shares none. A null or NaN bound, or a lower bound above the higher
    one, meets nothing. Both tables' columns must differ in their names, as in any join.
    """
    level, bin_, low, part = fresh("level", "bin", "low", "part", beside=(left, right))
    l_own, r_own = fresh("l_own", "r_own", beside=(left, right))

    def leveled(df: DataFrame, a: str, b: str, own: str) -> DataFrame:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        ends = F.abs(x) == float("inf"), F.abs(y) == float("inf")
        fits = F.greatest(F.lit(0), F.ceil(F.log2(F.nullif(y - x, F.lit(0.0)) / width))).cast("int")
        sound = ~F.isnan(x) & ~F.isnan(y) & (F.col(a) <= F.col(b) if closed else F.col(a) < F.col(b))
        return df.where(sound).withColumn(own, F.when(ends[0] | ends[1] | (y - x == float("inf")), ENDLESS).otherwise(F.coalesce(fits, F.lit(0))))

    a, b = leveled(left, left_low, left_high, l_own), leveled(right, right_low, right_high, r_own)
    # about 60 levels for whole numbers, 2,100 for any doubles
    used = {own: sorted(r[0] for r in df.select(own).distinct().collect()) for df, own in ((a, l_own), (b, r_own))}
    finite = lambda own: [n for n in used[own] if n != ENDLESS]

    def binned(df: DataFrame, x: str, y: str, own: str, other: str) -> DataFrame:
        levels = F.filter(F.array(*map(F.lit, sorted({*finite(l_own), *finite(r_own)}))).cast("array<int>"), lambda n: (n == F.col(own)) | ((n > F.col(own)) & F.array_contains(F.array(*map(F.lit, finite(other))).cast("array<int>"), n)))
        rows = df.where(F.col(own) < ENDLESS).withColumn(level, F.explode(levels))
        return rows.withColumn(bin_, F.explode(F.sequence(place(x), place(y))))

    def place(x: str | Column) -> Column:
        return F.floor((F.col(x) if isinstance(x, str) else x).cast("double") / (width * F.pow(F.lit(2.0), F.col(level))))

    meet = ((F.col(left_low) <= F.col(right_high)) & (F.col(right_low) <= F.col(left_high))) if closed else ((F.col(left_low) < F.col(right_high)) & (F.col(right_low) < F.col(left_high)))
    columns = [*left.columns, *right.columns]
    out = a.limit(0).join(b.limit(0), F.lit(False)).select(*columns) if not finite(l_own) or not finite(r_own) else None
    if out is None:
        both = binned(a, left_low, left_high, l_own, r_own).join(binned(b, right_low, right_high, r_own, l_own), [level, bin_])
        first = place(F.greatest(F.col(left_low).cast("double"), F.col(right_low).cast("double")))
        out = both.where(meet & (F.greatest(l_own, r_own) == F.col(level)) & (first == F.col(bin_))).select(*columns)
    for wide, wide_own, other in ((a, l_own, b.where(F.col(r_own) < ENDLESS)), (b, r_own, a)):
        if ENDLESS in used[wide_own]:
            copies = wide.where(F.col(wide_own) == ENDLESS).withColumn(part, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
            dealt = other.withColumn(part, F.pmod(F.xxhash64(*other.columns), F.lit(parts)).cast("int"))
            out = out.union(copies.join(dealt, part).where(meet).select(*columns))
    return out
