"""Exact quantiles by selection: rounds of sketches and counts that narrow an interval of values to the rank sought.

No group's values are held or sorted as a whole. A round sketches the values of each open interval, takes two values
around the rank from the sketch, and counts exactly how many rows lie below them and are equal to them. The rank is then
one of these values or lies in a smaller interval, of which only the rows go to the next round. The last few are ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspan.operators.shared import written

#: Steps of a sketch's grid of shares, its accuracy, rows of a group that are ranked at last, and rounds.
STEPS, ACCURACY, LAST, ROUNDS = 256, 5000, 10_000, 12


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: Column, shares: Sequence[float], last: int = LAST) -> DataFrame:
    """keys, share, quantile (double): as percentile_cont, between the two rows around share * (rows - 1) of each group.

    Null values don't count, and a group without others gives a null; a null key is a key. NaN is larger than all. Rounds
    end when no group has more than `last` rows in an interval, when they no longer get fewer, or after ROUNDS: what is
    left is ranked, so the result is exact in any case.
    """
    spark, names = df.sparkSession, [f"key_{i}" for i in range(len(keys))]
    rows = df.select(F.struct(*(F.col(k).alias(n) for n, k in zip(names, keys, strict=True)), F.lit(0).alias("none")).alias("g"), value.cast("double").alias("v"))
    sizes = written(rows.groupBy("g").agg(F.count("v").alias("n")), "sizes")
    wanted = sizes.withColumn("share", F.explode(F.array(*map(F.lit, shares)).cast("array<double>")))
    place = F.col("share") * (F.col("n") - 1)
    wanted = written(wanted.select("g", "share", "n", (place - F.floor(place)).alias("part"), F.floor(place).alias("low"), F.ceil(place).alias("high")), "wanted")
    # a rank (from 0) of a group, the open interval that holds it, and how many rows lie at or below the interval's lower end
    ranks = wanted.where("n > 0").select("g", F.explode(F.array("low", "high")).alias("rank")).distinct()
    nothing = F.lit(None).cast("double")
    state = written(ranks.select("g", "rank", nothing.alias("a"), nothing.alias("b"), F.lit(0).cast("bigint").alias("below")), "state")
    done, data, held = [], rows.where("v IS NOT NULL").select("g", "v"), None
    inside = (F.col("a").isNull() | (F.col("v") > F.col("a"))) & (F.col("b").isNull() | (F.col("v") < F.col("b")))
    grid = [i / STEPS for i in range(STEPS + 1)]
    for _ in range(ROUNDS):
        open_ = state.select("g", "a", "b").distinct()
        sketch = data.join(open_, "g").where(inside).groupBy("g", "a", "b").agg(F.count(F.lit(1)).alias("m"), F.percentile_approx("v", grid, ACCURACY).alias("s"))
        most = sketch.agg(F.max("m")).first()[0] or 0
        if most <= last or most == held:
            break
        held = most
        at = F.floor((F.col("rank") - F.col("below")) / F.col("m") * STEPS)
        same = F.col("t.g").eqNullSafe(F.col("u.g")) & F.col("t.a").eqNullSafe(F.col("u.a")) & F.col("t.b").eqNullSafe(F.col("u.b"))
        near = state.alias("t").join(sketch.alias("u"), same).select("t.*", "u.m", "u.s")
        near = near.select("g", "rank", "a", "b", "below", F.get("s", F.greatest(at - 1, F.lit(0)).cast("int")).alias("x"), F.get("s", F.least(at + 2, F.lit(STEPS)).cast("int")).alias("y"))
        near = written(near, "pivots")
        count = lambda c: F.sum(F.when(c, 1).otherwise(0))
        v, x, y = (F.col(c) for c in "vxy")
        counts = data.join(near, "g").where(inside).groupBy("g", "rank", "a", "b", "below", "x", "y").agg(count(v < x).alias("lx"), count(v <= x).alias("ex"), count(v < y).alias("ly"), count(v <= y).alias("ey"))
        left = F.col("rank") - F.col("below")
        told = written(counts.withColumn("found", F.when((left >= F.col("lx")) & (left < F.col("ex")), x).when((left >= F.col("ly")) & (left < F.col("ey")), y)).withColumn("left", left), "counts")
        done.append(told.where("found IS NOT NULL").select("g", "rank", F.col("found").alias("v")))
        low = F.when(F.col("left") < F.col("lx"), F.struct("a", F.col("x").alias("b"), "below")).when(F.col("left") < F.col("ly"), F.struct(x.alias("a"), y.alias("b"), (F.col("below") + F.col("ex")).alias("below"))).otherwise(F.struct(y.alias("a"), "b", (F.col("below") + F.col("ey")).alias("below")))
        state = written(told.where("found IS NULL").select("g", "rank", low.alias("s")).select("g", "rank", "s.*"), "state")
        # a row may lie in several ranks' intervals, and is kept once
        data = written(data.alias("d").join(state.alias("s"), (F.col("d.g") == F.col("s.g")) & inside, "left_semi"), "left")
    own = data.join(state, "g").where(inside)
    ranked = own.withColumn("n", F.row_number().over(Window.partitionBy("g", "rank").orderBy("v"))).where(F.col("n") == F.col("rank") - F.col("below") + 1)
    values = ranked.select("g", "rank", "v")
    for d in done:
        values = values.union(d)
    values = written(values, "values")
    out = wanted.join(values.select("g", F.col("rank").alias("low"), F.col("v").alias("x")), ["g", "low"], "left").join(values.select("g", F.col("rank").alias("high"), F.col("v").alias("y")), ["g", "high"], "left")
    x, y = F.col("x"), F.col("y")
    between = F.when(x == y, x).otherwise(x + (y - x) * F.col("part"))
    return out.select(*(F.col(f"g.{n}").alias(k) for n, k in zip(names, keys, strict=True)), "share", between.alias("quantile"))
