"""Sequences of events: rows of one key that take the steps of a pattern one after the other within a span of time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def match_sequence(events: DataFrame, key: str, time: str, tie: str, steps: Mapping[str, Column], within_s: int) -> DataFrame:
    """key and, for each step, the `tie` (a row's id) of the row that took it.

    An automaton reads each key's rows by time, then tie. A row of the first step begins anew, whatever came before; then
    the first row after it that takes the next step counts, and so on. A match ends with the last step, no later than
    within_s seconds after the first row. Rows whose key, time or tie is null take no part.

    Only the last beginning so far matters, and only for within_s seconds: so a key's rows are dealt out in buckets of
    that length, each with the last beginning of the one before, and a key with any number of rows is many tasks. A step
    is then the least row after the step before, an aggregate that Spark combines before its shuffle.
    """
    names, micros = list(steps), within_s * 1_000_000
    order = F.struct(F.unix_micros(F.col(time).cast("timestamp")).alias("t"), F.col(tie).alias("i"))
    known = events.where(F.col(key).isNotNull() & F.col(time).isNotNull() & F.col(tie).isNotNull())
    rows = known.select(F.col(key).alias("k"), order.alias("o"), *(F.coalesce(c, F.lit(False)).alias(f"s{i}") for i, c in enumerate(steps.values())))
    rows = rows.where(" OR ".join(f"s{i}" for i in range(len(names)))).withColumn("b", F.floor(F.col("o.t") / micros))
    lasts = rows.where("s0").groupBy("k", (F.col("b") + 1).alias("b")).agg(F.max("o").alias("o"))
    both = rows.unionByName(lasts.withColumn("s0", F.lit(True)), allowMissingColumns=True)
    ahead = Window.partitionBy("k", "b").orderBy("o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = both.withColumn("first", F.last(F.when(F.col("s0"), F.col("o")), ignorenulls=True).over(ahead))
    begun = begun.where(F.col("first").isNotNull() & (F.col("o") > F.col("first")) & (F.col("o.t") - F.col("first.t") <= micros))
    found = rows.where("s0").select("k", F.col("o").alias("first"), F.col("o").alias("at"), F.col("o.i").alias("i0"))
    for i in range(1, len(names)):
        own = begun.where(f"s{i}").select("k", "first", "o")
        # all rows of a beginning come after it, so the second step needs no look at the first
        after = own if i == 1 else own.join(found.select("k", "first", "at"), ["k", "first"]).where(F.col("o") > F.col("at"))
        taken = after.groupBy("k", "first").agg(F.min("o").alias("at"))
        found = found.drop("at").join(taken, ["k", "first"]).withColumn(f"i{i}", F.col("at.i"))
    return found.select(F.col("k").alias(key), *(F.col(f"i{i}").alias(n) for i, n in enumerate(names)))
