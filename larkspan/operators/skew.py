"""Joins whose hot keys are split by a salt."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspan.operators.shared import fresh, written

#: Most keys that are broadcast as hot.
HOT_KEYS = 100_000
#: Salts of facts with a null key.
NULL_PARTS = 4096


def salted_join(facts: DataFrame, dims: DataFrame, on: Sequence[str], per_part: int = 100_000, how: str = "inner") -> DataFrame:
    """Joins facts to dims (inner, left, left_semi or left_anti) with each key's facts split into parts of about per_part rows.

    Only the dims of keys with more facts than that are copied, once for each part. The counts are an aggregate that
    Spark combines before its shuffle; they are broadcast while there are HOT_KEYS of them at most, and beyond that are
    joined by a shuffle, of which adaptive execution splits large partitions. Facts with a null key meet no dims and are
    dealt out evenly. Where no key is hot or null this is a plain join, and no facts are written; the files of written
    facts stay while the result may be read.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(how)
    parts, salt, row = fresh("parts", "salt", "row", beside=(facts, dims))
    own = facts.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / per_part).cast("int").alias(parts)).where(F.col(parts) > 1)
    hot = written(own, "parts")
    number = hot.count()
    no_key = reduce(Column.__or__, (F.col(c).isNull() for c in on))
    if not number and not facts.where(no_key).limit(1).count():
        return facts.join(dims, list(on), how)
    hot = F.broadcast(hot) if number <= HOT_KEYS else hot.hint("merge")
    # numbered and written before the join: equal rows get different salts, and a retried task finds the same ones
    numbered = written(facts.withColumn(row, F.monotonically_increasing_id()), "facts")
    dealt = F.xxhash64(row)
    left = numbered.join(hot, list(on), "left").withColumn(salt, F.when(no_key, -1 - F.pmod(dealt, F.lit(NULL_PARTS))).otherwise(F.pmod(dealt, F.coalesce(parts, F.lit(1)))).cast("bigint")).drop(parts, row)
    right = dims.join(hot, list(on), "left").withColumn(salt, F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(parts, F.lit(1)).cast("bigint") - 1))).drop(parts)
    return left.join(right, [*on, salt], how).drop(salt)
