"""NOT IN with SQL's rules for nulls, as an anti join on the key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(left: DataFrame, column: str, right: DataFrame, other: str) -> DataFrame:
    """Rows of `left` whose `column` is NOT IN `other` of `right`.

    An empty right side keeps all rows; a null on it keeps none; else rows with a null go. Spark's own plan broadcasts
    the right side whatever its size; here one row of counts decides, and a shuffled anti join may do the rest.
    """
    n, known = right.agg(F.count(F.lit(1)), F.count(other)).first()
    if not n:
        return left
    values = right.select(F.col(other).alias("__other")).distinct()
    return left.where(F.lit(n == known) & F.col(column).isNotNull()).join(values, F.col(column) == F.col("__other"), "left_anti")
