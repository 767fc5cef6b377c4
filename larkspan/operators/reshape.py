"""Pivots, their inverse, and filters on window results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, keys: Sequence[str], name: str, names: Sequence, value: Column) -> DataFrame:
    """One column for each of `names`, given so that no job has to look for them."""
    return df.groupBy(*keys).pivot(name, list(names)).agg(value)


def melt(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "name", value: str = "value") -> DataFrame:
    """One row for each of `columns`; nulls stay."""
    return df.unpivot(list(keys), list(columns), name, value)


def qualify(df: DataFrame, condition: Column) -> DataFrame:
    """Rows whose window condition holds (QUALIFY). A rank condition becomes a group limit before the shuffle."""
    return df.withColumn("__q", condition).where("__q").drop("__q")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    from pyspark.sql import Window

    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__rank") <= k).drop("__rank")
