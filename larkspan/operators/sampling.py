"""Samples that depend on the rows alone, so that a lost executor or another partitioning gives the same one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share_of(key: Column) -> Column:
    """A number from 0 to 1 that depends on the key alone."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") / float(1 << 32)


def sample_by_key(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """All rows of about this fraction of the keys."""
    return df.where(share_of(F.col(key)) < fraction)
