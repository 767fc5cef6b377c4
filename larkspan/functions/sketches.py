"""Mergeable sketches: partial ones can be stored by day or shard and merged by aggregation later."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distinct_estimate(column: str, lg_k: int = 12) -> Column:
    return F.hll_sketch_estimate(F.hll_sketch_agg(column, F.lit(lg_k)))


def merge_distinct(sketch: str) -> Column:
    return F.hll_sketch_estimate(F.hll_union_agg(sketch))


def approx_quantiles(column: str, quantiles: list[float], accuracy: int = 10_000) -> Column:
    return F.percentile_approx(column, quantiles, accuracy)
