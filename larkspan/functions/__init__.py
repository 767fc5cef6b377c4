"""Scalar and aggregate functions as column expressions, all in the JVM."""

from larkspan.functions.scalar import cosine, dot, exact, l2_distance, money, norm, safe_divide, time_bucket, words
from larkspan.functions.sketches import approx_quantiles, distinct_estimate, merge_distinct

__all__ = ["approx_quantiles", "cosine", "distinct_estimate", "dot", "exact", "l2_distance", "merge_distinct", "money", "norm", "safe_divide", "time_bucket", "words"]
