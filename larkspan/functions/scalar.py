"""Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact(column: str | Column, scale: int = 2) -> Column:
    """A decimal, whose sums don't depend on the order of rows."""
    c = F.col(column) if isinstance(column, str) else column
    return c.cast(f"decimal(18,{scale})")


def money(column: Column) -> Column:
    """A double of two decimals, from an exact value."""
    return F.round(column, 2).cast("double")


def safe_divide(a: Column, b: Column) -> Column:
    """Null instead of an error for a zero divisor."""
    return F.when(b != 0, a / b)


def dot(a: Column, b: Column) -> Column:
    """Inner product in doubles, component by component."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null for a zero vector."""
    return safe_divide(dot(a, b), norm(a) * norm(b))


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x))


def time_bucket(time: str, seconds: int) -> Column:
    """Start of the bucket, in epoch seconds."""
    s = F.unix_seconds(F.col(time).cast("timestamp"))
    return s - F.pmod(s, F.lit(seconds))


def words(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
