"""Frequent items: a count-min table bounds all counts, and only the items that can reach the share are counted."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows and cells of a row of the table.
DEPTH, WIDTH = 4, 1 << 16


def cells(item: Column, depth: int, width: int) -> Column:
    """An item's cell in each row."""
    return F.array(*(F.pmod(F.xxhash64(item, F.lit(i)), F.lit(width)).cast("int") for i in range(depth)))


def count_min(items: DataFrame, item: str, keys: Sequence[str] = (), depth: int = DEPTH, width: int = WIDTH) -> DataFrame:
    """keys, row, cell, n: how many items fall into each cell; row -1 holds the number of all. Null items don't count.

    Tables of parts (days, say) merge by adding their cells: merge_count_min(). Spark adds up before the shuffle, so that
    a task sends a table of depth times width numbers a key at most, however frequent an item is.
    """
    own = items.where(F.col(item).isNotNull()).select(*keys, F.posexplode(F.concat(cells(F.col(item), depth, width), F.array(F.lit(-1)))).alias("row", "cell"))
    return own.groupBy(*keys, F.when(F.col("cell") < 0, -1).otherwise(F.col("row")).alias("row"), "cell").agg(F.count(F.lit(1)).alias("n"))


def merge_count_min(tables: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The table of several parts' tables."""
    return tables.groupBy(*keys, "row", "cell").agg(F.sum("n").alias("n"))


def frequent_items(items: DataFrame, item: str, share: float, table: DataFrame | None = None, depth: int = DEPTH, width: int = WIDTH) -> DataFrame:
    """item, n: exactly the items that make up at least `share` of all that aren't null, with their exact counts.

    A cell never counts less than an item has, so an item whose least cell is under the bound can't be frequent; all
    others are counted, those too that only share their cells with frequent ones. `table`: a count-min table of `items`
    of the same depth and width, if there is one. An empty table gives no row.
    """
    table = count_min(items, item, (), depth, width) if table is None else table
    total = table.where("row = -1").agg(F.sum("n")).first()[0] or 0
    bound = max(1, ceil(Fraction(str(share)) * total))
    high = table.where((F.col("row") >= 0) & (F.col("n") >= bound)).groupBy("row").agg(F.collect_set("cell").alias("cells"))
    rows = {r["row"]: r["cells"] for r in high.collect()}  # 1 / share cells a row, and `width`, at most
    if len(rows) < depth:
        return items.select(F.col(item), F.lit(0).cast("bigint").alias("n")).limit(0)
    own = cells(F.col(item), depth, width)
    maybe = items.where(F.col(item).isNotNull())
    for i in range(depth):
        maybe = maybe.where(own[i].isin(rows[i]))
    return maybe.groupBy(item).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= bound)
