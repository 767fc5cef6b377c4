"""Table functions in Python that take a table, by groups of its rows."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, udtf
from pyspark.sql.types import LongType, StructField, StructType


@udtf
class Sessions:
    """larkspan_sessions(TABLE(t), key, time, gap_s): one row for each session of each key, with its rows and its first and last time in microseconds.

    A session ends with a pause over gap_s seconds, or with the key's rows. analyze() asks for the rows by key and time,
    so a call needs no PARTITION BY; the rows of a key pass one by one and only three numbers are kept. A null time is no
    row; an empty table gives none.
    """

    def __init__(self) -> None:
        self.key = self.first = self.last = None
        self.n = 0

    @staticmethod
    def analyze(rows: AnalyzeArgument, key: AnalyzeArgument, time: AnalyzeArgument, gap_s: AnalyzeArgument) -> AnalyzeResult:
        known = {f.name: f for f in rows.dataType.fields} if rows.isTable else {}
        for name in (key.value, time.value):
            if name not in known:
                raise ValueError(f"no column {name}")
        counts = [StructField(n, LongType()) for n in ("n", "first_us", "last_us")]
        return AnalyzeResult(StructType([StructField(key.value, known[key.value].dataType), *counts]), partitionBy=[PartitioningColumn(key.value)], orderBy=[OrderingColumn(time.value)])

    def eval(self, row: Row, key: str, time: str, gap_s: int) -> Iterator[tuple]:
        at = row[time]
        if at is None:
            return
        if self.n and at - self.last > gap_s * 1_000_000:
            yield self.key, self.n, self.first, self.last
            self.n = 0
        if not self.n:
            self.key, self.first = row[key], at
        self.last, self.n = at, self.n + 1

    def terminate(self) -> Iterator[tuple]:
        if self.n:
            yield self.key, self.n, self.first, self.last


def register_tables(spark: SparkSession) -> None:
    spark.udtf.register("larkspan_sessions", Sessions)
