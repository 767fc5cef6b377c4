"""A source of its own: evenly spaced numbers, made in parallel on the executors."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Steps(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class StepsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.n, self.step, self.parts = int(options.get("rows", 10)), float(options.get("step", 1.0)), int(options.get("parts", 4))

    def partitions(self) -> list[Steps]:
        cuts = [self.n * i // self.parts for i in range(self.parts + 1)]
        return [Steps(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]

    def read(self, partition: Steps) -> Iterator[tuple]:
        for i in range(partition.first, partition.last):
            yield i, i * self.step


class StepsSource(DataSource):
    """spark.read.format("steps").option("rows", 10).option("step", 0.5).load()"""

    @classmethod
    def name(cls) -> str:
        return "steps"

    def schema(self) -> str:
        return "i bigint, x double"

    def reader(self, schema) -> StepsReader:
        return StepsReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(StepsSource)
