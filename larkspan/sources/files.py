"""File formats that Spark has built in, with schemas given rather than inferred."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FORMATS = {"parquet": {}, "orc": {}, "json": {"ignoreNullFields": "false"}, "csv": {"header": "true", "escape": '"', "multiLine": "true"}, "xml": {"rowTag": "row"}}


def write_files(df: DataFrame, path: str, kind: str = "parquet", partition_by: Sequence[str] = (), mode: str = "errorifexists", **options: str) -> None:
    writer = df.write.format(kind).mode(mode).options(**FORMATS.get(kind, {})).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def read_files(spark: SparkSession, path: str, schema: StructType | str, kind: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(kind).schema(schema).options(**FORMATS.get(kind, {})).options(**options).load(path)


def round_trip(df: DataFrame, folder: str, kind: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """`df` written to a new path in `folder` and read back."""
    path = f"{folder}/{kind}-{uuid.uuid4().hex}"
    write_files(df, path, kind, partition_by)
    return read_files(df.sparkSession, path, df.schema, kind).select(*df.columns)
