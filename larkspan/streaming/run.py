"""Runs a stream over what is there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def checkpoint_folder(spark: SparkSession) -> str:
    """In spark.checkpoint.dir, the folder that all executors share; a local session without it gets one of its own."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="larkspan-")
    return f"{path}/larkspan/stream-{uuid.uuid4().hex}"


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """The result of a streaming plan once all input is read, in files: all rows of append mode, all updates, or the last complete result.

    A batch that is run again after a failure replaces its own files.
    """
    spark = stream.sparkSession
    folder = checkpoint_folder(spark)
    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{folder}/state")
    if mode == "append":
        query = writer.format("parquet").start(f"{folder}/rows")
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{folder}/rows")
    def put(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch}")

    writer.foreachBatch(put).start().awaitTermination()
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/rows")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], stream.schema)
    rows = spark.read.schema(T.StructType([*stream.schema, T.StructField("batch", T.LongType())])).option("basePath", f"{folder}/rows").parquet(f"{folder}/rows")
    if mode == "complete":
        rows = rows.where(F.col("batch") == rows.agg(F.max("batch")).first()[0])
    return rows.drop("batch")
