"""Streams whose input appears in deals, one after the other, on one checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from larkspan.streaming.run import checkpoint_folder


def drain_deals(deals: Iterable[DataFrame], plan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All rows that `plan` (of append mode) emits while the rows of each deal appear as new files, after those of the deals before were read.

    The stream is started again for each deal and goes on from its checkpoint, with the watermark that all deals before
    have left: as a job would that runs once an hour.
    """
    folder, out = None, None
    for n, deal in enumerate(deals):
        spark = deal.sparkSession
        folder = folder or checkpoint_folder(spark)
        deal.write.parquet(f"{folder}/in/deal-{n:06}")
        out = plan(spark.readStream.schema(deal.schema).parquet(f"{folder}/in/*"))
        out.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{folder}/state").format("parquet").start(f"{folder}/rows").awaitTermination()
    if out is None:
        raise ValueError("no deals")
    return spark.read.schema(out.schema).parquet(f"{folder}/rows")
