"""Streaming plans over the events table. Event time is a timestamp: watermarks refuse timestamps without a zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, sf_dir: str, late: str = "10 minutes") -> DataFrame:
    """Events as they appear as files, with a watermark on ts."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    # a table is one file or a folder of files; the pattern fits both
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    return stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def _totals(windowed: DataFrame) -> DataFrame:
    return windowed.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total"))


def tumbling(events: DataFrame, size: str = "1 hour") -> DataFrame:
    return _totals(events.groupBy(F.window("ts", size).alias("w"), "event_type")).select(F.unix_seconds("w.start").alias("start_s"), "event_type", "n", F.col("total").cast("double").alias("total"))


def sliding(events: DataFrame, size: str = "6 hours", step: str = "2 hours") -> DataFrame:
    return _totals(events.groupBy(F.window("ts", size, step).alias("w"))).select(F.unix_seconds("w.start").alias("start_s"), "n", F.col("total").cast("double").alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    return _totals(events.groupBy(F.session_window("ts", gap).alias("w"), "user_id")).select("user_id", F.unix_seconds("w.start").alias("start_s"), F.unix_seconds("w.end").alias("end_s"), "n", F.col("total").cast("double").alias("total"))


def unique_events(events: DataFrame) -> DataFrame:
    """Each event_id once within the watermark."""
    return events.dropDuplicatesWithinWatermark(["event_id"]).select("event_id", "user_id", "event_type")


def interval_joined(clicks: DataFrame, buys: DataFrame, within: str = "1 hour") -> DataFrame:
    """Pairs of a click and a later purchase of the same user, no further apart than `within`; the bounds limit the state."""
    a = clicks.where("event_type = 'click'").select(F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("click_ts"))
    b = buys.where("event_type = 'purchase'").select(F.col("event_id").alias("buy_id"), F.col("user_id").alias("buyer_id"), F.col("ts").alias("buy_ts"))
    on = (F.col("user_id") == F.col("buyer_id")) & (F.col("buy_ts") >= F.col("click_ts")) & (F.col("buy_ts") <= F.col("click_ts") + F.expr(f"INTERVAL {within}"))
    return a.join(b, on).select("click_id", "buy_id", "user_id")
