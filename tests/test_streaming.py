"""Late rows, restarts and state over several batches."""

from __future__ import annotations

from datetime import datetime, timedelta

from larkspan.streaming import drain, running_totals, sessions, tumbling, unique_events
from pyspark.sql import functions as F

T0 = datetime(2024, 1, 1, 12)
SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


def put(spark, folder, n, rows):
    """One file a batch; names and times ascend."""
    spark.createDataFrame([(i, T0 + timedelta(minutes=m), u, "view", v) for i, m, u, v in rows], SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{n}")


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*").withWatermark("ts", "10 minutes")


def test_late_rows_are_dropped(spark, tmp_path):
    put(spark, tmp_path, 1, [(1, 0, 1, 1.0), (2, 5, 1, 2.0)])
    put(spark, tmp_path, 2, [(3, 120, 1, 3.0)])
    put(spark, tmp_path, 3, [(4, 130, 1, 3.0)])  # rows count as late against the watermark of the batch before
    put(spark, tmp_path, 4, [(5, 1, 1, 100.0), (6, 300, 1, 4.0)])
    rows = {r["start_s"]: (r["n"], r["total"]) for r in drain(tumbling(stream(spark, tmp_path))).collect()}
    first = int((T0 - datetime(1970, 1, 1)).total_seconds())
    assert rows[first] == (2, 3.0) and rows[first + 7200] == (2, 6.0)


def test_dedup_across_batches(spark, tmp_path):
    put(spark, tmp_path, 1, [(1, 0, 1, 1.0), (1, 0, 1, 1.0), (2, 1, 1, 1.0)])
    put(spark, tmp_path, 2, [(2, 1, 1, 1.0), (3, 2, 1, 1.0)])
    assert sorted(r["event_id"] for r in drain(unique_events(stream(spark, tmp_path))).collect()) == [1, 2, 3]


def test_sessions_close(spark, tmp_path):
    put(spark, tmp_path, 1, [(1, 0, 1, 1.0), (2, 20, 1, 2.0)])
    put(spark, tmp_path, 2, [(3, 45, 1, 3.0), (4, 600, 1, 9.0)])
    put(spark, tmp_path, 3, [(5, 1200, 1, 9.0)])
    rows = [(r["n"], r["total"]) for r in drain(sessions(stream(spark, tmp_path))).orderBy("start_s").collect()]
    assert rows[0] == (3, 6.0) and len(rows) >= 1


def test_state_adds_up(spark, tmp_path):
    put(spark, tmp_path, 1, [(1, 0, 1, 1.0), (2, 1, 2, 2.0)])
    put(spark, tmp_path, 2, [(3, 2, 1, 3.5)])
    rows = drain(running_totals(stream(spark, tmp_path)), "update").groupBy("user_id").agg(F.max(F.struct("n", "cents")).alias("x")).collect()
    assert {r["user_id"]: tuple(r["x"]) for r in rows} == {1: (2, 450), 2: (1, 200)}
