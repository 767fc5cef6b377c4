"""Time series, and streaming plans run to the end of their input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.functions import exact, time_bucket
from larkspan.operators import gap_fill
from larkspan.plans.registry import query
from larkspan.streaming import drain, event_stream, interval_joined, running_counts, running_totals, sliding, tumbling, unique_events
from larkspan.streaming import sessions as session_windows
from larkspan.streaming.state import rocks
from larkspan.tables import Tables

TUMBLING = "SELECT (epoch(ts)::BIGINT - epoch(ts)::BIGINT % 3600)::BIGINT AS start_s, event_type, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM (SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM events) GROUP BY ALL"
SLIDING = "SELECT s AS start_s, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM (SELECT value, unnest([b, b - 7200, b - 14400]) AS s FROM (SELECT value, epoch(date_trunc('second', ts))::BIGINT - epoch(date_trunc('second', ts))::BIGINT % 7200 AS b FROM events)) GROUP BY ALL"
SESSIONS = """SELECT user_id, epoch(date_trunc('second', min(ts)))::BIGINT AS start_s, epoch(date_trunc('second', max(ts) + INTERVAL 30 MINUTE))::BIGINT AS end_s, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM
(SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM events)) GROUP BY user_id, g"""


def _events(t: Tables) -> DataFrame:
    return t.events.withColumn("ts", F.col("ts").cast("timestamp"))


@query(TUMBLING)
def time_tumbling(t: Tables) -> DataFrame:
    return tumbling(_events(t))


@query(SLIDING)
def time_sliding(t: Tables) -> DataFrame:
    return sliding(_events(t))


@query(SESSIONS)
def time_sessions(t: Tables) -> DataFrame:
    return session_windows(_events(t))


@query("SELECT (epoch(date_trunc('second', ts))::BIGINT - epoch(date_trunc('second', ts))::BIGINT % 900)::BIGINT AS bucket, user_id, max(value) AS high, arg_max(value, event_id) AS closing, arg_min(value, event_id) AS opening FROM events GROUP BY ALL")
def time_buckets(t: Tables) -> DataFrame:
    return t.events.groupBy(time_bucket("ts", 900).alias("bucket"), "user_id").agg(F.max("value").alias("high"), F.max_by("value", "event_id").alias("closing"), F.min_by("value", "event_id").alias("opening"))


@query("""WITH d AS (SELECT event_type, date_trunc('hour', ts) AS h, sum(value::DECIMAL(18,2))::DOUBLE AS v FROM events GROUP BY ALL), s AS (SELECT event_type, min(h) AS a, max(h) AS b FROM d GROUP BY ALL),
g AS (SELECT event_type, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS h FROM s)
SELECT event_type, epoch(g.h)::BIGINT AS hour_s, last_value(v IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY g.h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM g LEFT JOIN d USING (event_type, h)""")
def time_gap_fill(t: Tables) -> DataFrame:
    hours = _events(t).groupBy("event_type", F.date_trunc("hour", "ts").alias("h")).agg(F.sum(exact("value")).cast("double").alias("v"))
    return gap_fill(hours, ["event_type"], "h", "1 hour", ["v"]).select("event_type", F.unix_seconds("h").alias("hour_s"), "v")


@query(TUMBLING)
def stream_tumbling(t: Tables) -> DataFrame:
    return drain(tumbling(event_stream(t.spark, t.path)), "complete")


@query(SLIDING)
def stream_sliding(t: Tables) -> DataFrame:
    return drain(sliding(event_stream(t.spark, t.path)), "complete")


@query("SELECT event_id, user_id, event_type FROM events")
def stream_dedup(t: Tables) -> DataFrame:
    return drain(unique_events(event_stream(t.spark, t.path)))


@query("""SELECT a.event_id AS click_id, b.event_id AS buy_id, a.user_id FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 1 HOUR WHERE a.event_type = 'click' AND b.event_type = 'purchase'""")
def stream_join(t: Tables) -> DataFrame:
    return drain(interval_joined(event_stream(t.spark, t.path), event_stream(t.spark, t.path)))


@query("SELECT user_id, count(*) AS n, sum(round(value * 100))::BIGINT AS cents FROM events GROUP BY ALL")
def stream_state(t: Tables) -> DataFrame:
    """The last state of each user: with several batches a user has several updates, of which the largest count is the last."""
    rows = drain(running_totals(event_stream(t.spark, t.path)), "update")
    return rows.groupBy("user_id").agg(F.max("n").alias("n"), F.max_by("cents", "n").alias("cents"))


@query(SESSIONS)
def stream_sessions(t: Tables) -> DataFrame:
    return drain(session_windows(event_stream(t.spark, t.path)), "complete")


@query("SELECT user_id, count(*) AS n FROM events GROUP BY ALL")
def stream_processor(t: Tables) -> DataFrame:
    """The last count of each user; with several batches a user has several updates, of which the largest is the last."""
    with rocks(t.spark):
        rows = drain(running_counts(event_stream(t.spark, t.path)), "update")
    return rows.groupBy("user_id").agg(F.max("n").alias("n"))


@query("SELECT c_custkey, c_nationkey FROM customer")
def stream_rate(t: Tables) -> DataFrame:
    """Customers as the counter source reaches their keys, in one batch: a stream joined with a table."""
    most = t.customer.agg(F.max("c_custkey")).first()[0] + 1
    ticks = t.spark.readStream.format("rate-micro-batch").option("rowsPerBatch", most).option("numPartitions", 4).load()
    return drain(ticks.select("value").join(t.customer, F.col("value") == F.col("c_custkey")).select("c_custkey", "c_nationkey"))
