"""Queries of the operators that work in rounds or over whole tables: scans, selection, overlaps, closure, frequent items, touched partitions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspan.functions import exact, words
from larkspan.operators import count_min, exact_quantiles, exclude, frequent_items, merge_count_min, merge_partitions, overlap_join, sessionize, transitive_closure, whole_rank, whole_scan
from larkspan.plans.registry import query
from larkspan.streaming.run import checkpoint_folder
from larkspan.tables import Tables


@query("""SELECT o_orderkey, row_number() OVER w AS place, sum(o_totalprice::DECIMAL(18,2)) OVER (w ROWS UNBOUNDED PRECEDING)::DOUBLE AS running, lag(o_totalprice, 2) OVER w AS two_before, lead(o_custkey) OVER w AS next_customer,
last_value(CASE WHEN o_orderstatus = 'P' THEN o_orderkey END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS last_pending FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey)""")
def window_whole_table(t: Tables) -> DataFrame:
    """Number, running sum, lag, lead and last pending order over all orders, in ranges of the order."""
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice", "o_custkey", "o_orderstatus")
    price = F.col("o_totalprice")
    out = whole_scan(rows, ["o_orderdate", "o_orderkey"], "place", sums={"running": exact("o_totalprice")}, fills={"last_pending": F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey"))}, lags={"two_before": (price, 2), "next_customer": (F.col("o_custkey"), -1)}, range_rows=1000)
    return out.select("o_orderkey", "place", F.col("running").cast("double").alias("running"), "two_before", "next_customer", "last_pending")


@query("SELECT s_suppkey, s_nationkey, rank() OVER (ORDER BY s_nationkey DESC) AS rk, dense_rank() OVER (ORDER BY s_nationkey DESC) AS dr FROM supplier")
def window_whole_ranks(t: Tables) -> DataFrame:
    """Ranks over all suppliers, with ties that lie in several ranges."""
    out = whole_rank(t.supplier.select("s_suppkey", "s_nationkey"), [("s_nationkey", False)], rank="rk", dense="dr", range_rows=50)
    return out.select("s_suppkey", "s_nationkey", "rk", "dr")


@query("""SELECT l_returnflag, 0.5::DOUBLE AS share, round(quantile_cont(l_extendedprice, 0.5), 6) AS quantile FROM lineitem GROUP BY ALL
UNION ALL SELECT l_returnflag, 0.9::DOUBLE, round(quantile_cont(l_extendedprice, 0.9), 6) FROM lineitem GROUP BY ALL""")
def agg_exact_quantiles(t: Tables) -> DataFrame:
    """Median and 90 % quantile by selection in rounds."""
    out = exact_quantiles(t.lineitem, ["l_returnflag"], F.col("l_extendedprice"), [0.5, 0.9], last=500)
    return out.withColumn("quantile", F.round("quantile", 6))


@query("""WITH s AS (SELECT user_id, g, min(ts) AS a, max(ts) AS b FROM (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM
(SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM events)) GROUP BY user_id, g),
e AS (SELECT event_id, ts AS a, ts + INTERVAL 1 SECOND * (1 + event_id % 600) AS b FROM events WHERE event_type = 'error')
SELECT e.event_id, s.user_id, epoch_us(s.a) AS began FROM e JOIN s ON e.a <= s.b AND s.a <= e.b""")
def join_overlap(t: Tables) -> DataFrame:
    """Errors, each with the seconds that it lasted, and all users' sessions that they touch: most sessions are points."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    spans = sessionize(t.events.select("user_id", "ts"), "user_id", "ts", 1800).groupBy("user_id", "session").agg(F.min(micros).alias("began"), F.max(micros).alias("ended"))
    errors = t.events.where("event_type = 'error'").select("event_id", micros.alias("low"), (micros + (1 + F.col("event_id") % 600) * 1_000_000).alias("high"))
    return overlap_join(errors, spans.select("user_id", "began", "ended"), "low", "high", "began", "ended", 600e6).select("event_id", "user_id", "began")


@query("""WITH RECURSIVE e AS (SELECT s_suppkey AS poorer, lead(s_suppkey) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS richer FROM supplier),
c(poorer, richer) AS (SELECT poorer, richer FROM e WHERE richer IS NOT NULL UNION SELECT c.poorer, e.richer FROM c JOIN e ON c.richer = e.poorer WHERE e.richer IS NOT NULL) SELECT poorer, richer FROM c""")
def closure_chains(t: Tables) -> DataFrame:
    """From each supplier's next richer one in its nation to all richer ones."""
    after = F.lead("s_suppkey").over(Window.partitionBy("s_nationkey").orderBy("s_acctbal", "s_suppkey"))
    return transitive_closure(t.supplier.select(F.col("s_suppkey").alias("poorer"), after.alias("richer")), "poorer", "richer")


@query("""WITH RECURSIVE e AS (SELECT DISTINCT event_type AS a, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events),
c(a, b) AS (SELECT a, b FROM e WHERE b IS NOT NULL UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a WHERE e.b IS NOT NULL) SELECT a, b FROM c""")
def closure_cycles(t: Tables) -> DataFrame:
    """Which kinds of events can come after which, by any number of steps: a graph of cycles."""
    after = F.lead("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return transitive_closure(t.events.select(F.col("event_type").alias("a"), after.alias("b")), "a", "b")


@query("""SELECT word, count(*) AS n FROM (SELECT unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')) AS word FROM documents) GROUP BY word
HAVING count(*) >= 0.002 * (SELECT sum(len(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> ''))) FROM documents)""")
def frequent_words(t: Tables) -> DataFrame:
    """Words that are 0.2 % of all words at least."""
    return frequent_items(t.documents.select(F.explode(words(F.col("text"))).alias("word")), "word", 0.002)


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey HAVING count(*) >= 0.0007 * (SELECT count(*) FROM lineitem)")
def frequent_parts(t: Tables) -> DataFrame:
    """Parts that are 0.07 % of all lines at least, from count-min tables by ship month that are merged."""
    lines = t.lineitem.select("l_partkey", F.date_trunc("month", "l_shipdate").alias("month"))
    return frequent_items(lines.select("l_partkey"), "l_partkey", 0.0007, merge_count_min(count_min(lines, "l_partkey", ["month"], 3, 4096)), 3, 4096)


OTHERS = "OVER (PARTITION BY s_nationkey ORDER BY s_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE CURRENT ROW)"


@query(f"SELECT s_suppkey, min(s_acctbal) {OTHERS} AS low, max(s_acctbal) {OTHERS} AS high, count(s_acctbal) {OTHERS} AS n, round(sum(s_acctbal) {OTHERS}, 4) AS total FROM supplier")
def window_exclude_kinds(t: Tables) -> DataFrame:
    """Least, greatest, number and sum (of doubles) of all others of a nation."""
    rows, value = t.supplier.select("s_suppkey", "s_nationkey", "s_acctbal"), F.col("s_acctbal")
    for name, kind in (("low", "min"), ("high", "max"), ("n", "count"), ("total", "sum")):
        rows = exclude(rows, ["s_nationkey"], value, name, kind, "s_suppkey")
    return rows.select("s_suppkey", "low", "high", "n", F.round("total", 4).alias("total"))


SIZES = "OVER (PARTITION BY p_brand ORDER BY p_size ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE"


@query(f"SELECT p_partkey, max(p_retailprice) {SIZES} GROUP) AS other_sizes, min(p_retailprice) {SIZES} TIES) AS without_ties FROM part")
def window_exclude_groups(t: Tables) -> DataFrame:
    rows = exclude(t.part, ["p_brand"], F.col("p_retailprice"), "other_sizes", "max", "p_size", "group")
    return exclude(rows, ["p_brand"], F.col("p_retailprice"), "without_ties", "min", "p_size", "ties").select("p_partkey", "other_sizes", "without_ties")


@query("""WITH o AS (SELECT o_orderkey, o_totalprice, o_orderstatus, year(o_orderdate) AS y FROM orders), c AS (SELECT * FROM o WHERE y = (SELECT max(y) FROM o) AND o_orderstatus <> 'O')
SELECT o_orderkey, o_totalprice, y::INT AS y FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM c) UNION ALL SELECT o_orderkey, o_totalprice + 1, y::INT FROM c WHERE o_orderstatus <> 'P'""")
def merge_touched_partitions(t: Tables) -> DataFrame:
    """Of a table of orders by year only the last year's folder is written again: finished orders change, pending ones go."""
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", F.year("o_orderdate").alias("y"))
    path = f"{checkpoint_folder(t.spark)}/orders-{uuid.uuid4().hex}"
    rows.repartition("y").write.partitionBy("y").parquet(path)
    last = rows.agg(F.max("y").alias("last"))
    changes = rows.join(F.broadcast(last), F.col("y") == F.col("last")).drop("last").where("o_orderstatus <> 'O'")  # one row
    changes = changes.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return merge_partitions(path, changes, ["o_orderkey"], "y", F.col("o_orderstatus") == "P").select("o_orderkey", "o_totalprice", "y")
