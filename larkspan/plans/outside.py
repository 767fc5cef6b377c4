"""Tables of blocks, databases, and table functions over tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.functions.tables import register_tables
from larkspan.plans.registry import query
from larkspan.sources.blocks import register_blocks
from larkspan.sources.jdbc import embedded
from larkspan.streaming.run import checkpoint_folder, drain
from larkspan.tables import Tables


def _blocks(t: Tables, *parts: DataFrame) -> str:
    """The path of a new table of blocks that holds the parts, a commit each."""
    register_blocks(t.spark)
    path = f"{checkpoint_folder(t.spark)}/blocks-{uuid.uuid4().hex}"
    for part in parts:
        part.write.format("blocks").option("path", path).option("block_rows", 500).mode("append").save()
    return path


@query("SELECT page_id, url, length(html)::BIGINT AS chars FROM pages WHERE page_id >= (SELECT median(page_id) FROM pages)")
def source_blocks(t: Tables) -> DataFrame:
    """Pages through the block format; only the blocks of the upper half are read."""
    path = _blocks(t, t.pages.repartitionByRange(4, "page_id").sortWithinPartitions("page_id"))
    middle = t.pages.agg(F.median("page_id")).first()[0]
    pages = t.spark.read.format("blocks").option("path", path).load()
    return pages.where(F.col("page_id") >= F.lit(int(-(-middle // 1)))).select("page_id", "url", F.length("html").cast("bigint").alias("chars"))


@query("SELECT page_id, length(html)::BIGINT AS chars FROM pages")
def source_blocks_stream(t: Tables) -> DataFrame:
    """Pages as a stream of commits: the shorter half first, then the others."""
    middle = t.pages.agg(F.median(F.length("html"))).first()[0]
    short = F.length("html") <= middle
    path = _blocks(t, t.pages.where(short), t.pages.where(~short))
    return drain(t.spark.readStream.format("blocks").option("path", path).load().select("page_id", F.length("html").cast("bigint").alias("chars")))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 200000")
def source_jdbc(t: Tables) -> DataFrame:
    """Orders through databases in the memory of the tasks' JVMs, in eight parts; the databases filter."""
    return embedded(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), "orders", "o_orderkey").where("o_totalprice > 200000")


@query("""SELECT user_id::BIGINT AS user_id, count(*) AS n, min(us) AS first_us, max(us) AS last_us FROM (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY us) AS g FROM
(SELECT user_id, epoch_us(ts)::BIGINT AS us, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) <= 3600000000 THEN 0 ELSE 1 END AS s FROM events)) GROUP BY user_id, g""")
def udtf_sessions(t: Tables) -> DataFrame:
    """Sessions by a table function that reads each user's events in order."""
    register_tables(t.spark)
    t.events.select(F.col("user_id").cast("bigint").alias("user_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us")).createOrReplaceTempView("larkspan_moments")
    return t.spark.sql("SELECT user_id, n, first_us, last_us FROM larkspan_sessions(TABLE(larkspan_moments), 'user_id', 'us', 3600)")
