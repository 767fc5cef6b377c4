"""One query for each relational operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspan.functions import exact
from larkspan.operators import asof_join, exact_quantiles, exclude_current_row, groups_frame, interval_join, melt, point_in_range_join, qualify, salted_join, sessionize, spread, not_in
from larkspan.operators.reshape import top_per_group
from larkspan.plans.registry import query
from larkspan.tables import Tables


@query("SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 5000")
def join_inner(t: Tables) -> DataFrame:
    return t.customer.where("c_acctbal > 5000").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name")


@query("SELECT o_orderkey, count(l_linenumber) AS lines FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_returnflag = 'A' GROUP BY ALL")
def join_left(t: Tables) -> DataFrame:
    lines = t.lineitem.where("l_returnflag = 'A'").groupBy("l_orderkey").agg(F.count("l_linenumber").alias("n"))
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce("n", F.lit(0)).cast("bigint").alias("lines"))


@query("SELECT n_name, s_name FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey AND s_acctbal > 8000")
def join_right(t: Tables) -> DataFrame:
    return t.supplier.where("s_acctbal > 8000").join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "right").select("n_name", "s_name")


@query("""SELECT coalesce(a.k, b.k) AS k, a.n AS suppliers, b.n AS customers FROM (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY ALL) a
FULL JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY ALL) b ON a.k = b.k""")
def join_full(t: Tables) -> DataFrame:
    a = t.supplier.where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("suppliers"))
    b = t.customer.where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("customers"))
    return a.join(b, "k", "full").select("k", "suppliers", "customers")


@query("SELECT r_name, n_name FROM region, nation WHERE n_regionkey <> r_regionkey")
def join_cross(t: Tables) -> DataFrame:
    # two dimensions of fixed size
    return t.region.crossJoin(t.nation).where("n_regionkey <> r_regionkey").select("r_name", "n_name")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 48)")
def join_semi(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem.where("l_quantity > 48"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def join_anti(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey", "o_custkey")


@query("SELECT p_partkey FROM part WHERE p_size NOT IN (SELECT s_nationkey FROM supplier)")
def join_not_in(t: Tables) -> DataFrame:
    return not_in(t.part, "p_size", t.supplier, "s_nationkey").select("p_partkey")


@query("SELECT p_partkey FROM part WHERE nullif(p_size, 40) NOT IN (SELECT s_nationkey FROM supplier)")
def join_not_in_left_null(t: Tables) -> DataFrame:
    return not_in(t.part.withColumn("size", F.nullif("p_size", F.lit(40))), "size", t.supplier, "s_nationkey").select("p_partkey")


@query("SELECT p_partkey FROM part WHERE p_size NOT IN (SELECT nullif(s_nationkey, (SELECT min(s_nationkey) FROM supplier)) FROM supplier)")
def join_not_in_null(t: Tables) -> DataFrame:
    """A null among the values: no row is surely not in."""
    least = t.supplier.agg(F.min("s_nationkey")).first()[0]
    return not_in(t.part, "p_size", t.supplier.withColumn("key", F.nullif("s_nationkey", F.lit(least))), "key").select("p_partkey")


@query("SELECT s_suppkey, p_partkey FROM supplier s JOIN part ON p_retailprice >= s_acctbal - 20 AND p_retailprice < s_acctbal + 20")
def join_range(t: Tables) -> DataFrame:
    bands = t.supplier.select("s_suppkey", (F.col("s_acctbal") - 20).alias("low"), (F.col("s_acctbal") + 20).alias("high"))
    return point_in_range_join(t.part.select("p_partkey", "p_retailprice"), bands, "p_retailprice", "low", "high", 40.0).select("s_suppkey", "p_partkey")


@query("""SELECT a.event_id, b.event_id AS before_id, b.value AS before_value FROM (SELECT * FROM events WHERE event_type = 'purchase') a
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') b ON a.user_id = b.user_id AND a.ts >= b.ts""")
def join_asof(t: Tables) -> DataFrame:
    buys = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = t.events.where("event_type = 'view'").select(F.col("event_id").alias("before_id"), "user_id", "ts", F.col("value").alias("before_value"))
    return asof_join(buys, views, ["user_id"], "ts", tie=["before_id"], values=["before_id", "before_value"]).select("event_id", "before_id", "before_value")


@query("""SELECT a.event_id, b.event_id AS before_id FROM (SELECT * FROM events WHERE event_type = 'purchase') a
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') b ON a.user_id = b.user_id AND a.ts > b.ts""")
def join_asof_bucketed(t: Tables) -> DataFrame:
    """Strictly earlier matches, with each user's rows dealt out by day."""
    buys = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = t.events.where("event_type = 'click'").select(F.col("event_id").alias("before_id"), "user_id", "ts")
    return asof_join(buys, clicks, ["user_id"], "ts", tie=["before_id"], values=["before_id"], strict=True, bucket_s=86_400).select("event_id", "before_id")


@query("""SELECT a.event_id AS error_id, b.event_id AS click_id FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL 2 HOUR AND a.ts + INTERVAL 1 HOUR
WHERE a.event_type = 'error' AND b.event_type = 'click'""")
def join_interval(t: Tables) -> DataFrame:
    errors = t.events.where("event_type = 'error'").select(F.col("event_id").alias("error_id"), "user_id", F.col("ts").alias("error_ts"))
    clicks = t.events.where("event_type = 'click'").select(F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("click_ts"))
    return interval_join(errors, clicks, "user_id", "error_ts", "click_ts", 7200, 3600).select("error_id", "click_id")


@query("""SELECT c_custkey, o_orderkey, o_totalprice FROM customer, LATERAL (SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 2)""")
def join_lateral(t: Tables) -> DataFrame:
    top = top_per_group(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 2)
    return t.customer.join(top, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "o_orderkey", "o_totalprice")


@query("SELECT p_brand, count(*) AS n, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS qty FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL")
def join_salted(t: Tables) -> DataFrame:
    facts = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_linenumber", "l_quantity")
    rows = salted_join(facts, t.part.select("p_partkey", "p_brand"), ["p_partkey"], per_part=30)
    return rows.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum(exact("l_quantity")).cast("double").alias("qty"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, grouping(l_returnflag)::INT AS g FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def agg_rollup(t: Tables) -> DataFrame:
    return t.lineitem.rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.grouping("l_returnflag").cast("int").alias("g"))


@query("SELECT l_returnflag, l_linestatus, min(l_quantity) AS low FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def agg_cube(t: Tables) -> DataFrame:
    return t.lineitem.cube("l_returnflag", "l_linestatus").agg(F.min("l_quantity").alias("low"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
def agg_grouping_sets(t: Tables) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return t.orders.groupingSets([[status], [priority], []], status, priority).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, count(*) FILTER (WHERE value > 250) AS large, min(value) AS low, max(value) AS high,
round(avg(value::DECIMAL(18,2))::DOUBLE, 6) AS mean, round(stddev_samp(value), 6) AS sd, arg_max(event_id, value * 1000000 + event_id) AS top_id FROM events GROUP BY ALL""")
def agg_kinds(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"), F.count_if(F.col("value") > 250).alias("large"), F.min("value").alias("low"), F.max("value").alias("high"), F.round(F.sum(exact("value")).cast("double") / F.count("value"), 6).alias("mean"), F.round(F.stddev_samp("value"), 6).alias("sd"), F.max_by("event_id", F.col("value") * 1000000 + F.col("event_id")).alias("top_id"))


@query("SELECT event_type, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY ALL")
def agg_percentiles(t: Tables) -> DataFrame:
    """By selection, as the built-in percentile keeps all values of a group in one buffer."""
    rows = exact_quantiles(t.events, ["event_type"], F.col("value"), [0.5, 0.9])
    own = lambda q: F.round(F.max(F.when(F.col("share") == q, F.col("quantile"))), 6)
    return rows.groupBy("event_type").agg(own(0.5).alias("median"), own(0.9).alias("p90"))


@query("SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS nations, list_sort(list(n_nationkey)) AS keys FROM nation GROUP BY ALL")
def agg_lists(t: Tables) -> DataFrame:
    return t.nation.groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list("n_name")), ",").alias("nations"), F.sort_array(F.collect_list("n_nationkey")).alias("keys"))


@query("SELECT event_type, count(DISTINCT event_id) AS n, true AS close FROM events GROUP BY ALL")
def agg_approximate(t: Tables) -> DataFrame:
    """Estimates within their error: 5 % of a distinct count, and of a median's rank."""
    rows = t.events.groupBy("event_type").agg(F.approx_count_distinct("event_id", 0.02).alias("about"), F.count_distinct("event_id").alias("n"), F.percentile_approx("value", 0.5, 1000).alias("mid"), F.percentile("value", [0.45, 0.55]).alias("near"))
    return rows.select("event_type", "n", ((F.abs(F.col("about") - F.col("n")) <= F.greatest(F.lit(2), 0.05 * F.col("n"))) & F.col("mid").between(F.col("near")[0], F.col("near")[1])).alias("close"))


@query("""SELECT o_custkey, o_orderkey, row_number() OVER w AS rn, rank() OVER p AS rk, dense_rank() OVER p AS dr, round(percent_rank() OVER w, 9) AS pr, round(cume_dist() OVER w, 9) AS cd, ntile(3) OVER w AS nt FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), p AS (PARTITION BY o_custkey ORDER BY o_orderpriority)""")
def window_ranks(t: Tables) -> DataFrame:
    w, p = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"), Window.partitionBy("o_custkey").orderBy("o_orderpriority")
    big = {"rn": F.row_number().over(w), "rk": F.rank().over(p), "dr": F.dense_rank().over(p), "nt": F.ntile(3).over(w)}
    return t.orders.select("o_custkey", "o_orderkey", *(c.cast("bigint").alias(n) for n, c in big.items()), F.round(F.percent_rank().over(w), 9).alias("pr"), F.round(F.cume_dist().over(w), 9).alias("cd"))


@query("""SELECT event_id, lag(value) OVER w AS before, lead(value, 2) OVER w AS after2, first_value(value) OVER w AS head, nth_value(value, 2) OVER w AS second FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""")
def window_offsets(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id")
    return t.events.select("event_id", F.lag("value").over(w).alias("before"), F.lead("value", 2).over(w).alias("after2"), F.first("value").over(w).alias("head"), F.nth_value("value", 2).over(w).alias("second"))


@query("""SELECT event_id, sum(value::DECIMAL(18,2)) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)::DOUBLE AS last3,
count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS in_day FROM events""")
def window_frames(t: Tables) -> DataFrame:
    rows = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(-2, 0)
    day = Window.partitionBy("user_id").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-86_400_000_000, 0)
    return t.events.select("event_id", F.sum(exact("value")).over(rows).cast("double").alias("last3"), F.count(F.lit(1)).over(day).alias("in_day"))


@query("SELECT p_partkey, sum(p_retailprice::DECIMAL(18,2)) OVER (PARTITION BY p_brand ORDER BY p_size GROUPS BETWEEN 1 PRECEDING AND 1 FOLLOWING)::DOUBLE AS around FROM part")
def window_groups(t: Tables) -> DataFrame:
    return groups_frame(t.part, ["p_brand"], "p_size", 1, 1, F.sum(exact("p_retailprice")), "around").select("p_partkey", F.col("around").cast("double").alias("around"))


@query("SELECT s_suppkey, sum(s_acctbal::DECIMAL(18,2)) OVER (PARTITION BY s_nationkey ORDER BY s_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE CURRENT ROW)::DOUBLE AS others FROM supplier")
def window_exclude(t: Tables) -> DataFrame:
    return exclude_current_row(t.supplier.withColumn("bal", exact("s_acctbal")), ["s_nationkey"], "bal", "others").select("s_suppkey", F.col("others").cast("double").alias("others"))


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
def window_qualify(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return qualify(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), F.row_number().over(w) == 1).select("o_custkey", "o_orderkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_k(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10 OFFSET 15")
def top_k_offset(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey").offset(15).limit(10)


@query("SELECT n_name, s_suppkey, s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey QUALIFY row_number() OVER (PARTITION BY n_name ORDER BY s_acctbal DESC, s_suppkey) <= 3")
def top_k_per_group(t: Tables) -> DataFrame:
    top = top_per_group(t.supplier.select("s_nationkey", "s_suppkey", "s_acctbal"), ["s_nationkey"], [F.desc("s_acctbal"), F.col("s_suppkey")], 3)
    return top.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("n_name", "s_suppkey", "s_acctbal")


@query("SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 UNION ALL SELECT s_nationkey FROM supplier")
def set_union_all(t: Tables) -> DataFrame:
    return t.customer.where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey"))


@query("SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 UNION SELECT s_nationkey FROM supplier")
def set_union(t: Tables) -> DataFrame:
    return set_union_all(t).distinct()


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def set_intersect(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_nationkey").alias("k")).intersect(t.supplier.where("s_acctbal > 5000").select("s_nationkey"))


@query("SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier")
def set_intersect_all(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_nationkey").alias("k")).intersectAll(t.supplier.select("s_nationkey"))


@query("SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000")
def set_except(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("k")).subtract(t.supplier.where("s_acctbal > 9000").select("s_nationkey"))


@query("SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
def set_except_all(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_nationkey").alias("k")).exceptAll(t.supplier.select("s_nationkey"))


@query("""SELECT l_returnflag, sum(CASE WHEN l_linestatus = 'F' THEN l_quantity::DECIMAL(18,2) END)::DOUBLE AS f, sum(CASE WHEN l_linestatus = 'O' THEN l_quantity::DECIMAL(18,2) END)::DOUBLE AS o FROM lineitem GROUP BY ALL""")
def reshape_pivot(t: Tables) -> DataFrame:
    wide = spread(t.lineitem, ["l_returnflag"], "l_linestatus", ["F", "O"], F.sum(exact("l_quantity")))
    return wide.select("l_returnflag", F.col("F").cast("double").alias("f"), F.col("O").cast("double").alias("o"))


@query("SELECT s_suppkey, name, value FROM (SELECT s_suppkey, s_acctbal AS balance, s_nationkey::DOUBLE AS nation FROM supplier) UNPIVOT (value FOR name IN (balance, nation))")
def reshape_unpivot(t: Tables) -> DataFrame:
    return melt(t.supplier.select("s_suppkey", F.col("s_acctbal").alias("balance"), F.col("s_nationkey").cast("double").alias("nation")), ["s_suppkey"], ["balance", "nation"])


@query("SELECT doc_id, n_chars::BIGINT AS n FROM documents WHERE n_chars < 0")
def filter_nothing(t: Tables) -> DataFrame:
    return t.documents.where("n_chars < 0").select("doc_id", F.col("n_chars").cast("bigint").alias("n"))


_CHAIN = """WITH RECURSIVE e AS (SELECT s_suppkey, s_nationkey, lead(s_suppkey) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS richer, lag(s_suppkey) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS poorer FROM {supplier}),
c(s_suppkey, richer, depth) AS (SELECT s_suppkey, richer, 1 FROM e WHERE poorer IS NULL UNION ALL SELECT e.s_suppkey, e.richer, c.depth + 1 FROM c JOIN e ON c.richer = e.s_suppkey WHERE c.depth < 20) SELECT s_suppkey, depth FROM c"""


@query(_CHAIN.format(supplier="supplier"))
def recursion(t: Tables) -> DataFrame:
    """The twenty poorest suppliers of each nation, from one to the next: a recursive table expression of so many rounds."""
    t.supplier.createOrReplaceTempView("larkspan_suppliers")
    return t.spark.sql(_CHAIN.format(supplier="larkspan_suppliers"))


@query("""SELECT user_id, session, count(*) AS n, min(event_id) AS first_id FROM (SELECT user_id, event_id, sum(s) OVER (PARTITION BY user_id ORDER BY ts)::BIGINT AS session FROM
(SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS s FROM events)) GROUP BY ALL""")
def sessions(t: Tables) -> DataFrame:
    return sessionize(t.events, "user_id", "ts", 3600).groupBy("user_id", F.col("session").cast("bigint").alias("session")).agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))
