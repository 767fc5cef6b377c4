"""Reports over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspan.functions import exact, money
from larkspan.plans.registry import query
from larkspan.tables import Tables

# exact decimals: sums are then the same in any order of rows
def net() -> Column:
    return exact("l_extendedprice") * (1 - exact("l_discount"))


NET_SQL = "(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(18,2)))"


@query(f"""SELECT l_returnflag, l_linestatus, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS sum_qty, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS sum_base,
round(sum({NET_SQL}), 2)::DOUBLE AS sum_net, round(sum({NET_SQL} * (1 + l_tax::DECIMAL(18,2))), 2)::DOUBLE AS sum_charge, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def pricing_summary(t: Tables) -> DataFrame:
    rows = t.lineitem.where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum(exact("l_quantity")).cast("double").alias("sum_qty"), F.sum(exact("l_extendedprice")).cast("double").alias("sum_base"), money(F.sum(net())).alias("sum_net"), money(F.sum(net() * (1 + exact("l_tax")))).alias("sum_charge"), F.count(F.lit(1)).alias("n"))


@query(f"""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, round(sum({NET_SQL}), 2)::DOUBLE AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE c_mktsegment = (SELECT min(c_mktsegment) FROM customer) AND o_orderdate < TIMESTAMP '1998-03-15' AND l_shipdate > TIMESTAMP '1998-03-15' GROUP BY ALL ORDER BY revenue DESC, o_orderkey LIMIT 10""")
def shipping_priority(t: Tables) -> DataFrame:
    day = F.lit("1998-03-15").cast("timestamp_ntz")
    segment = t.customer.agg(F.min("c_mktsegment").alias("c_mktsegment"))
    buyers = t.customer.join(segment, "c_mktsegment", "left_semi")
    rows = t.orders.where(F.col("o_orderdate") < day).join(buyers, F.col("o_custkey") == F.col("c_custkey"), "left_semi").join(t.lineitem.where(F.col("l_shipdate") > day), F.col("o_orderkey") == F.col("l_orderkey"))
    return rows.groupBy("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).agg(money(F.sum(net())).alias("revenue")).orderBy(F.desc("revenue"), "o_orderkey").limit(10)


@query("""SELECT o_orderpriority, count(*) AS n FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_shipdate > o_orderdate) GROUP BY ALL""")
def order_priority(t: Tables) -> DataFrame:
    late = (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("l_shipdate") > F.col("o_orderdate"))
    return t.orders.join(t.lineitem, late, "left_semi").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT r_name, n_name, round(sum({NET_SQL}), 2)::DOUBLE AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
JOIN supplier ON l_suppkey = s_suppkey AND s_nationkey = c_nationkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def local_suppliers(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, (F.col("o_custkey") == F.col("c_custkey")) & (F.col("s_nationkey") == F.col("c_nationkey")))
    # 25 nations at most, whatever the scale
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy("s_nationkey").agg(F.sum(net()).alias("net")).join(places, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("r_name", "n_name").agg(money(F.sum("net")).alias("revenue"))


@query("""SELECT round(sum(l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(18,2)), 2)::DOUBLE AS revenue FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24""")
def discount_forecast(t: Tables) -> DataFrame:
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    rows = t.lineitem.where((F.col("l_shipdate") >= at("1996-01-01")) & (F.col("l_shipdate") < at("1997-01-01")) & F.col("l_discount").between(0.05, 0.07) & (F.col("l_quantity") < 24))
    return rows.agg(money(F.sum(exact("l_extendedprice") * exact("l_discount"))).alias("revenue"))


@query(f"""SELECT c_custkey, c_name, round(sum({NET_SQL}), 2)::DOUBLE AS lost FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'
GROUP BY ALL ORDER BY lost DESC, c_custkey LIMIT 20""")
def returned_items(t: Tables) -> DataFrame:
    lost = t.lineitem.where("l_returnflag = 'R'").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(money(F.sum(net())).alias("lost"))
    return lost.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "c_name", "lost").orderBy(F.desc("lost"), "c_custkey").limit(20)


@query("""SELECT n_orders, count(*) AS n_customers FROM (SELECT c_custkey, count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority <> '1-URGENT' GROUP BY ALL) GROUP BY ALL""")
def order_counts(t: Tables) -> DataFrame:
    orders = t.orders.where("o_orderpriority <> '1-URGENT'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return t.customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy(F.coalesce("n", F.lit(0)).cast("bigint").alias("n_orders")).agg(F.count(F.lit(1)).alias("n_customers"))


@query(f"""SELECT round(100 * sum(CASE WHEN p_type = 'PROMO' THEN {NET_SQL} ELSE 0 END)::DOUBLE / sum({NET_SQL})::DOUBLE, 4) AS promo_share FROM lineitem JOIN part ON l_partkey = p_partkey""")
def promo_share(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.agg(F.round(100 * F.sum(F.when(F.col("p_type") == "PROMO", net()).otherwise(0)).cast("double") / F.sum(net()).cast("double"), 4).alias("promo_share"))


@query("""SELECT p_brand, p_type, count(DISTINCT l_suppkey) AS suppliers FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size < 20 GROUP BY ALL HAVING count(DISTINCT l_suppkey) > 3""")
def supplier_spread(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part.where("p_size < 20"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy("p_brand", "p_type").agg(F.countDistinct("l_suppkey").alias("suppliers")).where("suppliers > 3")


@query("""SELECT l_orderkey, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS qty FROM lineitem GROUP BY ALL HAVING sum(l_quantity) > 200 ORDER BY qty DESC, l_orderkey LIMIT 100""")
def large_orders(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.sum(exact("l_quantity")).cast("double").alias("qty")).where("qty > 200").orderBy(F.desc("qty"), "l_orderkey").limit(100)


@query("""SELECT l_partkey, round(sum(l_extendedprice::DECIMAL(18,2)), 2)::DOUBLE AS small_sales FROM lineitem l WHERE l_quantity < (SELECT 0.2 * avg(l_quantity) FROM lineitem i WHERE i.l_partkey = l.l_partkey) GROUP BY ALL""")
def small_quantities(t: Tables) -> DataFrame:
    t.lineitem.createOrReplaceTempView("larkspan_lineitem")
    return t.spark.sql("""SELECT l_partkey, cast(round(sum(cast(l_extendedprice AS decimal(18,2))), 2) AS double) AS small_sales FROM larkspan_lineitem l
    WHERE l_quantity < (SELECT 0.2D * avg(l_quantity) FROM larkspan_lineitem i WHERE i.l_partkey = l.l_partkey) GROUP BY l_partkey""")
