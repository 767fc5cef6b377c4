"""Merges, histories, samples, and SQL forms."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.functions import exact
from larkspan.operators.merge import difference, history, latest, merge
from larkspan.operators.sampling import sample_by_key
from larkspan.plans.registry import query
from larkspan.tables import Tables


@query("""SELECT s_suppkey, s_name, CASE WHEN s_acctbal > 5000 THEN 0 ELSE s_acctbal END AS s_acctbal FROM supplier WHERE s_acctbal >= 0
UNION ALL SELECT s_suppkey + 1000000, s_name, 1 FROM supplier WHERE s_nationkey = 3""")
def merge_rows(t: Tables) -> DataFrame:
    """Suppliers in debt go, rich ones change, those of a nation get a second row."""
    target = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    changed = target.where("s_acctbal > 5000 OR s_acctbal < 0").withColumn("s_acctbal", F.when(F.col("s_acctbal") < 0, F.col("s_acctbal")).otherwise(0.0))
    new = t.supplier.where("s_nationkey = 3").select((F.col("s_suppkey") + 1000000).alias("s_suppkey"), "s_name", F.lit(1.0).alias("s_acctbal"))
    return merge(target, changed.union(new), ["s_suppkey"], F.col("s_acctbal") < 0)


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def merge_latest(t: Tables) -> DataFrame:
    return latest(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type")


@query("""SELECT user_id, event_type, event_id AS valid_from, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS valid_to, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) IS NULL AS is_current FROM
(SELECT * FROM events QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id))""")
def merge_history(t: Tables) -> DataFrame:
    return history(t.events.select("user_id", "event_id", "event_type"), ["user_id"], "event_id", ["event_type"])


@query("""SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'delete' ELSE 'update' END AS change FROM supplier WHERE s_acctbal < 0 OR s_acctbal > 9000
UNION ALL SELECT -1 - s_suppkey, 'insert' FROM supplier WHERE s_nationkey = 5""")
def merge_difference(t: Tables) -> DataFrame:
    old = t.supplier.select("s_suppkey", "s_acctbal")
    kept = old.where("s_acctbal >= 0").withColumn("s_acctbal", F.when(F.col("s_acctbal") > 9000, F.col("s_acctbal") + 1).otherwise(F.col("s_acctbal")))
    new = kept.union(t.supplier.where("s_nationkey = 5").select(-1 - F.col("s_suppkey"), "s_acctbal"))
    return difference(old, new, ["s_suppkey"])


@query("SELECT o_custkey, count(*) AS n FROM orders WHERE ('0x' || substr(md5(o_custkey::VARCHAR), 1, 8))::BIGINT / 4294967296.0 < 0.25 GROUP BY ALL")
def sample_keys(t: Tables) -> DataFrame:
    return sample_by_key(t.orders.select("o_custkey"), "o_custkey", 0.25).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 1000 GROUP BY ALL")
def sql_pipe(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("larkspan_orders")
    return t.spark.sql("FROM larkspan_orders |> WHERE o_totalprice > 1000 |> AGGREGATE count(*) AS n GROUP BY o_orderstatus")


@query("SELECT p_partkey, CASE WHEN p_size < 30 THEN p_retailprice * 0.9 ELSE p_retailprice END AS price FROM part")
def sql_function(t: Tables) -> DataFrame:
    t.part.createOrReplaceTempView("larkspan_part")
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION larkspan_price(size INT, price DOUBLE) RETURNS DOUBLE RETURN CASE WHEN size < 30 THEN price * 0.9D ELSE price END")
    return t.spark.sql("SELECT p_partkey, larkspan_price(p_size, p_retailprice) AS price FROM larkspan_part")


@query("SELECT n_nationkey, (i - 1)::INT AS pos, substr(n_name, i, 1) AS c FROM nation, range(1, 20) r(i) WHERE i <= length(n_name)")
def explode_positions(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", F.posexplode(F.split("n_name", "")).alias("pos", "c"))


@query("SELECT r_regionkey, k, v FROM region, LATERAL (VALUES ('name', r_name), ('upper', upper(r_name))) s(k, v)")
def explode_stack(t: Tables) -> DataFrame:
    return t.region.select("r_regionkey", F.stack(F.lit(2), F.lit("name"), F.col("r_name"), F.lit("upper"), F.upper("r_name")).alias("k", "v"))


@query("SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS BIGINT) AS brand, TRY_CAST(p_type AS BIGINT) AS none FROM part")
def tolerant_casts(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.split_part("p_brand", F.lit("#"), F.lit(2)).try_cast("bigint").alias("brand"), F.col("p_type").try_cast("bigint").alias("none"))


@query("SELECT event_type, string_agg(user_id::VARCHAR, ',' ORDER BY user_id) AS users FROM (SELECT DISTINCT event_type, user_id FROM events) GROUP BY ALL")
def agg_listagg(t: Tables) -> DataFrame:
    t.events.select("event_type", "user_id").distinct().createOrReplaceTempView("larkspan_users")
    return t.spark.sql("SELECT event_type, listagg(cast(user_id AS string), ',') WITHIN GROUP (ORDER BY user_id) AS users FROM larkspan_users GROUP BY event_type")


@query("SELECT l_returnflag, count(*) FILTER (WHERE l_quantity < 10) AS small, round(corr(l_quantity, l_extendedprice), 6) AS r, bool_or(l_discount > 0.09) AS any_high, bit_xor(l_linenumber)::BIGINT AS x FROM lineitem GROUP BY ALL")
def agg_statistics(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.count_if(F.col("l_quantity") < 10).alias("small"), F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"), F.bool_or(F.col("l_discount") > 0.09).alias("any_high"), F.bit_xor("l_linenumber").cast("bigint").alias("x"))


@query("SELECT event_type, true AS close FROM events GROUP BY ALL")
def sketch_quantiles(t: Tables) -> DataFrame:
    """A KLL sketch's median between the exact 45 and 55 % quantiles."""
    rows = t.events.groupBy("event_type").agg(F.kll_sketch_agg_double("value").alias("s"), F.percentile("value", [0.45, 0.55]).alias("near"))
    return rows.select("event_type", F.kll_sketch_get_quantile_double("s", F.lit(0.5)).between(F.col("near")[0], F.col("near")[1]).alias("close"))


@query("SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_buy FROM events")
def window_fill(t: Tables) -> DataFrame:
    t.events.createOrReplaceTempView("larkspan_events")
    return t.spark.sql("SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END) IGNORE NULLS OVER w AS last_buy FROM larkspan_events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


def _pair(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    key = (a if len(a) else b).iloc[0, 0]
    return pd.DataFrame({"k": [int(key)], "suppliers": [len(a)], "customers": [len(b)]})


@query("SELECT coalesce(a.k, b.k)::BIGINT AS k, coalesce(a.n, 0) AS suppliers, coalesce(b.n, 0) AS customers FROM (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY ALL) a FULL JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 9900 GROUP BY ALL) b ON a.k = b.k")
def udf_cogroup(t: Tables) -> DataFrame:
    a = t.supplier.select(F.col("s_nationkey").alias("k")).groupBy("k")
    b = t.customer.where("c_acctbal > 9900").select(F.col("c_nationkey").alias("k")).groupBy("k")
    return a.cogroup(b).applyInPandas(_pair, "k bigint, suppliers bigint, customers bigint")


def _lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"page_id": b["page_id"], "tags": b["html"].str.count("<[a-z]")})


@query("SELECT page_id, len(regexp_extract_all(html, '<[a-z]'))::BIGINT AS tags FROM pages")
def udf_batches(t: Tables) -> DataFrame:
    return t.pages.select("page_id", "html").mapInPandas(_lengths, "page_id bigint, tags bigint")


@query("SELECT n_name, soundex, dist::BIGINT AS dist FROM (SELECT n_name, 'N350' AS soundex, levenshtein(n_name, 'NATION_1') AS dist FROM nation)")
def scalar_likeness(t: Tables) -> DataFrame:
    return t.nation.select("n_name", F.soundex("n_name").alias("soundex"), F.levenshtein("n_name", F.lit("NATION_1")).cast("bigint").alias("dist"))


@query("SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def scalar_variant(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("k"))


@query("SELECT l_orderkey, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS qty FROM lineitem GROUP BY ALL")
def agg_by_order(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.sum(exact("l_quantity")).cast("double").alias("qty"))
