"""Scalar functions, arrays, JSON, vectors, files and user-defined functions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

from larkspan.functions import cosine, distinct_estimate, dot, exact, safe_divide, words
from larkspan.plans.registry import query
from larkspan.sources import register, round_trip
from larkspan.streaming.run import checkpoint_folder
from larkspan.tables import Tables


@query("""SELECT p_partkey, upper(p_type) || '-' || lpad(p_size::VARCHAR, 3, '0') AS code, substr(p_brand, 7) AS brand_no, length(p_name)::BIGINT AS len, replace(p_name, ' ', '_') AS snake,
split_part(p_brand, '#', 2) AS part2, starts_with(p_type, 'S') AS is_s, reverse(p_type) AS rev FROM part""")
def scalar_strings(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.concat(F.upper("p_type"), F.lit("-"), F.lpad(F.col("p_size").cast("string"), 3, "0")).alias("code"), F.expr("substr(p_brand, 7)").alias("brand_no"), F.length("p_name").cast("bigint").alias("len"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("snake"), F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("part2"), F.startswith("p_type", F.lit("S")).alias("is_s"), F.reverse("p_type").alias("rev"))


@query("""SELECT doc_id, len(regexp_extract_all(text, '[A-Z][a-z]+'))::BIGINT AS capitals, regexp_extract(text, '([a-z]+) ([a-z]+)', 2) AS second, regexp_matches(text, 'the [a-z]+') AS has_the, regexp_replace(text, '[aeiou]', '*', 'g') AS masked FROM documents""")
def scalar_regex(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.regexp_count("text", F.lit("[A-Z][a-z]+")).cast("bigint").alias("capitals"), F.regexp_extract("text", "([a-z]+) ([a-z]+)", 2).alias("second"), F.col("text").rlike("the [a-z]+").alias("has_the"), F.regexp_replace("text", "[aeiou]", "*").alias("masked"))


@query("""SELECT p_partkey, round(sqrt(p_retailprice), 6) AS root, floor(p_retailprice / 7)::BIGINT AS sevenths, (p_partkey % 5)::BIGINT AS mod5, greatest(p_size, 10)::BIGINT AS big, round(ln(p_retailprice), 6) AS ln,
round(p_retailprice / nullif(p_size - 10, 0), 6) AS ratio, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'middle' ELSE 'large' END AS class FROM part""")
def scalar_math(t: Tables) -> DataFrame:
    price = F.col("p_retailprice")
    return t.part.select("p_partkey", F.round(F.sqrt(price), 6).alias("root"), F.floor(price / 7).cast("bigint").alias("sevenths"), (F.col("p_partkey") % 5).cast("bigint").alias("mod5"), F.greatest("p_size", F.lit(10)).cast("bigint").alias("big"), F.round(F.log(price), 6).alias("ln"), F.round(safe_divide(price, F.col("p_size") - 10), 6).alias("ratio"), F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "middle").otherwise("large").alias("class"))


@query("""SELECT o_orderkey, year(o_orderdate)::BIGINT AS y, month(o_orderdate)::BIGINT AS m, strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') AS q, date_diff('day', TIMESTAMP '1995-01-01', o_orderdate)::BIGINT AS days,
strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m-%d') AS next, isodow(o_orderdate)::BIGINT AS weekday FROM orders""")
def scalar_dates(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", F.year(d).cast("bigint").alias("y"), F.month(d).cast("bigint").alias("m"), F.date_format(F.date_trunc("quarter", d), "yyyy-MM-dd").alias("q"), F.datediff(d.cast("date"), F.lit("1995-01-01").cast("date")).cast("bigint").alias("days"), F.date_format(F.add_months(d.cast("date"), 1), "yyyy-MM-dd").alias("next"), (F.weekday(d) + 1).cast("bigint").alias("weekday"))


@query("SELECT event_id, (props->>'k')::BIGINT AS k, json_extract_string(props, '$.none') AS none FROM events")
def scalar_json(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.from_json("props", "k bigint").getField("k").alias("k"), F.get_json_object("props", "$.none").alias("none"))


@query("""SELECT doc_id, len(w)::BIGINT AS n_words, len(list_distinct(w))::BIGINT AS n_distinct, list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS letters, list_sort(list_distinct(list_filter(w, lambda x: length(x) > 12)))[1:3] AS longest
FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents)""")
def scalar_arrays(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", words(F.col("text")).alias("w"))
    letters = F.when(F.size("w") > 0, F.aggregate(F.transform("w", lambda x: F.length(x).cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x))
    return rows.select("doc_id", F.size("w").cast("bigint").alias("n_words"), F.size(F.array_distinct("w")).cast("bigint").alias("n_distinct"), letters.alias("letters"), F.slice(F.sort_array(F.array_distinct(F.filter("w", lambda x: F.length(x) > 12))), 1, 3).alias("longest"))


@query("SELECT word, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM documents) WHERE word <> '' GROUP BY ALL ORDER BY n DESC, word LIMIT 50")
def word_counts(t: Tables) -> DataFrame:
    """The words are counted first, which tasks combine before the shuffle; documents only for the 50 that are asked for."""
    text = words(F.col("text"))
    # an inner explode would add a filter on the array's size, which splits each text once more
    counts = t.documents.select(F.explode_outer(text).alias("word")).where("word IS NOT NULL").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "word").limit(50).collect()
    asked = F.array(*(F.lit(r["word"]) for r in top)).cast("array<string>")
    pairs = t.documents.select("doc_id", F.explode_outer(F.array_intersect(text, asked)).alias("word")).where("word IS NOT NULL")
    docs = pairs.groupBy("word").agg(F.countDistinct("doc_id").alias("docs"))
    return t.spark.createDataFrame(top, "word string, n bigint").join(docs, "word").orderBy(F.desc("n"), "word")


@query("SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, regexp_extract(url, '^([a-z]+):', 1) AS scheme, regexp_extract(url, '^[a-z]+://[^/]+([^?#]*)', 1) AS path, sha256(html) AS digest, md5(url) AS key FROM pages")
def scalar_urls(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.parse_url("url", F.lit("HOST")).alias("host"), F.parse_url("url", F.lit("PROTOCOL")).alias("scheme"), F.parse_url("url", F.lit("PATH")).alias("path"), F.sha2("html", 256).alias("digest"), F.md5("url").alias("key"))


@query("""SELECT a.vec_id, b.vec_id AS probe_id, round(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: x[1]::DOUBLE * x[2]::DOUBLE)), 6) AS score
FROM embeddings a, (SELECT * FROM embeddings ORDER BY vec_id LIMIT 3) b QUALIFY row_number() OVER (PARTITION BY b.vec_id ORDER BY list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: x[1]::DOUBLE * x[2]::DOUBLE)) DESC, a.vec_id) <= 5""")
def vector_top_k(t: Tables) -> DataFrame:
    """The five vectors of largest inner product with each of three probes."""
    from larkspan.operators.reshape import top_per_group

    probes = t.embeddings.orderBy("vec_id").limit(3).select(F.col("vec_id").alias("probe_id"), F.col("embedding").alias("probe"))
    # three probes
    rows = t.embeddings.join(F.broadcast(probes)).select("vec_id", "probe_id", dot(F.col("embedding"), F.col("probe")).alias("score"))
    return top_per_group(rows, ["probe_id"], [F.desc("score"), F.col("vec_id")], 5).withColumn("score", F.round("score", 6))


@query("SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]), 6) AS likeness FROM embeddings")
def vector_cosine(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", F.round(cosine(F.col("embedding"), F.reverse("embedding")), 6).alias("likeness"))


@query("SELECT l_returnflag, count(DISTINCT l_orderkey) AS n, true AS close FROM lineitem GROUP BY ALL")
def sketch_distinct(t: Tables) -> DataFrame:
    """A HyperLogLog estimate within 5 % of the exact count."""
    rows = t.lineitem.groupBy("l_returnflag").agg(distinct_estimate("l_orderkey").alias("about"), F.countDistinct("l_orderkey").alias("n"))
    return rows.select("l_returnflag", "n", (F.abs(F.col("about") - F.col("n")) <= 0.05 * F.col("n") + 1).alias("close"))


def _file_round_trip(kind: str):
    def plan(t: Tables) -> DataFrame:
        return round_trip(t.supplier, checkpoint_folder(t.spark), kind)

    plan.__name__ = f"file_{kind}"
    return query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")(plan)


for _kind in ("parquet", "orc", "json", "csv", "xml"):
    _file_round_trip(_kind)


@query("SELECT o_orderstatus, o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def file_partitioned(t: Tables) -> DataFrame:
    """Written by status; the filter then reads one folder."""
    return round_trip(t.orders.select("o_orderkey", "o_orderstatus"), checkpoint_folder(t.spark), "parquet", ["o_orderstatus"]).where("o_orderstatus = 'F'").select("o_orderstatus", "o_orderkey")


@query("""WITH b AS (SELECT floor((s_acctbal + 1000) / 500)::BIGINT AS i FROM supplier)
SELECT r.i::BIGINT AS i, r.i * 500.0::DOUBLE AS low, count(b.i) AS n FROM range(0, (SELECT max(i) + 1 FROM b)) r(i) LEFT JOIN b ON b.i = r.i GROUP BY r.i""")
def source_steps(t: Tables) -> DataFrame:
    """How many suppliers are in each band of balances, also in empty ones: the bands come from the steps source."""
    register(t.spark)
    band = t.supplier.select(F.floor((F.col("s_acctbal") + 1000) / 500).alias("band"))
    steps = t.spark.read.format("steps").option("rows", band.agg(F.max("band")).first()[0] + 1).option("step", 500.0).load()
    held = band.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    return steps.join(held, F.col("i") == F.col("band"), "left").select("i", F.col("x").alias("low"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@F.pandas_udf(T.DoubleType())
def fahrenheit(celsius: pd.Series) -> pd.Series:
    return celsius * 9 / 5 + 32


@query("SELECT event_id, round(value * 9 / 5 + 32, 6) AS f FROM events")
def udf_vectorized(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.round(fahrenheit("value"), 6).alias("f"))


@F.pandas_udf(T.DoubleType())
def highest(v: pd.Series) -> float:
    return float(v.max())


@query("SELECT event_type, round(max(value) - min(value), 6) AS spread FROM events GROUP BY ALL")
def udf_aggregate(t: Tables) -> DataFrame:
    """In two steps, by day and then over the days: Python gets a whole group as one series, and a kind of event has too many rows for that."""
    days = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(highest("value").alias("high"), highest(-F.col("value")).alias("low"))
    return days.groupBy("event_type").agg(F.round(highest("high") + highest("low"), 6).alias("spread"))


@udtf(returnType=T.StructType([T.StructField("position", T.IntegerType()), T.StructField("letter", T.StringType())]))
class Letters:
    def eval(self, word: str) -> Iterator[tuple]:
        for i, c in enumerate(word or ""):
            yield i + 1, c


@query("SELECT n_name, i::INT AS position, substr(n_name, i, 1) AS letter FROM nation, range(1, 20) r(i) WHERE i <= length(n_name)")
def udf_table(t: Tables) -> DataFrame:
    t.spark.udtf.register("larkspan_letters", Letters)
    t.nation.createOrReplaceTempView("larkspan_nation")
    return t.spark.sql("SELECT n_name, position, letter FROM larkspan_nation, LATERAL larkspan_letters(n_name)")


def _demean(batch: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"s_suppkey": batch["s_suppkey"], "off": (batch["s_acctbal"] - batch["s_acctbal"].mean()).round(4)})


@query("SELECT s_suppkey, round(s_acctbal - avg(s_acctbal) OVER (PARTITION BY s_nationkey), 4) AS off FROM supplier")
def udf_grouped(t: Tables) -> DataFrame:
    return t.supplier.groupBy("s_nationkey").applyInPandas(_demean, "s_suppkey bigint, off double")


@query("SELECT conv_id, count(*) AS turns, string_agg(role, '>' ORDER BY turn) AS roles, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY ALL")
def conversation_shapes(t: Tables) -> DataFrame:
    roles = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]), ">")
    return t.conversations.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), roles.alias("roles"), F.sum(F.length("text")).cast("bigint").alias("chars"))


@query("SELECT lang, source, count(*) AS n, sum(n_chars)::BIGINT AS chars, round(sum(quality)::DOUBLE / nullif(count(quality), 0), 6) AS good FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL")
def corpus_report(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, "doc_id", "left").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"), F.round(safe_divide(F.sum("quality").cast("double"), F.count("quality")), 6).alias("good"))
