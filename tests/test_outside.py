"""The block format, databases, and table functions over tables."""

from __future__ import annotations

import json
import subprocess
import sys
import time
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import ROOT
from larkspan.functions.tables import register_tables
from larkspan.sources.blocks import register_blocks
from larkspan.sources.jdbc import read_table, write_table
from larkspan.streaming import drain


@pytest.fixture
def table(spark, tmp_path):
    """1,000 rows in blocks of 100, ascending by id, in one commit; s has nulls, and blocks 5 to 9 only nulls."""
    register_blocks(spark)
    rows = spark.range(1000).coalesce(1).selectExpr("id", "cast(id AS double) / 10 AS x", "if(id < 500, concat('k', id % 7), null) AS s", "array(id) AS a")
    path = str(tmp_path / "t")
    rows.write.format("blocks").option("path", path).option("block_rows", 100).mode("append").save()
    return path


def read(spark, path):
    return spark.read.format("blocks").option("path", path).option("split_rows", 1).load()


@pytest.mark.parametrize(
    ("condition", "blocks"),
    [("true", 10), ("id < 100", 1), ("id >= 250 AND id <= 349", 2), ("id = 777", 1), ("id IN (5, 15, 905)", 2), ("x > 99.0", 1), ("s IS NULL", 5), ("s IS NOT NULL", 5), ("s = 'k3'", 5), ("s > 'k9'", 0), ("id < 100 OR x > 95", 10), ("id > 5000", 0), ("size(a) = 1", 10), ("id <=> 4", 10)],
)
def test_filters_skip_blocks(spark, table, condition, blocks):
    plain = spark.range(1000).selectExpr("id", "cast(id AS double) / 10 AS x", "if(id < 500, concat('k', id % 7), null) AS s", "array(id) AS a").where(condition)
    got = read(spark, table).where(condition)
    assert Counter(r["id"] for r in got.collect()) == Counter(r["id"] for r in plain.collect())
    assert got.rdd.getNumPartitions() == max(1, blocks)  # a block a task; without any there is one empty task


def test_appends_and_replaces(spark, table):
    more = spark.range(1000, 1010).selectExpr("id", "0.0D AS x", "'new' AS s", "array(id) AS a")
    more.write.format("blocks").option("path", table).mode("append").save()
    assert read(spark, table).count() == 1010
    stream = spark.readStream.format("blocks").option("path", table).load()
    assert drain(stream.select("id")).count() == 1010
    more.write.format("blocks").option("path", table).mode("overwrite").save()
    assert Counter(r["s"] for r in read(spark, table).collect()) == {"new": 10}
    more.limit(0).write.format("blocks").option("path", table).mode("append").save()
    assert read(spark, table).count() == 10


def test_a_failed_job_leaves_nothing(spark, table, tmp_path):
    before = {p.name for p in (tmp_path / "t").rglob("*") if p.is_file()}

    def broken(batches):
        for b in batches:
            if pa.compute.max(b.column(0)).as_py() >= 75:
                time.sleep(3)
                raise RuntimeError("a task that fails after others have written")
            yield b

    rows = spark.range(0, 100, 1, 4).selectExpr("id", "0.0D AS x", "'s' AS s", "array(id) AS a").mapInArrow(broken, "id bigint, x double, s string, a array<bigint>")
    with pytest.raises(Exception, match="fails after others"):
        rows.write.format("blocks").option("path", table).mode("append").save()
    assert read(spark, table).count() == 1000
    assert {p.name for p in (tmp_path / "t").rglob("*") if p.is_file()} == before


def test_stream_into_blocks(spark, table, tmp_path):
    """Each batch is a commit; a batch that comes again is not recorded again."""
    path = str(tmp_path / "copy")
    stream = spark.readStream.format("blocks").option("path", table).load()
    for _ in range(2):
        stream.writeStream.format("blocks").option("path", path).option("query", "q").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert Counter(r["id"] for r in read(spark, path).collect()) == Counter(range(1000))
    marks = [json.loads(p.read_text())["mark"] for p in (tmp_path / "copy" / "commits").glob("*.json")]
    assert len(marks) == len(set(marks))
    with pytest.raises(Exception, match="no table of blocks"):
        read(spark, str(tmp_path / "none")).count()


def test_database(spark):
    url = "jdbc:derby:memory:larkspantest;create=true"
    rows = spark.createDataFrame([(i, float(i), None if i % 5 == 0 else f"n{i}") for i in range(100)], "k bigint, v double, s string")
    write_table(rows, url, "t")
    got = read_table(spark, url, "t", "k", 5)
    assert got.rdd.getNumPartitions() == 5 and Counter(map(tuple, got.collect())) == Counter(map(tuple, rows.collect()))
    few = got.where("v >= 90")
    text = few._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in text and "GreaterThanOrEqual(v,90.0)" in text and few.count() == 10
    write_table(rows.limit(0), url, "empty")
    assert read_table(spark, url, "empty", "k").count() == 0


def test_sessions_by_a_table_function(spark):
    register_tables(spark)
    rows = [(1, 0), (1, 10_000_000), (1, 15_000_000), (1, 40_000_000), (2, 5), (None, 1), (None, 2), (3, None)]
    spark.createDataFrame(rows, "k int, us bigint").repartition(4).createOrReplaceTempView("moments_of_a_test")
    call = "SELECT * FROM larkspan_sessions(TABLE(moments_of_a_test), 'k', 'us', 10)"
    assert Counter(map(tuple, spark.sql(call).collect())) == Counter([(1, 3, 0, 15_000_000), (1, 1, 40_000_000, 40_000_000), (2, 1, 5, 5), (None, 2, 1, 2)])
    with pytest.raises(Exception, match="no column nothing"):
        spark.sql(call.replace("'us'", "'nothing'")).collect()


def test_embedded_databases_are_found_by_all_executors(tmp_path):
    """In processes of their own, as a test session's executors are its driver."""
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.checkpoint.dir", "file://{tmp_path}/shared").config("spark.ui.enabled", "false").getOrCreate()
from larkspan.session import ship
from larkspan.sources.jdbc import embedded
ship(spark)
rows = spark.range(-3, 2000).selectExpr("if(id < 0, null, id) AS id", "if(id % 7 = 0, null, id / 8) AS x")
got = embedded(rows, "numbers", "id").where("x > 100")
assert "GreaterThan(x,100.0)" in got._jdf.queryExecution().executedPlan().toString().replace("*", "")
assert embedded(rows, "numbers", "id").exceptAll(rows).count() == 0
for _ in range(2):  # a second action loads anew
    assert sorted(map(tuple, got.collect())) == [(i, i / 8) for i in range(801, 2000) if i % 7]
assert embedded(rows.limit(0), "numbers", "id").count() == 0
print("done")
spark.stop()
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=False)
    assert out.stdout.strip().endswith("done"), out.stderr[-2000:]
