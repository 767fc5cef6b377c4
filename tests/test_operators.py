"""Operators on small made-up tables: nulls, ties, empty sides, hot keys."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from larkspan.functions import cosine, dot, l2_distance, merge_distinct
from larkspan.operators import asof_join, exclude_current_row, exclude_peers, gap_fill, groups_frame, interval_join, melt, not_in, point_in_range_join, qualify, salted_join, sessionize, spread
from larkspan.operators.merge import difference
from larkspan.sources import FORMATS, round_trip
from pyspark.sql import Window
from pyspark.sql import functions as F

T0 = datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + timedelta(minutes=minutes)


def test_asof_edges(spark):
    left = spark.createDataFrame([(1, "a", at(10)), (2, "a", at(5)), (3, "b", at(10)), (4, None, at(10)), (5, "a", None), (6, "a", at(100))], "id int, k string, t timestamp")
    right = spark.createDataFrame([("a", at(5), 1, "x"), ("a", at(10), 2, "y"), ("a", at(10), 3, "z"), ("a", None, 4, "n"), (None, at(1), 5, "m")], "k string, t timestamp, n int, v string")
    got = lambda **o: {r["id"]: r["v"] for r in asof_join(left, right, ["k"], "t", tie=["n"], values=["v"], **o).collect()}
    assert got() == {1: "z", 2: "x", 3: None, 4: None, 5: None, 6: "z"}
    assert got(strict=True) == {1: "x", 2: None, 3: None, 4: None, 5: None, 6: "z"}
    assert got(bucket_s=60) == got(bucket_s=3600) == got(bucket_s=420) == got()
    assert got(bucket_s=300, strict=True) == got(strict=True)
    assert got(bucket_s=0) == got() and got(bucket_s=0, strict=True) == got(strict=True)
    assert got(tolerance="20 minutes") == {1: "z", 2: "x", 3: None, 4: None, 5: None, 6: None}
    assert asof_join(left, right.limit(0), ["k"], "t", values=["v"]).where("v IS NULL").count() == 6
    assert asof_join(left.limit(0), right, ["k"], "t", values=["v"]).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30)), max_size=12), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30)), max_size=12))
def test_asof_equals_a_scan(spark, left, right):
    a = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(left)], "id int, k int, t int")
    b = spark.createDataFrame([(k, t, n) for n, (k, t) in enumerate(right)], "k int, t int, n int")
    want = {i: max(((t2, n) for n, (k2, t2) in enumerate(right) if k2 == k and t2 <= t), default=(None, None))[1] for i, (k, t) in enumerate(left)}
    assert {r["id"]: r["n"] for r in asof_join(a, b, ["k"], "t", tie=["n"], values=["n"]).collect()} == want


def test_ranges(spark):
    points = spark.createDataFrame([(i, float(i)) for i in range(-50, 50, 7)] + [(99, None)], "p int, x double")
    ranges = spark.createDataFrame([(0, -40.0, -3.0), (1, 5.0, 5.0), (2, 0.0, 49.0), (3, 48.0, 1000.0), (4, None, 3.0)], "r int, low double, high double")
    got = Counter((r["p"], r["r"]) for r in point_in_range_join(points, ranges, "x", "low", "high", 10.0).collect())
    want = Counter((p["p"], r["r"]) for p in points.collect() for r in ranges.collect() if p["x"] is not None and r["low"] is not None and r["low"] <= p["x"] < r["high"])
    assert got == want
    a = spark.createDataFrame([(i, i % 2, at(i * 3)) for i in range(20)], "a int, k int, ta timestamp")
    b = spark.createDataFrame([(i, i % 2, at(i * 2)) for i in range(30)], "b int, k int, tb timestamp")
    got = Counter((r["a"], r["b"]) for r in interval_join(a, b, "k", "ta", "tb", 600, 300).collect())
    assert got == Counter((x["a"], y["b"]) for x in a.collect() for y in b.collect() if x["k"] == y["k"] and timedelta(minutes=-10) <= y["tb"] - x["ta"] <= timedelta(minutes=5))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_with_a_hot_key(spark, how):
    facts = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)] + [(None, 1000)], "k int, v int")
    dims = spark.createDataFrame([(i, f"d{i}") for i in range(0, 200, 2)] + [(1, "one"), (1, "two")], "k int, d string")
    got = Counter(salted_join(facts, dims, ["k"], per_part=20, how=how).collect())
    assert got == Counter(facts.join(dims, "k", how).collect())


def test_frames(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 1, 20), ("a", 2, 30), ("a", 5, None), ("b", 1, 7)], "k string, o int, v int")
    assert sorted((r["k"], r["o"], r["s"]) for r in groups_frame(df, ["k"], "o", 1, 0, F.sum("v"), "s").collect()) == [("a", 1, 30), ("a", 1, 30), ("a", 2, 60), ("a", 5, 30), ("b", 1, 7)]
    assert Counter((r["k"], r["v"], r["s"]) for r in exclude_current_row(df, ["k"], "v", "s").collect()) == Counter([("a", 10, 50), ("a", 20, 40), ("a", 30, 30), ("a", None, 60), ("b", 7, None)])
    assert {r["v"] for r in qualify(df, F.row_number().over(Window.partitionBy("k").orderBy(F.desc("o"))) == 1).collect()} == {None, 7}


def test_sessions_and_gaps(spark):
    df = spark.createDataFrame([(1, at(0)), (1, at(30)), (1, at(61)), (2, at(5)), (1, at(61))], "u int, t timestamp")
    assert Counter((r["u"], r["session"]) for r in sessionize(df, "u", "t", 1800).collect()) == Counter({(1, 1): 2, (1, 2): 2, (2, 1): 1})
    hours = spark.createDataFrame([("a", at(0), 1.0), ("a", at(180), None), ("a", at(240), 5.0), ("b", at(0), 2.0)], "k string, h timestamp, v double")
    assert [r["v"] for r in gap_fill(hours, ["k"], "h", "1 hour", ["v"]).where("k = 'a'").orderBy("h").collect()] == [1.0, 1.0, 1.0, 1.0, 5.0]


def test_reshape(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "k string, n string, v int")
    wide = spread(df, ["k"], "n", ["x", "y"], F.sum("v"))
    assert sorted(map(tuple, wide.collect())) == [("a", 1, 2), ("b", 3, None)]
    assert sorted(map(tuple, melt(wide, ["k"], ["x", "y"]).where("value IS NOT NULL").collect())) == [("a", "x", 1), ("a", "y", 2), ("b", "x", 3)]


def test_vectors_and_sketches(spark):
    row = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "a array<float>, b array<float>, z array<float>").select(dot(F.col("a"), F.col("b")), l2_distance(F.col("a"), F.col("b")), cosine(F.col("a"), F.col("b")), cosine(F.col("a"), F.col("z"))).first()
    assert (row[0], round(row[1], 9), round(row[2], 9), row[3]) == (24.0, round(2**0.5, 9), 0.96, None)
    parts = spark.range(1000).groupBy((F.col("id") % 7).alias("day")).agg(F.hll_sketch_agg("id").alias("s"))
    assert abs(parts.agg(merge_distinct("s").alias("n")).first()["n"] - 1000) < 50


@pytest.mark.parametrize("kind", sorted(FORMATS))
def test_formats_keep_awkward_values(spark, kind, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted", line', 1.5), (2, "é漢", None), (3, "plain", -0.25)], "i int, s string, x double")
    assert sorted(map(tuple, round_trip(df, str(tmp_path), kind).collect())) == sorted(map(tuple, df.collect()))


def test_difference_of_nulls(spark):
    old = spark.createDataFrame([(1, None, "x"), (None, "a", "b"), (2, "q", None), (3, "z", "z")], "k int, a string, b string")
    new = spark.createDataFrame([(1, "x", None), (None, "a", "b"), (2, "q", None), (4, "n", "n")], "k int, a string, b string")
    assert sorted(map(tuple, difference(old, new, ["k"]).collect())) == [(1, "update"), (3, "delete"), (4, "insert")]


def test_gaps_of_a_null_key(spark):
    hours = spark.createDataFrame([(None, at(0), 1.0), (None, at(120), 5.0)], "k string, h timestamp, v double")
    assert [r["v"] for r in gap_fill(hours, ["k"], "h", "1 hour", ["v"]).orderBy("h").collect()] == [1.0, 1.0, 5.0]


def test_salt_splits_equal_rows(spark):
    """A hot key whose rows are all equal is dealt to many tasks, and maps are no obstacle."""
    facts = spark.range(1000).selectExpr("1 AS k", "map('a', 1) AS m")
    dims = spark.createDataFrame([(1, "one")], "k int, d string")
    joined = salted_join(facts, dims, ["k"], per_part=100)
    assert joined.count() == 1000 and joined.columns == ["k", "m", "d"]
    assert "salt" in joined._jdf.queryExecution().analyzed().toString()


def test_very_wide_ranges(spark):
    points = spark.createDataFrame([(i, float(i * 1000)) for i in range(-5, 6)], "p int, x double")
    ranges = spark.createDataFrame([(0, -1e15, 1e15), (1, 0.0, 1000.0), (2, -2000.5, 3.5e9), (3, 1.0, 1.0)], "r int, low double, high double")
    got = Counter((r["p"], r["r"]) for r in point_in_range_join(points, ranges, "x", "low", "high", 1.0).collect())
    assert got == Counter((p["p"], r["r"]) for p in points.collect() for r in ranges.collect() if r["low"] <= p["x"] < r["high"])


def test_not_in_and_nulls(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    right = lambda *v: spark.createDataFrame([(x,) for x in v], "b int")
    got = lambda r: [x["a"] for x in not_in(left, "a", r, "b").collect()]
    assert got(right(1)) == [2] and got(right(1, None)) == [] and sorted(got(right()), key=str) == [1, 2, None]


def test_exclude_peers(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 1, 20), ("a", 2, 30), ("b", 1, 7)], "k string, o int, v int")
    assert Counter((r["v"], r["s"]) for r in exclude_peers(df, ["k"], "o", "v", "s").collect()) == Counter([(10, 30), (20, 30), (30, 30), (7, None)])
    assert Counter((r["v"], r["s"]) for r in exclude_peers(df, ["k"], "o", "v", "s", ties_only=True).collect()) == Counter([(10, 40), (20, 50), (30, 60), (7, 7)])


def test_table_sample_is_repeatable(spark, data):
    from larkspan.plans import QUERIES

    first, again = ([r[0] for r in QUERIES["sample_table"](spark, data).collect()] for _ in range(2))
    orders = {r[0] for r in spark.read.parquet(f"{data}/orders.parquet").select("o_orderkey").collect()}
    assert first == again and len(first) == len(set(first)) and set(first) <= orders
    assert 0.05 < len(first) / len(orders) < 0.15


def test_state_provider_is_restored(spark):
    from larkspan.streaming.state import PROVIDER, rocks

    before = spark.conf.get(PROVIDER, None)
    with rocks(spark):
        assert "RocksDB" in spark.conf.get(PROVIDER)
    assert spark.conf.get(PROVIDER, None) == before


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_with_many_hot_keys_and_null_keys(spark, how, monkeypatch):
    from larkspan.operators import skew

    monkeypatch.setattr(skew, "HOT_KEYS", 1)
    facts = spark.createDataFrame([(i % 3 if i % 2 else None, i) for i in range(300)] + [(7, 7), (7, 7)], "k int, v int")
    dims = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (None, "n")], "k int, d string")
    got = Counter(salted_join(facts, dims, ["k"], per_part=20, how=how).collect())
    assert got == Counter(facts.join(dims, "k", how).collect())
