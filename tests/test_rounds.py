"""Operators that work in rounds or over whole tables, against plain Python, with nulls, ties and clashing names."""

from __future__ import annotations

import random
from collections import Counter
from math import inf, nan

import pytest
from pyspark.sql import functions as F

from larkspan.operators import count_min, exact_quantiles, exclude, frequent_items, merge_count_min, merge_partitions, overlap_join, point_in_range_join, salted_join, scan, transitive_closure, whole_rank, whole_scan
from larkspan.sources import write_files


def table(df):
    return Counter(map(tuple, df.collect()))


# scans


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_scan_equals_a_list(spark, monkeypatch, size):
    plans, keep = [], scan.written

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, name)

    monkeypatch.setattr(scan, "written", seen)
    rng = random.Random(size)
    rows = [(i, rng.choice([None, 1, 2, 3, 3, 3, 3]), rng.choice([None, 5, 7])) for i in range(40)]
    df = spark.createDataFrame(rows, "place int, k int, part int").withColumn("key", F.col("place"))
    out = whole_scan(df, [("k", False), "place"], "row", sums={"total": F.col("part")}, fills={"last": F.col("part")}, lags={"three": (F.col("place"), 3), "next": (F.col("k"), -2)}, range_rows=size)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    rows.sort(key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    want, total, last = [], None, None
    for n, (i, k, v) in enumerate(rows):
        total, last = (total, last) if v is None else ((total or 0) + v, v)
        want.append((i, k, v, i, n + 1, total, last, rows[n - 3][0] if n > 2 else None, rows[n + 2][1] if n + 2 < len(rows) else None))
    assert out.columns == ["place", "k", "part", "key", "row", "total", "last", "three", "next"] and table(out) == Counter(want)
    assert size > len(rows) or not [p for p in plans if "SinglePartition" in p]  # rows of one range are one task
    assert whole_scan(df.limit(0), ["k"], lags={"x": (F.col("k"), 1)}).count() == 0


def test_ranks_over_ranges(spark):
    rows = [(k,) for k in [None] * 5 + [3] * 30 + [1, 2, 2, 9]]
    got = whole_rank(spark.createDataFrame(rows, "k int"), ["k"], range_rows=4).collect()
    values = sorted((r[0] for r in rows), key=lambda k: (k is not None, k))
    assert sorted(r["row_number"] for r in got) == list(range(1, len(rows) + 1))
    assert {(r["k"], r["rank"], r["dense_rank"]) for r in got} == {(k, values.index(k) + 1, sorted({*values}, key=values.index).index(k) + 1) for k in values}


# quantiles


@pytest.mark.parametrize("last", [0, 3, 10_000])
def test_quantiles_equal_sorting(spark, last):
    rng = random.Random(last)
    groups = {"ties": [5.0] * 300 + [1.0, 9.0], "few": [2.0], "none": [None], None: [float(i) for i in range(50)], "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(700)], "ends": [-inf, 0.0, inf, 1.0, nan], "zeros": [0.0] * 100 + [-0.0, None, 3.0]}
    df = spark.createDataFrame([(g, v) for g, own in groups.items() for v in own], "g string, v double")
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {(r["g"], r["share"]): r["quantile"] for r in exact_quantiles(df, ["g"], F.col("v"), shares, last).collect()}
    assert len(got) == len(groups) * len(shares)
    for g, own in groups.items():
        own = sorted((v for v in own if v is not None), key=lambda v: (v != v, v))
        for q in shares:
            if not own:
                assert got[g, q] is None
                continue
            at = q * (len(own) - 1)
            x, y = own[int(at)], own[-int(-at // 1)]
            want = x if x == y or (x != x and y != y) else x + (y - x) * (at - int(at))
            assert got[g, q] == pytest.approx(want, rel=1e-12, nan_ok=True)


# intervals


@pytest.mark.parametrize("closed", [True, False])
def test_overlaps_equal_all_pairs(spark, closed):
    rng = random.Random(4)

    def some(n):
        out = []
        for i in range(n):
            a = rng.choice([rng.uniform(-50, 50), float(rng.randrange(-5, 5)), 1e15, -inf, None, nan])
            out.append((i, a, rng.choice([a, inf, nan, None, -1.0] if a is None or abs(a) == inf or a != a else [a, a + rng.random(), a + 10 ** rng.uniform(-3, 4), a + 1, a - 1, inf, None])))
        return out + [(1000, 3.0, 3.0), (1001, -inf, inf), (1002, -1e308, 1e308)]

    left, right = some(150), some(150)
    a = spark.createDataFrame(left, "level int, l double, h double")
    b = spark.createDataFrame(right, "bin int, x double, y double")
    fine = lambda x, y: None not in (x, y) and x == x and y == y and (x <= y if closed else x < y)
    before = (lambda x, y: x <= y) if closed else (lambda x, y: x < y)
    want = Counter((i, j) for i, l, h in left for j, x, y in right if fine(l, h) and fine(x, y) and before(l, y) and before(x, h))
    got = overlap_join(a, b, "l", "h", "x", "y", 1.0, closed, 4)
    assert table(got.select("level", "bin")) == want and len(want) > 500
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert overlap_join(a.limit(0), b, "l", "h", "x", "y", 1.0).count() == 0


def test_ranges_without_end(spark):
    points = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, inf), (4, -inf), (5, None)], "level int, p double")
    ranges = spark.createDataFrame([(1, -inf, 1.0), (2, 1.0, inf), (3, -inf, inf), (4, 4.0, 6.0), (5, None, 3.0), (6, 3.0, 3.0), (7, -1e308, 1e308)], "part int, l double, h double")
    got = table(point_in_range_join(points, ranges, "p", "l", "h", 1.0).select("level", "part"))
    assert got == Counter([(1, 1), (1, 3), (1, 7), (2, 2), (2, 3), (2, 4), (2, 7), (4, 1), (4, 3)])


# closure


def test_closure_of_chains_and_cycles(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100)] + [(200, 200), (None, 1), (1, None), (5, 6)] + [(300, i) for i in range(301, 320)] + [(i, 400) for i in range(301, 320)]
    got = transitive_closure(spark.createDataFrame(links, "a int, b int"), "a", "b")
    want = {(i, j) for i in range(40) for j in range(i + 1, 41)} | {(i, j) for i in (100, 101, 102) for j in (100, 101, 102)} | {(200, 200), (300, 400)} | {(300, i) for i in range(301, 320)} | {(i, 400) for i in range(301, 320)}
    assert table(got) == Counter(want)
    assert table(transitive_closure(spark.createDataFrame(links[:4], "a int, b int"), "a", "b", 2)) == Counter([(0, 1), (1, 2), (2, 3), (3, 4), (0, 2), (1, 3), (2, 4)])
    assert transitive_closure(spark.createDataFrame([], "a int, b int"), "a", "b").count() == 0


# frequent items


@pytest.mark.parametrize("width", [8, 1 << 16])
def test_frequent_items(spark, width):
    rng = random.Random(width)
    items = [rng.choice("abc") if rng.random() < 0.4 else f"x{rng.randrange(300)}" for _ in range(2000)] + [None] * 500 + ["d"] * 200
    df = spark.createDataFrame([(w, i % 3) for i, w in enumerate(items)], "row string, cell int")
    own = Counter(w for w in items if w is not None)
    for share in (0.0005, 0.01, 0.08, 0.9):
        want = Counter({(w, n): 1 for w, n in own.items() if n >= share * 2200 - 1e-9})
        assert table(frequent_items(df, "row", share, depth=3, width=width)) == want
    parts = df.select(F.col("row").alias("item"), F.col("cell").alias("day"))
    merged = merge_count_min(count_min(parts, "item", ["day"], 3, width))
    assert table(merged.select("row", "cell", "n")) == table(count_min(parts, "item", (), 3, width).select("row", "cell", "n"))
    assert table(frequent_items(parts, "item", 0.05, merged, 3, width)) == Counter({(w, n): 1 for w, n in own.items() if n >= 0.05 * 2200})
    assert frequent_items(df.limit(0), "row", 0.1).count() == 0


# EXCLUDE


@pytest.mark.parametrize(("without", "order"), [("current row", None), ("group", "o"), ("ties", "o")])
@pytest.mark.parametrize("kind", ["sum", "count", "min", "max", "avg"])
def test_exclude(spark, without, order, kind):
    rows = [(1, 0, 1, 1e17), (2, 0, 2, 1.0), (3, 0, 3, 2.0), (4, 1, 1, inf), (5, 1, 1, 1.0), (6, 1, 2, None), (7, None, 1, 4.0), (8, 2, None, 3.0), (9, 2, None, 5.0), (10, 2, 7, -2.0)]
    df = spark.createDataFrame(rows, "id int, g int, o int, v double").withColumn("place", F.lit("kept"))
    folds = {"sum": sum, "count": len, "min": min, "max": max, "avg": lambda v: sum(v) / len(v)}
    for r in exclude(df, ["g"], F.col("v"), "out", kind, order, without).collect():
        left = [v for i, g, o, v in rows if g == r["g"] and v is not None and (i != r["id"] if without == "current row" else o != r["o"] or (without == "ties" and i == r["id"]))]
        want = (folds[kind](left) if left else 0 if kind == "count" else None)
        assert r["out"] == want and r["place"] == "kept", r
    with pytest.raises(ValueError, match="median"):
        exclude(df, ["g"], F.col("v"), "out", "median")


# skew and merges


def test_salted_join_keeps_columns(spark):
    facts = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 7), (None, 8)], "k int, row int").withColumn("__row", F.col("row")).withColumn("parts", F.lit("p"))
    dims = spark.createDataFrame([(1, "a"), (3, "b")], "k int, salt string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got, want = salted_join(facts, dims, ["k"], 10, how), facts.join(dims, "k", how)
        assert got.columns == want.columns and table(got) == table(want)
    cold = facts.where("k = 2")
    assert table(salted_join(cold, dims, ["k"], 10, "left")) == table(cold.join(dims, "k", "left"))


def test_merge_leaves_other_folders(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([(i, i * 10, ["a", "b", "c", None][i % 4]) for i in range(40)] + [(100, 1, "alone")], "k int, v int, p string")
    write_files(rows, path, partition_by=["p"])
    files = lambda: {f.parent.name: {g.name for g in f.parent.glob("*.parquet")} for f in (tmp_path / "t").rglob("*.parquet")}
    before = files()
    changes = spark.createDataFrame([(0, 5, "b"), (4, 6, "a"), (8, 0, "a"), (200, 7, "new"), (100, 0, "alone"), (None, 3, "b")], "k int, v int, p string")
    got = table(merge_partitions(path, changes, ["k"], "p", F.col("v") == 0).select("k", "v", "p"))
    want = Counter((i, i * 10, ["a", "b", "c", None][i % 4]) for i in range(40) if i not in (0, 4, 8)) + Counter([(0, 5, "b"), (4, 6, "a"), (200, 7, "new"), (None, 3, "b")])
    after = files()
    assert got == want
    assert {p for p in before if before[p] == after.get(p)} == {"p=c", "p=__HIVE_DEFAULT_PARTITION__"} and "p=alone" not in after and "p=new" in after
    assert table(merge_partitions(path, changes.limit(0), ["k"], "p").select("k", "v", "p")) == want and files() == after
