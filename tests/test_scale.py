"""What differed, failed or took too long on larger tables."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from larkspan.operators import closure, point_in_range_join, ranges, scan, transitive_closure, whole_scan
from larkspan.plans import ORACLES, QUERIES


def table(df):
    return Counter(map(tuple, df.collect()))


def test_closure_takes_few_rounds(spark, monkeypatch):
    rounds, keep = [], closure.written
    monkeypatch.setattr(closure, "written", lambda df, name: (rounds.append(name), keep(df, name))[1])
    chain = [(i, i + 1) for i in range(100)]
    assert table(transitive_closure(spark.createDataFrame(chain, "a int, b int"), "a", "b")) == Counter((i, j) for i in range(100) for j in range(i + 1, 101))
    assert len(rounds) <= 9  # a round for each binary digit of the longest way, the links and an empty round


def test_closure_of_any_links(spark):
    rng = random.Random(3)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(75)]
    steps = {i: {b for a, b in links if a == i} for i in range(60)}
    for most in (None, 1, 2, 3, 5, 8):
        want, new, n = set(links), set(links), 1
        while new and (most is None or n < most):
            new = {(a, c) for a, b in new for c in steps[b]} - want
            want, n = want | new, n + 1
        assert table(transitive_closure(spark.createDataFrame(links, "a int, b int"), "a", "b", most)) == Counter(want)


def test_closure_writes_no_pairs_of_chains(spark, monkeypatch):
    """A chain's pairs are the square of it: what is written grows with the chain."""
    rows, keep = [], closure.written

    def counted(df, name):
        out = keep(df, name)
        rows.append(out.count())
        return out

    monkeypatch.setattr(closure, "written", counted)
    got = transitive_closure(spark.range(2500).selectExpr("id AS a", "id + 1 AS b"), "a", "b")
    assert got.selectExpr("count(*)", "sum(b - a)", "min(b - a)").first()[:] == (2500 * 2501 // 2, 2500 * 2501 * 2502 // 6, 1)
    assert sum(rows) < 10 * 2500


def test_closure_of_many_graphs(spark, monkeypatch):
    """Chains, rings and tangles of more than one block, side by side."""
    monkeypatch.setattr(closure, "BLOCK", 3)
    rng, links = random.Random(7), []
    for g in range(120):
        size = rng.choice([1, 2, 4, 8, 12])
        names = rng.sample(range(g * 100, g * 100 + 50), size)
        kind = g % 4
        own = [(names[i], names[(i + 1) % size]) for i in range(size if kind == 1 else size - 1)]  # a ring or a chain
        if kind >= 2:
            own += [(rng.choice(names), rng.choice(names)) for _ in range(kind - 1)]
        links += own
    steps = {}
    for a, b in links:
        steps.setdefault(a, set()).add(b)
    want = set()
    for a in steps:
        todo, seen = list(steps[a]), set()
        while todo:
            if (b := todo.pop()) not in seen:
                seen.add(b)
                todo += steps.get(b, ())
        want |= {(a, b) for b in seen}
    got = transitive_closure(spark.createDataFrame(links, "a int, b bigint"), "a", "b")
    assert got.dtypes == [("a", "int"), ("b", "bigint")] and table(got) == Counter(want)
    words = spark.createDataFrame([(f"n{a}", f"n{b}") for a, b in links], "a string, b string")
    assert table(transitive_closure(words, "a", "b")) == Counter((f"n{a}", f"n{b}") for a, b in want)


def test_histogram_of_many_files_and_sizes(spark, tmp_path):
    rows = spark.range(3000).select(F.when(F.col("id") % 150 > 0, F.col("id") % 150).cast("int").alias("p_size"))
    rows.repartition(6).write.parquet(f"{tmp_path}/part.parquet")
    assert table(QUERIES["agg_histogram"](spark, str(tmp_path)).select("x", "n")) == Counter([(None, 20.0), *((float(i), 20.0) for i in range(1, 150))])


def test_merged_users_of_any_number(spark, tmp_path):
    rows = spark.range(40_000).selectExpr("if(id % 4 = 0, 'a', 'b') AS event_type", "timestamp_seconds(1700000000 + id * 10) AS ts", "if(id % 10 = 0, null, id % 30000 - 9000) AS user_id")
    rows.unionByName(spark.sql("SELECT 'c' AS event_type, timestamp_seconds(0) AS ts, CAST(null AS bigint) AS user_id")).write.parquet(f"{tmp_path}/events.parquet")
    own = {"a": set(), "b": set(), "c": set()}
    for i in range(40_000):
        if i % 10:
            own["b" if i % 4 else "a"].add(i % 30_000 - 9000)
    assert table(QUERIES["sketch_merge"](spark, str(tmp_path)).select("event_type", "users")) == Counter((k, len(v)) for k, v in own.items())


def test_pages_are_dealt_out(spark, data):
    out = QUERIES["scalar_xpath"](spark, data)
    assert "Exchange" in out._jdf.queryExecution().executedPlan().toString()  # one file of many rows is no one task


def test_small_ranges_are_no_more_than_keep_cores_busy(spark, monkeypatch):
    parts, keep = [], scan.written
    monkeypatch.setattr(scan, "written", lambda df, name: (parts.append(df.rdd.getNumPartitions()), keep(df, name))[1])
    out = whole_scan(spark.range(2000), ["id"], "place", range_rows=1)
    assert out.where("place <> id + 1").count() == 0 and max(parts) <= 4 * spark.sparkContext.defaultParallelism


def test_bins_of_many_pairs_are_cut(spark, monkeypatch):
    cut, keep = [], ranges._pieces
    monkeypatch.setattr(ranges, "PAIRS", 50)
    monkeypatch.setattr(ranges, "_pieces", lambda *args: (cut.append(keep(*args)), cut[-1])[1])
    rng = random.Random(5)
    for n, m in ((300, 20), (20, 300), (0, 5)):
        points = [(i, float(rng.choice([10, 11.5, rng.uniform(0, 1000)]))) for i in range(n)] + [(None, None), (-1, float("inf"))]
        spans = [(j, low, low + rng.choice([0.0, 3.0, 40.0, 500.0])) for j in range(m) for low in [float(rng.choice([9, rng.uniform(0, 1000)]))]]
        got = point_in_range_join(spark.createDataFrame(points, "i int, x double"), spark.createDataFrame(spans, "row int, low double, high double"), "x", "low", "high", 40.0)
        assert got.columns == ["i", "x", "row", "low", "high"]
        assert table(got) == Counter((i, x, *r) for i, x in points for r in spans if x is not None and r[1] <= x < r[2])
        a, b, keys = cut[-1]
        if n:
            most = a.groupBy(*keys).count().withColumnRenamed("count", "n").join(b.groupBy(*keys).count(), keys).selectExpr("max(n * count)").first()[0]
            assert most <= 400


def test_word_counts_of_repeated_and_null_ids(spark, tmp_path):
    rows = [(1, "a b a"), (1, "a c"), (2, "A, b!"), (None, "a d"), (3, None), (4, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["word_counts"](spark, str(tmp_path)).select("word", "n", "docs")
    assert list(map(tuple, got.collect())) == [("a", 5, 2), ("b", 2, 2), ("c", 1, 1), ("d", 1, 0)]
    spark.createDataFrame(rows[:0], "doc_id bigint, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert QUERIES["word_counts"](spark, f"{tmp_path}/none").count() == 0


def test_late_rows_at_the_edge_of_an_hour(spark, tmp_path):
    """epoch_ms() rounds: the last half millisecond of an hour is the next hour's, for windows, deals and the watermark."""
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT row_number() OVER (ORDER BY h, us, u) AS event_id, TIMESTAMP '2024-01-01' + to_microseconds(h * 3600000000 + us) AS ts, u AS user_id,
    CASE WHEN (h + u + us) % 3 = 0 THEN 'error' ELSE 'view' END AS event_type, u / 4 AS value, '{{}}' AS props
    FROM range(1, 13) a(h), range(1, 4) b(u), (VALUES (-501), (-500), (-499), (0), (499), (500), (599999500), (600000499)) c(us)) TO '{tmp_path}/events.parquet'""")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    want = Counter(con.execute(ORACLES["stream_late_rows"]).fetchall())
    assert table(QUERIES["stream_late_rows"](spark, str(tmp_path))) == want and sum(r[3] for r in want) > 0
