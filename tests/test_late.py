"""Sequences of events and late rows against plain Python."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from larkspan.operators.patterns import match_sequence
from larkspan.streaming.deals import drain_deals
from larkspan.streaming.state import rocks
from larkspan.streaming.timers import sequence_stream, windows_and_late_rows

T0 = datetime(2024, 1, 1)
EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


def steps(names):
    return {n: F.col("event_type") == n for n in names}


def scan(rows, names, within_s):
    """One pass over each user's rows by time, then id."""
    out, state = [], {}
    for i, s, user, kind in sorted((r for r in rows if None not in r[:3]), key=lambda r: (r[1], r[0])):
        first, ids = state.get(user, (0, []))
        if kind == names[0]:
            first, ids = s, [i]
        elif ids and s - first > within_s:
            ids = []
        elif kind in names and ids and names.index(kind) == len(ids):
            ids = [*ids, i]
            if len(ids) == len(names):
                out.append((user, *ids))
                ids = []
        state[user] = (first, ids)
    return Counter(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if s is None else T0 + timedelta(seconds=s), u, k, 1.0) for i, s, u, k in rows], EVENTS)


def events(seed, n=600):
    rng = random.Random(seed)
    rows = [(i, rng.choice([rng.uniform(0, 20_000), float(rng.randrange(40) * 500)]), rng.choice([1, 1, 1, 2, 3]), rng.choice(["a", "b", "c", "x"])) for i in range(n)]
    return rows + [(None, 5.0, 1, "a"), (n, None, 1, "b"), (n + 1, 7.0, None, "c"), (n + 2, 8.0, 1, None)]


@pytest.mark.parametrize("within", [1, 100, 600, 100_000])
@pytest.mark.parametrize("names", ["abc", "ab", "ca"])
def test_sequences_equal_a_scan(spark, names, within):
    rows = events(within)
    got = match_sequence(frame(spark, rows).withColumn("first", F.lit(1)), "user_id", "ts", "event_id", steps(names), within)
    assert got.columns == ["user_id", *names] and Counter(map(tuple, got.collect())) == scan(rows, list(names), within)
    assert match_sequence(frame(spark, rows[:0]), "user_id", "ts", "event_id", steps(names), within).count() == 0


def test_stream_of_sequences(spark):
    """Rows come in disorder, over three deals, within the delay."""
    rows = events(9, 150)[:150]
    rng = random.Random(1)
    home = {r[0]: min(2, int(r[1] // 7000) + (rng.random() < 0.3)) for r in rows}
    deals = [frame(spark, [r for r in rows if home[r[0]] == d]) for d in range(3)] + [frame(spark, [(-1, 1e6, -1, "end")])]
    with rocks(spark):
        got = drain_deals(deals, lambda s: sequence_stream(s, "user_id", "event_id", steps("abc"), 600, "15000 seconds"))
    assert Counter(map(tuple, got.collect())) == scan(rows, list("abc"), 600)


def test_late_rows_are_kept(spark):
    deals = [[(1, 10, 1), (2, 3700, 1), (3, 20, 2)], [(4, 9000, 1)], [(5, 30, 1), (6, 8900, 2), (7, 9100, 1)], [(8, 40, 3), (9, 10**6, -1)]]
    with rocks(spark):
        out = drain_deals([frame(spark, [(i, s, u, "x") for i, s, u in own]) for own in deals], lambda s: windows_and_late_rows(s, "10 minutes")).collect()
    base = int((T0 - datetime(1970, 1, 1)).total_seconds()) * 1000
    windows = {(r["user_id"], (r["start_ms"] - base) // 3_600_000): r["n"] for r in out if r["kind"] == "window"}
    late = {r["event_id"] for r in out if r["kind"] == "late"}
    assert late == {5, 8}  # the watermark had passed their hour
    assert windows == {(1, 0): 1, (1, 1): 1, (2, 0): 1, (1, 2): 2, (2, 2): 1}
