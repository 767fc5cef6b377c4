"""Stream processors whose keys are groups of users: few calls of the state, whatever the users and windows."""

from __future__ import annotations

from collections import Counter as Counts

import pandas as pd

from larkspan.streaming.state import Counter
from larkspan.streaming.timers import Sequence, Windows


class State:
    def __init__(self, calls):
        self.calls, self.held = calls, None

    def exists(self):
        self.calls.append("exists")
        return self.held is not None

    def get(self):
        self.calls.append("get")
        return self.held

    def update(self, value):
        self.calls.append("update")
        self.held = value

    put = update

    def appendList(self, rows):
        self.update([*(self.held or []), *rows])

    def clear(self):
        self.update(None)


class Handle:
    def __init__(self):
        self.calls, self.timers = [], []
        self.getValueState = self.getListState = lambda name, schema: State(self.calls)
        self.registerTimer = self.timers.append


class Watermark:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = lambda: ms


def started(processor):
    handle = Handle()
    processor.init(handle)
    return processor, handle


def test_windows_of_many_users_are_one_state():
    windows, handle = started(Windows(10))
    users = [*range(60), None]
    rows = pd.DataFrame([(i, u, i * 7 % 100, 5) for i, u in enumerate(users * 10)], columns=["event_id", "user_id", "ms", "cents"])
    late = pd.concat(windows.handleInputRows((0,), iter([rows[:300], rows[300:]]), Watermark(20)))
    over = pd.concat(windows.handleExpiredTimer((0,), Watermark(60), None))
    more = list(windows.handleInputRows((0,), iter([rows[rows["ms"] >= 90]]), Watermark(60)))
    rest = pd.concat(windows.handleExpiredTimer((0,), Watermark(1000), None))
    assert not more and len(handle.calls) < 20 and min(handle.timers) == 30
    pairs = lambda df: Counts({(None if pd.isna(u) else int(u), int(s)): int(n) for u, s, n in df[["user_id", "start_ms", "n"]].groupby(["user_id", "start_ms"], dropna=False)["n"].sum().reset_index().itertuples(index=False)})
    want = Counts((u, ms // 10 * 10) for u, ms in ((None if pd.isna(u) else int(u), ms) for u, ms in zip(rows["user_id"], rows["ms"], strict=True)))
    assert pairs(late) == Counts({k: n for k, n in want.items() if k[1] < 20})
    assert pairs(over) == Counts({k: n for k, n in want.items() if 20 <= k[1] < 60})
    assert pairs(rest) == Counts({k: n * (2 if k[1] == 90 else 1) for k, n in want.items() if k[1] >= 60})


def test_sequences_and_counts_of_many_users_are_one_state():
    sequence, handle = started(Sequence(2, 1_000_000))
    rows = pd.DataFrame([(u, t * 1000, u * 10 + s, s) for u in range(60) for s, t in ((0, u), (1, u + 900 + 2 * u))], columns=["key", "us", "id", "step"])
    list(sequence.handleInputRows((0,), iter([rows]), Watermark(0)))
    out = pd.concat([*sequence.handleExpiredTimer((0,), Watermark(800), None), *sequence.handleExpiredTimer((0,), Watermark(5000), None)])
    assert dict(zip(out["key"], out["ids"], strict=True)) == {u: [u * 10, u * 10 + 1] for u in range(51)} and len(handle.calls) < 20
    counter, handle = started(Counter())
    for _ in range(2):
        got = pd.concat(counter.handleInputRows((0,), iter([pd.DataFrame({"user_id": [1, None, 2, 1]}), pd.DataFrame({"user_id": [1]})]), None))
    assert {None if pd.isna(u) else int(u): n for u, n in zip(got["user_id"], got["n"], strict=True)} == {1: 6, 2: 2, None: 2} and len(handle.calls) < 10
