"""Stateful processors with event-time timers: windows that keep their late rows, and sequences of events.

They need rocks(). Spark drops late rows before a processor sees them if its input has the watermark's column; so the
input has the time as a number instead, and the processor tells late rows by the watermark itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from larkspan.streaming.state import in_groups

WINDOWS = "kind string, user_id bigint, start_ms bigint, event_id bigint, n bigint, cents bigint"
WINDOW_COLUMNS, OPEN = ["kind", "user_id", "start_ms", "event_id", "n", "cents"], ["user_id", "start_ms", "n", "cents"]


class Windows(StatefulProcessor):
    """Totals of users' windows when the watermark passes their ends; rows of a window that has passed come out one by one.

    A key is a group of users, and its open windows are one value, so that a batch costs few calls a group, not some for
    each window of each user. One timer waits for the first window that ends.
    """

    def __init__(self, size_ms: int):
        self.size = size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "user_id array<bigint>, start_ms array<bigint>, n array<bigint>, cents array<bigint>")

    def _windows(self) -> pd.DataFrame:
        held = self.open.get() if self.open.exists() else ([], [], [], [])
        return pd.DataFrame({c: pd.array(list(own), "Int64") for c, own in zip(OPEN, held, strict=True)})

    def _keep(self, windows: pd.DataFrame) -> None:
        if len(windows):
            self.open.update(tuple([None if v is pd.NA else int(v) for v in windows[c]] for c in OPEN))
            self.handle.registerTimer(int(windows["start_ms"].min()) + self.size)
        else:
            self.open.clear()

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        parts = [self._windows()]
        for part in rows:
            own = pd.DataFrame({"user_id": part["user_id"].astype("Int64"), "start_ms": part["ms"] - part["ms"] % self.size, "event_id": part["event_id"], "n": 1, "cents": part["cents"]})
            gone = own["start_ms"] + self.size <= passed
            if gone.any():
                yield own[gone].assign(kind="late")[WINDOW_COLUMNS]
            parts.append(own.loc[~gone, OPEN].astype("Int64"))
        self._keep(pd.concat(parts).groupby(["user_id", "start_ms"], as_index=False, dropna=False).sum())

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        windows = self._windows()
        over = (windows["start_ms"] + self.size <= timerValues.getCurrentWatermarkInMs()).astype(bool)
        if over.any():
            self._keep(windows[~over])
            yield windows[over].assign(kind="window", event_id=pd.array([None] * int(over.sum()), "Int64"))[WINDOW_COLUMNS]

    def close(self) -> None:
        pass


def windows_and_late_rows(events: DataFrame, late: str, size_ms: int = 3_600_000) -> DataFrame:
    """Two outputs in one: rows of kind "window" (totals of a user's window, once the watermark passes its end) and of kind "late" (an event whose window has passed).

    events: event_id, user_id, ts (a timestamp), value. Together both kinds count every event whose window the watermark
    passes exactly once. The state of a group of users is a few numbers for each open window.
    """
    rows = events.withWatermark("ts", late).select("event_id", "user_id", F.unix_millis("ts").alias("ms"), F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    return in_groups(rows, "user_id").transformWithStateInPandas(Windows(size_ms), WINDOWS, "append", "eventTime")


class Sequence(StatefulProcessor):
    """The automaton of match_sequence() over each user's rows, in event time: rows wait until the watermark has passed them.

    A key is a group of users, whose matches in the making are one value.
    """

    def __init__(self, steps: int, within_us: int):
        self.steps, self.within = steps, within_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us bigint, id bigint, step int, user bigint")
        # of each user: when the first step was taken, and the ids of the steps so far
        self.taken = handle.getValueState("taken", "user array<bigint>, us array<bigint>, ids array<array<bigint>>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        last = 0
        for part in rows:
            self.waiting.appendList(list(zip(*(part[c].tolist() for c in ("us", "id", "step", "key")), strict=True)))
            last = max(last, int(part["us"].max()))
        self.handle.registerTimer(last // 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted(map(tuple, self.waiting.get())) if self.waiting.exists() else []
        taken = {u: (us, list(ids)) for u, us, ids in zip(*self.taken.get(), strict=True)} if self.taken.exists() else {}
        users, out = [], []
        for us, id_, step, user in rows:
            if us >= passed:
                break
            if step == 0:
                taken[user] = (us, [id_])
                continue
            begun, ids = taken.get(user, (0, []))
            if ids and us - begun > self.within:
                del taken[user]
            elif ids and len(ids) == step:
                ids.append(id_)
                if len(ids) == self.steps:
                    users.append(user)
                    out.append(ids)
                    del taken[user]
        # the others are too late for the steps that are left
        taken = {u: (us, ids) for u, (us, ids) in taken.items() if us + self.within >= passed}
        if taken:
            self.taken.update((list(taken), [us for us, _ in taken.values()], [ids for _, ids in taken.values()]))
            self.handle.registerTimer((max(us for us, _ in taken.values()) + self.within) // 1000 + 1)
        else:
            self.taken.clear()
        left = [r for r in rows if r[0] >= passed]
        self.waiting.put(left) if left else self.waiting.clear()
        if out:
            yield pd.DataFrame({"key": users, "ids": out})

    def close(self) -> None:
        pass


def sequence_stream(events: DataFrame, key: str, tie: str, steps: dict[str, Column], within_s: int, late: str) -> DataFrame:
    """match_sequence() over a stream whose time is `ts`: a match comes out when the watermark has passed its last row.

    Rows may come in any order, as long as they are no later than `late`; later ones, if the rows around them are done,
    are read as if they came now. A row takes the first of the steps that it fits. The state is what waits for the
    watermark and one match in the making for each key, of which a timer ends the wait; keys are numbers, and GROUP
    neighbours share a state.
    """
    step = F.coalesce(*(F.when(c, i) for i, c in enumerate(steps.values())))
    rows = events.withWatermark("ts", late).select(F.col(key).alias("key"), F.unix_micros("ts").alias("us"), F.col(tie).alias("id"), step.cast("int").alias("step"))
    # a filter without the time would be done before the watermark sees the rows that take no step
    rows = rows.where(F.when(F.col("us").isNotNull() & F.col("key").isNotNull() & F.col("id").isNotNull(), F.col("step")).isNotNull())
    out = in_groups(rows, "key").transformWithStateInPandas(Sequence(len(steps), within_s * 1_000_000), "key bigint, ids array<bigint>", "append", "eventTime")
    return out.select(F.col("key").alias(key), *(F.col("ids")[i].alias(n) for i, n in enumerate(steps)))
